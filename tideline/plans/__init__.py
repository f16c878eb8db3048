"""The twelve warehouse jobs, composed only from the operators."""
