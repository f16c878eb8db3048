"""Topic, upsert-table, dimension and summary writers."""
