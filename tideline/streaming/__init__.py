"""State processors behind the streaming form of the stateful operators."""

import sys

from pyspark import cloudpickle

# Processors travel with the query, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
