"""wavefold: longitudinal survey analytics as Spark DataFrame operators."""

import sys as _sys

# Functions shipped to Python workers (pandas UDFs over range partitions) are
# pickled by value, so executors need no copy of this package on their path.
try:
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except (ImportError, AttributeError, ValueError):  # pragma: no cover
    pass
