"""riskloom: scorecard operators for binary-outcome risk models on Spark DataFrames."""

import sys as _sys

__version__ = "0.1.0"

# Functions of this package used inside Python UDFs (mapInPandas partial sums)
# are pickled by value, so executors need no copy of the package on their
# path (no --py-files / PYTHONPATH setup for the workers).
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - pickling by reference still works with --py-files
    pass
