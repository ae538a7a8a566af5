"""Rosterloom: guard, match, publish, audit and erase registrant lists with PySpark.

Every operator is a function from DataFrame(s) to DataFrame; only sinks and streaming
starters run actions.  Start with :mod:`rosterloom.plans.pipeline`.
"""

__version__ = "0.1.0"

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Functions that run inside tasks travel by value, so executors need no copy of the package.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
