"""Operators for preparing training text at scale.

Nothing outside this package imports it; `__spark_entry__.py` adds its
queries when it can be imported.
"""

import sys

from pyspark import cloudpickle

# the functions that run in Python workers travel with the tasks, so that
# executors need no installed copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
