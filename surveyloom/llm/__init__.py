"""Operators that prepare training text.

Functions of this package travel to the workers inside the tasks, so executors need no copy of it on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
