"""Operators for preparing training text. Nothing else in the library imports this subpackage.

Functions that run inside tasks are shipped with the tasks, so executors need no copy of the code.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
