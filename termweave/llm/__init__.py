"""Operators that prepare text for training language models.

Nothing else in the package imports this subpackage.  Its functions are pickled by value, so executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
