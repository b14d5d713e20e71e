"""Operators for training-data pipelines.

Python functions of this subpackage are pickled by value, so executors need not
be able to import it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
