"""Operators for building training corpora.

Nothing outside this package imports it. Functions that run on executors are
pickled by value, so executors need the libraries but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
