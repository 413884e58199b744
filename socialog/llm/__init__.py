"""Operators of a training-data pipeline; nothing else in the package imports them.

Functions that run inside tasks are shipped by value, so executors need numpy,
pandas and the libraries named in the modules, but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
