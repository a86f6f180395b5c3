"""Operators of a training-data pipeline. Nothing outside this subpackage imports it.

Functions that run on executors are sent by value, so workers need not have the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
