"""Operators for preparing training text. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Python workers need not find this package: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
