"""Operators for preparing training text; nothing else in the library imports this.

What Python tasks run is sent to them whole, so executors need not have this package on
their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
