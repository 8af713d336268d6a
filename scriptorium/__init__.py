"""Script-corpus analytics as lazy DataFrame operators."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the plan, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
