"""Registered queries over the test tables and their SQL counterparts."""

import sys

from pyspark import cloudpickle

# The stand-in models travel with their code as well.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
