"""Retrieval question answering as Spark jobs: corpus, search, answers, scores."""

import sys

from pyspark import cloudpickle

# Task functions travel with their code, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
