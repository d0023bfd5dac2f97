"""Scoring and curation of conversation corpora, written as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks are sent with the plan, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
