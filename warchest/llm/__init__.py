"""Operators for training-data corpora.  Nothing outside this folder imports it.

Functions of this package that run on executors travel with the job, so executors need no copy of it."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
