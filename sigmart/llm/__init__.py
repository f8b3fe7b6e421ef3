"""Operators for preparing training corpora, their queries, and the SQL some of them are compared with."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the task, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
