"""Operators for preparing language-model training data; see README.md in this folder."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the job: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
