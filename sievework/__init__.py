"""Screening analytics for published notices and their documents, on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# The few Python functions that run in tasks travel with their code, so that executors need no
# copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
