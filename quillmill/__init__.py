"""Corpus preparation and language-model evaluation as PySpark DataFrame functions."""

import sys

from pyspark import cloudpickle

# The few Python helpers that run inside tasks travel with the job, so executors
# need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
