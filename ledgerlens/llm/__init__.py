"""Operators for preparing training data. Nothing outside this folder imports it."""

import ledgerlens
from pyspark import cloudpickle

# functions that run on executors travel with the job, so workers need no copy of the package
cloudpickle.register_pickle_by_value(ledgerlens)
