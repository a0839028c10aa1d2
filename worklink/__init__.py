"""Seeker-to-job matching analytics as composable, lazy PySpark DataFrame functions."""

import sys

from pyspark import cloudpickle

# functions that run in Python workers travel with the job; `session.ship` sends the classes of broadcast values
cloudpickle.register_pickle_by_value(sys.modules[__name__])
