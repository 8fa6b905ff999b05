"""Zone-by-month panel analytics written as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# helpers used inside tasks travel with the job, so workers need no installed package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
