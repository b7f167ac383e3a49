"""Transaction risk scoring and drift monitoring as Spark jobs."""

import sys

from pyspark import cloudpickle

# Python helpers inside tasks travel with the job, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
