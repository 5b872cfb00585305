"""Customer-churn analytics on Spark: tables, features, statistics, models and streams."""

import sys

from pyspark import cloudpickle

# The few Python functions that run in tasks travel with the job, so executors need numpy and
# pandas but no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
