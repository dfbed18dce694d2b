"""matchlake: sports-match analytics as Spark DataFrame jobs.

Layers: ``sources`` (driver-table projection, raw JSON payloads, tables),
``plans`` (request planning), ``functions`` (column expressions),
``operators`` (silver/gold transformations, joins, rolling windows),
``ml`` (features, models, evaluation) and ``streaming`` (incremental ingest).
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with the tasks, so the
# package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
