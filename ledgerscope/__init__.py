"""ledgerscope: Spark-native payment-fraud analytics.

Layers: ``sources`` (raw CSV, fixtures, layer tables), ``functions``
(column expressions, surrogate keys, sampling), ``operators`` (ingest,
quality, features, reports, dashboard data, metrics), ``ml`` (model
workflow), ``plans`` (layer pipeline, registry, oracle SQL) and
``streaming`` (Structured Streaming scoring and windowed reports).
"""

import sys

from pyspark import cloudpickle

# Task closures carry the package's functions by value: executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
