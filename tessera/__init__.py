"""tessera: Spark-native demand, placement and sensor analytics.

Subpackages
-----------
``sources``    readers, text parsers and sinks
``functions``  native column functions (text -> arrays, dates, codes)
``operators``  matrices, profiles, placement, staged aggregates, ML
``streaming``  message decoding and prequential (test-then-train) runs
``plans``      the named queries over the driver tables and their SQL twins
"""

__version__ = "0.1.0"
