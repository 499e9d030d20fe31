"""strata: medallion-style batch analytics for irregular measurement series on Spark.

Layers (staging -> bronze -> silver -> gold) are plain DataFrames; every operator is a
function from DataFrames and column names to a DataFrame built from Spark built-ins, so
Catalyst plans and distributes the work.

Subpackages
-----------
sources    landing of text files, lineage stamps, layer sinks, driver tables
functions  scalar column expressions (locale parsing, labels, row-wise stats)
operators  profiling, data quality, dedup, dimensions, facts, window attribution,
           statistics and analytical views
plans      the mapping of the driver's tables onto the operators (query registry)
"""

__version__ = "0.1.0"
