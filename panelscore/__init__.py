"""Customer-month panel operators for monthly scoring, on Spark DataFrames.

``functions``  column expressions (months, cleaning, features, scores)
``sources``    readers, control file, month-partitioned sinks
``operators``  DataFrame -> DataFrame operators (rollup, enrichment, profile, drift, compare ...)
``plans``      monthly jobs composed of the operators
``catalog``    the same operators bound to the test tables, with their SQL counterparts
"""
