"""aerolake: a Spark-native analytics engine for station time series.

Sub-packages
------------
operators   DataFrame -> DataFrame operators (quality flags, windows, merges, the general data-preparation operators)
functions   column expressions (time, physics, text, statistics)
sources     parsers for raw instrument files, built on binaryFile / text scans
streaming   Structured Streaming forms of the windowed aggregates
plans       the named queries over the driver's tables and their SQL
"""

__version__ = "0.1.0"
