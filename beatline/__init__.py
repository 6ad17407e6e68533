"""beatline: incident analytics on Spark DataFrames.

Sub-packages: ``sources`` (typed CSV / text / Parquet readers and the
stand-in views), ``functions`` (column expressions), ``operators`` (joins,
nearest station, ranks, profiles), ``plans`` (the composite questions) and
``streaming`` (the same counts over a file stream).
"""

__version__ = "0.1.0"
