"""Baseline modelling, scoring and monitoring of flow tables on Spark.

Every operator takes DataFrames and returns DataFrames.  The caller names the
feature, label, category and key columns; nothing is tied to one table.
"""

__version__ = "0.1.0"
