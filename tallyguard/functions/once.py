"""Columns that are evaluated once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, cols: dict[str, Column]) -> DataFrame:
    """Add columns that later filters refer to by value.

    A filter on a plain projected column is pushed below the projection, with
    the column's whole expression copied into it for each use; for a parsed
    JSON line or a sum over all features that repeats the work many times.
    Columns made by a generator are computed first and then filtered.
    """
    row = F.struct(*[col.alias(name) for name, col in cols.items()])
    return df.select("*", F.inline_outer(F.array(row)))
