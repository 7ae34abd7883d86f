"""Registry of queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, sf: comparable(run(spark, sf))
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def comparable(df: DataFrame) -> DataFrame:
    """Round doubles to 6 places and write times as text, as the SQL does.

    Adding 0.0 turns a negative zero into zero.
    """
    changes = {}
    for name, kind in df.dtypes:
        if kind in ("double", "float"):
            changes[name] = F.round(F.col(name).cast("double"), 6) + F.lit(0.0)
        elif kind in ("timestamp", "timestamp_ntz"):
            changes[name] = F.date_format(name, TIME_FORMAT)
    return df.withColumns(changes) if changes else df
