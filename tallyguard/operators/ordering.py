"""Row numbers, previous rows and running maxima over one long ordered series.

A window without partition keys would send the whole series to one task.
These cut the order column into chunks, work inside each chunk, and carry one
summary row per chunk across: only the summaries, ``width`` times fewer, meet
in one place.  Rows without an order value come first, as in a window, in a
chunk of their own; NULL is a group of ``by`` like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CHUNK_WIDTH = 10_000
_CHUNK = "__chunk"
# Below the chunk of every order value.
_NO_ORDER = -(2**63)


def _chunked(df: DataFrame, order: str, width: int) -> DataFrame:
    chunk = F.floor(F.col(order) / F.lit(width))
    return df.withColumn(_CHUNK, F.coalesce(chunk, F.lit(_NO_ORDER)))


def _with_summary(work: DataFrame, summary: DataFrame, by: Sequence[str]) -> DataFrame:
    """``work`` with the summary of its chunk; NULL groups meet as well."""
    if not by:
        return work.join(summary, _CHUNK)
    other = summary.withColumnsRenamed({c: f"__of_{c}" for c in (*by, _CHUNK)})
    same = F.col(_CHUNK) == F.col(f"__of_{_CHUNK}")
    for c in by:
        same &= F.col(c).eqNullSafe(F.col(f"__of_{c}"))
    return work.join(other, same).drop(*[f"__of_{c}" for c in (*by, _CHUNK)])


def with_row_number(
    df: DataFrame, order: str, by: Sequence[str] = (), width: int = CHUNK_WIDTH
) -> DataFrame:
    """Add ``row_no`` (from 1) in ``order`` and ``row_total``, within each ``by``."""
    work = _chunked(df, order, width)
    keys = [*by, _CHUNK]
    upto = Window.partitionBy(*by).orderBy(_CHUNK)
    starts = (
        work.groupBy(*keys)
        .agg(F.count("*").alias("__n"))
        .withColumns(
            {
                "__start": F.sum("__n").over(upto) - F.col("__n"),
                "row_total": F.sum("__n").over(Window.partitionBy(*by)),
            }
        )
        .drop("__n")
    )
    inside = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    return (
        _with_summary(work, starts, by)
        .withColumn("row_no", F.col("__start") + inside)
        .drop(_CHUNK, "__start")
    )


def with_previous(
    df: DataFrame,
    order: str,
    cols: Sequence[str],
    by: Sequence[str] = (),
    width: int = CHUNK_WIDTH,
) -> DataFrame:
    """Add ``previous``, a struct of ``cols`` of the row before, NULL for the first."""
    work = _chunked(df, order, width)
    keys = [*by, _CHUNK]
    row = F.struct(*cols)
    tails = (
        work.groupBy(*keys)
        .agg(F.max_by(row, F.struct(order, *cols)).alias("__tail"))
        .withColumn("__before", F.lag("__tail").over(Window.partitionBy(*by).orderBy(_CHUNK)))
        .drop("__tail")
    )
    inside = F.lag(row).over(Window.partitionBy(*keys).orderBy(order, *cols))
    return (
        _with_summary(work, tails, by)
        .withColumn("previous", F.coalesce(inside, F.col("__before")))
        .drop(_CHUNK, "__before")
    )


def with_running_max(
    df: DataFrame,
    order: str,
    col: str,
    into: str,
    by: Sequence[str] = (),
    width: int = CHUNK_WIDTH,
) -> DataFrame:
    """Add ``into``, the largest ``col`` up to and including each row."""
    work = _chunked(df, order, width)
    keys = [*by, _CHUNK]
    earlier = (
        Window.partitionBy(*by).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    )
    peaks = (
        work.groupBy(*keys)
        .agg(F.max(col).alias("__peak"))
        .withColumn("__before", F.max("__peak").over(earlier))
        .drop("__peak")
    )
    inside = F.max(col).over(
        Window.partitionBy(*keys)
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        _with_summary(work, peaks, by)
        .withColumn(into, F.greatest(inside, F.col("__before")))
        .drop(_CHUNK, "__before")
    )
