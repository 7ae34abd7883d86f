"""Mergeable state of a stream in few parts, folded in a geometric schedule.

After batch ``b`` the state is held by one part for each one in the binary form
of ``b + 1``: batch 12 leaves parts over the batches 0 to 7, 8 to 11 and 12.  A
batch writes a single part, which takes in the parts that it makes needless, so
each row of state is merged about log2(n) times and a reader opens about log2(n)
parts.  Which parts these are follows from the number of the batch, so nothing is
listed and no pointer is kept.

A batch that is run again finds its inputs still there and overwrites its own
part: parts are removed only by the batch after the one that made them needless,
when that one has been committed.  A batch without rows leaves a gap, which
counts as empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import join_path
from . import store

Span = tuple[int, int]


def spans(batches: int) -> list[Span]:
    """First and last batch of each part that holds the first ``batches`` batches."""
    found, first = [], 0
    for bit in reversed(range(batches.bit_length())):
        if batches >> bit & 1:
            found.append((first, first + (1 << bit) - 1))
            first += 1 << bit
    return found


def span_of(batch_id: int) -> Span:
    """The part that a batch writes."""
    return spans(batch_id + 1)[-1]


def _path(folder: str, span: Span) -> str:
    return join_path(folder, f"batches-{span[0]:09d}-{span[1]:09d}")


def stored_spans(spark: SparkSession, folder: str) -> list[Span]:
    """The complete parts that are there, needless ones of the newest fold included."""
    found = [tuple(map(int, name.split("-")[1:])) for name in store.names(spark, folder) if name.startswith("batches-")]
    return sorted(span for span in found if store.is_complete(spark, _path(folder, span)))


def schema_of(spark: SparkSession, folder: str, span: Span) -> T.StructType:
    return spark.read.parquet(_path(folder, span)).schema


def _read(spark: SparkSession, folder: str, wanted: list[Span], schema: T.StructType) -> DataFrame | None:
    paths = [_path(folder, span) for span in wanted]
    paths = [path for path in paths if store.is_complete(spark, path)]
    return spark.read.schema(schema).parquet(*paths) if paths else None


def read_state(spark: SparkSession, folder: str, schema: T.StructType, upto: int) -> DataFrame | None:
    """Parts with the state after batch ``upto``; None without any."""
    return _read(spark, folder, spans(upto + 1), schema)


def fold_part(
    rows: DataFrame, folder: str, batch_id: int, merge: Callable[[DataFrame], DataFrame]
) -> None:
    """Add the state of one batch; ``merge`` takes rows of several parts to those of one.

    A batch that a later one has followed is committed; run again, it changes nothing.
    """
    spark, mine = rows.sparkSession, span_of(batch_id)
    if any(last > batch_id for _, last in stored_spans(spark, folder)):
        return
    before = spans(batch_id)
    inputs = [span for span in before if span[0] >= mine[0]]
    older = _read(spark, folder, inputs, rows.schema)
    merged = merge(rows if older is None else older.unionByName(rows))
    merged.coalesce(1).write.mode("overwrite").parquet(_path(folder, mine))
    for span in spans(batch_id - 1) if batch_id else []:
        if span not in before:  # taken in by the batch before, which is committed
            store.remove(spark, _path(folder, span))
