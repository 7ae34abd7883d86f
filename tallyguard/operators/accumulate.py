"""Combine snapshots with each other and with the original training data."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .encode import align_schema, normalize_headers
from .evaluate import with_share
from .sampling import has_at_least

# Fixed values.
MIN_NEW_ROWS = 50
SNAPSHOT_ID = "snapshot_id"


class SchemaMismatch(ValueError):
    """A snapshot has a column the first snapshot does not have."""


def _union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, parts)


def union_snapshots(snapshots: Sequence[DataFrame], strict: bool = True) -> DataFrame | None:
    """All rows of all snapshots in the columns of the first one.

    A column missing later becomes ``''`` (text) or NULL.  An extra column is
    an error when ``strict`` and dropped otherwise.
    """
    if not snapshots:
        return None
    header = dict(snapshots[0].dtypes)
    extra = sorted({c for s in snapshots for c in s.columns} - set(header))
    if strict and extra:
        raise SchemaMismatch(f"columns not in the first snapshot: {', '.join(extra)}")
    return _union_all([align_schema(s, header) for s in snapshots])


def accumulate_distinct(snapshots: DataFrame | Sequence[DataFrame]) -> DataFrame | None:
    """Distinct rows of all snapshots.

    Takes a snapshot table or a list of snapshots.  Copies collapse in the
    partial aggregate, before the shuffle, however many there are of a row.
    """
    if not isinstance(snapshots, DataFrame):
        snapshots = union_snapshots(snapshots)
        if snapshots is None:
            return None
    return snapshots.drop(SNAPSHOT_ID).dropDuplicates()


def accumulation_gate(snapshots: DataFrame, minimum: int = MIN_NEW_ROWS) -> DataFrame:
    """Whether the snapshots hold enough rows, counting every row of each."""
    return snapshots.agg(F.count("*").alias("rows")).select(
        "rows", F.lit(minimum).alias("minimum"), (F.col("rows") >= minimum).alias("ready")
    )


def combine_training(
    original: DataFrame,
    snapshots: DataFrame | None,
    min_new: int = MIN_NEW_ROWS,
    dedup: bool = False,
) -> DataFrame | None:
    """Original rows and all snapshot rows in the columns of the original.

    Without snapshots it is the original; with fewer than ``min_new`` snapshot
    rows there is nothing to train on yet and the result is None.  Snapshots
    are copies of one growing table, so by default a row counts once for each
    snapshot that has it; ``dedup`` counts it once.
    """
    base = normalize_headers(original)
    if snapshots is None:
        return base
    if not has_at_least(snapshots, min_new):
        return None
    rows = align_schema(snapshots.drop(SNAPSHOT_ID), dict(base.dtypes))
    combined = base.union(rows)
    return combined.dropDuplicates() if dedup else combined


def combine_snapshots_fallback(
    accumulated: DataFrame | None, snapshots: DataFrame | None, minimum: int
) -> DataFrame | None:
    """The accumulated table, or all snapshot rows when it is too small."""
    if accumulated is not None and has_at_least(accumulated, minimum):
        return accumulated
    return accumulated if snapshots is None else snapshots.drop(SNAPSHOT_ID)


def training_mix(original: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Rows and percentage of the training data by origin."""

    def counted(df: DataFrame, origin: str) -> DataFrame:
        return df.agg(F.count("*").alias("n")).select(F.lit(origin).alias("origin"), "n")

    return with_share(counted(original, "original").union(counted(snapshots, "accumulated")))
