"""Baselines that grow: count, mean and squared deviation per feature and part.

The moments of a union of parts follow from the moments of the parts, and those of
the rest from the whole and a part that is taken out.  So a retraining reads only
the rows that are new since the last one, also when test rows are held out later.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import finite
from .rules import Z_THRESHOLD
from .vectors import clean_std


def feature_moments(df: DataFrame, features: Sequence[str], normal: Column) -> DataFrame:
    """One row per feature over the normal rows, and the size of the part."""
    stats = []
    for i, name in enumerate(features):
        value = F.when(normal, finite(F.col(name)))
        stats += [
            F.count(value).alias(f"n{i}"),
            F.avg(value).alias(f"m{i}"),
            F.var_pop(value).alias(f"v{i}"),
        ]
    measured = df.agg(F.count_if(normal).alias("normal_rows"), F.count("*").alias("part_rows"), *stats)
    rows = [
        F.struct(
            F.lit(name).alias("feature"),
            F.col(f"n{i}").alias("value_count"),
            F.col(f"m{i}").alias("mean"),
            (F.col(f"v{i}") * F.col(f"n{i}")).alias("m2"),
            "normal_rows",
            "part_rows",
        )
        for i, name in enumerate(features)
    ]
    return measured.select(F.inline(F.array(*rows)))


def union_moments(moments: DataFrame) -> DataFrame:
    """Moments of all parts together, in the same form: one row per feature."""
    together = Window.partitionBy("feature")
    centred = moments.withColumn("__all", F.sum("value_count").over(together)).withColumn(
        "__mean", F.sum(F.col("mean") * F.col("value_count")).over(together) / F.nullif("__all", F.lit(0))
    )
    shift = F.col("mean") - F.col("__mean")
    return centred.groupBy("feature").agg(
        F.sum("value_count").alias("value_count"),
        F.max("__mean").alias("mean"),
        F.sum(F.col("m2") + F.col("value_count") * shift * shift).alias("m2"),
        F.sum("normal_rows").alias("normal_rows"),
        F.sum("part_rows").alias("part_rows"),
    )


def subtract_moments(whole: DataFrame, part: DataFrame) -> DataFrame:
    """Moments of the rows of ``whole`` that are not in ``part``, which must be some of them.

    The inverse of a merge: neither the whole nor the rest is read again.  Both
    sides have one row per feature (see ``union_moments``).  What rounding takes
    below zero is zero, and a rest without values has no mean.
    """
    gone = part.select("feature", *[F.col(c).alias(f"__{c}") for c in part.columns if c != "feature"])
    both = whole.join(F.broadcast(gone), "feature", "left")

    def without(name: str) -> Column:
        return F.col(name) - F.coalesce(F.col(f"__{name}"), F.lit(0))

    part_sum = F.coalesce(F.col("__mean") * F.col("__value_count"), F.lit(0.0))
    rest = both.withColumn("__rest", without("value_count")).withColumn(
        "__rest_mean", (F.col("mean") * F.col("value_count") - part_sum) / F.nullif("__rest", F.lit(0))
    )
    shift = F.col("__mean") - F.col("__rest_mean")
    between = F.coalesce(
        shift * shift * F.col("__rest") * F.col("__value_count") / F.nullif("value_count", F.lit(0)), F.lit(0.0)
    )
    return rest.select(
        "feature",
        F.col("__rest").alias("value_count"),
        F.col("__rest_mean").alias("mean"),
        F.when(F.col("__rest") > 0, F.greatest(without("m2") - between, F.lit(0.0))).alias("m2"),
        without("normal_rows").alias("normal_rows"),
        without("part_rows").alias("part_rows"),
    )


def merge_moments(
    moments: DataFrame, features: Sequence[str], z_threshold: float = Z_THRESHOLD
) -> DataFrame:
    """One-row model of all parts together, the same as a fit on their union.

    There is one row per feature and part, never one per data row.
    """

    def pick(name: str, col: Column) -> Column:
        return F.max(F.when(F.col("feature") == name, col))

    std = clean_std(F.col("mean"), F.sqrt(F.col("m2") / F.nullif("value_count", F.lit(0))))
    return union_moments(moments).agg(
        F.array(*[F.lit(f) for f in features]).alias("features"),
        F.array(*[pick(f, F.col("mean")) for f in features]).alias("means"),
        F.array(*[pick(f, std) for f in features]).alias("stds"),
        F.coalesce(pick(features[0], F.col("normal_rows")), F.lit(0)).alias("n"),
        F.lit(float(z_threshold)).alias("z_threshold"),
    )
