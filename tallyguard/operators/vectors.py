"""Fit and score when the features are one array column.

The expressions do not grow with the number of positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import compute_once, finite
from ..session import one_row
from .rules import CONFIDENCE_DIVISOR, STD_FLOOR, VOTE_SHARE, Z_THRESHOLD


def clean_std(mean: Column, std: Column) -> Column:
    """Deviation with rounding noise of a constant feature set to 0."""
    return F.when(std <= F.lit(STD_FLOOR) * F.abs(mean), F.lit(0.0)).otherwise(std)


def fit_vectors(
    df: DataFrame,
    vector: str,
    normal: Column | None = None,
    z_threshold: float = Z_THRESHOLD,
) -> DataFrame:
    """One-row model of a vector column.

    Partial aggregation leaves one row per position and task before the
    shuffle; the final arrays have one entry per position.
    """
    rows = df if normal is None else df.where(normal)
    per_position = (
        rows.select(F.posexplode(vector).alias("pos", "value"))
        .select("pos", finite(F.col("value")).alias("value"))
        .groupBy("pos")
        .agg(
            F.count("*").alias("n"),
            F.avg("value").alias("mean"),
            F.stddev_pop("value").alias("std"),
        )
        .withColumn("std", clean_std(F.col("mean"), F.col("std")))
    )
    ordered = F.array_sort(F.collect_list(F.struct("pos", "mean", "std")))
    return per_position.agg(ordered.alias("stats"), F.max("n").alias("n")).select(
        F.transform("stats", lambda s: s["pos"].cast("string")).alias("features"),
        F.transform("stats", lambda s: s["mean"]).alias("means"),
        F.transform("stats", lambda s: s["std"]).alias("stds"),
        F.coalesce("n", F.lit(0).cast("bigint")).alias("n"),
        F.lit(float(z_threshold)).alias("z_threshold"),
    )


def model_side(model: DataFrame) -> DataFrame:
    """The model row as rows are scored with it; a deviation of 0 becomes NULL."""
    divisors = F.transform("stds", lambda s: F.nullif(s, F.lit(0.0)))
    stats = F.arrays_zip(
        F.col("features").alias("feature"), F.col("means").alias("mean"), divisors.alias("std")
    )
    return one_row(model.select(stats.alias("__stats"), F.col("z_threshold").alias("__limit")))


def z_array(vector: str) -> Column:
    """z of each position; NULL without deviation and for a value that is not finite."""
    return F.zip_with(vector, "__stats", lambda x, s: F.abs(finite(x) - s["mean"]) / s["std"])


def score_vectors(
    df: DataFrame, model: DataFrame, vector: str, vote_share: float = VOTE_SHARE
) -> DataFrame:
    """Add ``prediction`` and ``confidence`` for a vector column."""
    voting = F.filter(z_array(vector), lambda z: z > F.col("__limit"))
    votes, z_sum = F.size("__hot"), F.aggregate("__hot", F.lit(0.0), lambda acc, z: acc + z)
    confidence = F.least(z_sum / (votes * F.lit(CONFIDENCE_DIVISOR)), F.lit(1.0))
    enough = votes > F.size(vector) * F.lit(float(vote_share))
    return (
        compute_once(df.crossJoin(model_side(model)), {"__hot": voting})
        .withColumns(
            {
                "prediction": F.coalesce(enough.cast("int"), F.lit(0)),
                "confidence": F.when(votes > 0, confidence).otherwise(F.lit(0.0)),
            }
        )
        .drop("__stats", "__limit", "__hot")
    )
