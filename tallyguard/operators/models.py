"""Versions of the stored model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import one_row
from .ordering import with_row_number


def latest_version(models: DataFrame) -> DataFrame:
    """One row ``model_id, created_at``: the newest version."""
    newest = F.max(F.struct("created_at", "model_id"))
    return models.agg(newest.alias("v")).select("v.model_id", "v.created_at")


def latest_rows(models: DataFrame) -> DataFrame:
    """Feature rows of the newest version."""
    newest = latest_version(models).select("model_id")
    return models.join(one_row(newest), "model_id", "left_semi")


def version_tags(models: DataFrame) -> DataFrame:
    """Each version with its number and role.

    Versions are immutable, so nothing is copied before a retraining: the
    version in force before retraining ``k`` is simply number ``k``.
    """
    versions = models.groupBy("model_id").agg(
        F.min("created_at").alias("created_at"),
        F.count("*").alias("features"),
        F.max("n").alias("n"),
    )
    numbered = with_row_number(
        versions.withColumn("__at", F.unix_micros("created_at")),
        "__at",
        width=86_400_000_000,
    )
    role = (
        F.when(F.col("row_no") == 1, "baseline")
        .when(F.col("row_no") == F.col("row_total"), "latest")
        .otherwise(F.concat(F.lit("before_retrain_"), F.col("row_no").cast("string")))
    )
    return numbered.select(
        "model_id", "created_at", "features", "n", F.col("row_no").alias("version"), role.alias("tag")
    )


def compare_models(left: DataFrame, right: DataFrame) -> DataFrame:
    """Shift of mean and deviation per feature between two versions, NULL for a feature of one only."""
    a = left.select("feature", F.col("mean").alias("mean_before"), F.col("std").alias("std_before"))
    b = right.select("feature", F.col("mean").alias("mean_after"), F.col("std").alias("std_after"))
    return a.join(b, "feature", "full").withColumns(
        {
            "mean_shift": F.col("mean_after") - F.col("mean_before"),
            "std_shift": F.col("std_after") - F.col("std_before"),
        }
    )
