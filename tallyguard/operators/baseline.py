"""Fit the baseline: mean and population deviation of each feature on normal rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import finite
from .rules import MODEL_TYPE, WIDE_FIT, Z_THRESHOLD, Z_THRESHOLD_IF_MISSING
from .vectors import clean_std, fit_vectors


def fit_baseline(
    df: DataFrame,
    features: Sequence[str],
    normal: Column | None = None,
    z_threshold: float = Z_THRESHOLD,
) -> DataFrame:
    """One-row model ``features, means, stds, n, z_threshold``.

    A single aggregate with a partial and a final step; no row is shuffled.
    Without normal rows ``n`` is 0 and the statistics are NULL: such a model
    predicts nothing, and saving it is refused.
    """
    names = F.array(*[F.lit(f) for f in features])
    rows = df if normal is None else df.where(normal)
    if len(features) > WIDE_FIT:
        vector = F.array(*[F.col(f).cast("double") for f in features])
        fitted = fit_vectors(rows.select(vector.alias("__v")), "__v", None, z_threshold)
        return fitted.withColumn("features", names)
    stats = [F.count("*").alias("n")]
    for i, name in enumerate(features):
        value = finite(F.col(name))
        stats.append(F.avg(value).alias(f"mean_{i}"))
        stats.append(F.stddev_pop(value).alias(f"std_{i}"))
    means = [F.col(f"mean_{i}") for i in range(len(features))]
    stds = [F.col(f"std_{i}") for i in range(len(features))]
    return rows.agg(*stats).select(
        names.alias("features"),
        F.array(*means).alias("means"),
        F.array(*[clean_std(m, s) for m, s in zip(means, stds)]).alias("stds"),
        "n",
        F.lit(float(z_threshold)).alias("z_threshold"),
    )


def fit_baselines(
    df: DataFrame,
    features: Sequence[str],
    normals: Mapping[str, Column],
    z_threshold: float = Z_THRESHOLD,
    name: str = "baseline",
) -> DataFrame:
    """One model row for each entry of ``normals``, all of them in a single scan.

    The statistics of each model are conditional aggregates over its own normal
    rows.  ``score`` takes all the rows at once when given ``by=name``.
    """
    stats = []
    for k, normal in enumerate(normals.values()):
        stats.append(F.count_if(normal).alias(f"n_{k}"))
        for i, feature in enumerate(features):
            value = F.when(normal, finite(F.col(feature)))
            stats += [F.avg(value).alias(f"mean_{k}_{i}"), F.stddev_pop(value).alias(f"std_{k}_{i}")]
    models = []
    for k, model in enumerate(normals):
        pairs = [(F.col(f"mean_{k}_{i}"), F.col(f"std_{k}_{i}")) for i in range(len(features))]
        models.append(
            F.struct(
                F.lit(model).alias(name),
                F.array(*[F.lit(f) for f in features]).alias("features"),
                F.array(*[m for m, _ in pairs]).alias("means"),
                F.array(*[clean_std(m, s) for m, s in pairs]).alias("stds"),
                F.col(f"n_{k}").alias("n"),
                F.lit(float(z_threshold)).alias("z_threshold"),
            )
        )
    return df.agg(*stats).select(F.inline(F.array(*models)))


def model_rows(
    model: DataFrame,
    model_id: str | Column,
    created_at: Column,
    model_type: str = MODEL_TYPE,
) -> DataFrame:
    """Long form of a one-row model, one row per feature, as it is stored."""
    ident = F.lit(model_id) if isinstance(model_id, str) else model_id
    return model.select(
        ident.alias("model_id"),
        created_at.cast("timestamp").alias("created_at"),
        F.posexplode(F.arrays_zip("features", "means", "stds")).alias("pos", "stat"),
        "n",
        "z_threshold",
    ).select(
        "model_id",
        "created_at",
        F.col("stat.features").alias("feature"),
        "pos",
        F.col("stat.means").alias("mean"),
        F.col("stat.stds").alias("std"),
        "n",
        "z_threshold",
        F.lit(model_type).alias("model_type"),
    )


def model_from_rows(rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """One-row model from stored rows of one version.

    Statistics are looked up by feature name, so the stored order is free.  A
    feature the model does not know gets NULL and casts no vote.
    """

    def pick(name: str, value: str) -> Column:
        return F.max(F.when(F.col("feature") == name, F.col(value)))

    return rows.agg(
        F.array(*[F.lit(f) for f in features]).alias("features"),
        F.array(*[pick(f, "mean") for f in features]).alias("means"),
        F.array(*[pick(f, "std") for f in features]).alias("stds"),
        F.max("n").alias("n"),
        F.coalesce(F.max("z_threshold"), F.lit(Z_THRESHOLD_IF_MISSING)).alias("z_threshold"),
    )
