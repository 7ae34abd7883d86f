"""Confusion counts, metrics and per-category detection rates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ratio
from ..schema import rate_column
from ..session import bounded_broadcast, one_row


def with_share(counts: DataFrame, count: str = "n", share: str = "percent") -> DataFrame:
    """Add each group's percentage of the total; the total is one broadcast row."""
    total = counts.agg(F.sum(count).alias("__total"))
    return (
        counts.crossJoin(one_row(total))
        .withColumn(share, ratio(F.col(count), F.col("__total")) * 100)
        .drop("__total")
    )


def label_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    return with_share(df.groupBy(label).agg(F.count("*").alias("n")))


def confusion_columns(label: str = "label", prediction: str = "prediction") -> list[Column]:
    truth, guess = F.col(label), F.col(prediction)
    return [
        F.count_if((guess == 1) & (truth == 1)).alias("true_positives"),
        F.count_if((guess == 1) & (truth == 0)).alias("false_positives"),
        F.count_if((guess == 0) & (truth == 0)).alias("true_negatives"),
        F.count_if((guess == 0) & (truth == 1)).alias("false_negatives"),
        F.count("*").alias("total_samples"),
    ]


def confusion_matrix(
    scored: DataFrame, label: str = "label", by: Sequence[str] = ()
) -> DataFrame:
    return scored.groupBy(*by).agg(*confusion_columns(label))


def with_metrics(confusion: DataFrame) -> DataFrame:
    """Add accuracy, precision, recall and F1; 0 where a denominator is 0."""
    tp, fp = F.col("true_positives"), F.col("false_positives")
    tn, fn = F.col("true_negatives"), F.col("false_negatives")
    rates = confusion.withColumns(
        {
            "accuracy": ratio(tp + tn, F.col("total_samples")),
            "precision": ratio(tp, tp + fp),
            "recall": ratio(tp, tp + fn),
        }
    )
    p, r = F.col("precision"), F.col("recall")
    return rates.withColumn("f1_score", ratio(F.lit(2.0) * p * r, p + r))


def classification_metrics(
    scored: DataFrame, label: str = "label", by: Sequence[str] = ()
) -> DataFrame:
    return with_metrics(confusion_matrix(scored, label, by))


def detection_rate_by_category(
    scored: DataFrame, targets: Sequence[str], category: str = "category"
) -> DataFrame:
    """Detected share of each target category; a category without rows gives 0."""
    found = (
        scored.where(F.col(category).isin(*targets))
        .groupBy(category)
        .agg(
            F.count_if(F.col("prediction") == 1).alias("detected"),
            F.count("*").alias("total"),
        )
    )
    wanted = scored.sparkSession.createDataFrame([(t,) for t in targets], f"{category} string")
    return wanted.join(bounded_broadcast(found, len(targets)), category, "left").select(
        category,
        F.coalesce("detected", F.lit(0)).alias("detected"),
        F.coalesce("total", F.lit(0)).alias("total"),
        ratio(F.col("detected"), F.col("total")).alias("rate"),
    )


def evaluate_model(
    scored: DataFrame,
    targets: Mapping[str, str],
    label: str = "label",
    category: str = "category",
    by: Sequence[str] = (),
    extra: Sequence[Column] = (),
) -> DataFrame:
    """Confusion counts, metrics and one detection rate per target, in one pass.

    ``targets`` maps the short name of each rate column to a category value;
    ``by`` gives one row per group, for example per cycle.
    """
    hits = []
    for i, value in enumerate(targets.values()):
        member = F.col(category) == value
        hits.append(F.count_if(member & (F.col("prediction") == 1)).alias(f"__hit{i}"))
        hits.append(F.count_if(member).alias(f"__all{i}"))
    counted = scored.groupBy(*by).agg(*confusion_columns(label), *extra, *hits)
    rates = {
        rate_column(name): ratio(F.col(f"__hit{i}"), F.col(f"__all{i}"))
        for i, name in enumerate(targets)
    }
    helpers = [f"__{kind}{i}" for i in range(len(targets)) for kind in ("hit", "all")]
    return with_metrics(counted).withColumns(rates).drop(*helpers)


def training_summary(
    scored: DataFrame,
    label: str = "label",
    min_confidence: float = 0.4,
    vote_share: float = 0.10,
    z_threshold: float = 1.4,
    model_id: str = "",
    created_at: Column | None = None,
) -> DataFrame:
    """One row of training metrics, as the training log keeps it."""
    alerted = (F.col("prediction") == 1) & (F.col("confidence") >= F.lit(float(min_confidence)))
    counted = scored.agg(
        *confusion_columns(label),
        F.count_if(F.col(label) == 0).alias("normal_samples"),
        F.count_if(alerted).alias("high_confidence_alerts"),
    )
    return with_metrics(counted).select(
        (created_at if created_at is not None else F.current_timestamp()).alias("ts"),
        F.lit(model_id).alias("model_id"),
        "accuracy",
        "precision",
        "recall",
        "f1_score",
        "total_samples",
        "normal_samples",
        (F.col("total_samples") - F.col("normal_samples")).alias("anomaly_samples"),
        "true_positives",
        "false_positives",
        "true_negatives",
        "false_negatives",
        "high_confidence_alerts",
        F.lit(float(min_confidence)).alias("confidence_threshold"),
        F.lit(float(vote_share)).alias("detection_threshold"),
        F.lit(float(z_threshold)).alias("z_score_threshold"),
    )
