"""Table checks: each gives rows ``check_name, passed, detail``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ratio
from ..schema import HISTORY_COUNTS, HISTORY_METRICS

# Fixed values.
MODEL_FIELDS = ("created_at", "feature", "mean", "std", "z_threshold", "model_type")
ALERT_FIELDS = ("ts", "prediction", "confidence")
HISTORY_FIELDS = ("iteration", "ts", *HISTORY_METRICS, *HISTORY_COUNTS)


def _checks(measured: DataFrame, *checks: tuple[str, Column, Column]) -> DataFrame:
    """Turn a one-row aggregate into one row per check."""
    rows = [
        F.struct(
            F.lit(name).alias("check_name"),
            F.coalesce(passed, F.lit(False)).alias("passed"),
            F.coalesce(detail.cast("string"), F.lit("")).alias("detail"),
        )
        for name, passed, detail in checks
    ]
    return measured.select(F.inline(F.array(*rows)))


def _number_text(col: Column) -> Column:
    return F.format_string("%.3f", col.cast("double"))


def _missing(df: DataFrame, fields: Sequence[str]) -> list[str]:
    return [f for f in fields if f not in df.columns]


def _has_columns(missing: list[str]) -> tuple[str, Column, Column]:
    return ("required_columns", F.lit(not missing), F.lit(",".join(missing)))


def _missing_only(df: DataFrame, missing: list[str]) -> DataFrame:
    one = df.sparkSession.range(1)
    return _checks(one, _has_columns(missing))


def check_model(models: DataFrame) -> DataFrame:
    """Stored rows of one model: fields, statistics for each feature, a threshold."""
    missing = _missing(models, MODEL_FIELDS)
    if missing:
        return _missing_only(models, missing)
    measured = models.agg(
        F.count("*").alias("features"),
        F.count("mean").alias("means"),
        F.count("std").alias("stds"),
        F.count_if(F.col("std") < 0).alias("negative"),
        F.min("z_threshold").alias("low"),
        F.max("z_threshold").alias("high"),
        F.min("model_type").alias("model_type"),
    )
    return _checks(
        measured,
        _has_columns(missing),
        (
            "equal_length",
            (F.col("means") == F.col("features")) & (F.col("stds") == F.col("features")),
            F.col("features"),
        ),
        ("std_not_negative", F.col("negative") == 0, F.col("negative")),
        ("one_threshold", F.col("low") == F.col("high"), _number_text(F.col("low"))),
        ("model_type", F.col("model_type").isNotNull(), F.col("model_type")),
    )


def check_alerts(alerts: DataFrame) -> DataFrame:
    missing = _missing(alerts, ALERT_FIELDS)
    if missing:
        return _missing_only(alerts, missing)
    filled = [F.col(f).isNotNull() for f in ALERT_FIELDS]
    measured = alerts.agg(
        F.count("*").alias("n"),
        F.count_if(~(filled[0] & filled[1] & filled[2])).alias("unfilled"),
        F.count_if(~F.col("confidence").between(0.0, 1.0)).alias("outside"),
        F.coalesce(F.avg("confidence"), F.lit(0.0)).alias("mean"),
    )
    return _checks(
        measured,
        _has_columns(missing),
        ("fields_filled", F.col("unfilled") == 0, F.col("unfilled")),
        ("confidence_range", F.col("outside") == 0, F.col("outside")),
        ("count", F.lit(True), F.col("n")),
        ("mean_confidence", F.lit(True), _number_text(F.col("mean"))),
    )


def check_history(history: DataFrame, order: str = "iteration") -> DataFrame:
    missing = _missing(history, HISTORY_FIELDS)
    if missing:
        return _missing_only(history, missing)
    outside = [
        F.count_if(~F.coalesce(F.col(m).between(0.0, 1.0), F.lit(False))).alias(f"bad_{m}")
        for m in HISTORY_METRICS
    ]
    measured = history.agg(
        F.count("*").alias("n"),
        *outside,
        F.max_by("accuracy", order).alias("accuracy"),
        F.max_by("recall", order).alias("recall"),
    )
    return _checks(
        measured,
        _has_columns(missing),
        ("not_empty", F.col("n") > 0, F.col("n")),
        *[
            (f"{m}_range", (F.col("n") > 0) & (F.col(f"bad_{m}") == 0), F.col(f"bad_{m}"))
            for m in HISTORY_METRICS
        ],
        ("latest_accuracy", F.col("accuracy").isNotNull(), _number_text(F.col("accuracy"))),
        ("latest_recall", F.col("recall").isNotNull(), _number_text(F.col("recall"))),
    )


def _shares(df: DataFrame, label: str, *extra: Column) -> DataFrame:
    counted = df.agg(
        F.count("*").alias("n"),
        F.count_if(F.col(label) == 0).alias("normals"),
        F.count_if(F.col(label) == 1).alias("anomalies"),
        *extra,
    )
    return counted.withColumns(
        {
            "normal_percent": ratio(F.col("normals"), F.col("n")) * 100,
            "anomaly_percent": ratio(F.col("anomalies"), F.col("n")) * 100,
        }
    )


def _within(name: str, bounds: tuple[float, float]) -> tuple[str, Column, Column]:
    return (name, F.col(name).between(*map(float, bounds)), _number_text(F.col(name)))


def check_distribution(
    df: DataFrame,
    label: str = "label",
    normal_range: tuple[float, float] = (20, 40),
    anomaly_range: tuple[float, float] = (60, 80),
) -> DataFrame:
    """Shares of normal and anomalous rows, in percent, against bounds."""
    return _checks(
        _shares(df, label),
        ("not_empty", F.col("n") > 0, F.col("n")),
        ("normal_count", F.lit(True), F.col("normals")),
        ("anomaly_count", F.lit(True), F.col("anomalies")),
        _within("normal_percent", normal_range),
        _within("anomaly_percent", anomaly_range),
    )


def check_test_set(
    test: DataFrame,
    size: int,
    allowed: Sequence[str],
    label: str = "label",
    category: str = "category",
    normal_range: tuple[float, float] = (60, 85),
    anomaly_range: tuple[float, float] = (15, 40),
) -> DataFrame:
    """Size, shares and categories of a test set.

    ``categories`` gives the number of rows of unexpected categories; each of
    these has a failed row ``unexpected_category`` of its own with its count.
    """
    unexpected = F.coalesce(F.col(category), F.lit("Unknown"))
    stranger = F.when(~unexpected.isin(*allowed), unexpected)
    measured = _shares(test, label, F.count(stranger).alias("strangers"))
    found = test.groupBy(stranger.alias("stranger")).agg(F.count("*").alias("n"))
    named = found.where(F.col("stranger").isNotNull()).select(
        F.lit("unexpected_category").alias("check_name"),
        F.lit(False).alias("passed"),
        F.concat_ws(": ", "stranger", F.col("n").cast("string")).alias("detail"),
    )
    checks = _checks(
        measured,
        ("size", F.col("n") == size, F.col("n")),
        _within("normal_percent", normal_range),
        _within("anomaly_percent", anomaly_range),
        ("categories", F.col("strangers") == 0, F.when(F.col("strangers") > 0, F.col("strangers"))),
    )
    return checks.unionByName(named)
