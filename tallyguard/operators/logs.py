"""Classify JSON log lines, route alerts and roll up reports.

Which rule applies to a line depends on which keys it has, also when their
value is null, so a line is read into its fields and its list of keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import alert_id, compute_once, hour_of_iso, ratio, time_cutoff
from ..session import one_row

# Fixed values.
LOG_ALERT_CONFIDENCE = 0.8
PEAK_HOURS = 3
DETECTION, TRAINING, SYSTEM, UNKNOWN = (
    "anomaly_detection",
    "model_training",
    "system_event",
    "unknown",
)
TEXT_FIELDS = ("timestamp", "level", "message", "component", "error_code")
NUMBER_FIELDS = (
    "anomaly_score",
    "confidence",
    "prediction",
    "accuracy",
    "precision",
    "recall",
    "f1_score",
    "training_samples",
    "previous_accuracy",
    "degradation_percent",
)

_ENTRY, _KEYS = "__entry", "__keys"


def parse_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """Keep the lines that are JSON objects, with their fields and keys beside."""
    fields = [f"{f} string" for f in TEXT_FIELDS] + [f"{f} double" for f in NUMBER_FIELDS]
    text = F.trim(value)
    parsed = compute_once(
        lines, {_ENTRY: F.from_json(text, ", ".join(fields)), _KEYS: F.json_object_keys(text)}
    )
    return parsed.where(F.col(_KEYS).isNotNull())


def _has(key: str) -> Column:
    return F.array_contains(_KEYS, key)


def _field(key: str) -> Column:
    return F.col(f"{_ENTRY}.{key}")


def _text(key: str, default: str = "") -> Column:
    """The text under ``key``, a default if the key is absent, NULL if its value is null."""
    return F.coalesce(_field(key), F.when(~_has(key), F.lit(default)))


def _number(key: str) -> Column:
    return F.coalesce(_field(key), F.when(~_has(key), F.lit(0.0)))


def _filled(key: str) -> Column:
    return F.coalesce(_field(key) != "", F.lit(False))


def _time(as_of: Column) -> Column:
    return F.coalesce(
        F.try_to_timestamp(_field("timestamp")), F.when(~_has("timestamp"), as_of)
    )


def log_type() -> Column:
    """First match by keys; NULL for a line without a time or a message."""
    return (
        F.when(_has("anomaly_score") | _has("prediction"), DETECTION)
        .when(_has("accuracy") | _has("training_samples"), TRAINING)
        .when(_has("component") | _has("error_code"), SYSTEM)
        .when(_filled("timestamp") & _filled("message"), UNKNOWN)
    )


def alert_type(min_confidence: float = LOG_ALERT_CONFIDENCE) -> Column:
    """First match: a line with a score alerts by confidence or not at all."""
    confident = _number("confidence") >= F.lit(float(min_confidence))
    return (
        F.when(_has("anomaly_score"), F.when(confident, "high_confidence_anomaly"))
        .when(_has("degradation_percent"), "performance_degradation")
        .when(_field("level") == "ERROR", "system_error")
    )


def severity(kind: Column) -> Column:
    return (
        F.when(kind == "high_confidence_anomaly", "HIGH")
        .when(kind == "performance_degradation", "MEDIUM")
        .when(kind == "system_error", "CRITICAL")
    )


def _description(kind: Column) -> Column:
    # The description of each kind of alert.
    return (
        F.when(kind == "high_confidence_anomaly", "High confidence anomaly detected")
        .when(kind == "performance_degradation", "Model performance has degraded")
        .when(kind == "system_error", "Critical system error detected")
    )


def classify_logs(
    lines: DataFrame,
    as_of: Column | None = None,
    min_confidence: float = LOG_ALERT_CONFIDENCE,
    value: str = "value",
) -> DataFrame:
    """One row per usable line: type, time, severity and the fields of its type."""
    now = F.current_timestamp() if as_of is None else as_of
    typed = compute_once(
        parse_lines(lines, value), {"type": log_type(), "__alert": alert_type(min_confidence)}
    )

    def only(kinds: tuple[str, ...], col: Column) -> Column:
        return F.when(F.col("type").isin(*kinds), col)

    carried = [c for c in lines.columns if c != value]
    fields = {
        **{k: only((DETECTION,), _number(k)) for k in ("anomaly_score", "confidence", "prediction")},
        **{
            k: only((TRAINING,), _number(k))
            for k in ("accuracy", "precision", "recall", "f1_score", "training_samples")
        },
        "level": only((SYSTEM, UNKNOWN), _text("level", "INFO")),
        "message": only((SYSTEM, UNKNOWN), _text("message")),
        "component": only((SYSTEM,), _text("component")),
        "error_code": only((SYSTEM,), _text("error_code")),
    }
    return typed.where(F.col("type").isNotNull()).select(
        *carried,
        "type",
        _time(now).alias("ts"),
        severity(F.col("__alert")).alias("severity"),
        *[col.alias(name) for name, col in fields.items()],
    )


def route_alerts(
    lines: DataFrame,
    as_of: Column | None = None,
    min_confidence: float = LOG_ALERT_CONFIDENCE,
    value: str = "value",
) -> DataFrame:
    """Alerts of the lines.  Also a line that cannot be classified may alert."""
    now = F.current_timestamp() if as_of is None else as_of
    routed = compute_once(parse_lines(lines, value), {"alert_type": alert_type(min_confidence)})
    kind = F.col("alert_type")

    def only(name: str, col: Column) -> Column:
        return F.when(kind == name, col)

    carried = [c for c in lines.columns if c != value]
    return (
        routed.where(kind.isNotNull())
        .withColumn("ts", _time(now))
        .select(
            *carried,
            alert_id(F.col("ts"), kind, F.col(value)).alias("alert_id"),
            "ts",
            "alert_type",
            severity(kind).alias("severity"),
            _description(kind).alias("description"),
            only("high_confidence_anomaly", _number("anomaly_score")).alias("anomaly_score"),
            only("high_confidence_anomaly", _number("confidence")).alias("confidence"),
            only("performance_degradation", _number("accuracy")).alias("current_accuracy"),
            only("performance_degradation", _number("previous_accuracy")).alias("previous_accuracy"),
            only("performance_degradation", _number("degradation_percent")).alias(
                "degradation_percent"
            ),
            only("system_error", _text("component", "unknown")).alias("component"),
            only("system_error", _text("error_code")).alias("error_code"),
            only("system_error", _text("message")).alias("message"),
        )
    )


def filter_logs(
    logs: DataFrame,
    log_type: str | None = None,
    severity: str | None = None,
    window: str | None = None,
    as_of: Column | None = None,
) -> DataFrame:
    """Classified lines by type, severity and age."""
    kept = logs
    if log_type:
        kept = kept.where(F.col("type") == log_type)
    if severity:
        kept = kept.where(F.col("severity") == severity)
    if window:
        now = F.current_timestamp() if as_of is None else as_of
        kept = kept.where(F.col("ts") >= time_cutoff(now, window))
    return kept


def anomaly_statistics(
    logs: DataFrame, min_confidence: float = LOG_ALERT_CONFIDENCE
) -> DataFrame:
    """Totals of the detection lines; zeros if there are none."""
    confidence = F.coalesce("confidence", F.lit(0.0))
    return logs.where(F.col("type") == DETECTION).agg(
        F.count("*").alias("total_detections"),
        ratio(F.count_if(F.col("prediction") == 1), F.count("*")).alias("anomaly_rate"),
        F.coalesce(F.avg(confidence), F.lit(0.0)).alias("average_confidence"),
        F.count_if(confidence >= F.lit(float(min_confidence))).alias("high_confidence_alerts"),
    )


def _hour_counts(rows: DataFrame, ts: str, *extra: Column) -> DataFrame:
    """Counts per hour of the day, at most 25 rows; ``ts`` is a time or ISO text."""
    at = F.col(ts)
    if dict(rows.dtypes)[ts] == "string":
        timed, hour = F.coalesce(at != "", F.lit(False)), hour_of_iso(at)
    else:
        timed, hour = at.isNotNull(), F.hour(at)
    return rows.groupBy(hour.alias("hour")).agg(
        F.count_if(timed).alias("n"),
        F.min(F.when(timed, at)).alias("first"),
        F.max(F.when(timed, at)).alias("last"),
        *extra,
    )


def _pattern_columns(top: int) -> list[Column]:
    """Time range, rows per hour of the day and the busiest hours from hour counts."""
    has_hour = F.col("hour").isNotNull()
    ranked = F.array_sort(
        F.collect_list(F.when(has_hour, F.struct((-F.col("n")).alias("neg"), F.col("hour"))))
    )
    entries = F.coalesce(F.sum("n"), F.lit(0))
    return [
        F.min("first").alias("first_seen"),
        F.max("last").alias("last_seen"),
        entries.alias("entries"),
        F.count("hour").alias("hours"),
        F.transform(F.slice(ranked, 1, top), lambda e: e["hour"]).alias("peak_hours"),
        (entries / F.greatest(F.count("hour"), F.lit(1))).alias("detection_frequency"),
    ]


def temporal_patterns(rows: DataFrame, ts: str = "ts", top: int = PEAK_HOURS) -> DataFrame:
    """First and last time, rows per hour of the day, and the busiest hours."""
    return _hour_counts(rows, ts).agg(*_pattern_columns(top))


def log_report(
    lines: DataFrame,
    as_of: Column | None = None,
    min_confidence: float = LOG_ALERT_CONFIDENCE,
    value: str = "value",
) -> DataFrame:
    """Statistics, time pattern and alert count of the lines as one nested row.

    Each line is parsed once; a line without a type is no log entry but may
    alert.  Every figure is first summed per hour of the day.
    """
    now = F.current_timestamp() if as_of is None else as_of
    typed = compute_once(
        parse_lines(lines, value), {"type": log_type(), "alert": alert_type(min_confidence)}
    )
    is_log, detection = F.col("type").isNotNull(), F.coalesce(F.col("type") == DETECTION, F.lit(False))
    entries = typed.select(
        F.when(is_log, _time(now)).alias("ts"),
        is_log.alias("is_log"),
        F.col("alert").isNotNull().alias("alerts"),
        detection.alias("detected"),
        F.when(detection, _number("prediction")).alias("prediction"),
        F.when(detection, F.coalesce(_number("confidence"), F.lit(0.0))).alias("confidence"),
    )
    by_hour = _hour_counts(
        entries,
        "ts",
        F.count_if("is_log").alias("logs"),
        F.count_if("alerts").alias("alerted"),
        F.count_if("detected").alias("detections"),
        F.count_if(F.col("prediction") == 1).alias("positives"),
        F.sum("confidence").alias("confidence"),
        F.count_if(F.col("confidence") >= F.lit(float(min_confidence))).alias("confident"),
    )
    zero = F.lit(0)
    detections = F.coalesce(F.sum("detections"), zero)
    stats = F.struct(
        detections.alias("total_detections"),
        ratio(F.sum("positives"), detections).alias("anomaly_rate"),
        ratio(F.sum("confidence"), detections).alias("average_confidence"),
        F.coalesce(F.sum("confident"), zero).alias("high_confidence_alerts"),
    )
    return by_hour.agg(
        F.coalesce(F.sum("logs"), zero).alias("total_logs_processed"),
        stats.alias("anomaly_statistics"),
        F.struct(*_pattern_columns(PEAK_HOURS)).alias("temporal_analysis"),
        F.struct(F.coalesce(F.sum("alerted"), zero).alias("total_alerts_generated")).alias("alert_summary"),
    ).select(now.alias("ts"), "*")
