"""Queries over JSON log lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import logs as L
from ..session import work_folder
from ..sources import files
from . import bindings as D
from .registry import query
from .sql import EV, LOG, SEVERITY, r, ratio, t

LOGS = f"{EV}, {LOG}"
KEYS = """CASE category WHEN 'purchase' THEN 6 WHEN 'signup' THEN CASE WHEN x1 > 50 THEN 8 ELSE 6 END
  WHEN 'error' THEN 5 WHEN 'click' THEN 2 ELSE 1 END"""


@query(
    "scan_log_lines",
    f"WITH {LOGS} SELECT {KEYS} AS keys, count(*) AS lines FROM log GROUP BY 1",
)
def scan_log_lines(spark, sf):
    """Beside each line stand an array line and a cut-off line, both to be skipped."""
    folder = work_folder(spark, "log-lines")
    noise = F.array(
        "value", F.lit("[1, 2]"), F.concat(F.lit('{"level": '), F.col("event_id").cast("string"))
    )
    D.log_lines(spark, sf).select(F.explode(noise).alias("value")).write.text(folder)
    lines = files.scan_log_lines(spark, folder)
    return lines.groupBy(F.size(F.json_object_keys("value")).alias("keys")).agg(
        F.count("*").alias("lines")
    )


@query(
    "classify_logs",
    f"""WITH {LOGS} SELECT event_id, type, {t('ts')} AS ts, {SEVERITY} AS severity,
  CASE WHEN category = 'purchase' THEN {r('x1 / 100')} END AS anomaly_score,
  CASE WHEN category = 'purchase' THEN {r('x2 / 100')} END AS confidence,
  CASE WHEN category = 'purchase' THEN {r('CASE WHEN x2 >= 50 THEN 1 ELSE 0 END')} END AS prediction,
  CASE WHEN category = 'signup' THEN {r('x2 / 100')} END AS accuracy,
  CASE WHEN category = 'signup' THEN {r('x2 / 200')} END AS "precision",
  CASE WHEN category = 'signup' THEN {r('x2 / 400')} END AS recall,
  CASE WHEN category = 'signup' THEN {r('0')} END AS f1_score,
  CASE WHEN category = 'signup' THEN {r('x4')} END AS training_samples,
  CASE category WHEN 'error' THEN 'ERROR' WHEN 'click' THEN 'INFO' END AS level,
  CASE WHEN category IN ('error', 'click') THEN category || ' ' || event_id END AS message,
  CASE WHEN category = 'error' THEN 'c' || CAST(x4 AS INTEGER) END AS component,
  CASE WHEN category = 'error' THEN 'E' || CAST(x2 AS INTEGER) END AS error_code
  FROM log WHERE type IS NOT NULL""",
)
def classify_logs(spark, sf):
    return L.classify_logs(D.log_lines(spark, sf))


ROUTED = f"""SELECT event_id, alert_type, {SEVERITY} AS severity,
  CASE alert_type WHEN 'high_confidence_anomaly' THEN 'High confidence anomaly detected'
    WHEN 'performance_degradation' THEN 'Model performance has degraded' ELSE 'Critical system error detected' END AS description,
  {t("CASE WHEN category = 'view' THEN TIMESTAMP '2024-02-01' ELSE ts END")} AS ts,
  CASE WHEN alert_type = 'high_confidence_anomaly' THEN {r('x1 / 100')} END AS anomaly_score,
  CASE WHEN alert_type = 'high_confidence_anomaly' THEN {r('x2 / 100')} END AS confidence,
  CASE WHEN alert_type = 'performance_degradation' THEN {r('x2 / 100')} END AS current_accuracy,
  CASE WHEN alert_type = 'performance_degradation' THEN {r('0.85')} END AS previous_accuracy,
  CASE WHEN alert_type = 'performance_degradation' THEN {r('x1')} END AS degradation_percent,
  CASE WHEN category = 'error' THEN 'c' || CAST(x4 AS INTEGER) WHEN category = 'view' THEN 'unknown' END AS component,
  CASE WHEN category = 'error' THEN 'E' || CAST(x2 AS INTEGER) WHEN category = 'view' THEN '' END AS error_code,
  CASE WHEN category = 'error' THEN 'error ' || event_id WHEN category = 'view' THEN '' END AS message
  FROM log WHERE alert_type IS NOT NULL"""


@query(
    "route_alerts",
    f"""WITH {LOGS}, routed AS ({ROUTED}) SELECT *, 'ALT_' || replace(substring(ts, 1, 10), '-', '') AS id_day,
  length('ALT__') + 8 + 32 AS id_chars FROM routed""",
)
def route_alerts(spark, sf):
    """Of the id, which is a digest of the line, its day and its length."""
    as_of = F.lit("2024-02-01").cast("timestamp")
    routed = L.route_alerts(D.log_lines(spark, sf), as_of)
    return routed.select(
        *[c for c in routed.columns if c != "alert_id"],
        F.substring("alert_id", 1, 12).alias("id_day"),
        F.length("alert_id").alias("id_chars"),
    )


@query(
    "filter_logs",
    f"""WITH {LOGS} SELECT event_id, {t('ts')} AS ts, {SEVERITY} AS severity FROM log
  WHERE type = 'model_training' AND alert_type = 'performance_degradation' AND ts >= (SELECT max(ts) FROM events) - INTERVAL 12 DAY""",
)
def filter_logs(spark, sf):
    as_of = D.newest_time(D.ev(spark, sf))
    logs = L.classify_logs(D.log_lines(spark, sf))
    kept = L.filter_logs(logs, "model_training", "MEDIUM", "12 days", as_of)
    return kept.select("event_id", "ts", "severity")


STATS = f"""SELECT count(*) AS total_detections, {ratio('count_if(x2 >= 50)', 'count(*)')} AS anomaly_rate,
  avg(x2 / 100) AS average_confidence, CAST(count_if(x2 / 100 >= 0.8::DOUBLE) AS BIGINT) AS high_confidence_alerts
  FROM log WHERE type = 'anomaly_detection'"""


@query(
    "anomaly_statistics",
    f"""WITH {LOGS}, s AS ({STATS}) SELECT total_detections, {r('anomaly_rate')} AS anomaly_rate,
  {r('average_confidence')} AS average_confidence, high_confidence_alerts FROM s""",
)
def anomaly_statistics(spark, sf):
    return L.anomaly_statistics(L.classify_logs(D.log_lines(spark, sf)))


def _temporal(source: str, where: str) -> str:
    return f"""th AS (SELECT hour(ts)::INTEGER AS hour, count(*) AS n, min(ts) AS lo, max(ts) AS hi FROM {source} WHERE {where} GROUP BY 1),
  tk AS (SELECT *, row_number() OVER (ORDER BY n DESC, hour) AS k FROM th),
  tp AS (SELECT min(lo) AS first_seen, max(hi) AS last_seen, CAST(sum(n) AS BIGINT) AS entries, count(*) AS hours,
    sum(n)::DOUBLE / count(*) AS detection_frequency, max(CASE WHEN k = 1 THEN hour END) AS peak_1,
    max(CASE WHEN k = 2 THEN hour END) AS peak_2, max(CASE WHEN k = 3 THEN hour END) AS peak_3 FROM tk)"""


def _peaks(prefix: str = ""):
    return [F.get(F.col(f"{prefix}peak_hours"), i).alias(f"peak_{i + 1}") for i in range(3)]


TEMPORAL_OUT = f"{t('first_seen')} AS first_seen, {t('last_seen')} AS last_seen, entries, hours, {r('detection_frequency')} AS detection_frequency, peak_1, peak_2, peak_3"


@query("temporal_patterns", f"WITH {LOGS}, {_temporal('ev', 'true')} SELECT {TEMPORAL_OUT} FROM tp")
def temporal_patterns(spark, sf):
    found = L.temporal_patterns(D.ev(spark, sf))
    return found.select(
        "first_seen", "last_seen", "entries", "hours", "detection_frequency", *_peaks()
    )


REPORT = f"""WITH {LOGS}, s AS ({STATS}), {_temporal('log', 'type IS NOT NULL')},
  c AS (SELECT count(type) AS total_logs_processed, count(alert_type) AS total_alerts_generated FROM log)
  SELECT total_logs_processed, total_alerts_generated, total_detections, {r('anomaly_rate')} AS anomaly_rate,
    {r('average_confidence')} AS average_confidence, high_confidence_alerts, {TEMPORAL_OUT} FROM s, tp, c"""


def _report(spark, sf):
    lines = D.log_lines(spark, sf)
    as_of = F.lit("2024-02-01").cast("timestamp")
    return L.log_report(lines, as_of)


def _flat(report):
    return report.select(
        "total_logs_processed",
        "alert_summary.total_alerts_generated",
        "anomaly_statistics.*",
        *[
            f"temporal_analysis.{c}"
            for c in ("first_seen", "last_seen", "entries", "hours", "detection_frequency")
        ],
        *_peaks("temporal_analysis."),
    )


@query("log_report", REPORT)
def log_report(spark, sf):
    return _flat(_report(spark, sf))


@query("report_sink", REPORT)
def report_sink(spark, sf):
    folder = work_folder(spark, "reports")
    report = _report(spark, sf)
    for _ in range(2):  # a report written again replaces itself
        files.write_report(report, folder, "daily")
    return _flat(files.read_report(spark, folder, report.schema))


@query(
    "fn_json_keys",
    f"""WITH {LOGS} SELECT event_id, {KEYS} AS keys, category = 'purchase' AS has_score,
  coalesce(CASE WHEN category = 'purchase' THEN {r('x2 / 100')} END, 0) AS confidence FROM log""",
)
def fn_json_keys(spark, sf):
    entry = F.from_json("value", "map<string,string>")
    return D.log_lines(spark, sf).select(
        "event_id",
        F.size(F.json_object_keys("value")).alias("keys"),
        F.map_contains_key(entry, "anomaly_score").alias("has_score"),
        F.coalesce(F.get_json_object("value", "$.confidence").try_cast("double"), F.lit(0.0)).alias(
            "confidence"
        ),
    )
