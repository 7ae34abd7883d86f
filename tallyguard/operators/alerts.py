"""Views over alert tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import time_cutoff
from ..schema import ALERT
from .evaluate import with_share

# Limits of the confidence bands.
HIGH_ABOVE = 0.7
LOW_BELOW = 0.3
LATEST = 10


def confidence_band(confidence: Column) -> Column:
    return (
        F.when(confidence > F.lit(HIGH_ABOVE), "high")
        .when(confidence >= F.lit(LOW_BELOW), "medium")
        .when(confidence < F.lit(LOW_BELOW), "low")
    )


def alert_kind(df: DataFrame) -> Column:
    """``anomaly_type``, else ``type``, else Unknown."""
    have = [F.col(c) for c in ("anomaly_type", "type") if c in df.columns]
    return F.coalesce(*have, F.lit("Unknown"))


def recent_alerts(alerts: DataFrame, as_of: Column, window: str, ts: str = "ts") -> DataFrame:
    return alerts.where(F.col(ts) >= time_cutoff(as_of, window))


def latest_alerts(
    alerts: DataFrame, key: Sequence[str], n: int = LATEST, ts: str = "ts"
) -> DataFrame:
    """The ``n`` newest alerts, ties by key: each task keeps only its own ``n``."""
    return alerts.orderBy(F.desc(ts), *key).limit(n)


def alert_type_counts(alerts: DataFrame) -> DataFrame:
    """Alerts per kind with their percentage of all alerts."""
    kinds = alerts.groupBy(alert_kind(alerts).alias("alert_kind"))
    return with_share(kinds.agg(F.count("*").alias("n")))


def summary_rows(
    alerts: DataFrame, key: Sequence[str], by: Sequence[str] = (), n: int = LATEST, ts: str = "ts"
) -> DataFrame:
    """A row for each kind (and ``by``): number of alerts and the newest ``n`` of them.

    Such rows can be merged, see ``merge_summary_rows``.  The newest are ranked
    within each task first, so at most ``n`` alerts of a kind leave a task.
    """
    age = F.coalesce(-F.unix_micros(F.col(ts).cast("timestamp")), F.lit((1 << 63) - 1))
    kinds = alerts.select(
        *by,
        alert_kind(alerts).alias("alert_kind"),
        F.struct(age.alias("age"), *key, F.col(ts).alias("ts"), alert_kind(alerts).alias("kind"), "confidence").alias("alert"),
    )
    groups = [*by, "alert_kind"]
    ranked = kinds.withColumn("__rank", F.row_number().over(Window.partitionBy(*groups).orderBy("alert")))
    newest = ranked.where(F.col("__rank") <= n).groupBy(*groups).agg(F.sort_array(F.collect_list("alert")).alias("newest"))
    return kinds.groupBy(*groups).agg(F.count("*").alias("alerts")).join(newest, groups)


def merge_summary_rows(rows: DataFrame, by: Sequence[str] = (), n: int = LATEST) -> DataFrame:
    """Rows of several parts as those of one; a group has as many rows as there are parts."""
    newest = F.slice(F.sort_array(F.flatten(F.collect_list("newest"))), 1, n)
    return rows.groupBy(*by, "alert_kind").agg(F.sum("alerts").alias("alerts"), newest.alias("newest"))


def summary_document(rows: DataFrame, by: Sequence[str] = (), n: int = LATEST) -> DataFrame:
    """One nested row (for each ``by``): total, counts per kind, and the newest alerts of all kinds."""
    kinds = F.sort_array(F.collect_list(F.struct("alert_kind", "alerts")))
    newest = F.slice(F.sort_array(F.flatten(F.collect_list("newest"))), 1, n)
    return rows.groupBy(*by).agg(
        F.coalesce(F.sum("alerts"), F.lit(0)).alias("total_alerts"),
        F.map_from_entries(kinds).alias("alert_types"),
        F.transform(newest, lambda a: a.dropFields("age")).alias("latest_alerts"),
    )


def alert_summary(alerts: DataFrame, key: Sequence[str], n: int = LATEST, ts: str = "ts") -> DataFrame:
    """The summary document of an alert table."""
    return summary_document(summary_rows(alerts, key, (), n, ts), (), n)


def alert_kpis(
    alerts: DataFrame, as_of: Column, window: str = "1 hour", minutes: int = 60, ts: str = "ts"
) -> DataFrame:
    """Count, rate, confidence extremes and band counts of the recent alerts."""
    band = confidence_band(F.col("confidence"))
    return recent_alerts(alerts, as_of, window, ts).agg(
        F.count("*").alias("alerts"),
        (F.count("*") / F.lit(minutes)).alias("alerts_per_minute"),
        F.avg("confidence").alias("avg_confidence"),
        F.max("confidence").alias("max_confidence"),
        F.min("confidence").alias("min_confidence"),
        F.count_if(band == "high").alias("high"),
        F.count_if(band == "medium").alias("medium"),
        F.count_if(band == "low").alias("low"),
    )


def readable_alerts(alerts: DataFrame, broken: str) -> DataFrame:
    """Drop the all-NULL rows of documents whose text landed in ``broken``.

    An alert without any of the known fields is an alert all the same.
    """
    filled = F.coalesce(*[F.col(c).cast("string") for c in ALERT.names]).isNotNull()
    return alerts.where(F.col(broken).isNull() | filled).drop(broken)


def normalize_alerts(documents: DataFrame, value: str = "value") -> DataFrame:
    """One row per alert from documents that hold an array or a single alert."""
    schema = f"array<{ALERT.simpleString()}>"
    parsed = documents.select(F.from_json(value, schema).alias("alerts"))
    rows = parsed.select(F.explode("alerts").alias("alert"))
    return rows.where(F.col("alert").isNotNull()).select("alert.*")
