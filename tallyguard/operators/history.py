"""Metric history, one row per retraining cycle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import HISTORY_METRICS
from ..session import bounded_broadcast, one_row
from .evaluate import evaluate_model
from .ordering import CHUNK_WIDTH, with_previous, with_row_number

# Fixed values.
BASELINE_CYCLES = 3
DEGRADATION_THRESHOLD = 0.10
SERIES_WIDTH = 40
NOISE_START_IF_UNKNOWN = 3


def cycle_history(
    scored: DataFrame,
    cycle: str,
    targets: Mapping[str, str],
    ts: str,
    label: str = "label",
    category: str = "category",
) -> DataFrame:
    """History of a scored table that holds many cycles; rates keep 4 places."""
    evaluated = evaluate_model(
        scored,
        targets,
        label,
        category,
        by=[cycle],
        extra=[F.max(F.col(ts).cast("timestamp")).alias("ts")],
    ).withColumnRenamed(cycle, "iteration")
    return rounded(evaluated)


def rounded(evaluated: DataFrame, places: int = 4) -> DataFrame:
    """Round the rates as they are stored; counts stay as they are."""
    rates = [name for name, kind in evaluated.dtypes if kind == "double"]
    return evaluated.withColumns({r: F.round(r, places) for r in rates})


def _long(history: DataFrame, order: str, metrics: Sequence[str]) -> DataFrame:
    doubles = [F.col(m).cast("double").alias(m) for m in metrics]
    return (
        history.select(order, *doubles)
        .unpivot([order], list(metrics), "metric", "value")
        .where(F.col("value").isNotNull())
    )


def _for_each_metric(history: DataFrame, metrics: Sequence[str], found: DataFrame) -> DataFrame:
    """One row per asked metric, also for a metric without values."""
    wanted = history.sparkSession.createDataFrame([(m,) for m in metrics], "metric string")
    return wanted.join(bounded_broadcast(found, len(metrics)), "metric", "left")


def metric_stats(history: DataFrame, metrics: Sequence[str] = HISTORY_METRICS) -> DataFrame:
    """Mean, min, max and population deviation of each metric, 0 without values."""
    aggs = []
    for m in metrics:
        value = F.col(m).cast("double")
        aggs.append(
            F.struct(
                F.lit(m).alias("metric"),
                F.count(value).alias("n"),
                F.coalesce(F.avg(value), F.lit(0.0)).alias("mean"),
                F.coalesce(F.min(value), F.lit(0.0)).alias("min"),
                F.coalesce(F.max(value), F.lit(0.0)).alias("max"),
                F.coalesce(F.stddev_pop(value), F.lit(0.0)).alias("std"),
            )
        )
    return history.agg(F.array(*aggs).alias("stats")).select(F.inline("stats"))


def metric_trend(
    history: DataFrame,
    order: str = "iteration",
    metrics: Sequence[str] = HISTORY_METRICS,
    width: int = CHUNK_WIDTH,
) -> DataFrame:
    """Mean of the second half of the values minus mean of the first half."""
    ranked = with_row_number(_long(history, order, metrics), order, ["metric"], width)
    first = F.col("row_no") <= F.floor(F.col("row_total") / 2)
    found = ranked.groupBy("metric").agg(
        F.count("*").alias("n"),
        (F.avg(F.when(~first, F.col("value"))) - F.avg(F.when(first, F.col("value")))).alias("trend"),
    )
    return _for_each_metric(history, metrics, found).select(
        "metric",
        F.coalesce("n", F.lit(0)).alias("n"),
        F.coalesce("trend", F.lit(0.0)).alias("trend"),
    )


def degradation_alert(
    history: DataFrame,
    order: str = "iteration",
    metrics: Sequence[str] = HISTORY_METRICS,
    threshold: float = DEGRADATION_THRESHOLD,
    width: int = CHUNK_WIDTH,
) -> DataFrame:
    """Whether the last value lies below the mean of the first three by the threshold.

    Needs one value more than the baseline has, and a baseline that is not 0.
    """
    ranked = with_row_number(_long(history, order, metrics), order, ["metric"], width)
    found = (
        ranked.groupBy("metric")
        .agg(
            F.count("*").alias("n"),
            F.avg(F.when(F.col("row_no") <= BASELINE_CYCLES, F.col("value"))).alias("baseline"),
            F.max(F.when(F.col("row_no") == F.col("row_total"), F.col("value"))).alias("current"),
        )
        .withColumn(
            "drop",
            (F.col("baseline") - F.col("current")) / F.nullif(F.col("baseline"), F.lit(0.0)),
        )
    )
    enough = F.col("n") > BASELINE_CYCLES
    return _for_each_metric(history, metrics, found).select(
        "metric",
        F.coalesce("n", F.lit(0)).alias("n"),
        "baseline",
        "current",
        "drop",
        F.coalesce(enough & (F.col("drop") >= F.lit(float(threshold))), F.lit(False)).alias("alert"),
    )


def baseline_vs_current(
    history: DataFrame,
    metrics: Mapping[str, float],
    start_cycle: int | None = None,
    order: str = "iteration",
) -> DataFrame:
    """Each metric in the last cycle before ``start_cycle`` and in the last cycle.

    Without an earlier cycle the first one is the baseline.  ``metrics`` maps a
    metric to its display factor.  Fewer than two cycles give no rows.
    """
    start = NOISE_START_IF_UNKNOWN if start_cycle is None else start_cycle
    row = F.struct(order, *metrics)
    before = F.when(F.col(order) < start, F.col(order))
    picked = history.agg(
        F.count("*").alias("n"),
        F.coalesce(F.max_by(row, before), F.min_by(row, order)).alias("b"),
        F.max_by(row, order).alias("c"),
    ).where(F.col("n") >= 2)
    compared = [
        F.struct(
            F.lit(m).alias("metric"),
            F.col(f"b.{order}").alias("baseline_cycle"),
            F.col(f"c.{order}").alias("current_cycle"),
            (F.col(f"b.{m}").cast("double") * factor).alias("baseline"),
            (F.col(f"c.{m}").cast("double") * factor).alias("current"),
            ((F.col(f"c.{m}") - F.col(f"b.{m}")).cast("double") * factor).alias("change"),
        )
        for m, factor in ((m, F.lit(float(f))) for m, f in metrics.items())
    ]
    return picked.select(F.inline(F.array(*compared)))


def scaled_series(
    history: DataFrame,
    metrics: Sequence[str],
    order: str = "iteration",
    width: int = SERIES_WIDTH,
) -> DataFrame:
    """Each value scaled to 0..width between the metric's extremes, truncated."""
    bounds = history.agg(
        *[F.min(F.col(m).cast("double")).alias(f"__min_{m}") for m in metrics],
        *[F.max(F.col(m).cast("double")).alias(f"__max_{m}") for m in metrics],
    )

    def bar(m: str):
        low, high = F.col(f"__min_{m}"), F.col(f"__max_{m}")
        value = F.col(m).cast("double")
        scaled = ((value - low) / F.nullif(high - low, F.lit(0.0)) * F.lit(width)).cast("int")
        return F.when(high > low, scaled).otherwise(F.lit(width))

    entries = [
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"), bar(m).alias("bar"))
        for m in metrics
    ]
    return history.crossJoin(one_row(bounds)).select(order, F.inline(F.array(*entries)))


def cycle_deltas(
    history: DataFrame,
    metrics: Sequence[str] = HISTORY_METRICS,
    order: str = "iteration",
    width: int = CHUNK_WIDTH,
) -> DataFrame:
    """Metrics per cycle, their change from the cycle before and the drop in percent."""
    with_before = with_previous(history, order, metrics, width=width)
    changes = {f"{m}_change": F.col(m) - F.col(f"previous.{m}") for m in metrics}
    drops = {
        f"{m}_drop_percent": (F.col(f"previous.{m}") - F.col(m))
        / F.nullif(F.col(f"previous.{m}"), F.lit(0.0))
        * 100
        for m in metrics
    }
    return with_before.withColumns({**changes, **drops}).select(
        order, *metrics, *changes, *drops
    )


def retrain_cycle_count(events: DataFrame) -> DataFrame:
    """Attempts and completed retraining cycles; only successes count as cycles."""
    return events.agg(
        F.count("*").alias("attempts"),
        F.count_if(F.col("status") == "success").alias("cycles"),
    )


def history_report(history: DataFrame, order: str = "iteration") -> DataFrame:
    """The newest row, the number of cycles and the statistics of each metric."""
    newest = F.max_by(F.struct(*history.columns), order)
    stats = [
        F.struct(
            F.coalesce(F.avg(m), F.lit(0.0)).alias("mean"),
            F.coalesce(F.min(m), F.lit(0.0)).alias("min"),
            F.coalesce(F.max(m), F.lit(0.0)).alias("max"),
            F.coalesce(F.stddev_pop(m), F.lit(0.0)).alias("std"),
        ).alias(f"{m}_stats")
        for m in HISTORY_METRICS
    ]
    return history.agg(
        newest.alias("current_metrics"),
        F.count("*").alias("history_count"),
        *stats,
    ).withColumn("status", F.when(F.col("history_count") > 0, F.lit("active")))

