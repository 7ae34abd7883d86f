"""Continuous scoring, log alerts, snapshots, retraining and rolling summaries.

A job takes a streaming DataFrame and starts a query.  ``available_now`` runs
it over what has arrived and stops, so the same job serves a schedule and a
long-running stream.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..operators.accumulate import SNAPSHOT_ID
from ..operators.alerts import LATEST, merge_summary_rows, summary_document, summary_rows
from ..operators.evaluate import evaluate_model
from ..operators.logs import route_alerts
from ..operators.moments import feature_moments, merge_moments, subtract_moments, union_moments
from ..operators.sampling import rows_in_test
from ..operators.score import score, score_alerts
from ..session import join_path
from ..sources import parts, tables

WATERMARK = "10 minutes"
DEDUP_SALTS = 32


def read_stream(
    spark: SparkSession, folder: str, schema, glob: str | None = None, fmt: str = "parquet"
) -> DataFrame:
    """File stream over a folder; each file is read once."""
    reader = spark.readStream.schema(schema).format(fmt)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(folder)


def start(
    writer: DataStreamWriter, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Start on a trigger interval, or over the available files if there is none."""
    timed = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return timed.option("checkpointLocation", checkpoint).start()


def _to_parquet(df: DataFrame, out: str) -> DataStreamWriter:
    return df.writeStream.format("parquet").outputMode("append").option("path", out)


def stream_score(
    flows: DataFrame,
    model: DataFrame,
    features: Sequence[str],
    key: Sequence[str],
    out: str,
    checkpoint: str,
    category: str = "category",
    ts: str | None = None,
    interval: str | None = None,
    container: str | None = None,
) -> StreamingQuery:
    """Score each arriving row once with a stored model and write the alerts."""
    alerts = score_alerts(flows, model, features, key, category, ts, container=container)
    return start(_to_parquet(alerts, out), checkpoint, interval)


def stream_log_alerts(
    lines: DataFrame,
    out: str,
    checkpoint: str,
    as_of: Column | None = None,
    interval: str | None = None,
) -> StreamingQuery:
    return start(_to_parquet(route_alerts(lines, as_of), out), checkpoint, interval)


def stream_snapshots(
    rows: DataFrame, table: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Each batch with rows becomes one snapshot, named after the batch."""

    def keep(batch: DataFrame, batch_id: int) -> None:
        tables.capture_snapshot(batch, table, batch_id)

    return start(rows.writeStream.foreachBatch(keep), checkpoint, interval)


# The test set of a history: takes the snapshots so far and tells whether it is the real one.
BuildTest = Callable[[DataFrame | None], tuple[DataFrame, bool]]


def retrain_step(
    original: DataFrame,
    build_test: BuildTest,
    features: Sequence[str],
    targets: Mapping[str, str],
    folder: str,
    min_new: int,
    normal: Column,
    label: str = "label",
    category: str = "category",
    max_test_rows: int | None = None,
) -> Callable[[DataFrame, int], None]:
    """What one tick does: snapshot, gate, test set, fit, store, evaluate, record.

    The fit covers the original rows and every snapshot so far, without the rows
    of the test set (all copies of a test row are left out), yet a tick reads
    only its own batch: the moments of all rows are kept in parts that fold, and
    so are the moments of those rows that are in the test set; the model is made
    from the difference.  History is read once, when the test set is drawn, to
    find the test rows in it; while ``build_test`` only has a fallback, nothing
    is stored and the fallback's rows are looked up each time.

    All outputs are parts named after the batch, so a batch that is run again
    after a failure replaces its own rows and adds none.  Success is recorded
    last, when model, evaluation and history are there.
    """
    snapshots, models = join_path(folder, "snapshots"), join_path(folder, "models")
    history, events = join_path(folder, "history"), join_path(folder, "events")
    moments, tests = join_path(folder, "moments"), join_path(folder, "test_sets")
    columns = original.columns

    def measured(rows: DataFrame) -> DataFrame:
        return feature_moments(rows, features, normal)

    def in_test(rows: DataFrame, test: DataFrame) -> DataFrame:
        return measured(rows_in_test(rows.select(*columns), test, max_test_rows))

    def captured(spark: SparkSession, batch_id: int) -> DataFrame | None:
        table = tables.read_table(spark, snapshots)
        return None if table is None else table.where(F.col(SNAPSHOT_ID) <= batch_id).select(*columns)

    def whole_history(spark: SparkSession, batch_id: int) -> DataFrame:
        arrived = captured(spark, batch_id)
        return original if arrived is None else original.unionByName(arrived)

    def held_out(spark: SparkSession, batch_id: int) -> tuple[DataFrame, DataFrame]:
        """The test set of this tick and the moments of its rows in the history."""
        version = tables.newest_version(spark, tests)
        if version is None:
            test, is_real = build_test(captured(spark, batch_id))
            if not is_real:
                return test, in_test(whole_history(spark, batch_id), test)
        else:
            test, is_real = None, True
        test = tables.create_once(spark, tests, lambda: (test, is_real))
        version = tables.newest_version(spark, tests)
        held = join_path(folder, "held_out", f"version-{version}")
        base = tables.read_table(spark, join_path(held, "base"))
        if base is None:
            found = in_test(whole_history(spark, batch_id), test)
            found.withColumn("upto", F.lit(batch_id)).write.mode("overwrite").parquet(join_path(held, "base"))
            base = tables.read_table(spark, join_path(held, "base"))
        if batch_id > base.first()["upto"]:
            batch = tables.read_table(spark, join_path(snapshots, f"{SNAPSHOT_ID}={batch_id}"))
            if batch is not None:
                parts.fold_part(in_test(batch, test), join_path(held, "later"), batch_id, union_moments)
        base = base.drop("upto")
        later = parts.read_state(spark, join_path(held, "later"), base.schema, batch_id)
        return test, base if later is None else union_moments(base.unionByName(later))

    def tick(batch: DataFrame, batch_id: int) -> None:
        spark, started = batch.sparkSession, time.monotonic()
        first = tables.read_table(spark, join_path(moments, "original"))
        if first is None:
            measured(original).write.mode("overwrite").parquet(join_path(moments, "original"))
            first = tables.read_table(spark, join_path(moments, "original"))
        if tables.capture_snapshot(batch, snapshots, batch_id):
            # Read the rows back from the snapshot, not again from the source.
            batch = spark.read.parquet(join_path(snapshots, f"{SNAPSHOT_ID}={batch_id}"))
        later = join_path(moments, "later")
        parts.fold_part(measured(batch), later, batch_id, union_moments)
        arrived = parts.read_state(spark, later, first.schema, batch_id)
        new_rows = (
            arrived.where(F.col("feature") == features[0]).agg(F.coalesce(F.sum("part_rows"), F.lit(0))).first()[0]
        )

        def record(status: str, message: str = "", model_id: str = "") -> None:
            took = time.monotonic() - started
            tables.log_retrain_event(
                spark, events, batch_id, status, F.current_timestamp(), message, took, model_id
            )

        if new_rows < min_new:
            record("skipped", "too few new rows")
            return
        model_id, now = f"cycle_{batch_id:06d}", F.current_timestamp()
        test, gone = held_out(spark, batch_id)
        rest = subtract_moments(union_moments(first.unionByName(arrived)), gone)
        try:
            model = tables.save_model(merge_moments(rest, features), models, model_id, now)
        except ValueError as error:
            record("failed", str(error))
            return
        evaluated = evaluate_model(score(test, model, features), targets, label, category)
        tables.append_history(evaluated.withColumn("ts", now), history, batch_id)
        record("success", model_id=model_id)

    return tick


def stream_retrain(
    flows: DataFrame,
    step: Callable[[DataFrame, int], None],
    checkpoint: str,
    interval: str | None = None,
) -> StreamingQuery:
    return start(flows.writeStream.foreachBatch(step), checkpoint, interval)


def windowed_summary(
    alerts: DataFrame,
    length: str,
    slide: str | None = None,
    by: Sequence[str] = (),
    ts: str = "ts",
    watermark: str = WATERMARK,
) -> DataFrame:
    """Alert count and confidence figures per event-time window."""
    window = F.window(ts, length, slide) if slide else F.window(ts, length)
    return (
        alerts.withWatermark(ts, watermark)
        .groupBy(window.alias("window"), *by)
        .agg(
            F.count("*").alias("alerts"),
            F.avg("confidence").alias("avg_confidence"),
            F.max("confidence").alias("max_confidence"),
        )
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            *by,
            "alerts",
            "avg_confidence",
            "max_confidence",
        )
    )


def stream_summary(
    alerts: DataFrame,
    out: str,
    checkpoint: str,
    length: str = "1 minute",
    slide: str | None = None,
    by: Sequence[str] = (),
    ts: str = "ts",
    watermark: str = WATERMARK,
    interval: str | None = None,
) -> StreamingQuery:
    """Tumbling windows, or sliding ones with ``slide``; a window is written once closed."""
    summary = windowed_summary(alerts, length, slide, by, ts, watermark)
    return start(_to_parquet(summary, out), checkpoint, interval)


def stream_alert_summary(
    alerts: DataFrame,
    out: str,
    checkpoint: str,
    key: Sequence[str],
    length: str = "1 minute",
    n: int = LATEST,
    ts: str = "ts",
    interval: str | None = None,
) -> StreamingQuery:
    """Keep the summary of each window in ``out``: total, counts per kind, the newest ``n`` alerts.

    The rows of a batch are merged into parts that fold, so an alert that comes
    late still counts in its own window.
    """
    by = ["window_start"]

    def keep(batch: DataFrame, batch_id: int) -> None:
        placed = batch.withColumn("window_start", F.window(F.col(ts).cast("timestamp"), length)["start"])
        rows = summary_rows(placed, key, by, n, ts)
        parts.fold_part(rows, out, batch_id, lambda several: merge_summary_rows(several, by, n))

    return start(alerts.writeStream.foreachBatch(keep), checkpoint, interval)


def read_alert_summary(spark: SparkSession, out: str, n: int = LATEST) -> DataFrame | None:
    """A nested row for each window."""
    stored = parts.stored_spans(spark, out)
    if not stored:
        return None
    rows = parts.read_state(spark, out, parts.schema_of(spark, out, stored[-1]), max(last for _, last in stored))
    return summary_document(merge_summary_rows(rows, ["window_start"], n), ["window_start"], n)


def deduplicate(
    rows: DataFrame, key: Sequence[str], ts: str = "ts", watermark: str = WATERMARK
) -> DataFrame:
    """One row of each key; a key is remembered for the watermark's length.

    A first round works per key and salt, where the salt is the task that read
    the row: however hot a key is, the second round sees it once per salt.
    """
    salted = rows.withWatermark(ts, watermark).withColumn(
        "__salt", F.pmod(F.spark_partition_id(), F.lit(DEDUP_SALTS))
    )
    once = salted.dropDuplicatesWithinWatermark([*key, "__salt"]).drop("__salt")
    return once.dropDuplicatesWithinWatermark(list(key))


def stream_dedup(
    rows: DataFrame,
    key: Sequence[str],
    out: str,
    checkpoint: str,
    ts: str = "ts",
    watermark: str = WATERMARK,
    interval: str | None = None,
) -> StreamingQuery:
    return start(_to_parquet(deduplicate(rows, key, ts, watermark), out), checkpoint, interval)


def running_totals(
    flows: DataFrame, label: str = "label", flag: str | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Rows, anomalies and flipped rows so far; an anomaly stays one when flipped."""
    flipped = F.col(flag) if flag else F.lit(False)
    return flows.groupBy(*by).agg(
        F.count("*").alias("generated"),
        F.count_if((F.col(label) == 1) | flipped).alias("anomalies"),
        F.count_if(flipped).alias("flipped"),
    )


def _add_totals(totals: DataFrame, by: Sequence[str]) -> DataFrame:
    return totals.groupBy(*by).agg(*[F.sum(c).alias(c) for c in ("generated", "anomalies", "flipped")])


def stream_running_totals(
    flows: DataFrame,
    out: str,
    checkpoint: str,
    label: str = "label",
    flag: str | None = None,
    by: Sequence[str] = (),
    interval: str | None = None,
) -> StreamingQuery:
    """Keep the totals so far in ``out``, in parts that fold; no group is kept in the stream's own state."""

    def keep(batch: DataFrame, batch_id: int) -> None:
        totals = running_totals(batch, label, flag, by)
        parts.fold_part(totals, out, batch_id, lambda rows: _add_totals(rows, by))

    return start(flows.writeStream.foreachBatch(keep), checkpoint, interval)


def latest_totals(spark: SparkSession, out: str, by: Sequence[str] = ()) -> DataFrame | None:
    """Totals after the newest batch."""
    stored = parts.stored_spans(spark, out)
    if not stored:
        return None
    newest = max(last for _, last in stored)
    schema = parts.schema_of(spark, out, stored[-1])
    return _add_totals(parts.read_state(spark, out, schema, newest), by)


def stream_late(
    rows: DataFrame,
    out: str,
    checkpoint: str,
    length: str,
    ts: str = "ts",
    watermark: str = WATERMARK,
    interval: str | None = None,
) -> StreamingQuery:
    """Write the rows that a tumbling summary of ``length`` drops as too late, one part per batch.

    A row is late if its window ended before the watermark that was in force when
    its batch began: the newest time of all batches before, less ``watermark``.
    The newest times are kept in parts that fold, so a batch that is run again
    comes to the same rows.  Times count in milliseconds, as in the engine.
    """
    times, late = join_path(out, "times"), join_path(out, "late")

    def newest(batch: DataFrame) -> DataFrame:
        return batch.agg(F.max(ts).cast("timestamp").alias("newest"))

    def keep(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen = newest(batch)
        before = parts.read_state(spark, times, seen.schema, batch_id - 1)
        limit = before.agg(F.max("newest")).first()[0] if before is not None else None
        if limit is not None:
            in_force = F.date_trunc("millisecond", F.lit(limit)) - F.expr(f"INTERVAL {watermark}")
            behind = batch.where(F.window(F.col(ts), length)["end"] <= in_force)
            tables.write_part(behind, late, "batch_id", batch_id)
        parts.fold_part(seen, times, batch_id, lambda rows: rows.agg(F.max("newest").alias("newest")))

    return start(rows.writeStream.foreachBatch(keep), checkpoint, interval)


def read_late(spark: SparkSession, out: str) -> DataFrame | None:
    return tables.read_table(spark, join_path(out, "late"))


def dropped_rows(query: StreamingQuery) -> int:
    """Rows (after partial aggregation) that the engine reports as dropped by the watermark."""
    progress = query.recentProgress
    return sum(state["numRowsDroppedByWatermark"] for p in progress for state in p["stateOperators"])


def late_rows(
    source: DataFrame,
    windows: DataFrame,
    late: DataFrame | None,
    closed_before: Column,
    length: str,
    ts: str = "ts",
) -> DataFrame:
    """Source rows per closed window, how many were counted in it, and how many came too late.

    ``windows`` is the output of a tumbling ``stream_summary`` without further
    grouping, ``late`` that of ``stream_late`` over the same rows.  The three
    figures come from three places: where ``arrived`` is not ``counted`` plus
    ``late``, rows were lost in another way.
    """

    def by_window(rows: DataFrame, name: str) -> DataFrame:
        counted = rows.groupBy(F.window(ts, length).alias("window")).agg(F.count("*").alias(name))
        return counted.select(
            F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), name
        )

    arrived = by_window(source, "arrived").where(F.col("window_end") <= closed_before)
    counted = windows.select("window_start", F.col("alerts").alias("counted"))
    behind = by_window(source.limit(0) if late is None else late, "late").drop("window_end")
    joined = arrived.join(counted, "window_start", "left").join(behind, "window_start", "left")
    return joined.select(
        "window_start",
        "window_end",
        "arrived",
        F.coalesce("counted", F.lit(0)).alias("counted"),
        F.coalesce("late", F.lit(0)).alias("late"),
    )
