"""Streaming jobs run over the available rows; each result is read back as a table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.noise import inject_label_noise
from ..operators.sampling import TEST_SIZE, choose_test_set, train_minus_test
from ..operators.score import score, score_alerts
from ..session import join_path, work_folder
from ..sources import tables
from ..streaming import jobs as J
from . import bindings as D
from .flow_queries import ALERT_ROWS, SUMMARY_SQL, _noisy_sql, summary_text
from .log_queries import LOGS, ROUTED
from .registry import query
from .sql import (
    CONFUSION,
    COUNTS,
    EV,
    EV_ALERTS,
    RATES,
    TARGET_COUNTS,
    TARGET_RATES,
    label_test_set,
    metrics,
    r,
    scored,
    t,
    test_set,
)


def _folders(spark, name: str) -> tuple[str, str]:
    base = work_folder(spark, name)
    return join_path(base, "out"), join_path(base, "checkpoint")


def _finish(job) -> None:
    job.awaitTermination()


def _frozen_model(spark, sf):
    return tables.freeze_model(D.ev_model(spark, sf))


def _flow_stream(spark, sf):
    return D.as_flows(D.events_stream(spark, sf))


def _alert_stream(spark, sf):
    return score_alerts(
        _flow_stream(spark, sf), _frozen_model(spark, sf), D.EV_FEATURES, ["event_id"], ts="ts"
    )


@query("stream_score", f"SELECT *, 'monitor' AS container FROM ({ALERT_ROWS})")
def stream_score(spark, sf):
    out, checkpoint = _folders(spark, "stream-score")
    _finish(
        J.stream_score(
            _flow_stream(spark, sf),
            _frozen_model(spark, sf),
            D.EV_FEATURES,
            ["event_id"],
            out,
            checkpoint,
            ts="ts",
            container="monitor",
        )
    )
    return spark.read.parquet(out)


@query(
    "stream_log_alerts",
    f"""WITH {LOGS}, routed AS ({ROUTED}) SELECT alert_type, severity, ts, confidence, degradation_percent, component, error_code, message FROM routed""",
)
def stream_log_alerts(spark, sf):
    base = work_folder(spark, "stream-logs")
    lines = join_path(base, "lines")
    D.log_lines(spark, sf).select("value").write.text(lines)
    out, checkpoint = join_path(base, "out"), join_path(base, "checkpoint")
    as_of = F.lit("2024-02-01").cast("timestamp")
    _finish(J.stream_log_alerts(spark.readStream.text(lines), out, checkpoint, as_of))
    return spark.read.parquet(out).select(
        "alert_type",
        "severity",
        "ts",
        "confidence",
        "degradation_percent",
        "component",
        "error_code",
        "message",
    )


def _ticks(rows, column: str, dates, folder: str):
    """Write the rows slice by slice, as a growing source; yields after each slice."""
    before = None
    for number, date in enumerate(dates):
        end = F.lit(date).cast("timestamp")
        inside = F.col(column) < end if before is None else (F.col(column) < end) & (F.col(column) >= before)
        rows.where(inside).write.mode("append").parquet(folder)
        before = end
        yield number


@query(
    "stream_snapshots",
    """SELECT CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 0 WHEN o_orderdate < TIMESTAMP '2000-01-01' THEN 1 ELSE 2 END AS snapshot_id,
  o_orderkey FROM orders""",
)
def stream_snapshots(spark, sf):
    """Three ticks over a growing table: each snapshot holds what is new."""
    base = work_folder(spark, "stream-snapshots")
    source, table = join_path(base, "source"), join_path(base, "table")
    rows = D.orders(spark, sf)
    for _ in _ticks(rows, "o_orderdate", D.SNAP_DATES, source):
        arrived = spark.readStream.schema(rows.schema).parquet(source)
        _finish(J.stream_snapshots(arrived, table, join_path(base, "checkpoint")))
    return tables.read_table(spark, table).select("snapshot_id", "o_orderkey")


def _cycle_sql() -> str:
    """Per tick: the test set, the training rows without it, and the model of these."""
    cuts = ", ".join(f"({i}, TIMESTAMP '{d}')" for i, d in enumerate(D.SLICE_DATES))
    stats = ", ".join(f"avg(x{i + 1}) AS m{i}, stddev_pop(x{i + 1}) AS s{i}" for i in range(4))
    return f"""{EV}, cuts AS (SELECT * FROM (VALUES {cuts}) c(iteration, cut)),
  arrived AS (SELECT ev.* FROM ev, cuts WHERE iteration = 1 AND ts < cut),
  {test_set('first_set', 'ev', 'event_id', 500, 'view', tuple(D.EV_TARGETS))},
  {label_test_set('later_set', 'arrived', 'event_id', 500)},
  tests AS (SELECT iteration, event_id FROM cuts, first_set WHERE iteration = 0
    UNION ALL SELECT iteration, event_id FROM cuts, later_set WHERE iteration > 0),
  history AS (SELECT iteration, ev.* FROM cuts, ev UNION ALL SELECT iteration, ev.* FROM cuts, ev WHERE ts < cut),
  train AS (SELECT * FROM history ANTI JOIN tests USING (iteration, event_id)),
  overlap AS (SELECT iteration, count(tests.event_id) AS overlap FROM cuts
    LEFT JOIN (SELECT * FROM tests SEMI JOIN train USING (iteration, event_id)) tests USING (iteration) GROUP BY 1),
  models AS (SELECT iteration, count(*) AS n, {stats} FROM train WHERE category = 'view' GROUP BY iteration),
  judged AS (SELECT ev.*, iteration AS cycle FROM tests JOIN ev USING (event_id))"""


@query(
    "stream_retrain",
    f"""WITH {_cycle_sql()}, {scored('s', 'judged', 'models', extra=', m.iteration')},
  c AS (SELECT iteration, {CONFUSION}, {TARGET_COUNTS} FROM s WHERE cycle = iteration GROUP BY iteration), m AS ({metrics('c', 'iteration', TARGET_RATES)})
  SELECT iteration, {', '.join(COUNTS)}, {', '.join(f"{r(f'round({c}, 4)')} AS {c}" for c in RATES)},
    models.n AS fitted_rows, overlap FROM m JOIN models USING (iteration) JOIN overlap USING (iteration)""",
)
def stream_retrain(spark, sf):
    """Three ticks: each fits on all events plus the slices so far, without the rows of the test set.

    In the first tick too few rows have arrived, so the test set is a fallback of
    original rows; the second one draws the set that stays.  ``overlap`` compares
    the rows that the stored model was fitted on with the rows that remain when
    the test rows are taken out of the whole history.
    """
    base = work_folder(spark, "stream-retrain")
    source = join_path(base, "source")
    flows = D.ev(spark, sf)
    first_slice = flows.where(F.col("ts") < F.lit(D.SLICE_DATES[0]).cast("timestamp")).count()
    used = []

    def build_test(arrived):
        test, is_real = choose_test_set(
            arrived, flows, ["event_id"], TEST_SIZE, max(first_slice + 1, TEST_SIZE), **D.EV_KINDS
        )
        used.append(test)
        return test, is_real

    step = J.retrain_step(
        original=flows,
        build_test=build_test,
        features=D.EV_FEATURES,
        targets=D.EV_TARGETS,
        folder=base,
        min_new=30,
        normal=D.ev_normal(),
        max_test_rows=TEST_SIZE,
    )
    for _ in _ticks(flows, "ts", D.SLICE_DATES, source):
        arrived = spark.readStream.schema(flows.schema).parquet(source)
        _finish(J.stream_retrain(arrived, step, join_path(base, "checkpoint")))
    models = tables.read_models(spark, join_path(base, "models"))
    fitted = models.groupBy(F.substring("model_id", 7, 6).cast("int").alias("iteration")).agg(
        F.max("n").alias("fitted_rows")
    )
    snapshots = tables.read_table(spark, join_path(base, "snapshots"))
    left = []
    for tick in range(len(D.SLICE_DATES)):
        test = used[0] if tick == 0 else tables.read_test_set(spark, join_path(base, "test_sets"))
        rows = flows.unionByName(snapshots.where(F.col("snapshot_id") <= tick).select(*flows.columns))
        kept = train_minus_test(rows, test.select(*flows.columns), TEST_SIZE)
        left.append(kept.where(D.ev_normal()).agg(F.lit(tick).alias("iteration"), F.count("*").alias("left")))
    history = tables.read_history(spark, join_path(base, "history")).drop("ts")
    both = fitted.join(reduce(DataFrame.unionByName, left), "iteration")
    both = both.withColumn("overlap", F.col("fitted_rows") - F.col("left")).drop("left")
    return history.join(both, "iteration")


@query(
    "stream_summary_tumbling",
    f"""WITH {EV_ALERTS}, w AS (SELECT time_bucket(INTERVAL 1 MINUTE, ts) AS s, * FROM alerts)
  SELECT {t('s')} AS window_start, {t('s + INTERVAL 1 MINUTE')} AS window_end, count(*) AS alerts,
    {r('avg(confidence)')} AS avg_confidence, {r('max(confidence)')} AS max_confidence FROM w
  WHERE s + INTERVAL 1 MINUTE <= (SELECT max(ts) FROM alerts) - INTERVAL 10 MINUTE GROUP BY s""",
)
def stream_summary_tumbling(spark, sf):
    out, checkpoint = _folders(spark, "stream-tumbling")
    _finish(J.stream_summary(_alert_stream(spark, sf), out, checkpoint, "1 minute"))
    return spark.read.parquet(out)


@query(
    "alert_summary_minutes",
    f"""WITH {EV_ALERTS}, w AS (SELECT time_bucket(INTERVAL 1 MINUTE, ts) AS s, * FROM alerts),
  placed AS (SELECT s, event_id, anomaly_type AS kind, count(*) OVER (PARTITION BY s, anomaly_type) AS kind_alerts,
    row_number() OVER (PARTITION BY s ORDER BY ts DESC, event_id) AS place FROM w)
  SELECT {t('s')} AS window_start, count(*) AS total_alerts, {SUMMARY_SQL} FROM placed GROUP BY s""",
)
def alert_summary_minutes(spark, sf):
    """The alert summary of each minute, kept up to date over three ticks."""
    base = work_folder(spark, "alert-summaries")
    source, out = join_path(base, "source"), join_path(base, "out")
    rows = D.ev_alerts(spark, sf)
    for _ in _ticks(rows, "ts", D.SLICE_DATES, source):
        arrived = spark.readStream.schema(rows.schema).parquet(source)
        _finish(J.stream_alert_summary(arrived, out, join_path(base, "checkpoint"), ["event_id"]))
    return summary_text(J.read_alert_summary(spark, out))


@query(
    "stream_kpi_sliding",
    f"""WITH {EV_ALERTS}, w AS (SELECT time_bucket(INTERVAL 15 MINUTE, ts) - k * INTERVAL 15 MINUTE AS s, alerts.*
    FROM alerts, range(4) k(k))
  SELECT {t('s')} AS window_start, {t('s + INTERVAL 1 HOUR')} AS window_end, count(*) AS alerts,
    {r('avg(confidence)')} AS avg_confidence, {r('max(confidence)')} AS max_confidence FROM w
  WHERE s + INTERVAL 1 HOUR <= (SELECT max(ts) FROM alerts) - INTERVAL 10 MINUTE GROUP BY s""",
)
def stream_kpi_sliding(spark, sf):
    out, checkpoint = _folders(spark, "stream-sliding")
    _finish(J.stream_summary(_alert_stream(spark, sf), out, checkpoint, "1 hour", "15 minutes"))
    return spark.read.parquet(out)


@query("stream_dedup", ALERT_ROWS)
def stream_dedup(spark, sf):
    """Every alert arrives twice and is kept once."""
    out, checkpoint = _folders(spark, "stream-dedup")
    twice = _alert_stream(spark, sf).unionByName(_alert_stream(spark, sf))
    _finish(J.stream_dedup(twice, ["event_id"], out, checkpoint))
    return spark.read.parquet(out)


@query(
    "stream_running_totals",
    f"""WITH {EV}, {_noisy_sql()} SELECT CAST(x3 AS INTEGER) AS hour, count(*) AS generated,
  CAST(count_if(label = 1 OR flipped) AS BIGINT) AS anomalies, CAST(count_if(flipped) AS BIGINT) AS flipped FROM noisy GROUP BY 1""",
)
def stream_running_totals(spark, sf):
    """Three ticks, added up in parts that fold."""
    base = work_folder(spark, "stream-totals")
    source, out = join_path(base, "source"), join_path(base, "out")
    flows = D.ev(spark, sf)
    for _ in _ticks(flows, "ts", D.SLICE_DATES, source):
        arrived = spark.readStream.schema(flows.schema).parquet(source)
        noisy = inject_label_noise(
            arrived, 0.15, ["event_id"], 7, normal="view", flag="flipped"
        ).withColumn("hour", F.col("x3").cast("int"))
        checkpoint = join_path(base, "checkpoint")
        _finish(J.stream_running_totals(noisy, out, checkpoint, flag="flipped", by=["hour"]))
    return J.latest_totals(spark, out, ["hour"])


LATE_SQL = f"""WITH w AS (SELECT date_trunc('day', ts) AS s, ts, event_type FROM events),
  first AS (SELECT max(ts) - INTERVAL 10 MINUTE AS closed FROM events WHERE event_type <> 'error'),
  last AS (SELECT max(ts) - INTERVAL 10 MINUTE AS closed FROM events),
  c AS (SELECT s, count(*) AS arrived,
    count_if(event_type = 'error' AND s + INTERVAL 1 DAY <= (SELECT closed FROM first)) AS late FROM w GROUP BY s)
  SELECT {t('s')} AS window_start, {t('s + INTERVAL 1 DAY')} AS window_end, arrived,
    CAST(arrived - late AS BIGINT) AS counted, CAST(late AS BIGINT) AS late
  FROM c WHERE s + INTERVAL 1 DAY <= (SELECT closed FROM last)"""


@query("stream_late_rows", LATE_SQL)
def stream_late_rows(spark, sf):
    """All errors arrive in a second tick, when the days before the last one are closed."""
    base = work_folder(spark, "stream-late")
    source, out, late = (join_path(base, name) for name in ("source", "out", "late"))
    flows = score(D.ev(spark, sf), _frozen_model(spark, sf), D.EV_FEATURES)
    is_error = F.col("category") == "error"
    for rows in (flows.where(~is_error), flows.where(is_error)):
        rows.write.mode("append").parquet(source)
        arrived = spark.readStream.schema(flows.schema).parquet(source)
        _finish(J.stream_summary(arrived, out, join_path(base, "checkpoint"), "1 day"))
        _finish(J.stream_late(arrived, late, join_path(base, "late-checkpoint"), "1 day"))
    stored = spark.read.schema(flows.schema).parquet(source)
    closed = D.newest_time(stored) - F.expr("INTERVAL 10 MINUTES")
    return J.late_rows(stored, spark.read.parquet(out), J.read_late(spark, late), closed, "1 day")
