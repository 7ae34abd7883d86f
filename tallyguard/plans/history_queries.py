"""Queries over the metric history and the retraining events."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate as V
from ..operators import history as H
from ..operators import noise as N
from ..operators import quality as Q
from ..operators import score as S
from ..operators.baseline import fit_baseline
from ..schema import history_schema
from ..session import work_folder
from ..sources import tables
from . import bindings as D
from .registry import query
from .sql import (
    CONFUSION,
    COUNTS,
    EV,
    EV_SCORED,
    HIST,
    RATES,
    TARGET_COUNTS,
    TARGET_RATES,
    metrics,
    model,
    r,
    scored,
    t,
)

METRICS = ("accuracy", "precision", "recall", "f1_score")
HIST_ROWS = f"iteration, {t('ts')} AS ts, {', '.join(COUNTS)}, {', '.join(f'{r(c)} AS {c}' for c in RATES)}"


@query(
    "history_append",
    f"""WITH {EV_SCORED}, {model('old', 'ev', where="category = 'view' AND ts < TIMESTAMP '2024-01-11'")},
  {scored('early', 'ev', 'old')},
  c AS (SELECT 1 AS iteration, {CONFUSION}, {TARGET_COUNTS} FROM early
    UNION ALL SELECT 2, {CONFUSION}, {TARGET_COUNTS} FROM scored),
  m AS ({metrics('c', 'iteration', TARGET_RATES)})
  SELECT iteration, {', '.join(COUNTS)}, {', '.join(f"{r(f'round({c}, 4)')} AS {c}" for c in RATES)} FROM m""",
)
def history_append(spark, sf):
    """Two cycles; the second is recorded twice and still counts once."""
    folder = work_folder(spark, "history")
    flows = D.ev(spark, sf)
    early = fit_baseline(
        flows.where(F.col("ts") < F.lit("2024-01-11").cast("timestamp")), D.EV_FEATURES, D.ev_normal()
    )
    first = S.score(flows, early, D.EV_FEATURES)
    tables.append_history(V.evaluate_model(first, D.EV_TARGETS), folder, 1)
    for _ in range(2):
        tables.append_history(V.evaluate_model(D.ev_scored(spark, sf), D.EV_TARGETS), folder, 2)
    return tables.read_history(spark, folder)


@query("history_scan", f"WITH {HIST} SELECT {HIST_ROWS} FROM hist")
def history_scan(spark, sf):
    """All cycles stored at once, twice; each replaces itself."""
    folder = work_folder(spark, "history")
    for _ in range(2):
        tables.append_cycles(D.history(spark, sf), folder)
    return tables.read_history(spark, folder, history_schema(D.EV_TARGETS))


EVENTS_SQL = f"{HIST}, events_log AS (SELECT iteration, CASE WHEN recall >= 0.55::DOUBLE THEN 'success' ELSE 'skipped' END AS status FROM hist)"


def _events(spark, sf, folder: str):
    """One attempt per cycle, recorded twice; it counts as a success where recall is high enough."""
    history = D.stored_history(spark, sf)
    good = F.col("recall") >= F.lit(0.55)
    events = history.select(
        "iteration",
        "ts",
        F.when(good, "success").otherwise("skipped").alias("status"),
        F.when(good, "").otherwise("recall too low").alias("message"),
        F.lit(1.0).alias("duration_seconds"),
        F.concat(F.lit("m"), "iteration").alias("model_id"),
    )
    for _ in range(2):
        tables.append_cycles(events, folder)
    return tables.read_retrain_events(spark, folder)


@query(
    "retrain_event_log",
    f"WITH {EVENTS_SQL} SELECT iteration, status, 'm' || iteration AS model_id FROM events_log",
)
def retrain_event_log(spark, sf):
    return _events(spark, sf, work_folder(spark, "events")).select("iteration", "status", "model_id")


@query(
    "retrain_cycle_count",
    f"WITH {EVENTS_SQL} SELECT count(*) AS attempts, CAST(count_if(status = 'success') AS BIGINT) AS cycles FROM events_log",
)
def retrain_cycle_count(spark, sf):
    return H.retrain_cycle_count(_events(spark, sf, work_folder(spark, "events")))


@query("cycle_history", f"WITH {HIST} SELECT {HIST_ROWS} FROM hist")
def cycle_history(spark, sf):
    return D.history(spark, sf)


@query(
    "metric_stats",
    f"""WITH {HIST} SELECT metric, count(*) AS n, {r('avg(value)')} AS mean, {r('min(value)')} AS min,
  {r('max(value)')} AS max, {r('stddev_pop(value)')} AS std FROM long GROUP BY metric""",
)
def metric_stats(spark, sf):
    return H.metric_stats(D.stored_history(spark, sf))


RANKED = f"{HIST}, k AS (SELECT *, row_number() OVER (PARTITION BY metric ORDER BY iteration) AS rn, count(*) OVER (PARTITION BY metric) AS n FROM long)"


@query(
    "metric_trend",
    f"""WITH {RANKED} SELECT metric, max(n) AS n,
  {r('avg(CASE WHEN rn > n // 2 THEN value END) - avg(CASE WHEN rn <= n // 2 THEN value END)')} AS trend
  FROM k GROUP BY metric""",
)
def metric_trend(spark, sf):
    return H.metric_trend(D.stored_history(spark, sf))


@query(
    "degradation_alert",
    f"""WITH {RANKED}, d AS (SELECT metric, max(n) AS n, avg(CASE WHEN rn <= 3 THEN value END) AS baseline,
    max(CASE WHEN rn = n THEN value END) AS current FROM k GROUP BY metric)
  SELECT metric, n, {r('baseline')} AS baseline, {r('current')} AS current, {r('(baseline - current) / baseline')} AS drop,
    (baseline - current) / baseline >= 0.02::DOUBLE AS alert FROM d""",
)
def degradation_alert(spark, sf):
    return H.degradation_alert(D.stored_history(spark, sf), threshold=0.02)


COMPARED = {
    "accuracy": 100,
    "precision": 100,
    "recall": 100,
    "f1_score": 1,
    "false_negatives": 1,
    "error_detection_rate": 100,
    "purchase_detection_rate": 100,
    "signup_detection_rate": 100,
}


def _compare_sql(m: str, factor: int) -> str:
    b, c = f'b."{m}" * {factor}::DOUBLE', f'c."{m}" * {factor}::DOUBLE'
    return f"""SELECT '{m}' AS metric, b.iteration AS baseline_cycle, c.iteration AS current_cycle,
  {r(b)} AS baseline, {r(c)} AS current, {r(f'{c} - {b}')} AS change FROM b, c"""


@query(
    "baseline_vs_current",
    f"""WITH {HIST}, b AS (SELECT * FROM hist WHERE iteration < 12 ORDER BY iteration DESC LIMIT 1),
  c AS (SELECT * FROM hist ORDER BY iteration DESC LIMIT 1) {' UNION ALL '.join(_compare_sql(m, f) for m, f in COMPARED.items())}""",
)
def baseline_vs_current(spark, sf):
    return H.baseline_vs_current(D.stored_history(spark, sf), COMPARED, 12)


@query(
    "scaled_series",
    f"""WITH {HIST}, l AS (SELECT iteration, 'recall' AS metric, recall AS value FROM hist UNION ALL
    SELECT iteration, 'accuracy', accuracy FROM hist UNION ALL SELECT iteration, 'false_negatives', false_negatives FROM hist),
  b AS (SELECT metric, min(value) AS low, max(value) AS high FROM l GROUP BY metric)
  SELECT iteration, metric, {r('value')} AS value,
    CASE WHEN high > low THEN CAST(trunc((value - low) / (high - low) * 40) AS INTEGER) ELSE 40 END AS bar FROM l JOIN b USING (metric)""",
)
def scaled_series(spark, sf):
    return H.scaled_series(D.stored_history(spark, sf), ["recall", "accuracy", "false_negatives"])


CHANGES = ", ".join(
    f'{r(f"""h."{m}" """)} AS "{m}", {r(f"""h."{m}" - p."{m}" """)} AS {m}_change, '
    f'{r(f"""(p."{m}" - h."{m}") / nullif(p."{m}", 0) * 100""")} AS {m}_drop_percent'
    for m in METRICS
)


@query(
    "cycle_deltas",
    f"WITH {HIST} SELECT h.iteration, {CHANGES} FROM hist h ASOF LEFT JOIN hist p ON h.iteration > p.iteration",
)
def cycle_deltas(spark, sf):
    return H.cycle_deltas(D.stored_history(spark, sf))


@query(
    "noise_activation",
    f"""WITH {EV}, c AS (SELECT date_diff('day', DATE '2024-01-01', CAST(ts AS DATE))::INTEGER AS cycle,
    count_if(category = 'error') >= count_if(category = 'view') AS enabled FROM ev GROUP BY 1),
  i AS (SELECT *, count_if(NOT enabled) OVER (ORDER BY cycle) AS island FROM c),
  s AS (SELECT *, min(CASE WHEN enabled AND cycle >= 3 THEN cycle END) OVER (PARTITION BY island ORDER BY cycle) AS start FROM i)
  SELECT cycle, enabled, enabled AND start IS NOT NULL AS is_active,
    last_value(CASE WHEN enabled THEN start END IGNORE NULLS) OVER (ORDER BY cycle) AS started_at_cycle FROM s""",
)
def noise_activation(spark, sf):
    """Noise is enabled on days with at least as many errors as views."""
    cycles = (
        D.with_cycle(D.ev(spark, sf))
        .groupBy("cycle")
        .agg(
            (
                F.count_if(F.col("category") == "error") >= F.count_if(F.col("category") == "view")
            ).alias("enabled")
        )
    )
    return N.noise_activation(cycles)


@query(
    "check_history",
    f"""WITH {HIST}, c AS (SELECT count(*) AS n, max_by(accuracy, iteration) AS a, max_by(recall, iteration) AS b FROM hist)
  SELECT 'required_columns' AS check_name, true AS passed, '' AS detail UNION ALL SELECT 'not_empty', n > 0, CAST(n AS VARCHAR) FROM c
  UNION ALL SELECT metric || '_range', count_if(value BETWEEN 0 AND 1) = (SELECT n FROM c),
    CAST((SELECT n FROM c) - count_if(value BETWEEN 0 AND 1) AS VARCHAR) FROM long GROUP BY metric
  UNION ALL SELECT 'latest_accuracy', true, printf('%.3f', a) FROM c UNION ALL SELECT 'latest_recall', true, printf('%.3f', b) FROM c""",
)
def check_history(spark, sf):
    return Q.check_history(D.stored_history(spark, sf))


@query(
    "history_report",
    f"""WITH {HIST} SELECT count(*) AS history_count, max(iteration) AS last_iteration, {r('max_by(accuracy, iteration)')} AS last_accuracy,
  {r('avg(recall)')} AS mean_recall, {r('stddev_pop(f1_score)')} AS std_f1, 'active' AS status FROM hist""",
)
def history_report(spark, sf):
    return H.history_report(D.stored_history(spark, sf)).select(
        "history_count",
        F.col("current_metrics.iteration").alias("last_iteration"),
        F.col("current_metrics.accuracy").alias("last_accuracy"),
        F.col("recall_stats.mean").alias("mean_recall"),
        F.col("f1_score_stats.std").alias("std_f1"),
        "status",
    )
