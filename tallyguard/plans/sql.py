"""Building blocks of the comparison SQL."""

from __future__ import annotations

from collections.abc import Sequence


def r(expr: str) -> str:
    """Round as ``registry.comparable`` does."""
    return f"(round(CAST({expr} AS DOUBLE), 6) + CAST(0 AS DOUBLE))"


def t(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%f')"


def ratio(a: str, b: str) -> str:
    return f"coalesce(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0), 0)"


def hex_long(text: str, digits: int = 8) -> str:
    return f"CAST(('0x' || substring(md5({text}), 1, {digits})) AS BIGINT)"


def bucket(col: str) -> str:
    return f"(CASE WHEN {col} = '' THEN 0 ELSE {hex_long(col)} % 1000 END)"


EV = """ev AS (
  SELECT event_id, ts, event_type AS category, value AS x1,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS x2,
         CAST(hour(ts) AS DOUBLE) AS x3, CAST(user_id AS DOUBLE) AS x4,
         CAST(CASE WHEN event_type <> 'view' THEN 1 ELSE 0 END AS INTEGER) AS label
  FROM events)"""

EV_GAPS = f"""{EV}, gaps AS (
  SELECT * REPLACE (CASE WHEN category = 'click' AND x2 >= 50 THEN NULL ELSE category END AS category) FROM ev)"""

EV_FEATURES = ("x1", "x2", "x3", "x4")

LI_FEATURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
LI = """li AS (
  SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
         l_returnflag, l_linestatus,
         CAST(CASE WHEN l_returnflag <> 'N' THEN 1 ELSE 0 END AS INTEGER) AS label
  FROM lineitem)"""


def model(
    name: str,
    source: str,
    features: Sequence[str] = EV_FEATURES,
    where: str = "category = 'view'",
    keys: str = "",
) -> str:
    """CTE with ``m<i>, s<i>, n``; ``keys`` adds grouping columns."""
    stats = []
    for i, f in enumerate(features):
        stats.append(f"avg({f}) AS m{i}")
        stats.append(
            f"CASE WHEN stddev_pop({f}) <= 1e-12 * abs(avg({f})) THEN 0 "
            f"ELSE stddev_pop({f}) END AS s{i}"
        )
    head = f"{keys}, " if keys else ""
    tail = f" GROUP BY {keys}" if keys else ""
    return f"{name} AS (SELECT {head}count(*) AS n, {', '.join(stats)} FROM {source} WHERE {where}{tail})"


def scored(
    name: str,
    source: str,
    model_name: str,
    features: Sequence[str] = EV_FEATURES,
    threshold: float = 1.4,
    extra: str = "",
) -> str:
    """CTEs that add z<i>, prediction and confidence to every row of ``source``."""
    k = len(features)
    zs = ", ".join(f"abs({f} - m{i}) / nullif(s{i}, 0) AS z{i}" for i, f in enumerate(features))
    votes = " + ".join(f"CASE WHEN z{i} > {threshold}::DOUBLE THEN 1 ELSE 0 END" for i in range(k))
    z_sum = " + ".join(
        f"CASE WHEN z{i} > {threshold}::DOUBLE THEN z{i} ELSE 0 END" for i in range(k)
    )
    return f"""{name}_z AS (SELECT f.*{extra}, {zs} FROM {source} f, {model_name} m),
{name}_v AS (SELECT *, {votes} AS votes, {z_sum} AS z_sum FROM {name}_z),
{name} AS (SELECT *, CAST(CASE WHEN votes > {k} * 0.10::DOUBLE THEN 1 ELSE 0 END AS INTEGER) AS prediction,
  CASE WHEN votes > 0 THEN least(z_sum / (votes * 5), 1) ELSE 0 END AS confidence FROM {name}_v)"""


EV_SCORED = f"{EV}, {model('model', 'ev')}, {scored('scored', 'ev', 'model')}"
EV_ALERTS = f"""{EV_SCORED}, alerts AS (
  SELECT event_id, ts, 'ANOMALY' AS prediction, category AS anomaly_type, confidence
  FROM scored WHERE prediction = 1 AND confidence >= 0.4::DOUBLE)"""

CONFUSION = """count_if(prediction = 1 AND label = 1) AS tp, count_if(prediction = 1 AND label = 0) AS fp,
  count_if(prediction = 0 AND label = 0) AS tn, count_if(prediction = 0 AND label = 1) AS fn, count(*) AS total"""


def metrics(source: str, keys: str = "", extra: str = "") -> str:
    """Select of confusion counts and metrics from a CTE that has CONFUSION's columns."""
    head = f"{keys}, " if keys else ""
    tail = f", {extra}" if extra else ""
    return f"""SELECT {head}CAST(tp AS BIGINT) AS true_positives, CAST(fp AS BIGINT) AS false_positives,
  CAST(tn AS BIGINT) AS true_negatives, CAST(fn AS BIGINT) AS false_negatives, total AS total_samples,
  {ratio('tp + tn', 'total')} AS accuracy, {ratio('tp', 'tp + fp')} AS "precision",
  {ratio('tp', 'tp + fn')} AS recall,
  {ratio('2 * ' + ratio('tp', 'tp + fp') + ' * ' + ratio('tp', 'tp + fn'),
         ratio('tp', 'tp + fp') + ' + ' + ratio('tp', 'tp + fn'))} AS f1_score{tail} FROM {source}"""


TARGET_COUNTS = ", ".join(
    f"count_if(category = '{c}' AND prediction = 1) AS hit_{c}, count_if(category = '{c}') AS all_{c}"
    for c in ("error", "purchase", "signup")
)
TARGET_RATES = ", ".join(
    f"{ratio(f'hit_{c}', f'all_{c}')} AS {c}_detection_rate" for c in ("error", "purchase", "signup")
)
RATES = (
    "accuracy", '"precision"', "recall", "f1_score",
    "error_detection_rate", "purchase_detection_rate", "signup_detection_rate",
)
COUNTS = (
    "true_positives", "false_positives", "true_negatives", "false_negatives", "total_samples",
)

HIST = f"""{EV_SCORED},
hist_c AS (SELECT CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) AS iteration,
  max(ts) AS ts, {CONFUSION}, {TARGET_COUNTS} FROM scored GROUP BY 1),
hist_m AS ({metrics('hist_c', 'iteration, ts', TARGET_RATES)}),
hist AS (SELECT iteration, ts, {', '.join(COUNTS)}, {', '.join(f'round({c}, 4) AS {c}' for c in RATES)} FROM hist_m),
long AS (SELECT iteration, metric, value FROM hist UNPIVOT (value FOR metric IN (accuracy, "precision", recall, f1_score)))"""

SNAP_CUTS = "(VALUES (0, TIMESTAMP '1998-01-01'), (1, TIMESTAMP '2000-01-01'), (2, TIMESTAMP '2100-01-01')) c(snapshot_id, cut)"
SNAP = f"""snap AS (SELECT CAST(snapshot_id AS INTEGER) AS snapshot_id, o_orderkey, o_custkey,
  o_orderstatus, o_totalprice, o_orderpriority FROM orders, {SNAP_CUTS} WHERE o_orderdate < cut)"""

DOC = """doc AS (SELECT doc_id, lang, source AS category, quality, toxic AS label
  FROM documents JOIN labels USING (doc_id))"""

LOG = """log AS (
  SELECT event_id, category, ts, x1, x2, x4,
    CASE category WHEN 'purchase' THEN 'anomaly_detection' WHEN 'signup' THEN 'model_training'
      WHEN 'error' THEN 'system_event' WHEN 'click' THEN 'unknown' END AS type,
    CASE WHEN category = 'purchase' THEN CASE WHEN x2 / 100 >= 0.8::DOUBLE THEN 'high_confidence_anomaly' END
      WHEN category = 'signup' AND x1 > 50 THEN 'performance_degradation'
      WHEN category = 'error' OR (category = 'view' AND x2 >= 90) THEN 'system_error' END AS alert_type
  FROM ev)"""
SEVERITY = """CASE alert_type WHEN 'high_confidence_anomaly' THEN 'HIGH'
  WHEN 'performance_degradation' THEN 'MEDIUM' WHEN 'system_error' THEN 'CRITICAL' END"""


def ranked(source: str, key: str, seed: int, by: str) -> str:
    """Row number within ``by`` in the order of the seeded digest."""
    return (
        f"row_number() OVER (PARTITION BY {by} ORDER BY md5(concat_ws('|', '{seed}', {key})), {key})"
    )


def test_set(
    name: str, source: str, key: str, size: int, normal: str, targets: Sequence[str],
    category: str = "category", seed: int = 42, columns: str = "*",
) -> str:
    """CTEs of a fixed test set: a fifth targets if there are enough."""
    wanted = ", ".join(f"'{v}'" for v in targets)
    a = int(size * 0.2)
    return f"""{name}_s AS (SELECT {columns}, {category} IN ({wanted}) AS is_target FROM {source}
  WHERE {category} = '{normal}' OR {category} IN ({wanted})),
{name}_q AS (SELECT least({a}, count_if(is_target)) AS qt, count_if(NOT is_target) AS normals FROM {name}_s),
{name}_r AS (SELECT *, {ranked(name + '_s', key, seed, 'is_target')} AS rn FROM {name}_s),
{name} AS (SELECT {name}_r.* FROM {name}_r, {name}_q
  WHERE CASE WHEN is_target THEN rn <= qt ELSE rn <= least({size} - qt, normals) END)"""


def label_test_set(name: str, source: str, key: str, size: int, seed: int = 42) -> str:
    """CTEs of a synthetic test set: normals first."""
    n = int(size * 0.8)
    return f"""{name}_q AS (SELECT least({n}, count_if(label = 0)) AS qn, count_if(label = 1) AS anomalies FROM {source}),
{name}_r AS (SELECT *, {ranked(source, key, seed, 'label')} AS rn FROM {source} WHERE label IN (0, 1)),
{name} AS (SELECT {name}_r.* FROM {name}_r, {name}_q
  WHERE CASE WHEN label = 0 THEN rn <= qn ELSE rn <= least({size} - qn, anomalies) END)"""
