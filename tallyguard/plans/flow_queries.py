"""Queries over flows: encoding, fitting, scoring, evaluation and reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import (
    alert_id,
    bucket,
    capped_ratio,
    clean_name,
    hour_of_iso,
    percent_text,
    time_cutoff,
    try_number,
)
from ..operators import alerts as A
from ..operators import baseline as B
from ..operators import encode as E
from ..operators import evaluate as V
from ..operators import models as M
from ..operators import noise as N
from ..operators import profile as P
from ..operators import quality as Q
from ..operators import score as S
from ..operators import vectors as X
from ..session import work_folder
from ..sources import files, tables
from . import bindings as D
from .registry import query
from .sql import (
    CONFUSION,
    EV,
    EV_ALERTS,
    EV_GAPS,
    EV_SCORED,
    LI,
    LI_FEATURES,
    TARGET_COUNTS,
    TARGET_RATES,
    bucket as sql_bucket,
    hex_long,
    metrics,
    model,
    r,
    ratio as sql_ratio,
    scored,
    t,
)

RAW = ("event_id", "value", "k", "hour", "user_id", "event_type", "label")


def _raw_text(spark: SparkSession, sf: str) -> DataFrame:
    """Events with every cell as text, as a CSV file has them."""
    flows = D.ev(spark, sf)
    return flows.select(
        F.col("event_id").cast("string"),
        F.col("x1").cast("string").alias("value"),
        F.col("x2").cast("string").alias("k"),
        F.col("x3").cast("string").alias("hour"),
        F.col("x4").cast("string").alias("user_id"),
        F.col("category").alias("event_type"),
        F.col("label").cast("string"),
    )


ENCODED = f"""WITH {EV} SELECT event_id, {r('x1')} AS x1, {r('x2')} AS x2, {r('x3')} AS x3, {r('x4')} AS x4,
  {r(sql_bucket('category'))} AS x5, label FROM ev"""


def _encoded(raw: DataFrame) -> DataFrame:
    cells = ["value", "k", "hour", "user_id", "event_type"]
    encoded = E.encode_features(raw, cells)
    return encoded.select(
        F.col("event_id").cast("bigint"),
        *[F.col(c).alias(f"x{i + 1}") for i, c in enumerate(cells)],
        F.col("label").cast("int"),
    )


# Sources and sinks ----------------------------------------------------------


@query(
    "scan_flows",
    f"""WITH {EV} SELECT event_id, {r('x1')} AS x1, {r("CASE WHEN category = 'click' THEN 0 ELSE x2 END")} AS x2,
  {r('x3')} AS x3, {r("CASE WHEN category <> 'signup' THEN x4 END")} AS x4,
  {r(f"CASE WHEN category = 'error' THEN 0 WHEN category <> 'signup' THEN {sql_bucket('category')} END")} AS x5,
  CASE WHEN category <> 'signup' THEN label END AS label FROM ev""",
)
def scan_flows(spark, sf):
    """Clicks have an empty cell, errors an empty quoted one, and the rows of signups end early."""
    folder = work_folder(spark, "flows")
    kind = F.col("event_type")
    start = [F.col("event_id"), F.col("value"), F.when(kind == "click", "").otherwise(F.col("k")), F.col("hour")]
    rest = [F.col("user_id"), F.when(kind == "error", '""').otherwise(kind), F.col("label")]
    line = F.when(kind == "signup", F.concat_ws(",", *start)).otherwise(F.concat_ws(",", *start, *rest))
    # A single column named like the header, so that each file has header and lines as they are.
    lines = _raw_text(spark, sf).select(line.alias(",".join(RAW)))
    lines.write.csv(folder, header=True, sep="\u0001", quote="")
    cells = ("value", "k", "hour", "user_id", "event_type")
    rows = files.scan_flows(spark, folder, RAW, cells, label="label")
    return rows.select(
        F.col("event_id").cast("bigint"),
        *[F.col(c).alias(f"x{i + 1}") for i, c in enumerate(cells)],
        "label",
    )


ALERT_ROWS = f"""WITH {EV_ALERTS} SELECT event_id, {t('ts')} AS ts, prediction, anomaly_type,
  {r('confidence')} AS confidence FROM alerts"""


@query(
    "scan_alert_files",
    f"""WITH {EV_ALERTS} SELECT event_id AS sample_id, anomaly_type, {r('confidence')} AS confidence
  FROM alerts WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 10 DAY""",
)
def scan_alert_files(spark, sf):
    """Alerts written as array documents and read back for a time window."""
    folder = work_folder(spark, "alert-files")
    alerts = D.ev_alerts(spark, sf).select(
        F.col("ts").alias("timestamp"),
        F.col("event_id").alias("sample_id"),
        "prediction",
        "anomaly_type",
        "confidence",
    )
    files.write_alert_documents(alerts, folder, ["sample_id"])
    as_of = D.newest_time(D.ev(spark, sf))
    return files.scan_alert_files(spark, folder, as_of, "10 days").select(
        "sample_id", "anomaly_type", "confidence"
    )


@query("sink_alerts", ALERT_ROWS)
def sink_alerts(spark, sf):
    """Two batches, both of them written twice as after a failure."""
    folder, alerts = work_folder(spark, "alerts"), D.ev_alerts(spark, sf)
    cut = F.col("ts") < F.lit(D.SLICE_DATES[0]).cast("timestamp")
    for number, batch in enumerate([alerts.where(cut), alerts.where(~cut)]):
        for _ in range(2):
            tables.append_alerts(batch, folder, number)
    return tables.read_alerts(spark, folder).drop("alert_date", "batch")


@query(
    "sink_training_log",
    f"""WITH {EV_SCORED}, c AS (SELECT {CONFUSION}, count_if(label = 0) AS normals,
    count_if(prediction = 1 AND confidence >= 0.4::DOUBLE) AS alerts, max(ts) AS ts FROM scored),
  m AS ({metrics('c', 'ts, normals, alerts')})
  SELECT {t('ts')} AS ts, 'first' AS model_id, {r('accuracy')} AS accuracy, {r('"precision"')} AS "precision",
    {r('recall')} AS recall, {r('f1_score')} AS f1_score, total_samples,
    CAST(normals AS BIGINT) AS normal_samples, CAST(total_samples - normals AS BIGINT) AS anomaly_samples,
    true_positives, false_positives, true_negatives, false_negatives,
    CAST(alerts AS BIGINT) AS high_confidence_alerts, CAST(0.4 AS DOUBLE) AS confidence_threshold,
    CAST(0.1 AS DOUBLE) AS detection_threshold, CAST(1.4 AS DOUBLE) AS z_score_threshold FROM m""",
)
def sink_training_log(spark, sf):
    folder = work_folder(spark, "training-log")
    rows = D.ev(spark, sf)
    summary = V.training_summary(
        D.ev_scored(spark, sf), model_id="first", created_at=D.newest_time(rows)
    )
    for _ in range(2):
        tables.append_training_log(summary, folder, "first")
    return tables.read_table(spark, folder, summary.schema)


def _save_versions(spark: SparkSession, sf: str, folder: str) -> None:
    """Three versions, each fitted on the rows up to a later date."""
    for number, (cut, at) in enumerate(zip(D.SLICE_DATES, D.MODEL_TIMES), start=1):
        seen = D.ev(spark, sf).where(F.col("ts") < F.lit(cut).cast("timestamp"))
        fitted = B.fit_baseline(seen, D.EV_FEATURES, D.ev_normal())
        tables.save_model(fitted, folder, f"v{number}", F.lit(at).cast("timestamp"))


def _version(number: int, source: str = "ev") -> str:
    cut = D.SLICE_DATES[number - 1]
    return model(f"v{number}", source, where=f"category = 'view' AND ts < TIMESTAMP '{cut}'")


VERSIONS = f"{EV}, {_version(1)}, {_version(2)}, {_version(3)}"

def _long_model(name: str, features=("x1", "x2", "x3", "x4")) -> str:
    return " UNION ALL ".join(
        f"SELECT '{f}' AS feature, {i} AS pos, m{i} AS mean, s{i} AS std, n FROM {name}"
        for i, f in enumerate(features)
    )


@query(
    "model_save_load",
    f"""WITH {VERSIONS} SELECT feature, {r('mean')} AS mean, {r('std')} AS std, n,
  CAST(1.4 AS DOUBLE) AS z_threshold FROM ({_long_model('v3')})""",
)
def model_save_load(spark, sf):
    folder = work_folder(spark, "models")
    _save_versions(spark, sf, folder)
    loaded = tables.load_model(spark, folder, D.EV_FEATURES)
    return B.model_rows(loaded, "", F.lit(None)).select("feature", "mean", "std", "n", "z_threshold")


@query(
    "model_version_tag",
    f"""WITH {VERSIONS} SELECT 'v1' AS model_id, 1 AS version, 'baseline' AS tag, 4 AS features, n FROM v1
  UNION ALL SELECT 'v2', 2, 'before_retrain_2', 4, n FROM v2 UNION ALL SELECT 'v3', 3, 'latest', 4, n FROM v3""",
)
def model_version_tag(spark, sf):
    folder = work_folder(spark, "models")
    _save_versions(spark, sf, folder)
    tags = M.version_tags(tables.read_models(spark, folder))
    return tags.select(
        "model_id", F.col("version").cast("int"), "tag", F.col("features").cast("int"), "n"
    )


@query(
    "latest_model_version",
    f"""WITH {VERSIONS}, stored AS ({' UNION ALL '.join(
        f"SELECT 'v{i + 1}' AS model_id, TIMESTAMP '{at}' AS created_at, n FROM v{i + 1}" for i, at in enumerate(D.MODEL_TIMES))})
  SELECT model_id, {t('created_at')} AS created_at, n FROM stored
  WHERE (created_at, model_id) = (SELECT max((created_at, model_id)) FROM stored)""",
)
def latest_model_version(spark, sf):
    folder = work_folder(spark, "models")
    _save_versions(spark, sf, folder)
    models = tables.read_models(spark, folder)
    return M.latest_rows(models).groupBy("model_id", "created_at").agg(F.max("n").alias("n"))


@query(
    "score_with_latest_model",
    f"""WITH {VERSIONS}, {scored('s', 'ev', 'v3')} SELECT event_id, prediction, {r('confidence')} AS confidence FROM s""",
)
def score_with_latest_model(spark, sf):
    folder = work_folder(spark, "models")
    _save_versions(spark, sf, folder)
    newest = tables.freeze_model(tables.load_model(spark, folder, D.EV_FEATURES))
    return S.score(D.ev(spark, sf), newest, D.EV_FEATURES).select("event_id", "prediction", "confidence")


@query(
    "model_compare",
    f"""WITH {VERSIONS}, a AS ({_long_model('v1')}), b AS ({_long_model('v3')})
  SELECT feature, {r('a.mean')} AS mean_before, {r('a.std')} AS std_before, {r('b.mean')} AS mean_after,
    {r('b.std')} AS std_after, {r('b.mean - a.mean')} AS mean_shift, {r('b.std - a.std')} AS std_shift
  FROM a JOIN b USING (feature)""",
)
def model_compare(spark, sf):
    folder = work_folder(spark, "models")
    _save_versions(spark, sf, folder)
    models = tables.read_models(spark, folder)
    first, last = (models.where(F.col("model_id") == v) for v in ("v1", "v3"))
    return M.compare_models(first, last)


@query(
    "check_model",
    f"""WITH {VERSIONS}, stored AS ({_long_model('v3')}),
  c AS (SELECT count(*) AS features, count(mean) AS means, count(std) AS stds, count_if(std < 0) AS negative FROM stored)
  SELECT 'required_columns' AS check_name, true AS passed, '' AS detail UNION ALL
  SELECT 'equal_length', means = features AND stds = features, CAST(features AS VARCHAR) FROM c UNION ALL
  SELECT 'std_not_negative', negative = 0, CAST(negative AS VARCHAR) FROM c UNION ALL
  SELECT 'one_threshold', true, '1.400' UNION ALL SELECT 'model_type', true, 'statistical_anomaly_detector'""",
)
def check_model(spark, sf):
    folder = work_folder(spark, "models")
    _save_versions(spark, sf, folder)
    return Q.check_model(M.latest_rows(tables.read_models(spark, folder)))


# Projections and predicates -------------------------------------------------


@query("encode_features", ENCODED)
def encode_features(spark, sf):
    return _encoded(_raw_text(spark, sf))


@query(
    "encode_features_lineitem",
    f"""SELECT l_orderkey, {r('l_quantity')} AS l_quantity, {r('l_extendedprice')} AS l_extendedprice,
  {r(sql_bucket('l_returnflag'))} AS l_returnflag, {r(sql_bucket('l_linestatus'))} AS l_linestatus FROM lineitem""",
)
def encode_features_lineitem(spark, sf):
    cells = ("l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus")
    return E.encode_features(D.li(spark, sf), cells).select("l_orderkey", *cells)


@query(
    "normalize_headers",
    f"SELECT o_orderkey, o_orderstatus, {r('o_totalprice')} AS o_totalprice FROM orders",
)
def normalize_headers(spark, sf):
    rows = D.orders(spark, sf).select("o_orderkey", "o_orderstatus", "o_totalprice")
    return E.normalize_headers(rows.toDF("o_order key", " o_orderstatus", "o_total price "))


@query(
    "align_schema",
    f"""SELECT o_orderkey, {r('o_totalprice')} AS o_totalprice, '' AS o_clerk,
  CAST(NULL AS BIGINT) AS o_shippriority, o_orderstatus FROM orders""",
)
def align_schema(spark, sf):
    target = {
        "o_orderkey": "bigint",
        "o_totalprice": "double",
        "o_clerk": "string",
        "o_shippriority": "bigint",
        "o_orderstatus": "string",
    }
    return E.align_schema(D.orders(spark, sf), target)


@query(
    "split_features_label",
    f"""WITH {EV} SELECT event_id, 'training' AS layout, category, label, 5 AS width, {r('x1')} AS f1, {r('x2')} AS f2,
    {r('x3')} AS f3, {r('x4')} AS f4, {r(sql_bucket('category'))} AS f5 FROM ev UNION ALL
  SELECT event_id, 'evaluation', category, label, 4, {r('x1')}, {r('x2')}, {r('x3')}, {r('x4')}, NULL FROM ev""",
)
def split_features_label(spark, sf):
    def layout(name: str, include_category: bool) -> DataFrame:
        split = E.split_features_label(
            D.ev(spark, sf), D.EV_FEATURES, include_category=include_category, keep=["event_id"]
        )
        return split.select(
            "event_id",
            F.lit(name).alias("layout"),
            "category",
            "label",
            F.size("features").alias("width"),
            *[F.get("features", i).alias(f"f{i + 1}") for i in range(5)],
        )

    return layout("training", True).union(layout("evaluation", False))


@query("filter_normal", f"WITH {EV} SELECT event_id, {r('x1')} AS x1 FROM ev WHERE category = 'view'")
def filter_normal(spark, sf):
    return E.filter_normal(D.ev(spark, sf), D.ev_normal()).select("event_id", "x1")


@query(
    "select_target_categories",
    f"""WITH {EV_GAPS} SELECT event_id, category, label, CASE WHEN label = 0 THEN 'normal' ELSE 'target' END AS stratum
  FROM gaps WHERE category <> 'click'""",
)
def select_target_categories(spark, sf):
    kept = E.select_target_categories(D.ev_with_gaps(spark, sf), **D.EV_KINDS)
    return kept.select("event_id", "category", "label", "stratum")


@query(
    "excluded_categories",
    f"""WITH {EV_GAPS} SELECT coalesce(category, 'Unknown') AS category, count(*) AS n FROM gaps
  WHERE category IS NULL OR category = 'click' GROUP BY 1""",
)
def excluded_categories(spark, sf):
    return E.excluded_categories(D.ev_with_gaps(spark, sf), **D.EV_KINDS)


@query(
    "excluded_categories_documents",
    """SELECT coalesce(source, 'Unknown') AS category, count(*) AS n FROM documents
  WHERE source IS NULL OR source NOT IN ('src0', 'src1', 'src2') GROUP BY 1""",
)
def excluded_categories_documents(spark, sf):
    rows = D.table(spark, sf, "documents").select(F.col("source").alias("category"))
    return E.excluded_categories(rows, normal="src0", targets=("src1", "src2"))


@query(
    "row_fingerprint",
    """SELECT l_orderkey, concat_ws('_', CAST(l_quantity AS VARCHAR), CAST(l_extendedprice AS VARCHAR),
  CAST(l_discount AS VARCHAR)) AS fingerprint FROM lineitem""",
)
def row_fingerprint(spark, sf):
    cells = [F.col(c) for c in ("l_quantity", "l_extendedprice", "l_discount")]
    return D.li(spark, sf).select("l_orderkey", E.row_fingerprint(*cells).alias("fingerprint"))


# Baseline and scoring -------------------------------------------------------


def _model_oracle(prefix: str, name: str, features) -> str:
    return f"""WITH {prefix} SELECT feature, pos, {r('mean')} AS mean, {r('std')} AS std, n
  FROM ({_long_model(name, features)})"""


def _model_out(fitted: DataFrame) -> DataFrame:
    return B.model_rows(fitted, "", F.lit(None)).select("feature", "pos", "mean", "std", "n")


@query("fit_baseline", _model_oracle(f"{EV}, {model('m', 'ev')}", "m", D.EV_FEATURES))
def fit_baseline(spark, sf):
    return _model_out(D.ev_model(spark, sf))


LI_MODEL = f"{LI}, {model('model', 'li', LI_FEATURES, where="l_returnflag = 'N'")}"


@query("fit_baseline_lineitem", _model_oracle(LI_MODEL, "model", LI_FEATURES))
def fit_baseline_lineitem(spark, sf):
    return _model_out(D.li_model(spark, sf))


EV5 = EV + f", ev5 AS (SELECT *, CAST({sql_bucket('category')} AS DOUBLE) AS x5 FROM ev)"
X5 = (*D.EV_FEATURES, "x5")


@query(
    "z_scores",
    f"""WITH {EV5}, {model('model', 'ev5', X5)}, {scored('s', 'ev5', 'model', X5)}
  SELECT event_id, {', '.join(f"{r(f'z{i}')} AS z_x{i + 1}" for i in range(5))} FROM s""",
)
def z_scores(spark, sf):
    flows = D.with_x5(D.ev(spark, sf))
    fitted = B.fit_baseline(flows, X5, D.ev_normal())
    return S.z_scores(flows, fitted, X5).select("event_id", *[f"z_{f}" for f in X5])


@query(
    "score_with_category",
    f"""WITH {EV5}, {model('model', 'ev5', X5)}, {scored('s', 'ev5', 'model', X5)}
  SELECT event_id, prediction, {r('confidence')} AS confidence FROM s""",
)
def score_with_category(spark, sf):
    """The training layout: the encoded category is a feature without deviation."""
    flows = D.with_x5(D.ev(spark, sf))
    fitted = B.fit_baseline(flows, X5, D.ev_normal())
    return S.score(flows, fitted, X5).select("event_id", "prediction", "confidence")


@query("predict", f"WITH {EV_SCORED} SELECT event_id, prediction, label FROM scored")
def predict(spark, sf):
    scored_rows = S.predict(D.ev(spark, sf), D.ev_model(spark, sf), D.EV_FEATURES)
    return scored_rows.select("event_id", "prediction", "label")


LI_SCORED = f"{LI_MODEL}, {scored('scored', 'li', 'model', LI_FEATURES)}"


@query(
    "predict_lineitem",
    f"""WITH {LI_SCORED} SELECT l_returnflag, l_linestatus, count(*) AS n,
  CAST(sum(prediction) AS BIGINT) AS predicted, {r('sum(confidence)')} AS confidence FROM scored GROUP BY ALL""",
)
def predict_lineitem(spark, sf):
    scored_rows = S.score(D.li(spark, sf), D.li_model(spark, sf), LI_FEATURES)
    return scored_rows.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"),
        F.sum("prediction").alias("predicted"),
        F.sum("confidence").alias("confidence"),
    )


@query(
    "confidence",
    f"WITH {EV_SCORED} SELECT event_id, {r('confidence')} AS confidence FROM scored",
)
def confidence(spark, sf):
    return D.ev_scored(spark, sf).select("event_id", "confidence")


@query("score_alerts", ALERT_ROWS)
def score_alerts(spark, sf):
    return D.ev_alerts(spark, sf)


@query(
    "fit_score_vectors",
    f"""WITH p AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS pos FROM embeddings),
  m AS (SELECT pos, avg(x) AS mean, CASE WHEN stddev_pop(x) <= 1e-12 * abs(avg(x)) THEN 0
    ELSE stddev_pop(x) END AS std FROM p WHERE label = 0 GROUP BY pos),
  z AS (SELECT vec_id, p.label, abs(x - mean) / nullif(std, 0) AS z FROM p JOIN m USING (pos)),
  v AS (SELECT vec_id, label, count(*) AS k, count_if(z > 1.4::DOUBLE) AS votes,
    sum(CASE WHEN z > 1.4::DOUBLE THEN z ELSE 0 END) AS z_sum FROM z GROUP BY ALL)
  SELECT vec_id, label, CAST(CASE WHEN votes > k * 0.10::DOUBLE THEN 1 ELSE 0 END AS INTEGER) AS prediction,
    {r('CASE WHEN votes > 0 THEN least(z_sum / (votes * 5), 1) ELSE 0 END')} AS confidence FROM v""",
)
def fit_score_vectors(spark, sf):
    rows = D.table(spark, sf, "embeddings")
    fitted = X.fit_vectors(rows, "embedding", F.col("label") == 0)
    return X.score_vectors(rows, fitted, "embedding").select("vec_id", "label", "prediction", "confidence")


@query(
    "alert_coverage",
    f"""WITH {EV_SCORED} SELECT count(*) AS rows,
  CAST(count_if(prediction = 1 AND confidence >= 0.4::DOUBLE) AS BIGINT) AS alerts,
  {r(sql_ratio('count_if(prediction = 1 AND label = 1)', 'count_if(label = 1)') + ' * 100')} AS coverage_percent,
  {r(sql_ratio('count_if(prediction = 1 AND confidence >= 0.4::DOUBLE)', 'count(*)') + ' * 100')} AS alert_rate_percent
  FROM scored""",
)
def alert_coverage(spark, sf):
    return S.alert_coverage(D.ev_scored(spark, sf))


@query(
    "top_contributing_features",
    f"""WITH {EV_SCORED}, l AS ({' UNION ALL '.join(
        f"SELECT event_id, confidence, 'x{i + 1}' AS feature, z{i} AS z FROM scored "
        f"WHERE prediction = 1 AND confidence >= 0.4::DOUBLE AND z{i} > 1.4::DOUBLE" for i in range(4))})
  SELECT event_id, {r('confidence')} AS confidence,
    CAST(row_number() OVER (PARTITION BY event_id ORDER BY z DESC, feature) AS INTEGER) AS rank, feature, {r('z')} AS z FROM l""",
)
def top_contributing_features(spark, sf):
    return S.contributing_features(
        D.ev(spark, sf), D.ev_model(spark, sf), D.EV_FEATURES, ["event_id"]
    )


@query(
    "score_broadcast_join",
    f"""WITH {LI_SCORED} SELECT prediction, label, count(*) AS n, {r('max(z0)')} AS max_z_quantity,
  {r('max(z1)')} AS max_z_price FROM scored GROUP BY ALL""",
)
def score_broadcast_join(spark, sf):
    """Every row beside the one model row; the model side is a global aggregate."""
    fitted = D.li_model(spark, sf)
    rows = S.score(D.li(spark, sf), fitted, LI_FEATURES, keep_z=("l_quantity", "l_extendedprice"))
    return rows.groupBy("prediction", "label").agg(
        F.count("*").alias("n"),
        F.max("z_l_quantity").alias("max_z_quantity"),
        F.max("z_l_extendedprice").alias("max_z_price"),
    )


# Evaluation and reports -----------------------------------------------------


@query(
    "label_distribution",
    f"""WITH {EV} SELECT label, count(*) AS n, {r('100.0 * count(*) / (SELECT count(*) FROM ev)')} AS percent
  FROM ev GROUP BY label""",
)
def label_distribution(spark, sf):
    return V.label_distribution(D.ev(spark, sf))


@query(
    "confusion_matrix",
    f"""WITH {EV_SCORED}, c AS (SELECT {CONFUSION} FROM scored) SELECT CAST(tp AS BIGINT) AS true_positives,
  CAST(fp AS BIGINT) AS false_positives, CAST(tn AS BIGINT) AS true_negatives, CAST(fn AS BIGINT) AS false_negatives,
  total AS total_samples FROM c""",
)
def confusion_matrix(spark, sf):
    return V.confusion_matrix(D.ev_scored(spark, sf))


def _rounded(source: str, counts: str, rates) -> str:
    return f"SELECT {counts}, {', '.join(f'{r(c)} AS {c}' for c in rates)} FROM {source}"


COUNT_COLUMNS = "true_positives, false_positives, true_negatives, false_negatives, total_samples"
RATE_COLUMNS = ("accuracy", '"precision"', "recall", "f1_score")
TARGET_RATE_COLUMNS = tuple(f"{c}_detection_rate" for c in ("error", "purchase", "signup"))


@query(
    "classification_metrics",
    f"""WITH {EV_SCORED}, c AS (SELECT {CONFUSION} FROM scored), m AS ({metrics('c')})
  {_rounded('m', COUNT_COLUMNS, RATE_COLUMNS)}""",
)
def classification_metrics(spark, sf):
    return V.classification_metrics(D.ev_scored(spark, sf))


@query(
    "detection_rate_by_category",
    f"""WITH {EV_SCORED}, w AS (SELECT * FROM (VALUES ('error'), ('purchase'), ('signup'), ('absent')) w(category))
  SELECT w.category, coalesce(CAST(count_if(prediction = 1) AS BIGINT), 0) AS detected, count(prediction) AS total,
    {r(sql_ratio('count_if(prediction = 1)', 'count(prediction)'))} AS rate
  FROM w LEFT JOIN scored USING (category) GROUP BY ALL""",
)
def detection_rate_by_category(spark, sf):
    return V.detection_rate_by_category(
        D.ev_scored(spark, sf), ["error", "purchase", "signup", "absent"]
    )


EVALUATED = f"""WITH {EV_SCORED}, c AS (SELECT {CONFUSION}, {TARGET_COUNTS} FROM scored),
  m AS ({metrics('c', '', TARGET_RATES)}) {_rounded('m', COUNT_COLUMNS, RATE_COLUMNS + TARGET_RATE_COLUMNS)}"""


@query("evaluate_model", EVALUATED)
def evaluate_model(spark, sf):
    return V.evaluate_model(D.ev_scored(spark, sf), D.EV_TARGETS)


@query(
    "evaluate_model_lineitem",
    f"""WITH {LI_SCORED}, c AS (SELECT {CONFUSION}, count_if(l_returnflag = 'R' AND prediction = 1) AS hit,
    count_if(l_returnflag = 'R') AS members FROM scored),
  m AS ({metrics('c', '', sql_ratio('hit', 'members') + ' AS returned_detection_rate')})
  {_rounded('m', COUNT_COLUMNS, RATE_COLUMNS + ('returned_detection_rate',))}""",
)
def evaluate_model_lineitem(spark, sf):
    rows = S.score(D.li(spark, sf), D.li_model(spark, sf), LI_FEATURES)
    return V.evaluate_model(rows, {"returned": "R"}, category="l_returnflag")


PROFILE = f"""{EV_ALERTS}, p AS (SELECT (SELECT count(*) FROM ev) AS flows,
  (SELECT count(*) FROM ev WHERE label = 1) AS anomalies, (SELECT count(*) FROM alerts) AS alerts)"""


@query(
    "flows_vs_alerts",
    f"""WITH {PROFILE} SELECT flows AS total_flows, anomalies, flows - anomalies AS normal, alerts FROM p""",
)
def flows_vs_alerts(spark, sf):
    return P.flows_vs_alerts(D.ev_scored(spark, sf))


@query(
    "traffic_profile",
    f"""WITH {PROFILE} SELECT flows AS total_flows, flows - anomalies AS normal, anomalies,
  {r('100.0 * anomalies / flows')} AS anomaly_percent, alerts, {r('100.0 * alerts / flows')} AS alert_percent,
  printf('%.1f%%', 100.0::DOUBLE * alerts / anomalies) AS alert_ratio FROM p""",
)
def traffic_profile(spark, sf):
    return P.traffic_profile(D.ev_scored(spark, sf))


def _top_sql(value: str, source: str = "ev", limit: int = 5) -> str:
    return f"""(SELECT string_agg(v || '=' || n, ', ' ORDER BY n DESC, v) FROM (
    SELECT CAST({value} AS VARCHAR) AS v, count(*) AS n FROM {source} GROUP BY 1 ORDER BY n DESC, v LIMIT {limit}))"""


@query(
    "traffic_report",
    f"""WITH {PROFILE} SELECT flows AS total_flows, flows - anomalies AS normal, anomalies,
  {r('100.0 * anomalies / flows')} AS anomaly_percent, alerts, {r('100.0 * alerts / flows')} AS alert_percent,
  printf('%.1f%%', 100.0::DOUBLE * alerts / anomalies) AS alert_ratio,
  {_top_sql('CAST(x3 AS INTEGER)')} AS top_protocols, {_top_sql('CAST(x4 AS INTEGER)')} AS top_services,
  {_top_sql('category', '(SELECT * FROM ev WHERE label = 1)', 1000)} AS attack_categories FROM p""",
)
def traffic_report(spark, sf):
    """Hours stand for protocols and users for services; the lists are printed to be compared."""
    scored_flows = D.ev_scored(spark, sf).withColumns(
        {"proto": F.col("x3").cast("int"), "service": F.col("x4").cast("int")}
    )
    report = P.traffic_report(scored_flows)
    lists = ("top_protocols", "top_services", "attack_categories")
    printed = lambda e: F.concat_ws("=", e["value"], e["n"].cast("string"))
    return report.withColumns({c: F.array_join(F.transform(c, printed), ", ") for c in lists})


@query(
    "category_histogram",
    "SELECT event_type AS category, count(*) AS n FROM events WHERE event_type <> 'view' GROUP BY 1",
)
def category_histogram(spark, sf):
    return P.category_histogram(D.ev(spark, sf))


@query(
    "dataset_composition",
    f"""WITH {EV}, n AS (SELECT count(*) AS all_rows FROM ev)
  SELECT 'label' AS part, CAST(label AS VARCHAR) AS value, count(*) AS n, {r('100.0 * count(*) / any_value(all_rows)')} AS percent FROM ev, n GROUP BY label
  UNION ALL SELECT 'category', category, count(*), {r('100.0 * count(*) / any_value(all_rows)')} FROM ev, n GROUP BY category
  UNION ALL SELECT 'total', NULL, count(*), {r('100.0')} FROM ev""",
)
def dataset_composition(spark, sf):
    return P.dataset_composition(D.ev(spark, sf))


@query(
    "batch_anomaly_counts",
    f"""WITH {EV} SELECT {t("date_trunc('hour', ts)")} AS batch, count(*) AS flows,
  CAST(count_if(label = 1) AS BIGINT) AS anomalies FROM ev GROUP BY 1""",
)
def batch_anomaly_counts(spark, sf):
    return P.batch_anomaly_counts(D.ev(spark, sf), [F.date_trunc("hour", "ts").alias("batch")])


def _top(table: str, col: str, name: str) -> str:
    return f"SELECT {col} AS {name}, count(*) AS n FROM {table} GROUP BY 1 ORDER BY n DESC, 1 LIMIT 5"


@query("top_protocols", _top("lineitem", "l_linestatus", "proto"))
def top_protocols(spark, sf):
    return P.top_values(D.li(spark, sf), "l_linestatus", "proto")


@query("top_services", _top("events", "user_id", "service"))
def top_services(spark, sf):
    return P.top_values(D.table(spark, sf, "events"), "user_id", "service")


@query(
    "peak_hours",
    "SELECT hour(ts)::INTEGER AS hour, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, 1 LIMIT 3",
)
def peak_hours(spark, sf):
    return P.top_values(D.table(spark, sf, "events"), F.hour("ts"), "hour", 3)


@query(
    "sorted_distribution",
    f"""SELECT source, count(*) AS n, {r('100.0 * count(*) / (SELECT count(*) FROM documents)')} AS percent
  FROM documents GROUP BY source""",
)
def sorted_distribution(spark, sf):
    return P.sorted_distribution(D.table(spark, sf, "documents").select("source"), "source")


# Alert views ----------------------------------------------------------------

AS_OF = "(SELECT max(ts) FROM events)"


@query(
    "recent_alerts_window",
    f"""WITH {EV_ALERTS} SELECT event_id, {t('ts')} AS ts, prediction, anomaly_type, {r('confidence')} AS confidence
  FROM alerts WHERE ts >= {AS_OF} - INTERVAL 5 DAY""",
)
def recent_alerts_window(spark, sf):
    as_of = D.newest_time(D.ev(spark, sf))
    return A.recent_alerts(D.ev_alerts(spark, sf), as_of, "5 days")


BAND = """CASE WHEN confidence > 0.7::DOUBLE THEN 'high' WHEN confidence >= 0.3::DOUBLE THEN 'medium' ELSE 'low' END"""


@query(
    "confidence_band",
    f"WITH {EV_SCORED} SELECT event_id, {BAND} AS band FROM scored",
)
def confidence_band(spark, sf):
    return D.ev_scored(spark, sf).select(
        "event_id", A.confidence_band(F.col("confidence")).alias("band")
    )


@query(
    "alert_type_fallback",
    f"""WITH {EV_ALERTS} SELECT event_id, CASE WHEN anomaly_type IN ('error', 'signup') THEN anomaly_type
  WHEN anomaly_type = 'click' THEN 'Unknown' ELSE 'other' END AS alert_kind FROM alerts""",
)
def alert_type_fallback(spark, sf):
    """Errors and signups carry ``anomaly_type``, clicks no type, the rest ``type``."""
    kind = F.col("anomaly_type")
    rows = D.ev_alerts(spark, sf).select(
        "event_id",
        F.when(kind.isin("error", "signup"), kind).alias("anomaly_type"),
        F.when(kind != "click", F.lit("other")).alias("type"),
    )
    return rows.select("event_id", A.alert_kind(rows).alias("alert_kind"))


@query(
    "normalize_alerts",
    f"""WITH {EV_ALERTS} SELECT event_id AS sample_id, anomaly_type, {r('confidence')} AS confidence FROM alerts
  UNION ALL SELECT event_id, 'copy', {r('confidence')} FROM alerts WHERE anomaly_type = 'error'""",
)
def normalize_alerts(spark, sf):
    """Errors as arrays of two alerts, signups as arrays of one, others as objects."""
    kind = F.col("anomaly_type")
    one = F.struct(F.col("event_id").alias("sample_id"), kind, F.col("confidence"))
    two = F.struct(F.col("event_id").alias("sample_id"), F.lit("copy").alias("anomaly_type"), F.col("confidence"))
    document = (
        F.when(kind == "error", F.to_json(F.array(one, two)))
        .when(kind == "signup", F.to_json(F.array(one)))
        .otherwise(F.to_json(one))
    )
    documents = D.ev_alerts(spark, sf).select(document.alias("value"))
    return A.normalize_alerts(documents).select("sample_id", "anomaly_type", "confidence")


# Types and ids of an alert summary as one text each.
SUMMARY_SQL = """string_agg(DISTINCT kind || '=' || kind_alerts, ', ' ORDER BY kind || '=' || kind_alerts) AS alert_types,
  string_agg(CAST(event_id AS VARCHAR), ', ' ORDER BY place) FILTER (WHERE place <= 10) AS latest_alerts"""


def summary_text(summary: DataFrame) -> DataFrame:
    kinds = F.transform(
        F.map_entries("alert_types"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))
    )
    ids = F.transform("latest_alerts", lambda a: a["event_id"].cast("string"))
    return summary.withColumns(
        {"alert_types": F.array_join(F.array_sort(kinds), ", "), "latest_alerts": F.array_join(ids, ", ")}
    )


@query(
    "alert_summary",
    f"""WITH {EV_ALERTS}, placed AS (SELECT event_id, anomaly_type AS kind, count(*) OVER (PARTITION BY anomaly_type) AS kind_alerts,
    row_number() OVER (ORDER BY ts DESC, event_id) AS place FROM alerts)
  SELECT count(*) AS total_alerts, {SUMMARY_SQL} FROM placed""",
)
def alert_summary(spark, sf):
    """Total, counts per type and the ten newest alerts as one document."""
    return summary_text(A.alert_summary(D.ev_alerts(spark, sf), ["event_id"]))


@query(
    "alert_type_counts",
    f"""WITH {EV_ALERTS} SELECT anomaly_type AS alert_kind, count(*) AS n,
  {r('100.0 * count(*) / (SELECT count(*) FROM alerts)')} AS percent FROM alerts GROUP BY 1""",
)
def alert_type_counts(spark, sf):
    return A.alert_type_counts(D.ev_alerts(spark, sf))


@query(
    "alert_kpis",
    f"""WITH {EV_ALERTS}, b AS (SELECT *, {BAND} AS band FROM alerts WHERE ts >= {AS_OF} - INTERVAL 7 DAY)
  SELECT count(*) AS alerts, {r('count(*) / 10080::DOUBLE')} AS alerts_per_minute, {r('avg(confidence)')} AS avg_confidence,
    {r('max(confidence)')} AS max_confidence, {r('min(confidence)')} AS min_confidence,
    CAST(count_if(band = 'high') AS BIGINT) AS high, CAST(count_if(band = 'medium') AS BIGINT) AS medium,
    CAST(count_if(band = 'low') AS BIGINT) AS low FROM b""",
)
def alert_kpis(spark, sf):
    as_of = D.newest_time(D.ev(spark, sf))
    return A.alert_kpis(D.ev_alerts(spark, sf), as_of, "7 days", 7 * 24 * 60)


@query(
    "latest_alerts",
    f"""WITH {EV_ALERTS} SELECT event_id, {t('ts')} AS ts, prediction, anomaly_type, {r('confidence')} AS confidence
  FROM alerts ORDER BY alerts.ts DESC, event_id LIMIT 10""",
)
def latest_alerts(spark, sf):
    return A.latest_alerts(D.ev_alerts(spark, sf), ["event_id"])


# Label noise ----------------------------------------------------------------

NOISE_RATE = 0.15


def _noisy_sql(name: str = "noisy", rate: float = NOISE_RATE, seed: int = 7) -> str:
    text = f"concat_ws('|', '{seed}', event_id)"
    return f"""{name}_f AS (SELECT *, label = 1 AND {hex_long(text)} / 4294967296::DOUBLE < {rate}::DOUBLE AS flipped FROM ev),
{name} AS (SELECT * EXCLUDE (label, category), CAST(CASE WHEN flipped THEN 0 ELSE label END AS INTEGER) AS label,
  CASE WHEN flipped THEN 'view' ELSE category END AS category FROM {name}_f)"""


def _noisy(spark, sf, rate: float = NOISE_RATE, seed: int = 7) -> DataFrame:
    return N.inject_label_noise(
        D.ev(spark, sf), rate, ["event_id"], seed, normal="view", flag="flipped"
    )


@query(
    "inject_label_noise",
    f"""WITH {EV}, {_noisy_sql()} SELECT event_id, {r('x1')} AS x1, {r('x2')} AS x2, label, category, flipped FROM noisy""",
)
def inject_label_noise(spark, sf):
    return _noisy(spark, sf).select("event_id", "x1", "x2", "label", "category", "flipped")


@query(
    "noise_summary",
    f"""WITH {EV}, {_noisy_sql()} SELECT count(*) AS rows, CAST(count_if(flipped) AS BIGINT) AS flipped,
  CAST(count_if(flipped OR label = 1) AS BIGINT) AS eligible,
  {r(sql_ratio('count_if(flipped)', 'count_if(flipped OR label = 1)'))} AS effective_rate FROM noisy""",
)
def noise_summary(spark, sf):
    return N.noise_summary(_noisy(spark, sf), "flipped")


@query(
    "noise_degradation",
    f"""WITH {EV}, {_noisy_sql('noisy', 0.5)}, {model('clean_m', 'ev')}, {model('noisy_m', 'noisy', where='label = 0')},
  {scored('a', 'ev', 'clean_m')}, {scored('b', 'ev', 'noisy_m')},
  c AS (SELECT 'clean' AS baseline, {CONFUSION} FROM a UNION ALL SELECT 'noisy', {CONFUSION} FROM b),
  m AS ({metrics('c', 'baseline')}) {_rounded('m', 'baseline, ' + COUNT_COLUMNS, RATE_COLUMNS)}""",
)
def noise_degradation(spark, sf):
    """Baselines fitted on clean and on noisy labels, both judged by the clean ones: two scans in all."""
    flows = _noisy(spark, sf, 0.5).withColumns(
        {"noisy_label": F.col("label"), "label": (F.col("flipped") | (F.col("label") == 1)).cast("int")}
    )
    fits = B.fit_baselines(
        flows, D.EV_FEATURES, {"clean": F.col("label") == 0, "noisy": F.col("noisy_label") == 0}
    )
    return V.classification_metrics(S.score(flows, fits, D.EV_FEATURES, by="baseline"), by=["baseline"])


# Scalar functions -----------------------------------------------------------


@query(
    "fn_hash_bucket",
    f"SELECT doc_id, CAST({sql_bucket('source')} AS BIGINT) AS source_bucket, CAST({sql_bucket('text')} AS BIGINT) AS text_bucket FROM documents",
)
def fn_hash_bucket(spark, sf):
    rows = D.table(spark, sf, "documents")
    return rows.select(
        "doc_id",
        bucket(F.col("source")).alias("source_bucket"),
        bucket(F.col("text")).alias("text_bucket"),
    )


@query(
    "fn_try_float",
    f"""SELECT o_orderkey, {r('o_totalprice')} AS price, {r('TRY_CAST(o_orderstatus AS DOUBLE)')} AS status,
  {r("TRY_CAST(substring(o_orderpriority, 1, 1) AS DOUBLE)")} AS priority FROM orders""",
)
def fn_try_float(spark, sf):
    return D.orders(spark, sf).select(
        "o_orderkey",
        try_number(F.col("o_totalprice").cast("string")).alias("price"),
        try_number(F.col("o_orderstatus")).alias("status"),
        try_number(F.substring("o_orderpriority", 1, 1)).alias("priority"),
    )


@query(
    "fn_hour_of_iso",
    "SELECT event_id, CASE WHEN event_type <> 'click' THEN CAST(hour(ts) AS INTEGER) END AS hour FROM events",
)
def fn_hour_of_iso(spark, sf):
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    text = F.when(F.col("category") == "click", F.lit("not a time")).otherwise(iso)
    return D.ev(spark, sf).select("event_id", hour_of_iso(text).alias("hour"))


@query(
    "fn_time_cutoff",
    f"SELECT event_id, {t('ts - INTERVAL 5 MINUTE')} AS cutoff, ts - INTERVAL 5 MINUTE >= {AS_OF} - INTERVAL 1 HOUR AS recent FROM events",
)
def fn_time_cutoff(spark, sf):
    flows = D.ev(spark, sf)
    cutoff = time_cutoff(F.col("ts"), "5 minutes")
    recent = cutoff >= time_cutoff(D.newest_time(flows), "1 hour")
    return flows.select("event_id", cutoff.alias("cutoff"), recent.alias("recent"))


@query(
    "fn_percent_format",
    """SELECT event_type AS category, printf('%.1f%%', 100 * avg(CASE WHEN value > 50 THEN 1::DOUBLE ELSE 0 END)) AS share,
  printf('%.4f', avg(value)) AS mean FROM events GROUP BY 1""",
)
def fn_percent_format(spark, sf):
    return D.ev(spark, sf).groupBy("category").agg(
        percent_text(F.avg(F.when(F.col("x1") > 50, 1.0).otherwise(0.0))).alias("share"),
        F.format_string("%.4f", F.avg("x1")).alias("mean"),
    )


@query(
    "fn_alert_id",
    f"""WITH {EV_ALERTS} SELECT event_id, 'ALT_' || strftime(ts, '%Y%m%d') || '_' ||
  md5(concat_ws('|', 'score', event_id)) AS alert_id FROM alerts""",
)
def fn_alert_id(spark, sf):
    ident = alert_id(F.col("ts"), F.lit("score"), F.col("event_id"))
    return D.ev_alerts(spark, sf).select("event_id", ident.alias("alert_id"))


@query(
    "fn_clean_name",
    "SELECT event_type AS category, replace('Mean  of ' || event_type, ' ', '') AS cleaned, count(*) AS n FROM events GROUP BY ALL",
)
def fn_clean_name(spark, sf):
    """Column names are cleaned on the driver, text cells with ``replace``."""
    counts = D.ev(spark, sf).groupBy("category").agg(F.count("*").alias("n"))
    raw = counts.withColumn("clean ed", F.replace(F.concat(F.lit("Mean  of "), "category"), F.lit(" "), F.lit("")))
    return raw.toDF(*[clean_name(c) for c in raw.columns])


@query(
    "fn_capped_ratio",
    f"SELECT event_id, {r('least(' + sql_ratio('value', 'user_id') + ', 1)')} AS capped FROM events",
)
def fn_capped_ratio(spark, sf):
    return D.ev(spark, sf).select("event_id", capped_ratio(F.col("x1"), F.col("x4")).alias("capped"))


@query(
    "fn_vector_fold",
    f"""WITH p AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x FROM embeddings)
  SELECT vec_id, {r('sum(abs(x - 0.1::DOUBLE) / 0.5::DOUBLE)')} AS folded, count_if(abs(x - 0.1::DOUBLE) / 0.5::DOUBLE > 0.2::DOUBLE)::INTEGER AS above
  FROM p GROUP BY vec_id""",
)
def fn_vector_fold(spark, sf):
    distances = F.transform("embedding", lambda x: F.abs(x.cast("double") - 0.1) / 0.5)
    return D.table(spark, sf, "embeddings").select(
        "vec_id",
        F.aggregate(distances, F.lit(0.0), lambda acc, v: acc + v).alias("folded"),
        F.size(F.filter(distances, lambda v: v > 0.2)).alias("above"),
    )


# Checks ---------------------------------------------------------------------


@query(
    "check_alerts",
    f"""WITH {EV_ALERTS}, c AS (SELECT count(*) AS n, avg(confidence) AS mean,
    count_if(NOT confidence BETWEEN 0 AND 1) AS outside, count_if(ts IS NULL OR confidence IS NULL) AS unfilled FROM alerts)
  SELECT 'required_columns' AS check_name, true AS passed, '' AS detail UNION ALL
  SELECT 'fields_filled', unfilled = 0, CAST(unfilled AS VARCHAR) FROM c UNION ALL
  SELECT 'confidence_range', outside = 0, CAST(outside AS VARCHAR) FROM c UNION ALL
  SELECT 'count', true, CAST(n AS VARCHAR) FROM c UNION ALL
  SELECT 'mean_confidence', true, printf('%.3f', mean) FROM c""",
)
def check_alerts(spark, sf):
    return Q.check_alerts(D.ev_alerts(spark, sf))


@query(
    "check_distribution",
    f"""WITH {EV}, c AS (SELECT count(*) AS n, count_if(label = 0) AS a, count_if(label = 1) AS b FROM ev)
  SELECT 'not_empty' AS check_name, n > 0 AS passed, CAST(n AS VARCHAR) AS detail FROM c UNION ALL
  SELECT 'normal_count', true, CAST(a AS VARCHAR) FROM c UNION ALL
  SELECT 'anomaly_count', true, CAST(b AS VARCHAR) FROM c UNION ALL
  SELECT 'normal_percent', 100.0 * a / n BETWEEN 20 AND 40, printf('%.3f', 100::DOUBLE * a / n) FROM c UNION ALL
  SELECT 'anomaly_percent', 100.0 * b / n BETWEEN 60 AND 80, printf('%.3f', 100::DOUBLE * b / n) FROM c""",
)
def check_distribution(spark, sf):
    return Q.check_distribution(D.ev(spark, sf))
