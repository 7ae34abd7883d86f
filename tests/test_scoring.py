import math

import pytest
from pyspark.sql import functions as F

from tallyguard.operators import baseline as B
from tallyguard.operators import encode as E
from tallyguard.operators import evaluate as V
from tallyguard.operators import score as S
from tallyguard.operators import vectors as X
from tallyguard.operators.moments import feature_moments, merge_moments, subtract_moments, union_moments
from tallyguard.schema import FLOW_FEATURES

from .conftest import FLOW_TABLE_FEATURES

MODEL = "features array<string>, means array<double>, stds array<double>, n bigint, z_threshold double"


def make_model(spark, means, stds, threshold=1.4):
    names = [f"f{i}" for i in range(len(means))]
    rows = [(names, [float(m) for m in means], [float(s) for s in stds], 10, threshold)]
    return spark.createDataFrame(rows, MODEL), names


def make_rows(spark, rows):
    names = [f"f{i}" for i in range(len(rows[0]))]
    return spark.createDataFrame(
        [tuple(float(v) if v is not None else None for v in r) for r in rows],
        ", ".join(f"{n} double" for n in names),
    )


def scored(spark, means, stds, row):
    model, names = make_model(spark, means, stds)
    return S.score(make_rows(spark, [row]), model, names).first()


@pytest.mark.parametrize(
    "means, stds, row, expected",
    [
        ([10, 20, 30], [2, 4, 6], [10, 25, 42], 1),
        ([100], [10], [113], 0),
        ([100], [10], [115], 1),
        ([50] * 10, [10] * 10, [50] * 10, 0),
        ([50] * 10, [10] * 10, [65] + [50] * 9, 0),
        ([50] * 10, [10] * 10, [65, 65] + [50] * 8, 1),
        ([10, 20], [0, 5], [15, 30], 1),
    ],
)
def test_prediction(spark, means, stds, row, expected):
    assert scored(spark, means, stds, row).prediction == expected


@pytest.mark.parametrize(
    "means, stds, row, expected",
    [
        ([10] * 5, [2] * 5, [30] * 5, 1.0),
        ([10] * 5, [2] * 5, [13] * 5, 0.3),
        ([10] * 3, [5] * 3, [11, 12, 13], 0.0),
        ([10] * 10, [5] * 10, [10] * 8 + [20, 20], 0.4),
    ],
)
def test_confidence(spark, means, stds, row, expected):
    assert scored(spark, means, stds, row).confidence == pytest.approx(expected)


def test_alert_threshold_is_inclusive(spark):
    model, names = make_model(spark, [10] * 10, [5] * 10)
    rows = make_rows(spark, [[10] * 8 + [20, 20], [10] * 8 + [19.9, 20]]).withColumn("category", F.lit("x"))
    alerts = S.score_alerts(rows, model, names, ["f8"]).collect()
    assert [a.f8 for a in alerts] == [20.0]


def test_nan_infinite_and_null_values_cast_no_vote(spark):
    model, names = make_model(spark, [10, 10], [2, 2])
    rows = make_rows(spark, [[float("nan"), 10], [float("inf"), 10], [None, 10], [20, 10]])
    got = S.score(rows, model, names).collect()
    assert [r.prediction for r in got] == [0, 0, 0, 1]
    assert [r.confidence for r in got[:3]] == [0.0] * 3


def test_z_scores_skip_constant_features(spark):
    model, names = make_model(spark, [10, 20], [0, 5])
    row = S.z_scores(make_rows(spark, [[15, 30]]), model, names).first()
    assert row.z_f0 is None and row.z_f1 == 2.0


def test_contributing_features_are_ranked(spark):
    model, names = make_model(spark, [0, 0, 0, 0], [1, 1, 1, 1])
    rows = make_rows(spark, [[3, 1, 9, 3]]).withColumn("key", F.lit(1))
    got = S.contributing_features(rows, model, names, ["key"]).orderBy("rank").collect()
    assert [(r["rank"], r.feature, r.z) for r in got] == [(1, "f2", 9.0), (2, "f0", 3.0), (3, "f3", 3.0)]


def test_fit(spark):
    rows = make_rows(spark, [[1, 1], [2, 2], [3, 3], [4, 4], [5, 5]])
    got = B.fit_baseline(rows, ["f0"]).first()
    assert got.means == [3.0] and got.stds[0] == pytest.approx(math.sqrt(2)) and got.n == 5
    three = make_rows(spark, [[1, 2, 3], [2, 4, 6], [3, 6, 9]])
    assert B.fit_baseline(three, ["f0", "f1", "f2"]).first().means == [2.0, 4.0, 6.0]


def test_fit_ignores_values_that_are_not_finite(spark):
    rows = make_rows(spark, [[1], [3], [float("nan")], [float("inf")], [None]])
    got = B.fit_baseline(rows, ["f0"]).first()
    assert got.means == [2.0] and got.stds == [1.0] and got.n == 5


def test_constant_feature_has_no_deviation(spark):
    rows = make_rows(spark, [[0.1]] * 3)
    got = B.fit_baseline(rows, ["f0"]).first()
    assert got.stds == [0.0]
    model = B.fit_baseline(rows, ["f0"])
    assert S.score(make_rows(spark, [[7.0]]), model, ["f0"]).first().prediction == 0


def test_constant_normals_predict_nothing(spark, flow_sample):
    flows = E.encode_features(flow_sample, FLOW_FEATURES)
    model = B.fit_baseline(flows, FLOW_FEATURES, F.col("label") == 0)
    got = S.score(flows, model, FLOW_FEATURES).agg(F.max("prediction"), F.max("confidence")).first()
    assert tuple(got) == (0, 0.0)


def test_no_normal_rows_give_an_empty_model(spark):
    rows = make_rows(spark, [[1], [2]])
    model = B.fit_baseline(rows, ["f0"], F.lit(False))
    assert model.first().n == 0
    assert S.score(rows, model, ["f0"]).first().prediction == 0


def test_model_lookup_is_by_name(spark):
    model, _ = make_model(spark, [1, 2, 3], [4, 5, 6])
    rows = B.model_rows(model, "m", F.current_timestamp())
    got = B.model_from_rows(rows.drop("z_threshold").withColumn("z_threshold", F.lit(None).cast("double")), ["f2", "f0", "new"]).first()
    assert got.means == [3.0, 1.0, None] and got.stds == [6.0, 4.0, None]
    assert got.z_threshold == 1.5


def test_vector_form_agrees_with_columns(spark, flow_table):
    names = list(FLOW_TABLE_FEATURES)
    rows = flow_table.withColumn("v", F.array(*[F.col(c).cast("double") for c in names]))
    normal = F.col("label") == 0
    wide = S.score(rows, B.fit_baseline(rows, names, normal), names)
    vector = X.score_vectors(rows, X.fit_vectors(rows, "v", normal), "v")
    both = wide.select("id", "prediction", "confidence").join(
        vector.select("id", F.col("prediction").alias("p"), F.col("confidence").alias("c")), "id"
    )
    wrong = both.where((F.col("prediction") != F.col("p")) | (F.abs(F.col("confidence") - F.col("c")) > 1e-9))
    assert both.count() == 2000 and wrong.count() == 0


def test_merged_moments_equal_a_fit_on_the_union(spark, flow_table):
    names = list(FLOW_TABLE_FEATURES)
    normal = F.col("label") == 0
    parts = [flow_table.where(F.col("id") % 3 == i) for i in range(3)]
    moments = [feature_moments(p, names, normal) for p in parts]
    merged = merge_moments(moments[0].union(moments[1]).union(moments[2]), names).first()
    whole = B.fit_baseline(flow_table, names, normal).first()
    assert merged.n == whole.n and merged.features == whole.features
    assert merged.means == pytest.approx(whole.means, rel=1e-12)
    assert merged.stds == pytest.approx(whole.stds, rel=1e-9)


def test_baseline_detects_the_generated_attacks(spark, flow_table):
    names = list(FLOW_TABLE_FEATURES)
    model = B.fit_baseline(flow_table, names, F.col("label") == 0)
    got = V.classification_metrics(S.score(flow_table, model, names)).first()
    prevalence = flow_table.agg(F.avg("label")).first()[0]
    assert got.recall > 0.9 and got.precision > prevalence


def test_metrics(spark):
    pairs = list(zip([1, 1, 0, 0, 1, 0, 1, 0], [1, 0, 0, 1, 1, 0, 0, 0]))
    got = V.classification_metrics(spark.createDataFrame(pairs, "prediction int, label int")).first()
    assert (got.true_positives, got.false_positives, got.true_negatives, got.false_negatives) == (2, 2, 3, 1)
    assert got.accuracy == 0.625 and got.precision == 0.5
    assert got.f1_score == pytest.approx(2 * 0.5 * (2 / 3) / (0.5 + 2 / 3))


def test_metrics_of_nothing_are_zero(spark):
    got = V.classification_metrics(spark.createDataFrame([], "prediction int, label int")).first()
    assert (got.accuracy, got.precision, got.recall, got.f1_score) == (0.0, 0.0, 0.0, 0.0)
    coverage = S.alert_coverage(spark.createDataFrame([], "prediction int, label int, confidence double")).first()
    assert coverage.coverage_percent == 0.0 and coverage.alert_rate_percent == 0.0


def test_detection_rate_of_a_missing_category_is_zero(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 0), ("c", 1)], "category string, prediction int")
    got = {r.category: (r.detected, r.total, r.rate) for r in V.detection_rate_by_category(rows, ["a", "b"]).collect()}
    assert got == {"a": (1, 2, 0.5), "b": (0, 0, 0.0)}


def test_encode_and_align(spark):
    rows = spark.createDataFrame([("1.5", "tcp"), ("", "-")], "a string, b string")
    got = E.encode_features(rows, ["a", "b"]).collect()
    assert [tuple(r) for r in got] == [(1.5, 282.0), (0.0, 692.0)]
    spaced = spark.createDataFrame([(1, "x", 9)], "`s bytes` int, `pro to` string, extra int")
    aligned = E.align_schema(spaced, {"proto": "string", "sbytes": "int", "service": "string", "dur": "double"})
    assert tuple(aligned.first()) == ("x", 1, "", None)
    assert E.normalize_headers(spaced).columns == ["sbytes", "proto", "extra"]


def test_target_selection(spark):
    rows = spark.createDataFrame(
        [("Normal", 0), ("Backdoors", 0), ("DoS", 1), (None, 0)], "category string, label int"
    )
    got = {(r.category, r.label, r.stratum) for r in E.select_target_categories(rows).collect()}
    assert got == {("Normal", 0, "normal"), ("Backdoors", 1, "target")}
    assert [tuple(r) for r in E.excluded_categories(rows).collect()] == [("DoS", 1), ("Unknown", 1)]
    strata = rows.select(E.stratum(F.col("category"), "Normal", ["Backdoors"]).alias("s")).collect()
    assert [r.s for r in strata] == ["normal", "target", "other", "other"]
    layouts = [
        E.split_features_label(rows.withColumn("x", F.lit(1)), ["x"], include_category=flag).first().features
        for flag in (True, False)
    ]
    assert [len(x) for x in layouts] == [2, 1]
    prints = rows.select(E.row_fingerprint(F.lit(1.5), F.lit(None), F.lit(7)).alias("p")).first().p
    assert prints == "1.5__7"


def test_several_models_in_one_scan(spark, tmp_path):
    rows = spark.range(400).select(
        "id", (F.col("id") % 17).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b"),
        (F.col("id") % 3 == 0).alias("even"), (F.col("id") % 10 == 0).cast("int").alias("label"),
    )
    rows.write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    normals = {"one": F.col("label") == 0, "two": F.col("even"), "none": F.lit(False)}
    fits = B.fit_baselines(rows, ["a", "b"], normals)
    for name in ("one", "two"):
        want = B.fit_baseline(rows, ["a", "b"], normals[name]).first()
        got = fits.where(F.col("baseline") == name).drop("baseline").first()
        assert got.n == want.n and got.means == pytest.approx(want.means) and got.stds == pytest.approx(want.stds)
    both = S.score(rows, fits, ["a", "b"], by="baseline")
    alone = S.score(rows, B.fit_baseline(rows, ["a", "b"], normals["one"]), ["a", "b"])
    columns = ["id", "prediction", "confidence"]
    assert both.where("baseline = 'one'").select(*columns).exceptAll(alone.select(*columns)).isEmpty()
    assert both.where("baseline = 'none' AND prediction <> 0").isEmpty() and both.count() == 1200
    plan = both._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 2  # one to fit, one to score


def test_without_a_model_nothing_is_an_anomaly(spark):
    rows = spark.range(3)
    assert {tuple(r) for r in S.score(rows, None, ["id"]).select("prediction", "confidence").collect()} == {(0, 0.0)}
    assert S.predict(rows, None, ["id"]).columns == ["id", "prediction"]
    assert S.score_alerts(rows.withColumn("category", F.lit("x")), None, ["id"], ["id"]).isEmpty()


def test_kept_z_and_container(spark):
    rows = spark.range(20).select("id", F.col("id").cast("double").alias("a"), F.lit("x").alias("category"))
    model = B.fit_baseline(rows.where("id < 5"), ["a"])
    z = S.z_scores(rows, model, ["a"]).select("id", "z_a")
    assert S.score(rows, model, ["a"], keep_z=["a"]).select("id", "z_a").exceptAll(z).isEmpty()
    alerts = S.score_alerts(rows, model, ["a"], ["id"], container="monitor")
    assert alerts.columns[-1] == "container" and {r.container for r in alerts.collect()} == {"monitor"}


def test_moments_are_subtracted(spark):
    rows = spark.range(200).select(
        F.col("id").alias("k"), (F.col("id") * 1e6 + 1e9).alias("a"), F.when(F.col("id") % 7 > 0, F.col("id") % 5).cast("double").alias("b")
    )
    part, rest = rows.where("k % 9 = 2"), rows.where("k % 9 <> 2")
    of = lambda df: union_moments(feature_moments(df, ["a", "b"], F.col("k") >= 0))
    got = {r.feature: r for r in subtract_moments(of(rows), of(part)).collect()}
    want = {r.feature: r for r in of(rest).collect()}
    for name, row in want.items():
        assert tuple(got[name])[1:] == pytest.approx(tuple(row)[1:], rel=1e-9)
    nothing = {r.feature: r for r in subtract_moments(of(rows), of(rows)).collect()}
    assert nothing["a"].value_count == 0 and nothing["a"].mean is None and nothing["a"].part_rows == 0
    same = subtract_moments(of(rows), of(rows.where("false"))).collect()
    assert {r.feature: r.value_count for r in same} == {"a": 200, "b": of(rows).where("feature = 'b'").first().value_count}
