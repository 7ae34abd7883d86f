import random

import pytest
from pyspark.sql import functions as F

from tallyguard.operators import history as H
from tallyguard.operators import models as M
from tallyguard.operators import noise as N
from tallyguard.operators import ordering as O
from tallyguard.operators import profile as P
from tallyguard.operators import quality as Q
from tallyguard.operators.baseline import fit_baseline
from tallyguard.operators.evaluate import classification_metrics, evaluate_model
from tallyguard.operators.score import score
from tallyguard.sources import tables

from .conftest import FLOW_TABLE_FEATURES


def series(spark, values, name="accuracy"):
    rows = [(i, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, f"iteration int, {name} double").repartition(3)


@pytest.mark.parametrize("width", [1, 2, 10_000])
@pytest.mark.parametrize(
    "values, expected",
    [
        ([0.2, 0.4, 0.9, 0.5, 0.7], 0.4),
        ([0.7, 0.5, 0.9, 0.4, 0.2], -0.1),
        ([0.9], 0.0),
        ([None, 0.5, None, 0.7], 0.2),
        ([None, None], 0.0),
    ],
)
def test_trend(spark, values, expected, width):
    got = H.metric_trend(series(spark, values), metrics=["accuracy"], width=width).first()
    assert got.trend == pytest.approx(expected)


@pytest.mark.parametrize("width", [2, 10_000])
@pytest.mark.parametrize(
    "values, threshold, expected",
    [
        ([0.9, 0.7, 0.8, 0.6], 0.10, True),
        ([0.9, 0.7, 0.8, 0.78], 0.05, False),
        ([0.7, 0.7, 0.2], 0.10, False),
        ([0.0, 0.0, 0.0, 0.0], 0.10, False),
        ([0.6, None, 0.9, 0.75, 0.5, None], 0.10, True),
        ([], 0.10, False),
    ],
)
def test_degradation(spark, values, threshold, expected, width):
    got = H.degradation_alert(series(spark, values), metrics=["accuracy"], threshold=threshold, width=width)
    assert got.first().alert is expected


def test_stats(spark):
    got = H.metric_stats(series(spark, [0.4, 0.6, 0.9, 0.5]), ["accuracy"]).first()
    assert (got.n, got.min, got.max) == (4, 0.4, 0.9)
    assert got.mean == pytest.approx(0.6) and got["std"] == pytest.approx(0.035**0.5)
    none = H.metric_stats(series(spark, []), ["accuracy"]).first()
    assert tuple(none) == ("accuracy", 0, 0.0, 0.0, 0.0, 0.0)


def test_baseline_vs_current(spark):
    history = series(spark, [0.9, 0.8, 0.85, 0.6, 0.5])
    got = H.baseline_vs_current(history, {"accuracy": 100}).first()
    assert (got.baseline_cycle, got.current_cycle) == (2, 4)
    assert got.change == pytest.approx(-35.0)
    assert H.baseline_vs_current(history, {"accuracy": 1}, 0).first().baseline == 0.9
    assert H.baseline_vs_current(series(spark, [0.9]), {"accuracy": 1}).count() == 0


def test_scaled_series(spark):
    got = H.scaled_series(series(spark, [0.5, 0.75, 1.0]), ["accuracy"]).orderBy("iteration")
    assert [r.bar for r in got.collect()] == [0, 20, 40]
    assert {r.bar for r in H.scaled_series(series(spark, [0.5, 0.5]), ["accuracy"]).collect()} == {40}


@pytest.mark.parametrize("width", [1, 3, 10_000])
def test_cycle_deltas(spark, width):
    got = H.cycle_deltas(series(spark, [0.85, 0.65, 0.65, 0.0, 0.5]), ["accuracy"], width=width)
    rows = got.orderBy("iteration").collect()
    assert [r.accuracy_change for r in rows] == [None] + [pytest.approx(x) for x in (-0.2, 0.0, -0.65, 0.5)]
    assert rows[1].accuracy_drop_percent == pytest.approx(100 * 0.2 / 0.85)
    assert rows[4].accuracy_drop_percent is None


def test_row_numbers_over_chunks(spark):
    rows = spark.range(0, 1000, 7).select("id", (F.col("id") % 2).alias("g")).repartition(5)
    for width in (1, 50, 10_000):
        got = O.with_row_number(rows, "id", ["g"], width).orderBy("g", "id").collect()
        for g in (0, 1):
            part = [r for r in got if r.g == g]
            assert [r.row_no for r in part] == list(range(1, len(part) + 1))
            assert {r.row_total for r in part} == {len(part)}


def state_machine(steps, trigger):
    """Step by step: on once enabled and triggered, off when disabled."""
    active, started, out = False, None, []
    for cycle, enabled in steps:
        if enabled and not active and cycle >= trigger:
            active, started = True, cycle
        elif not enabled and active:
            active = False
        out.append((active, started))
    return out


@pytest.mark.parametrize("width", [1, 4, 10_000])
def test_activation_follows_the_state_machine(spark, width):
    rng = random.Random(width)
    cycle, steps = 0, []
    for _ in range(60):
        cycle += rng.choice([0, 1, 1, 2])
        steps.append((cycle, rng.random() < 0.6))
    table = spark.createDataFrame([(i, c, e) for i, (c, e) in enumerate(steps)], "step int, cycle int, enabled boolean")
    got = N.noise_activation(table.repartition(4), 3, order="step", width=width).orderBy("step").collect()
    assert [(r.is_active, r.started_at_cycle) for r in got] == state_machine(steps, 3)


@pytest.mark.parametrize(
    "steps, active, started",
    [
        ([(3, True)], True, 3),
        ([(5, False)], False, None),
        ([(3, True), (4, False)], False, 3),
        ([(3, True), (4, False), (6, True)], True, 6),
        ([(1, True), (2, True)], False, None),
    ],
)
def test_activation_cases(spark, steps, active, started):
    table = spark.createDataFrame(steps, "cycle int, enabled boolean")
    last = N.noise_activation(table).orderBy(F.desc("cycle")).first()
    assert (last.is_active, last.started_at_cycle) == (active, started)


# Label noise ----------------------------------------------------------------


def test_noise_changes_only_label_and_category(spark, flow_table):
    noisy = N.inject_label_noise(flow_table, 0.4, ["id"], category="attack_cat", flag="flipped")
    features = ["id", *FLOW_TABLE_FEATURES]
    assert noisy.select(features).exceptAll(flow_table.select(features)).count() == 0
    flipped = noisy.where("flipped")
    assert flipped.where("label <> 0 OR attack_cat <> 'Normal'").count() == 0
    assert flipped.join(flow_table.where("label = 0"), "id", "left_semi").count() == 0
    summary = N.noise_summary(noisy, "flipped").first()
    assert summary.eligible == flow_table.where("label = 1").count()
    assert summary.effective_rate == pytest.approx(0.4, abs=0.05)


def test_noise_rates(spark, flow_table):
    rates = {r: N.inject_label_noise(flow_table, r, ["id"], category="attack_cat") for r in (0.0, 1.0)}
    assert rates[0.0].where("label = 1").count() == flow_table.where("label = 1").count()
    assert rates[1.0].where("label = 1").count() == 0
    with pytest.raises(ValueError):
        N.inject_label_noise(flow_table, 100.0, ["id"])
    off = N.inject_label_noise(flow_table, 1.0, ["id"], category="attack_cat", active=F.lit(False))
    assert off.where("label = 1").count() == flow_table.where("label = 1").count()


def test_noise_costs_recall(spark, flow_table):
    names = list(FLOW_TABLE_FEATURES)
    noisy = N.inject_label_noise(flow_table, 0.6, ["id"], category="attack_cat")
    normal = F.col("label") == 0
    recall = {
        name: classification_metrics(score(flow_table, fit_baseline(rows, names, normal), names)).first().recall
        for name, rows in (("clean", flow_table), ("noisy", noisy))
    }
    assert recall["noisy"] < recall["clean"]


# Stored models, history, events ---------------------------------------------


def test_model_versions(spark, tmp_path):
    path = str(tmp_path / "models")
    rows = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    assert tables.load_model(spark, path, ["a", "b"]) is None
    with pytest.raises(ValueError):
        tables.save_model(fit_baseline(rows, ["a"], F.lit(False)), path, "none", F.current_timestamp())
    for day, name in enumerate(["m1", "m2", "m3"], start=1):
        model = fit_baseline(rows.limit(1) if day == 1 else rows, ["a", "b"])
        tables.save_model(model, path, name, F.lit(f"2025-01-0{day}").cast("timestamp"))
    newest = tables.load_model(spark, path, ["b", "a"]).first()
    assert newest.means == [5.0, 2.0] and newest.stds == [0.0, 1.0] and newest.n == 2
    assert tables.load_model(spark, path, ["a"], "m1").first().n == 1
    stored = tables.read_models(spark, path)
    tags = {r.model_id: (r.version, r.tag) for r in M.version_tags(stored).collect()}
    assert tags == {"m1": (1, "baseline"), "m2": (2, "before_retrain_2"), "m3": (3, "latest")}
    shift = M.compare_models(stored.where("model_id = 'm1'"), stored.where("model_id = 'm3'"))
    assert {r.feature: r.std_shift for r in shift.collect()} == {"a": 1.0, "b": 0.0}
    assert all(r.passed for r in Q.check_model(M.latest_rows(stored)).collect())


def test_history_and_events(spark, tmp_path):
    path, log = str(tmp_path / "history"), str(tmp_path / "events")
    rows = spark.createDataFrame([(1, 1, "a"), (0, 1, "b"), (0, 0, "c")], "prediction int, label int, category string")
    for iteration in (1, 2, 2):
        evaluated = evaluate_model(rows, {"first": "a", "second": "b"}).withColumn("ts", F.current_timestamp())
        tables.append_history(evaluated, path, iteration)
    history = tables.read_history(spark, path)
    assert history.count() == 2
    row = history.first()
    assert (row.accuracy, row.first_detection_rate, row.second_detection_rate) == (0.6667, 1.0, 0.0)
    assert all(r.passed for r in Q.check_history(history).collect())
    for i, status in enumerate(["success", "skipped", "success"]):
        tables.log_retrain_event(spark, log, i, status, F.current_timestamp())
    counted = H.retrain_cycle_count(tables.read_retrain_events(spark, log)).first()
    assert (counted.attempts, counted.cycles) == (3, 2)
    report = H.history_report(history).first()
    assert report.history_count == 2 and report.current_metrics.iteration == 2


# Checks and profiles --------------------------------------------------------


def checks(df):
    return {r.check_name: (r.passed, r.detail) for r in df.collect()}


def test_checks_fail_on_bad_tables(spark):
    assert checks(Q.check_model(spark.range(1)))["required_columns"][0] is False
    alerts = spark.createDataFrame([("t", "ANOMALY", 1.5), ("t", None, 0.5)], "ts string, prediction string, confidence double")
    got = checks(Q.check_alerts(alerts))
    assert got["confidence_range"] == (False, "1") and got["fields_filled"] == (False, "1")
    assert got["mean_confidence"] == (True, "1.000")
    assert checks(Q.check_alerts(alerts.where("false")))["count"] == (True, "0")


def test_check_distribution_and_test_set(spark):
    rows = spark.range(100).select(
        F.when(F.col("id") < 80, "Normal").otherwise("DoS").alias("category"),
        (F.col("id") >= 80).cast("int").alias("label"),
    )
    assert checks(Q.check_distribution(rows))["normal_percent"] == (False, "80.000")
    good = checks(Q.check_test_set(rows, 100, ["Normal", "DoS"]))
    assert all(passed for passed, _ in good.values())
    bad = checks(Q.check_test_set(rows, 500, ["Normal"]))
    assert bad["size"] == (False, "100") and bad["categories"] == (False, "20")
    two = rows.withColumn("category", F.when(F.col("label") == 0, "Fuzzers").otherwise(F.col("category")))
    named = Q.check_test_set(two, 100, ["Normal"]).where("check_name = 'unexpected_category'").collect()
    assert sorted((r.passed, r.detail) for r in named) == [(False, "DoS: 20"), (False, "Fuzzers: 80")]


@pytest.mark.parametrize("width", [1, 10_000])
def test_rows_without_order_or_group_stay(spark, width):
    rows = [(None, "a", 1.0), (1, "a", 2.0), (2, "a", 3.0), (1, None, 4.0), (None, None, 5.0)]
    df = spark.createDataFrame(rows, "i int, g string, v double")
    numbered = {r.v: (r.row_no, r.row_total) for r in O.with_row_number(df, "i", ["g"], width).collect()}
    assert numbered == {1.0: (1, 3), 2.0: (2, 3), 3.0: (3, 3), 5.0: (1, 2), 4.0: (2, 2)}
    before = {r.v: r.previous and r.previous.v for r in O.with_previous(df, "i", ["v"], ["g"], width).collect()}
    assert before == {1.0: None, 2.0: 1.0, 3.0: 2.0, 5.0: None, 4.0: 5.0}
    most = {r.v: r.most for r in O.with_running_max(df, "i", "v", "most", ["g"], width).collect()}
    assert most == {1.0: 1.0, 2.0: 2.0, 3.0: 3.0, 5.0: 5.0, 4.0: 5.0}


def test_profile(spark, flow_sample):
    scored = flow_sample.withColumns(
        {"prediction": F.col("label"), "confidence": F.when(F.col("sbytes") > 0, F.lit(0.5)), "category": F.col("attack_cat")}
    )
    one_less = F.when(F.col("label") == 1, F.lit(0.3))
    scored = scored.where("label = 0").unionByName(scored.where("label = 1").limit(2)).unionByName(
        scored.where("label = 1").limit(1).withColumn("confidence", one_less)
    )
    got = P.traffic_profile(scored).first()
    assert (got.total_flows, got.normal, got.anomalies, got.alerts) == (8, 5, 3, 2)
    assert (got.anomaly_percent, got.alert_percent, got.alert_ratio) == (37.5, 25.0, "66.7%")
    quiet = P.traffic_profile(scored.where("label = 0")).first()
    assert quiet.alert_ratio == "0.0%"
    report = P.traffic_report(scored)
    row = report.first()
    assert (row.total_flows, row.alerts, row.alert_ratio) == (8, 2, "66.7%")
    assert [tuple(e) for e in row.top_services] == [("http", 5), ("-", 3)]
    assert [tuple(e) for e in row.top_protocols] == [("tcp", 8)] and [tuple(e) for e in row.attack_categories] == [("Backdoors", 3)]
    empty = P.traffic_report(scored.where("false")).first()
    assert (empty.total_flows, empty.top_services, empty.alert_ratio) == (0, [], "0.0%")
    parts = {(r.part, r.value): r.n for r in P.dataset_composition(flow_sample, category="attack_cat").collect()}
    assert parts == {("total", None): 8, ("label", "0"): 5, ("label", "1"): 3,
                     ("category", "Normal"): 5, ("category", "Backdoors"): 3}
    assert [tuple(r) for r in P.category_histogram(flow_sample, category="attack_cat").collect()] == [("Backdoors", 3)]
    assert [r.service for r in P.top_values(flow_sample, "service", "service").collect()] == ["http", "-"]
