from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyguard.operators.accumulate import combine_training
from tallyguard.operators.baseline import fit_baseline
from tallyguard.operators.sampling import train_minus_test
from tallyguard.operators.score import score_alerts
from tallyguard.sources import parts, tables
from tallyguard.streaming import jobs as J

SCHEMA = "id long, ts timestamp, x double, category string, label int, confidence double"
START = datetime(2025, 1, 1)


def rows(spark, minutes, first=0):
    data = [
        (first + i, START + timedelta(minutes=m), float(i % 10) + 20 * (i % 5 == 0),
         "Generic" if i % 5 == 0 else "Normal", int(i % 5 == 0), 0.5)
        for i, m in enumerate(minutes)
    ]
    return spark.createDataFrame(data, SCHEMA)


class Source:
    """A folder that grows file by file, and the stream over it."""

    def __init__(self, spark, tmp_path):
        self.spark, self.folder = spark, str(tmp_path / "source")
        self.out, self.checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def add(self, df):
        df.coalesce(1).write.mode("append").parquet(self.folder)

    def stream(self):
        return J.read_stream(self.spark, self.folder, SCHEMA)

    def result(self):
        return self.spark.read.parquet(self.out)


@pytest.fixture
def source(spark, tmp_path):
    return Source(spark, tmp_path)


def test_scoring_stream_equals_batch_and_scores_each_row_once(spark, source):
    everything = rows(spark, range(100))
    model = tables.freeze_model(fit_baseline(everything, ["x"], F.col("label") == 0))
    for part in (everything.where("id < 60"), everything.where("id >= 60")):
        source.add(part)
        J.stream_score(source.stream(), model, ["x"], ["id"], source.out, source.checkpoint, ts="ts").awaitTermination()
    J.stream_score(source.stream(), model, ["x"], ["id"], source.out, source.checkpoint, ts="ts").awaitTermination()
    batch = score_alerts(everything, model, ["x"], ["id"], ts="ts")
    assert batch.count() > 0
    assert source.result().exceptAll(batch).count() == 0 and source.result().count() == batch.count()


def test_tumbling_summary_and_late_rows(spark, source, tmp_path):
    """Rows that come after their window was closed are counted as late."""
    late = str(tmp_path / "late")
    dropped = []
    for minutes, first in (([0, 1, 2, 61, 62], 0), ([3, 4, 63, 125], 100)):
        source.add(rows(spark, minutes, first))
        summary = J.stream_summary(source.stream(), source.out, source.checkpoint, "10 minutes")
        summary.awaitTermination()
        dropped.append(J.dropped_rows(summary))
        J.stream_late(source.stream(), late, str(tmp_path / "late-checkpoint"), "10 minutes").awaitTermination()
    assert dropped[0] == 0 and dropped[1] > 0  # counted after partial aggregation
    closed = F.lit(START + timedelta(minutes=115))
    everything = spark.read.parquet(source.folder)
    found = J.late_rows(everything, source.result(), J.read_late(spark, late), closed, "10 minutes")
    got = found.orderBy("window_start").collect()
    assert [(r.arrived, r.counted, r.late) for r in got] == [(5, 3, 2), (3, 3, 0)]
    assert {r.id for r in J.read_late(spark, late).collect()} == {100, 101}


def test_deduplication(spark, source):
    source.add(rows(spark, range(20)).union(rows(spark, range(20))))
    J.stream_dedup(source.stream(), ["id"], source.out, source.checkpoint).awaitTermination()
    source.add(rows(spark, range(15, 25), first=15))
    J.stream_dedup(source.stream(), ["id"], source.out, source.checkpoint).awaitTermination()
    got = source.result().groupBy("id").count()
    assert got.count() == 25 and got.agg(F.max("count")).first()[0] == 1


def test_hot_key_deduplication(spark, source):
    """One key makes up almost all rows, spread over several files."""
    for first in (0, 40, 80):
        source.add(rows(spark, [1] * 40).withColumn("id", F.lit(7).cast("long")))
        source.add(rows(spark, [1, 2], first=1000 + first))
    J.stream_dedup(source.stream(), ["id"], source.out, source.checkpoint).awaitTermination()
    got = source.result()
    assert got.count() == 7 and got.where("id = 7").count() == 1


def test_running_totals(spark, source):
    for first, n in ((0, 10), (10, 15), (25, 5)):
        source.add(rows(spark, range(n), first))
        J.stream_running_totals(source.stream(), source.out, source.checkpoint).awaitTermination()
    got = J.latest_totals(spark, source.out).first()
    assert (got.generated, got.anomalies, got.flipped) == (30, 6, 0)


def test_parts_stay_few():
    kept = []
    for batch in range(1000):
        before = parts.spans(batch)
        assert sum(last - first + 1 for first, last in parts.spans(batch + 1)) == batch + 1
        inputs = [s for s in before if s[0] >= parts.span_of(batch)[0]]
        assert set(inputs) <= set(kept)
        kept = [s for s in kept if batch == 0 or s in before or s not in parts.spans(batch - 1)] + [parts.span_of(batch)]
        assert set(parts.spans(batch + 1)) <= set(kept) and len(kept) <= 2 * (batch + 1).bit_length()


def test_folding_parts_and_running_a_batch_again(spark, tmp_path):
    folder = str(tmp_path / "state")

    def add(batch):
        rows = spark.createDataFrame([(batch % 2, batch)], "k int, n long")
        parts.fold_part(rows, folder, batch, lambda several: several.groupBy("k").agg(F.sum("n").alias("n")))

    def total(batch):
        state = parts.read_state(spark, folder, parts.schema_of(spark, folder, parts.span_of(batch)), batch)
        return state.agg(F.sum("n")).first()[0]

    for batch in range(9):
        add(batch)
        add(batch)  # the last batch again
        assert total(batch) == sum(range(batch + 1))
    add(3)  # committed long ago
    assert total(8) == 36 and len(parts.stored_spans(spark, folder)) <= 8
    assert parts.stored_spans(spark, folder + "-absent") == []


def test_alert_summary_of_each_minute(spark, source):
    for minutes, first in (([0, 0, 1], 0), ([1, 5], 10), ([0], 20)):
        source.add(rows(spark, minutes, first).withColumnRenamed("category", "anomaly_type"))
        stream = J.read_stream(spark, source.folder, SCHEMA.replace("category", "anomaly_type"))
        J.stream_alert_summary(stream, source.out, source.checkpoint, ["id"], n=2).awaitTermination()
    got = {r.window_start: r for r in J.read_alert_summary(spark, source.out, 2).collect()}
    assert {t: r.total_alerts for t, r in got.items()} == {START: 3, START + timedelta(minutes=1): 2, START + timedelta(minutes=5): 1}
    assert [a.id for a in got[START].latest_alerts] == [0, 1] and got[START].alert_types == {"Generic": 2, "Normal": 1}


def test_snapshots(spark, source):
    for first, n in ((0, 5), (5, 7)):
        source.add(rows(spark, range(n), first))
        J.stream_snapshots(source.stream(), source.out, source.checkpoint).awaitTermination()
    counts = {r.snapshot_id: r["count"] for r in source.result().groupBy("snapshot_id").count().collect()}
    assert counts == {0: 5, 1: 7}


def retrain(spark, tmp_path, min_new=30, build=None, original=None):
    original = rows(spark, range(50), 10_000) if original is None else original
    build = build or (lambda arrived: (original.limit(0), False))
    return J.retrain_step(
        original, build, ["x"], {"generic": "Generic"}, str(tmp_path / "state"), min_new, F.col("label") == 0
    )


def test_retraining(spark, source, tmp_path):
    step = retrain(spark, tmp_path)
    state = str(tmp_path / "state")
    for first, n in ((0, 10), (10, 40), (50, 30)):
        source.add(rows(spark, range(n), first))
        J.stream_retrain(source.stream(), step, source.checkpoint).awaitTermination()
    events = tables.read_retrain_events(spark, state + "/events").orderBy("iteration").collect()
    assert [e.status for e in events] == ["skipped", "success", "success"]
    assert tables.read_history(spark, state + "/history").count() == 2
    # The kept moments give the model that a fit on all rows gives.
    snapshots = tables.read_table(spark, state + "/snapshots")
    everything = combine_training(rows(spark, range(50), 10_000), snapshots, 30)
    want = fit_baseline(everything, ["x"], F.col("label") == 0).first()
    got = tables.load_model(spark, state + "/models", ["x"]).first()
    assert got.n == want.n and got.means == pytest.approx(want.means) and got.stds == pytest.approx(want.stds)


def test_retraining_without_test_rows(spark, source, tmp_path):
    """A fallback first, then a set that is drawn once; later batches hold more copies of its rows."""
    drawn = []
    columns = ["id", "ts", "x", "category", "label", "confidence"]

    def build(arrived):
        drawn.append(arrived.count())
        return arrived.where(F.col("id") % 4 == 1).select(*columns), drawn[-1] > 20

    original = rows(spark, range(40), 0)
    step = retrain(spark, tmp_path, 1, build, original)
    state = str(tmp_path / "state")
    batches = [rows(spark, range(20), 0), rows(spark, range(20), 100), rows(spark, range(20), 0), rows(spark, range(30), 100)]
    for i, batch in enumerate(batches):
        step(batch, i)
        if i == 1:
            step(batch, i)  # run again, after the test set was drawn
    test = tables.read_test_set(spark, state + "/test_sets")
    assert test.count() == 10 and drawn == [20, 40]
    for tick in range(1, 4):
        whole = original
        for batch in batches[: tick + 1]:
            whole = whole.unionByName(batch)
        want = fit_baseline(train_minus_test(whole, test), ["x"], F.col("label") == 0).first()
        got = tables.load_model(spark, state + "/models", ["x"], f"cycle_{tick:06d}").first()
        assert got.n == want.n and got.means == pytest.approx(want.means) and got.stds == pytest.approx(want.stds)
    events = tables.read_retrain_events(spark, state + "/events")
    assert {e.status for e in events.collect()} == {"success"} and events.count() == 4


def test_retraining_a_batch_again_changes_nothing(spark, source, tmp_path):
    step = retrain(spark, tmp_path, min_new=1)
    state = str(tmp_path / "state")
    batches = [rows(spark, range(20), 100 * i) for i in range(3)]

    def outcome():
        models = tables.read_models(spark, state + "/models").select("model_id", "mean", "std", "n")
        history = tables.read_history(spark, state + "/history").drop("ts")
        return sorted(map(tuple, models.collect())), sorted(map(str, history.collect()))

    for i, batch in enumerate(batches):
        step(batch, i)
    before = outcome()
    step(batches[1], 1)
    step(batches[2], 2)
    assert outcome() == before


def test_log_stream(spark, tmp_path):
    folder = tmp_path / "lines"
    folder.mkdir()
    (folder / "a.log").write_text('{"level": "ERROR", "timestamp": "2025-01-01T00:00:00"}\n{broken\n{"a": 1}\n')
    out = str(tmp_path / "out")
    J.stream_log_alerts(spark.readStream.text(str(folder)), out, str(tmp_path / "cp")).awaitTermination()
    assert [r.severity for r in spark.read.parquet(out).collect()] == ["CRITICAL"]
