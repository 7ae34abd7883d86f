import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyguard.operators import alerts as A
from tallyguard.operators import logs as L
from tallyguard.schema import FLOW_COLUMNS, FLOW_FEATURES
from tallyguard.sources import files, tables

AT = "2025-01-01T12:00:00"
DETECTION = {"timestamp": AT, "level": "INFO", "message": "m", "anomaly_score": 0.85,
             "features": [1, 2], "prediction": 1, "confidence": 0.92}
TRAINING = {"timestamp": AT, "accuracy": 0.88, "precision": 0.85, "recall": 0.82,
            "f1_score": 0.83, "training_samples": 1000}
SYSTEM = {"timestamp": AT, "level": "ERROR", "message": "down", "component": "db", "error_code": "E1"}
UNKNOWN = {"timestamp": AT, "message": "hello"}


def lines(spark, *entries):
    texts = [e if isinstance(e, str) else json.dumps(e) for e in entries]
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, value string").coalesce(1)


def as_of():
    return F.lit("2025-01-02 00:00:00").cast("timestamp")


def classified(spark, *entries):
    return {r.n: r for r in L.classify_logs(lines(spark, *entries), as_of()).collect()}


def routed(spark, *entries):
    return {r.n: r for r in L.route_alerts(lines(spark, *entries), as_of()).collect()}


def test_types_and_fields(spark):
    got = classified(spark, DETECTION, TRAINING, SYSTEM, UNKNOWN, {"level": "INFO"})
    assert {n: r.type for n, r in got.items()} == {
        0: "anomaly_detection", 1: "model_training", 2: "system_event", 3: "unknown",
    }
    assert (got[0].anomaly_score, got[0].confidence, got[0].prediction) == (0.85, 0.92, 1.0)
    assert (got[1].accuracy, got[1].f1_score, got[1].training_samples) == (0.88, 0.83, 1000.0)
    assert (got[2].component, got[2].error_code, got[2].severity) == ("db", "E1", "CRITICAL")
    assert (got[3].level, got[3].message, got[3].component) == ("INFO", "hello", None)
    assert got[0].ts == datetime(2025, 1, 1, 12)


def test_precedence_and_defaults(spark):
    got = classified(
        spark,
        {**TRAINING, **DETECTION},
        {**SYSTEM, "accuracy": 0.5},
        {"prediction": 1},
        {"training_samples": 5},
        {"error_code": "E9"},
        {"anomaly_score": None},
    )
    assert [got[n].type for n in range(6)] == [
        "anomaly_detection", "model_training", "anomaly_detection",
        "model_training", "system_event", "anomaly_detection",
    ]
    assert (got[2].confidence, got[2].ts) == (0.0, datetime(2025, 1, 2))
    assert (got[3].accuracy, got[4].component, got[4].level) == (0.0, "", "INFO")
    assert got[5].anomaly_score is None


@pytest.mark.parametrize(
    "line", ["[1, 2]", '{"level": "ERR', "", "7", "null", {"timestamp": "", "message": "x"},
             {"timestamp": AT, "message": ""}, {"timestamp": AT}, {}]
)
def test_unusable_lines_are_dropped(spark, line):
    assert classified(spark, line) == {}


def test_routing(spark):
    degraded = {"accuracy": 0.65, "previous_accuracy": 0.85, "degradation_percent": 23.5}
    got = routed(
        spark,
        {"timestamp": AT, "anomaly_score": 0.95, "confidence": 0.92},
        degraded,
        SYSTEM,
        {**DETECTION, "confidence": 0.65},
        {**DETECTION, "confidence": 0.1, "level": "ERROR"},
        {"anomaly_score": 0.9},
        {"anomaly_score": 0.9, "confidence": None, "level": "ERROR"},
        UNKNOWN,
        {"level": "ERROR"},
        {"anomaly_score": 0.9, "confidence": 0.8},
    )
    assert {n: r.severity for n, r in got.items()} == {
        0: "HIGH", 1: "MEDIUM", 2: "CRITICAL", 8: "CRITICAL", 9: "HIGH",
    }
    assert (got[0].alert_type, got[0].anomaly_score, got[0].component) == ("high_confidence_anomaly", 0.95, None)
    assert (got[1].current_accuracy, got[1].previous_accuracy, got[1].degradation_percent) == (0.65, 0.85, 23.5)
    assert (got[2].component, got[2].error_code, got[2].message) == ("db", "E1", "down")
    assert (got[8].component, got[8].error_code) == ("unknown", "")
    assert len({r.alert_id for r in got.values()}) == len(got)


def test_filters(spark):
    logs = L.classify_logs(lines(spark, DETECTION, TRAINING, SYSTEM, UNKNOWN), as_of())
    assert L.filter_logs(logs, log_type="unknown").count() == 1
    assert L.filter_logs(logs, severity="HIGH").count() == 1
    assert L.filter_logs(logs, window="11 hours", as_of=as_of()).count() == 0
    assert L.filter_logs(logs, window="12 hours", as_of=as_of()).count() == 4


def detections():
    pairs = zip([1, 1, 0, 1, 0], [0.92, 0.68, 0.55, 0.78, 0.65])
    return [{**DETECTION, "prediction": p, "confidence": c} for p, c in pairs]


def test_statistics(spark):
    got = L.anomaly_statistics(L.classify_logs(lines(spark, *detections(), SYSTEM), as_of())).first()
    assert (got.total_detections, got.anomaly_rate, got.high_confidence_alerts) == (5, 0.6, 1)
    assert got.average_confidence == pytest.approx(0.716)
    none = L.anomaly_statistics(L.classify_logs(lines(spark, SYSTEM), as_of())).first()
    assert tuple(none) == (0, 0.0, 0.0, 0)


def test_temporal_patterns(spark):
    times = [f"2025-01-01T12:{5 * i:02d}:00" for i in range(10)]
    rows = spark.createDataFrame([(t,) for t in times], "ts string")
    got = L.temporal_patterns(rows).first()
    assert (got.first_seen, got.last_seen, got.peak_hours) == (times[0], times[-1], [12])
    assert got.detection_frequency == 10.0
    odd = rows.union(spark.createDataFrame([("soon",), ("",), (None,)], "ts string"))
    assert L.temporal_patterns(odd).first().entries == 11
    empty = L.temporal_patterns(rows.where("false")).first()
    assert (empty.entries, empty.detection_frequency, empty.peak_hours) == (0, 0.0, [])


def test_report(spark):
    entries = lines(spark, *detections(), SYSTEM)
    found = L.log_report(entries, as_of())
    report = found.first()
    assert found._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1  # the lines are read once
    assert report.total_logs_processed == 6
    assert report.anomaly_statistics.total_detections == 5
    assert report.anomaly_statistics.average_confidence == pytest.approx(0.716)
    assert report.temporal_analysis.peak_hours == [12]
    assert report.alert_summary.total_alerts_generated == 2
    empty = L.log_report(entries.where("false"), as_of()).first()
    assert empty.total_logs_processed == 0 and empty.anomaly_statistics.anomaly_rate == 0.0


# Files and alert views ------------------------------------------------------


def test_alert_files(spark, tmp_path):
    one = {"timestamp": "2025-01-01T10:00:00", "sample_id": 1, "confidence": 0.5, "anomaly_type": "a"}
    (tmp_path / "a.json").write_text(json.dumps([one, {**one, "sample_id": 2}], indent=2))
    (tmp_path / "b.json").write_text(json.dumps({**one, "sample_id": 3, "timestamp": "2025-01-01T23:00:00"}))
    (tmp_path / "c.json").write_text('[{"sample_id": 4, ')
    (tmp_path / "d.json").write_text('{"unknown_field": 1}')
    got = files.scan_alert_files(spark, str(tmp_path))
    assert got.count() == 4
    assert sorted(r.sample_id or 0 for r in got.collect()) == [0, 1, 2, 3]
    recent = files.scan_alert_files(spark, str(tmp_path), as_of(), "2 hours")
    assert [r.sample_id for r in recent.collect()] == [3]


def test_alert_documents_round_trip(spark, tmp_path):
    alerts = spark.range(25).select(
        F.col("id").alias("sample_id"),
        F.lit("2025-01-01 00:00:00.123456").cast("timestamp").alias("timestamp"),
        F.lit(0.5).alias("confidence"),
    )
    path = str(tmp_path / "docs")
    files.write_alert_documents(alerts, path, ["sample_id"], per_file=10)
    back = files.scan_alert_files(spark, path).select("sample_id", "timestamp", "confidence")
    assert back.exceptAll(alerts).count() == 0 and back.count() == 25
    assert len(list((tmp_path / "docs").glob("part-*"))) == 3


def test_alert_documents_in_rows(spark):
    docs = spark.createDataFrame(
        [('[{"sample_id": 1}, {"sample_id": 2, "type": "t"}, {"foo": 1}, null]',), ('{"sample_id": 3}',), ("[]",), ("{bro",)],
        "value string",
    )
    got = A.normalize_alerts(docs)
    kinds = {r.sample_id: r.k for r in got.select("sample_id", A.alert_kind(got).alias("k")).collect()}
    assert kinds == {None: "Unknown", 1: "Unknown", 2: "t", 3: "Unknown"}


def test_log_lines_and_flows(spark, tmp_path):
    path = tmp_path / "log"
    path.write_text('{"a": 1}\n[1]\n{bad\n\n{}\n')
    assert files.scan_log_lines(spark, str(path)).count() == 2
    csv = tmp_path / "flows.csv"
    csv.write_text("dur,proto,label\n1.5,tcp,0\n2,udp\n3,-,1,extra\n")
    columns = ["dur", "proto", "label"]
    got = files.scan_flows(spark, str(csv), columns, ["dur", "proto"], "label").collect()
    assert [(r.dur, r.label) for r in got] == [(1.5, 0), (2.0, None), (3.0, 1)]
    assert [r.proto for r in got][::2] == [282.0, 692.0]
    # An empty cell is a value, a cell that a short row lacks is none; quotes may hide commas.
    csv.write_text('dur,proto,label\n,tcp,1\n2,,0\n"",udp\n4\n5,"a,""b",1\n,\n')
    cells = files.scan_flows(spark, str(csv), columns).collect()
    assert [tuple(r) for r in cells] == [
        ("", "tcp", "1"), ("2", "", "0"), ("", "udp", None), ("4", None, None), ("5", 'a,"b', "1"), ("", "", None),
    ]
    got = files.scan_flows(spark, str(csv), columns, ["dur", "proto"], "label").collect()
    assert [r.dur for r in got] == [0.0, 2.0, 0.0, 4.0, 5.0, 0.0] and [r.proto is None for r in got][3] and got[1].proto == 0.0
    assert files.scan_flows(spark, str(csv), columns).select("proto").where("proto IS NULL").count() == 1
    csv.write_text("la bel,proto,more,dur\n1,udp,9,4\n")
    moved = files.scan_flows(spark, str(csv), columns, ["dur"], "label")
    assert [tuple(r) for r in moved.collect()] == [(4.0, "udp", 1)]
    assert files.scan_flows(spark, str(tmp_path / "absent.csv"), columns, ["dur"]).count() == 0


def test_flow_file_with_all_columns(spark, tmp_path, flow_sample):
    path = str(tmp_path / "flows")
    files.write_flows(flow_sample, path)
    got = files.scan_flows(spark, path, FLOW_COLUMNS, FLOW_FEATURES, "label")
    assert got.columns == FLOW_COLUMNS and got.count() == 8
    row = got.where("label = 1").first()
    assert (row.proto, row.service, row.sbytes, row.attack_cat) == (282.0, 692.0, 31000.0, "Backdoors")


def alert_rows(spark):
    rows = [(i, f"2025-01-01 {i:02d}:00:00", c) for i, c in enumerate([0.71, 0.7, 0.3, 0.29, 0.9])]
    return spark.createDataFrame(rows, "id int, t string, confidence double").select(
        "id", F.col("t").cast("timestamp").alias("ts"), "confidence"
    )


def test_bands_and_kpis(spark):
    alerts = alert_rows(spark)
    bands = [r.b for r in alerts.select(A.confidence_band(F.col("confidence")).alias("b")).collect()]
    assert bands == ["high", "medium", "medium", "low", "high"]
    now = F.lit("2025-01-01 05:00:00").cast("timestamp")
    got = A.alert_kpis(alerts, now, "3 hours", 180).first()
    assert (got.alerts, got.high, got.medium, got.low) == (3, 1, 1, 1)
    assert got.alerts_per_minute == pytest.approx(3 / 180)
    assert A.alert_kpis(alerts, now, "1 minute", 1).first().alerts == 0
    assert [r.id for r in A.latest_alerts(alerts, ["id"], 2).collect()] == [4, 3]


def test_stored_alerts_are_read_by_day(spark, tmp_path):
    path = str(tmp_path / "alerts")
    assert tables.read_alerts(spark, path) is None
    tables.append_alerts(alert_rows(spark), path, 0)
    later = alert_rows(spark).withColumn("ts", F.expr("ts + INTERVAL 1 DAY"))
    tables.append_alerts(later.unionByName(later.withColumn("ts", F.expr("ts + INTERVAL 5 DAY"))), path, 1)
    tables.append_alerts(later, path, 1)  # again, now without rows on the last day
    assert tables.read_alerts(spark, path).count() == 10
    since = F.lit("2025-01-02 03:00:00").cast("timestamp")
    recent = tables.read_alerts(spark, path, since)
    assert recent.count() == 2
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(alert_date" in plan


def test_a_report_written_again_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "reports")
    for report_id, n in (("a", 1), ("b", 2), ("a", 3)):
        files.write_report(spark.range(n).select(F.lit(n).alias("n")), path, report_id)
    schema = spark.range(0).select(F.lit(0).alias("n")).schema
    assert sorted(r.n for r in files.read_report(spark, path, schema).collect()) == [2, 2, 3, 3, 3]


def test_alert_documents_do_not_grow_with_a_repeated_key(spark, tmp_path):
    alerts = spark.range(0, 900, 1, 3).select(F.lit(7).alias("sample_id"), F.lit(0.5).alias("confidence"))
    path = str(tmp_path / "documents")
    files.write_alert_documents(alerts, path, ["sample_id"], 100)
    sizes = spark.read.text(path).select(F.size(F.from_json("value", "array<map<string,string>>")).alias("n"))
    assert sizes.agg(F.sum("n")).first()[0] == 900 and sizes.agg(F.max("n")).first()[0] < 300


def test_alert_summary(spark):
    rows = [(i, f"2025-01-01 00:00:{i % 40:02d}" if i else None, "b" if i % 3 else None, 0.5) for i in range(60)]
    alerts = spark.createDataFrame(rows, "id int, t string, anomaly_type string, confidence double")
    alerts = alerts.withColumn("ts", F.col("t").cast("timestamp")).repartition(4)
    got = A.alert_summary(alerts, ["id"]).first()
    assert got.total_alerts == 60 and got.alert_types == {"b": 40, "Unknown": 20}
    newest = sorted((r for r in rows if r[1]), key=lambda r: (r[1], -r[0]), reverse=True)[:10]
    assert [a.id for a in got.latest_alerts] == [r[0] for r in newest]
    # Rows of parts merge to the rows of the whole.
    halves = [A.summary_rows(alerts.where(F.col("id") % 2 == k), ["id"]) for k in (0, 1)]
    merged = A.summary_document(A.merge_summary_rows(halves[0].unionByName(halves[1]))).first()
    assert merged == got
    empty = A.alert_summary(alerts.limit(0), ["id"]).first()
    assert (empty.total_alerts, empty.alert_types, empty.latest_alerts) == (0, {}, [])
    plan = A.summary_rows(alerts, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
