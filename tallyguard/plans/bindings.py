"""The driver tables as flow tables, logs, history and snapshots.

EV    events as flows: four numeric features, 'view' is normal,
      error/purchase/signup are targets, 'click' is another category
LI    lineitem as flows: 'N' is normal, 'R' the target; rows have no key
LOG   events as JSON log lines, one kind of line per event type
HIST  events scored and evaluated per day, one cycle per day
SNAP  orders as a growing table, captured at three dates; the last capture
      is the whole table
DOC   documents with labels
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import bucket
from ..operators.baseline import fit_baseline
from ..operators.history import cycle_history
from ..operators.score import score, score_alerts
from ..schema import history_schema
from ..session import join_path, work_folder
from ..sources import tables

EV_FEATURES = ("x1", "x2", "x3", "x4")
EV_TARGETS = {"error": "error", "purchase": "purchase", "signup": "signup"}
EV_KINDS = {"normal": "view", "targets": ("error", "purchase", "signup")}

LI_FEATURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
LI_COLUMNS = ("l_orderkey", "l_linenumber", *LI_FEATURES, "l_returnflag", "l_linestatus")
LI_KINDS = {"normal": "N", "targets": ("R",), "category": "l_returnflag"}

SNAP_DATES = ("1998-01-01", "2000-01-01", "2100-01-01")
SNAP_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")

SLICE_DATES = ("2024-01-11", "2024-01-21", "2100-01-01")
MODEL_TIMES = ("2024-02-01 00:00:00", "2024-02-02 00:00:00", "2024-02-03 00:00:00")


# Schemas are stated, so that opening a table runs no job.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(join_path(sf, f"{name}.parquet"))


# EV -------------------------------------------------------------------------


def as_flows(events: DataFrame) -> DataFrame:
    """Events, batch or stream, as a flow table."""
    return events.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_type").alias("category"),
        F.col("value").alias("x1"),
        F.get_json_object("props", "$.k").cast("double").alias("x2"),
        F.hour(F.col("ts").cast("timestamp")).cast("double").alias("x3"),
        F.col("user_id").cast("double").alias("x4"),
        (F.col("event_type") != "view").cast("int").alias("label"),
    )


def ev(spark: SparkSession, sf: str) -> DataFrame:
    return as_flows(table(spark, sf, "events"))


def ev_with_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Some clicks have no category."""
    missing = (F.col("category") == "click") & (F.col("x2") >= 50.0)
    return ev(spark, sf).withColumn("category", F.when(~missing, F.col("category")))


def ev_normal() -> Column:
    """On the category, which is a source column, so that Parquet skips the rest."""
    return F.col("category") == "view"


def with_x5(flows: DataFrame) -> DataFrame:
    return flows.withColumn("x5", bucket(F.col("category")).cast("double"))


def ev_model(spark: SparkSession, sf: str) -> DataFrame:
    return fit_baseline(ev(spark, sf), EV_FEATURES, ev_normal())


def ev_scored(spark: SparkSession, sf: str) -> DataFrame:
    return score(ev(spark, sf), ev_model(spark, sf), EV_FEATURES)


def ev_alerts(spark: SparkSession, sf: str) -> DataFrame:
    return score_alerts(ev(spark, sf), ev_model(spark, sf), EV_FEATURES, ["event_id"], ts="ts")


def newest_time(df: DataFrame, ts: str = "ts") -> Column:
    """The largest time as a literal, the ``as_of`` of reproducible reports."""
    return F.lit(df.agg(F.max(ts)).first()[0])


def events_stream(spark: SparkSession, sf: str) -> DataFrame:
    return (
        spark.readStream.schema(SCHEMAS["events"])
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf)
    )


# LI -------------------------------------------------------------------------


def li(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        *LI_COLUMNS, (F.col("l_returnflag") != "N").cast("int").alias("label")
    )


def li_normal() -> Column:
    return F.col("l_returnflag") == "N"


def li_model(spark: SparkSession, sf: str) -> DataFrame:
    return fit_baseline(li(spark, sf), LI_FEATURES, li_normal())


# LOG ------------------------------------------------------------------------


def as_log_lines(flows: DataFrame) -> DataFrame:
    """One JSON line per event; which keys it has depends on the event type."""
    kind = F.col("category")

    def only(name: str, value: Column) -> Column:
        return F.when(kind == name, value)

    share = F.col("x2") / F.lit(100.0)
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    degraded = (kind == "signup") & (F.col("x1") > 50.0)
    level = (
        F.when(kind == "error", "ERROR")
        .when(kind == "view", F.when(F.col("x2") >= 90.0, "ERROR").otherwise("WARN"))
        .when(kind != "click", "INFO")
    )
    message = F.concat(kind, F.lit(" "), F.col("event_id").cast("string"))
    entry = F.struct(
        F.when(kind != "view", iso).alias("timestamp"),
        level.alias("level"),
        F.when(kind.isin("purchase", "error", "click"), message).alias("message"),
        only("purchase", F.col("x1") / F.lit(100.0)).alias("anomaly_score"),
        only("purchase", share).alias("confidence"),
        only("purchase", (share >= 0.5).cast("int")).alias("prediction"),
        only("signup", share).alias("accuracy"),
        only("signup", share / 2).alias("precision"),
        only("signup", share / 4).alias("recall"),
        only("signup", F.col("x4")).alias("training_samples"),
        F.when(degraded, F.lit(0.85)).alias("previous_accuracy"),
        F.when(degraded, F.col("x1")).alias("degradation_percent"),
        only("error", F.concat(F.lit("c"), F.col("x4").cast("int").cast("string"))).alias("component"),
        only("error", F.concat(F.lit("E"), F.col("x2").cast("int").cast("string"))).alias("error_code"),
    )
    return flows.select("event_id", F.to_json(entry).alias("value"))


def log_lines(spark: SparkSession, sf: str) -> DataFrame:
    return as_log_lines(ev(spark, sf))


# HIST -----------------------------------------------------------------------


def with_cycle(flows: DataFrame) -> DataFrame:
    return flows.withColumn("cycle", F.datediff("ts", F.lit("2024-01-01").cast("date")))


def history(spark: SparkSession, sf: str) -> DataFrame:
    scored = with_cycle(ev_scored(spark, sf))
    return cycle_history(scored, "cycle", EV_TARGETS, "ts")


def stored_history(spark: SparkSession, sf: str) -> DataFrame:
    """The history as a tracker finds it: stored, so that what reads it twice scores nothing again."""
    folder = work_folder(spark, "history")
    history(spark, sf).coalesce(1).write.parquet(folder)  # a row for each cycle
    return tables.read_history(spark, folder, history_schema(EV_TARGETS))


# SNAP -----------------------------------------------------------------------


def orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(*SNAP_COLUMNS, "o_orderdate")


def snapshot_list(spark: SparkSession, sf: str) -> list[DataFrame]:
    rows = orders(spark, sf)
    return [
        rows.where(F.col("o_orderdate") < F.lit(date).cast("timestamp")).drop("o_orderdate")
        for date in SNAP_DATES
    ]


def snapshot_table(spark: SparkSession, sf: str) -> DataFrame:
    """The three captures as stored: written once, read back with their ids."""
    folder = work_folder(spark, "snapshots")
    for number, rows in enumerate(snapshot_list(spark, sf)):
        tables.capture_snapshot(rows, folder, number)
    return tables.read_table(spark, folder)


# DOC ------------------------------------------------------------------------


def doc(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "documents")
        .select("doc_id", "source", "lang")
        .join(table(spark, sf, "labels"), "doc_id")
        .select(
            "doc_id",
            "lang",
            F.col("source").alias("category"),
            "quality",
            F.col("toxic").alias("label"),
        )
    )
