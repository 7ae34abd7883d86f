import hashlib

import pytest
from pyspark.sql import functions as F

from tallyguard import functions as fn


def value(spark, col):
    return spark.range(1).select(col.alias("v")).first()["v"]


@pytest.mark.parametrize("text, expected", [("tcp", 282), ("-", 692), ("", 0), (None, None)])
def test_bucket_is_stable(spark, text, expected):
    assert value(spark, fn.bucket(F.lit(text).cast("string"))) == expected


def test_bucket_matches_md5_prefix(spark):
    words = ["udp", "http", "Ünïcode", "x" * 5000]
    df = spark.createDataFrame([(w,) for w in words], "w string").select("w", fn.bucket(F.col("w")).alias("b"))
    for row in df.collect():
        assert row.b == int(hashlib.md5(row.w.encode()).hexdigest()[:8], 16) % 1000


@pytest.mark.parametrize(
    "text, expected", [("1e3", 1000.0), (" 2 ", 2.0), ("tcp", None), ("", None), ("-", None)]
)
def test_try_number(spark, text, expected):
    assert value(spark, fn.try_number(F.lit(text))) == expected


@pytest.mark.parametrize("text", ["nan", "inf", "-inf"])
def test_finite_drops_nan_and_infinities(spark, text):
    assert value(spark, fn.finite(F.lit(float(text)))) is None
    assert value(spark, fn.finite(F.lit(-3.5))) == -3.5


def test_uniform_does_not_depend_on_partitions(spark):
    rows = spark.range(5000).select("id", fn.uniform(7, "id").alias("u"))
    one = rows.coalesce(1).agg(F.sum("u"), F.min("u"), F.max("u"), F.avg("u")).first()
    many = spark.range(5000).repartition(13).select(fn.uniform(7, "id").alias("u"))
    assert many.agg(F.min("u"), F.max("u")).first() == (one[1], one[2])
    assert 0 <= one[1] and one[2] < 1 and abs(one[3] - 0.5) < 0.02


def test_ratio_of_zero_denominator_is_zero(spark):
    assert value(spark, fn.ratio(F.lit(3), F.lit(0))) == 0.0
    assert value(spark, fn.ratio(F.lit(3), F.lit(4))) == 0.75
    assert value(spark, fn.capped_ratio(F.lit(9), F.lit(4))) == 1.0


def test_time_functions(spark):
    assert value(spark, fn.hour_of_iso(F.lit("2025-01-01T12:35:00"))) == 12
    assert value(spark, fn.hour_of_iso(F.lit("not a time"))) is None
    cut = fn.time_cutoff(F.lit("2025-01-01 00:30:00").cast("timestamp"), "1 hour")
    assert value(spark, F.date_format(cut, "yyyy-MM-dd HH:mm")) == "2024-12-31 23:30"


def test_text_functions(spark):
    assert value(spark, fn.percent_text(F.lit(0.235))) == "23.5%"
    assert fn.clean_name(" attack _cat") == "attack_cat"
    at = F.lit("2025-03-04 00:00:00").cast("timestamp")
    first = value(spark, fn.alert_id(at, F.lit("rule"), F.lit(1)))
    assert first.startswith("ALT_20250304_")
    assert first == value(spark, fn.alert_id(at, F.lit("rule"), F.lit(1)))
    assert first != value(spark, fn.alert_id(at, F.lit("rule"), F.lit(2)))
