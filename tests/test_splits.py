import pytest
from pyspark.sql import functions as F

from tallyguard.operators import accumulate as U
from tallyguard.operators import sampling as T
from tallyguard.sources import tables


def flows(spark, normals, attacks, others=0):
    n = normals + attacks + others
    kind = F.when(F.col("id") < normals, "Normal").when(F.col("id") < normals + attacks, "Generic").otherwise("DoS")
    return spark.range(n).select(
        "id", kind.alias("category"), (F.col("id") >= normals).cast("int").alias("label")
    )


def composition(test):
    return tuple(test.agg(F.count_if(F.col("label") == 0), F.count_if(F.col("label") == 1)).first())


def test_quotas_with_enough_rows(spark):
    rows = flows(spark, 3000, 1000, 500)
    test = T.fixed_test_set(rows, ["id"])
    assert composition(test) == (400, 100)
    assert test.where(F.col("category") == "DoS").count() == 0


@pytest.mark.parametrize(
    "normals, attacks, size, fixed, synthetic",
    [
        (50, 50, 20, (16, 4), (16, 4)),
        (1000, 10, 500, (490, 10), (400, 10)),
        (100, 1000, 500, (100, 100), (100, 400)),
        (5, 3, 500, (5, 3), (5, 3)),
        (0, 30, 20, (0, 4), (0, 20)),
    ],
)
def test_quotas_with_few_rows(spark, normals, attacks, size, fixed, synthetic):
    rows = flows(spark, normals, attacks)
    assert composition(T.fixed_test_set(rows, ["id"], size)) == fixed
    assert composition(T.synthetic_test_set(rows, ["id"], size)) == synthetic


def test_empty_table_gives_empty_set(spark):
    assert T.fixed_test_set(flows(spark, 0, 0), ["id"]).count() == 0


def test_sample_equals_ranking_the_whole_table(spark):
    rows = flows(spark, 700, 300)
    hashed = rows.withColumn("h", T.key_hash(42, "id")).collect()
    want = set()
    for label, quota in ((0, 80), (1, 20)):
        ranked = sorted((r.h, r.id) for r in hashed if r.label == label)
        want |= {i for _, i in ranked[:quota]}
    assert {r.id for r in T.fixed_test_set(rows, ["id"], 100).collect()} == want


def test_sample_is_the_same_under_any_partitioning(spark):
    rows = flows(spark, 2000, 500)
    first = {r.id for r in T.fixed_test_set(rows.repartition(3), ["id"]).collect()}
    second = {r.id for r in T.fixed_test_set(rows.repartition(17, "label"), ["id"]).collect()}
    other_seed = {r.id for r in T.fixed_test_set(rows, ["id"], seed=1).collect()}
    assert first == second and first != other_seed


def test_sample_across_coarse_buckets(spark, monkeypatch):
    """With one hex digit many rows share the cut bucket."""
    rows = flows(spark, 900, 300)
    fine = {r.id for r in T.fixed_test_set(rows, ["id"], 123).collect()}
    monkeypatch.setattr(T, "HASH_DIGITS", 1)
    assert {r.id for r in T.fixed_test_set(rows, ["id"], 123).collect()} == fine


def test_copy_numbers_make_a_key(spark, monkeypatch):
    monkeypatch.setattr(T, "COPIES_PER_CHUNK", 7)
    rows = spark.createDataFrame([("hot", None)] * 100 + [("rare", 1)] * 2, "a string, b int")
    numbered = T.with_copy_number(rows)
    got = numbered.groupBy("a").agg(
        F.count("*").alias("n"), F.countDistinct("copy_no").alias("d"), F.max("copy_no").alias("m")
    )
    assert {r.a: (r.n, r.d, r.m) for r in got.collect()} == {"hot": (100, 100, 100), "rare": (2, 2, 2)}
    assert numbered.select("a", "b").exceptAll(rows).count() == 0


def test_sampling_copies_of_one_row(spark):
    """Half of the normals are copies of one row; each copy is its own row."""
    rows = flows(spark, 300, 100).withColumn(
        "id", F.when(F.col("id") < 150, F.lit(0)).otherwise(F.col("id"))
    )
    test = T.fixed_test_set(T.with_copy_number(rows), ["id", "category", "label", "copy_no"], 100)
    assert composition(test) == (80, 20)
    hot = test.where(F.col("id") == 0).count()
    assert 20 < hot < 60


def test_training_split_has_no_test_rows(spark):
    rows = flows(spark, 800, 200, 100)
    test = T.fixed_test_set(rows, ["id"], 100)
    train = T.training_split(rows, ["id"], 100)
    assert train.count() == 1000 and train.join(test, "id", "left_semi").count() == 0
    assert train.where(F.col("category") == "DoS").count() == 100


def test_train_minus_test_removes_all_copies_and_matches_nulls(spark):
    rows = spark.createDataFrame([(1, None)] * 3 + [(1, "a"), (2, None)], "k int, v string")
    test = spark.createDataFrame([(1, None)], "k int, v string")
    for bound in (1, None):
        left = T.train_minus_test(rows, test, bound)
        assert sorted(map(tuple, left.collect())) == [(1, "a"), (2, None)]


def test_exclude_by_fingerprint(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "p string, x int")
    test = spark.createDataFrame([("a", 9), ("a", 8)], "p string, x int")
    assert [r.x for r in T.exclude_by_fingerprint(rows, test, "p", 2).collect()] == [3]


def test_hot_row_in_a_shuffled_join_spreads_over_salts(spark):
    """A third of the rows are equal; no task of the join gets all of them."""
    rows = spark.range(0, 9000, 1, 32).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id")).alias("k"),
        F.lit("x").alias("v"),
    )
    test = spark.createDataFrame([(1, "x"), (1, "x"), (2, "x")], "k long, v string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = T.train_minus_test(rows, test)
        sizes = left.where("k IS NULL").groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in sizes) == 3000 and left.count() == 8998
        assert max(r["count"] for r in sizes) < 1500
        kept = T.exclude_by_fingerprint(rows, test, "k")
        assert kept.count() == 8998
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_leakage_check(spark):
    rows = flows(spark, 80, 20)
    test = T.synthetic_test_set(rows, ["id"], 10)
    good = T.leakage_check(rows, T.train_minus_test(rows, test), test).first()
    assert (good.total_rows, good.train_rows, good.test_rows, good.overlap) == (100, 90, 10, 0)
    assert good.adds_up and good.leak_free
    bad = T.leakage_check(rows, rows, test).first()
    assert bad.overlap == 10 and not bad.adds_up and not bad.leak_free


def test_fallback(spark):
    small, big = flows(spark, 50, 50), flows(spark, 400, 200)
    test, synthetic = T.choose_test_set(small, small, ["id"], size=20)
    assert not synthetic and composition(test) == (16, 4)
    assert T.choose_test_set(None, small, ["id"], size=20)[1] is False
    assert T.choose_test_set(big, small, ["id"], size=20)[1] is True


# Accumulation ---------------------------------------------------------------


def test_copies_collapse(spark, flow_sample):
    assert U.accumulate_distinct([flow_sample, flow_sample]).count() == 2
    assert U.accumulate_distinct([]) is None


def test_duplicates_within_and_across_snapshots(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x")], "k int, v string")
    b = spark.createDataFrame([("x", 1)], "v string, k int")
    assert [tuple(r) for r in U.accumulate_distinct([a, b]).collect()] == [(1, "x")]
    c = spark.createDataFrame([(2, "x"), (3, "y")], "k int, v string")
    assert U.accumulate_distinct([a, c]).count() == 3


def test_extra_columns_are_refused_or_dropped(spark):
    a = spark.createDataFrame([(1.0, "tcp", 0)], "dur double, proto string, label int")
    b = spark.createDataFrame([(1.0, "http", 0)], "dur double, service string, label int")
    with pytest.raises(U.SchemaMismatch, match="service"):
        U.accumulate_distinct([a, b])
    rows = {tuple(r) for r in U.union_snapshots([a, b], strict=False).collect()}
    assert rows == {(1.0, "tcp", 0), (1.0, "", 0)}


def test_combine_training(spark):
    original = spark.createDataFrame([(1, "o", 0.5)], "`i d` int, name string, x double")
    snaps = spark.createDataFrame([(2, 9, 7), (2, 9, 8)], "id int, extra int, snapshot_id int")
    combined = U.combine_training(original, snaps, 2)
    assert sorted(map(tuple, combined.collect()), key=str) == [(1, "o", 0.5), (2, "", None), (2, "", None)]
    assert U.combine_training(original, snaps, 2, dedup=True).count() == 2
    assert U.combine_training(original, snaps, 3) is None
    assert U.combine_training(original, None).columns == ["id", "name", "x"]


def test_gate_mix_and_fallback(spark):
    original, snaps = flows(spark, 5, 5), flows(spark, 20, 10)
    gate = U.accumulation_gate(snaps, 30).first()
    assert (gate.rows, gate.ready) == (30, True)
    assert not U.accumulation_gate(snaps, 31).first().ready
    mix = {r.origin: (r.n, r.percent) for r in U.training_mix(original, snaps).collect()}
    assert mix == {"original": (10, 25.0), "accumulated": (30, 75.0)}
    assert U.combine_snapshots_fallback(original, snaps, 10).count() == 10
    assert U.combine_snapshots_fallback(original, snaps, 11).count() == 30
    assert U.combine_snapshots_fallback(original, None, 11).count() == 10


# Stored test sets and snapshots ---------------------------------------------


def test_snapshots(spark, tmp_path):
    path = str(tmp_path / "snaps")
    assert not tables.capture_snapshot(flows(spark, 0, 0), path, 1)
    assert tables.read_table(spark, path) is None
    assert tables.capture_snapshot(flows(spark, 3, 2), path, 1)
    assert tables.capture_snapshot(flows(spark, 3, 2), path, 1)
    assert tables.capture_snapshot(flows(spark, 1, 0), path, 2)
    assert tables.read_table(spark, path).count() == 6


def test_test_set_versions(spark, tmp_path):
    path = str(tmp_path / "sets")
    assert tables.read_test_set(spark, path) is None
    assert tables.restore_test_set(spark, path) is None
    assert tables.add_test_set(flows(spark, 1, 0), path) == 1
    assert tables.add_test_set(flows(spark, 2, 0), path) == 2
    assert tables.read_test_set(spark, path).count() == 2
    assert tables.restore_test_set(spark, path) == 3
    assert tables.read_test_set(spark, path).count() == 1
    assert tables.read_test_set(spark, path, 2).count() == 2
    assert tables.read_test_set(spark, path, 9) is None


def test_create_once_stores_only_the_real_set(spark, tmp_path):
    path = str(tmp_path / "once")
    fallback = tables.create_once(spark, path, lambda: (flows(spark, 3, 0), False))
    assert fallback.count() == 3 and tables.read_test_set(spark, path) is None
    assert tables.create_once(spark, path, lambda: (flows(spark, 4, 0), True)).count() == 4
    assert tables.create_once(spark, path, lambda: (flows(spark, 9, 0), True)).count() == 4


def test_versions_of_two_writers_and_reset(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    path = str(tmp_path / "sets")
    with ThreadPoolExecutor(2) as pool:
        numbers = list(pool.map(lambda n: tables.add_test_set(spark.range(n), path), (3, 4)))
    assert sorted(numbers) == [1, 2] and tables.stored_versions(spark, path) == [1, 2]
    assert tables.read_test_set(spark, path, numbers[1]).count() == 4
    assert tables.reset_test_set(spark, path) == 3 and tables.reset_test_set(spark, path) is None
    assert tables.read_test_set(spark, path) is None and tables.read_test_set(spark, path, 1) is not None
    assert tables.create_once(spark, path, lambda: (spark.range(9), False)).count() == 9
    assert tables.create_once(spark, path, lambda: (spark.range(5), True)).count() == 5
    assert tables.newest_version(spark, path) == 4
    assert tables.create_once(spark, path, lambda: (spark.range(6), True)).count() == 5
    assert tables.restore_test_set(spark, path, numbers[0]) == 5 and tables.read_test_set(spark, path).count() == 3
    assert tables.recreate_test_set(spark, path, lambda: (spark.range(8), True)).count() == 8


def test_bitmap_keeps_unmarked_rows_in_place(spark):
    rows = spark.range(5000).select(F.when(F.col("id") < 4999, F.col("id").cast("string")).alias("k"), F.col("id").alias("v"))
    test = rows.where("v >= 40 AND v < 60")
    maybe, absent = T.split_by_bitmap(rows, T.id_bitmap(test.select("k")), "k")
    assert maybe.count() + absent.where("k IS NOT NULL").count() == 4999 and absent.where("k IS NULL").count() == 1
    assert test.join(absent, "k").count() == 0 and maybe.count() < 30
    kept = T.exclude_by_fingerprint(rows, test, "k")
    assert kept.count() == 4980 and kept.where("k IS NULL").count() == 1
    bits = T.id_bitmap(test.select("k")).first().bits
    assert len(bits) == T.BITMAP_WORDS and sum(b.bit_count() if b >= 0 else (b & (1 << 64) - 1).bit_count() for b in bits) == 20
    # The branch of unmarked rows has no exchange above the table.
    plan = absent._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("BroadcastExchange")]
    assert "Exchange hashpartitioning" not in above and "Exchange SinglePartition" not in above


def test_counted_rows_are_shuffled_once(spark, tmp_path):
    spark.range(3000).select((F.col("id") % 100).alias("a"), F.lit("N").alias("category"), F.lit(0).alias("label")).write.parquet(
        str(tmp_path / "rows")
    )
    rows = spark.read.parquet(str(tmp_path / "rows"))
    numbered = T.with_copy_number(rows)
    assert numbered.groupBy("a").agg(F.max("copy_no").alias("m")).where("m <> 30").isEmpty() and numbered.count() == 3000
    sampled = T.fixed_test_set(numbered, ["a", "category", "label", "copy_no"], 100, normal="N", targets=("R",))
    sampled.collect()
    plan = sampled._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # Shuffles keyed by the table's own columns: one, whichever branch reads it; the others reuse it.
    assert plan.count("ReusedExchange") >= 1
