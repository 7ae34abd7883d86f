"""Random tables against straightforward Python."""

from __future__ import annotations

import math
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyguard.operators import accumulate as U
from tallyguard.operators import sampling as T
from tallyguard.operators.score import score, z_scores

from .test_scoring import MODEL

few = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
cell = st.one_of(
    st.none(),
    st.sampled_from([0.0, 1.0, -1.0, float("nan"), float("inf"), float("-inf")]),
    st.floats(-100, 100, allow_nan=False),
)


def voting(row, means, stds, limit):
    zs = []
    for x, m, s in zip(row, means, stds):
        if x is not None and math.isfinite(x) and s > 0:
            z = abs(x - m) / s
            if z > limit:
                zs.append(z)
    return zs


@pytest.mark.parametrize("k", [1, 8, 20, 70])
@few
@given(data=st.data())
def test_scoring_equals_a_loop(spark, k, data):
    means = data.draw(st.lists(st.floats(-10, 10), min_size=k, max_size=k))
    stds = data.draw(st.lists(st.sampled_from([0.0, 0.5, 1.0, 7.25]), min_size=k, max_size=k))
    rows = data.draw(st.lists(st.lists(cell, min_size=k, max_size=k), min_size=1, max_size=25))
    names = [f"f{i}" for i in range(k)]
    model = spark.createDataFrame([(names, means, stds, 1, 1.4)], MODEL)
    schema = "id int, " + ", ".join(f"{n} double" for n in names)
    table = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], schema)
    got = score(table, model, names).orderBy("id").collect()
    for row, out in zip(rows, got):
        zs = voting(row, means, stds, 1.4)
        assert out.prediction == int(len(zs) > 0.10 * k)
        want = min(sum(zs) / (len(zs) * 5), 1.0) if zs else 0.0
        assert out.confidence == pytest.approx(want, rel=1e-12)
    shown = z_scores(table, model, names).orderBy("id").first()
    for i, (x, m, s) in enumerate(zip(rows[0], means, stds)):
        usable = x is not None and math.isfinite(x) and s > 0
        assert shown[f"z_f{i}"] == (pytest.approx(abs(x - m) / s) if usable else None)


@few
@given(
    rows=st.lists(st.tuples(st.integers(0, 5), st.sampled_from(["Normal", "Generic", "DoS", None])), max_size=60),
    size=st.integers(1, 40),
)
def test_sampling_copies_keeps_quotas_and_never_invents_rows(spark, rows, size):
    table = spark.createDataFrame([(k, c, int(c == "Generic")) for k, c in rows], "k int, category string, label int")
    keyed = T.with_copy_number(table)
    assert keyed.count() == len(rows)
    test = T.fixed_test_set(keyed, ["k", "category", "label", "copy_no"], size)
    got = test.collect()
    targets = sum(c == "Generic" for _, c in rows)
    normals = sum(c in (None, "Normal") for _, c in rows)
    take = min(int(size * 0.2), targets)
    assert sum(r.label == 1 for r in got) == take
    assert sum(r.label == 0 for r in got) == min(size - take, normals)
    assert not Counter((r.k, r.category) for r in got) - Counter(rows)


@few
@given(
    rows=st.lists(st.tuples(st.integers(0, 4), st.sampled_from([None, "a", "b"])), max_size=40),
    test=st.lists(st.tuples(st.integers(0, 4), st.sampled_from([None, "a", "b"])), max_size=6),
)
def test_train_minus_test_equals_a_filter(spark, rows, test):
    schema = "k int, v string"
    table, held = spark.createDataFrame(rows, schema), spark.createDataFrame(test, schema)
    want = Counter(r for r in rows if r not in set(test))
    for bound in (len(test), None):
        got = T.train_minus_test(table, held, bound).collect()
        assert Counter((r.k, r.v) for r in got) == want


@few
@given(parts=st.lists(st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["x", "y", None])), max_size=15), min_size=1, max_size=4))
def test_accumulated_rows_are_the_distinct_rows(spark, parts):
    frames = [spark.createDataFrame(p, "k int, v string") for p in parts]
    got = Counter((r.k, r.v) for r in U.accumulate_distinct(frames).collect())
    assert got == Counter({row for p in parts for row in p})
    bag = Counter((r.k, r.v) for r in U.union_snapshots(frames).collect())
    assert bag == Counter(row for p in parts for row in p)


def test_digest_order_is_uniform(spark):
    buckets = spark.range(40_000).groupBy(F.substring(T.key_hash(1, "id"), 1, 1).alias("b")).count()
    counts = [r["count"] for r in buckets.collect()]
    assert len(counts) == 16 and max(counts) < 1.1 * 2500 and min(counts) > 0.9 * 2500
