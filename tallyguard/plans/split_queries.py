"""Queries over snapshots, training data and test sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import accumulate as U
from ..operators import encode as E
from ..operators import profile as P
from ..operators import quality as Q
from ..operators import sampling as T
from ..session import join_path, work_folder
from ..sources import tables
from . import bindings as D
from .registry import query
from .sql import DOC, EV, EV_GAPS, LI, SNAP, label_test_set, r, test_set

EV_TARGETS = ("error", "purchase", "signup")
DOC_SIZE = 100
SNAP_ROWS = f"o_orderkey, o_custkey, o_orderstatus, {r('o_totalprice')} AS o_totalprice, o_orderpriority"

# Snapshots ------------------------------------------------------------------


@query("snapshot_capture", f"WITH {SNAP} SELECT snapshot_id, o_orderkey FROM snap")
def snapshot_capture(spark, sf):
    return D.snapshot_table(spark, sf).select("snapshot_id", "o_orderkey")


@query("accumulate_distinct", f"WITH {SNAP} SELECT DISTINCT {SNAP_ROWS} FROM snap")
def accumulate_distinct(spark, sf):
    return U.accumulate_distinct(D.snapshot_list(spark, sf))


@query(
    "accumulate_distinct_table",
    f"WITH {SNAP} SELECT o_orderstatus, o_orderpriority, count(DISTINCT o_orderkey) AS n FROM snap GROUP BY ALL",
)
def accumulate_distinct_table(spark, sf):
    """The same over the stored snapshot table: one scan instead of a union."""
    distinct = U.accumulate_distinct(D.snapshot_table(spark, sf))
    return distinct.groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))


def _original(spark, sf):
    """Orders as the original training data, with stray spaces in the headers."""
    rows = D.orders(spark, sf).select("o_orderkey", "o_orderstatus", "o_totalprice")
    return rows.withColumn("o_comment", F.lit("original")).withColumnsRenamed(
        {"o_orderkey": "o_order key", "o_totalprice": " o_totalprice"}
    )


COMBINED = f"""{SNAP}, original AS (SELECT o_orderkey, o_orderstatus, o_totalprice, 'original' AS o_comment FROM orders),
  combined AS (SELECT * FROM original UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice, '' FROM snap)"""


@query(
    "combine_training",
    f"""WITH {COMBINED} SELECT o_orderkey, o_orderstatus, {r('o_totalprice')} AS o_totalprice, o_comment FROM combined""",
)
def combine_training(spark, sf):
    return U.combine_training(_original(spark, sf), D.snapshot_table(spark, sf), 50)


@query(
    "combine_training_distinct",
    f"""WITH {COMBINED} SELECT DISTINCT o_orderkey, o_orderstatus, {r('o_totalprice')} AS o_totalprice, o_comment FROM combined""",
)
def combine_training_distinct(spark, sf):
    return U.combine_training(_original(spark, sf), D.snapshot_table(spark, sf), 50, dedup=True)


@query("combine_snapshots_fallback", f"WITH {SNAP} SELECT {SNAP_ROWS} FROM snap")
def combine_snapshots_fallback(spark, sf):
    """The distinct rows are one too few, so the plain union of snapshots is used."""
    accumulated = U.accumulate_distinct(D.snapshot_list(spark, sf))
    needed = D.orders(spark, sf).count() + 1
    return U.combine_snapshots_fallback(accumulated, D.snapshot_table(spark, sf), needed)


@query(
    "accumulation_gate",
    f"WITH {SNAP} SELECT count(*) AS rows, 50 AS minimum, count(*) >= 50 AS ready FROM snap",
)
def accumulation_gate(spark, sf):
    return U.accumulation_gate(D.snapshot_table(spark, sf))


@query(
    "training_mix",
    f"""WITH {SNAP}, c AS (SELECT 'original' AS origin, count(*) AS n FROM orders
  UNION ALL SELECT 'accumulated', count(*) FROM snap)
  SELECT origin, n, {r('100.0 * n / (SELECT sum(n) FROM c)')} AS percent FROM c""",
)
def training_mix(spark, sf):
    return U.training_mix(D.orders(spark, sf), D.snapshot_table(spark, sf))


# Test sets ------------------------------------------------------------------


@query(
    "fixed_test_set",
    f"WITH {EV_GAPS}, {test_set('test', 'gaps', 'event_id', 500, 'view', EV_TARGETS)} SELECT event_id, category, label FROM test",
)
def fixed_test_set(spark, sf):
    test = T.fixed_test_set(D.ev_with_gaps(spark, sf), ["event_id"], **D.EV_KINDS)
    return test.select("event_id", "category", "label")


DOC_TEST = f"{DOC}, {label_test_set('test', 'doc', 'doc_id', DOC_SIZE)}"


def _doc_test(spark, sf, seed: int = T.SEED):
    return T.synthetic_test_set(D.doc(spark, sf), ["doc_id"], DOC_SIZE, seed)


DOC_KINDS = {"normal": "src0", "targets": ("src1", "src2")}


@query(
    "fixed_test_set_documents",
    f"""WITH {DOC}, {test_set('test', 'doc', 'doc_id', DOC_SIZE, *DOC_KINDS.values())}
  SELECT doc_id, category, CAST(CASE WHEN is_target THEN 1 ELSE label END AS INTEGER) AS label FROM test""",
)
def fixed_test_set_documents(spark, sf):
    """Documents by source: one is normal, two are targets, the others stay out."""
    test = T.fixed_test_set(D.doc(spark, sf), ["doc_id"], DOC_SIZE, **DOC_KINDS)
    return test.select("doc_id", "category", "label")


@query("synthetic_test_set_documents", f"WITH {DOC_TEST} SELECT doc_id, category, label FROM test")
def synthetic_test_set_documents(spark, sf):
    return _doc_test(spark, sf).select("doc_id", "category", "label")


@query(
    "synthetic_test_set",
    f"WITH {EV}, {label_test_set('test', 'ev', 'event_id', 500)} SELECT event_id, category, label FROM test",
)
def synthetic_test_set(spark, sf):
    test = T.synthetic_test_set(D.ev(spark, sf), ["event_id"])
    return test.select("event_id", "category", "label")


@query(
    "test_set_with_fallback",
    f"""WITH {EV}, {DOC}, {test_set('test', 'ev', 'event_id', 500, 'view', EV_TARGETS)}
  SELECT event_id, category, label, false AS is_synthetic FROM test""",
)
def test_set_with_fallback(spark, sf):
    """More labelled documents are asked for than there are, so events serve."""
    documents = D.doc(spark, sf).withColumnRenamed("doc_id", "event_id")
    needed = documents.count() + 1
    test, is_synthetic = T.choose_test_set(
        documents, D.ev(spark, sf), ["event_id"], min_rows=needed, **D.EV_KINDS
    )
    return test.select("event_id", "category", "label", F.lit(is_synthetic).alias("is_synthetic"))


@query(
    "training_split",
    f"""WITH {EV}, {test_set('test', 'ev', 'event_id', 500, 'view', EV_TARGETS)}
  SELECT event_id, category, label FROM ev WHERE event_id NOT IN (SELECT event_id FROM test)""",
)
def training_split(spark, sf):
    train = T.training_split(D.ev(spark, sf), ["event_id"], **D.EV_KINDS)
    return train.select("event_id", "category", "label")


@query(
    "create_once",
    f"WITH {DOC_TEST} SELECT doc_id, category, label FROM test",
)
def create_once(spark, sf):
    """The second call would draw other rows but finds the stored set."""
    folder = work_folder(spark, "test-set")
    tables.create_once(spark, folder, lambda: (_doc_test(spark, sf), True))
    stored = tables.create_once(spark, folder, lambda: (_doc_test(spark, sf, seed=1), True))
    return stored.select("doc_id", "category", "label")


@query(
    "testset_versions",
    f"""WITH {DOC}, {label_test_set('a', 'doc', 'doc_id', DOC_SIZE, 42)}, {label_test_set('b', 'doc', 'doc_id', DOC_SIZE, 43)}
  SELECT 1 AS version, doc_id, label FROM a UNION ALL SELECT 2, doc_id, label FROM b
  UNION ALL SELECT 3, doc_id, label FROM a UNION ALL SELECT 5, doc_id, label FROM b""",
)
def testset_versions(spark, sf):
    """A set, a second one, the first one restored, and, after a reset (number 4), the second one built again."""
    folder = work_folder(spark, "test-sets")
    tables.add_test_set(_doc_test(spark, sf, 42), folder)
    tables.add_test_set(_doc_test(spark, sf, 43), folder)
    tables.restore_test_set(spark, folder)
    tables.recreate_test_set(spark, folder, lambda: (_doc_test(spark, sf, 43), True))
    return tables.read_table(spark, folder).select("version", "doc_id", "label")


# Training data without test rows --------------------------------------------


@query(
    "train_minus_test",
    f"""WITH {EV}, {test_set('test', 'ev', 'event_id', 500, 'view', EV_TARGETS)}
  SELECT event_id, {r('x1')} AS x1, category, label FROM ev WHERE event_id NOT IN (SELECT event_id FROM test)""",
)
def train_minus_test(spark, sf):
    flows = D.ev(spark, sf)
    test = T.fixed_test_set(flows, ["event_id"], **D.EV_KINDS)
    return T.train_minus_test(flows, test, T.TEST_SIZE).select("event_id", "x1", "category", "label")


@query(
    "train_minus_test_documents",
    f"WITH {DOC_TEST} SELECT doc_id, category, label FROM doc WHERE doc_id NOT IN (SELECT doc_id FROM test)",
)
def train_minus_test_documents(spark, sf):
    train = T.train_minus_test(D.doc(spark, sf), _doc_test(spark, sf), DOC_SIZE)
    return train.select("doc_id", "category", "label")


LI_COLUMNS = (
    "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "label",
)
LI_COPIES = f"""{LI}, copies AS (SELECT *, row_number() OVER (PARTITION BY {', '.join(LI_COLUMNS)}) AS copy_no FROM li),
  {test_set('test', 'copies', ', '.join(LI_COLUMNS) + ', copy_no', 1000, 'N', ('R',), category='l_returnflag')}"""


def _li_test(spark, sf):
    """Line items have no key: content and copy number together make one."""
    keyed = T.with_copy_number(D.li(spark, sf))
    key = [*LI_COLUMNS, "copy_no"]
    return T.fixed_test_set(keyed, key, 1000, **D.LI_KINDS)


@query(
    "fixed_test_set_lineitem",
    f"WITH {LI_COPIES} SELECT l_orderkey, l_linenumber, l_returnflag, label, copy_no FROM test",
)
def fixed_test_set_lineitem(spark, sf):
    return _li_test(spark, sf).select(
        "l_orderkey", "l_linenumber", "l_returnflag", "label", "copy_no"
    )


FINGERPRINT = """concat_ws('_', CAST(l_quantity AS VARCHAR), CAST(l_extendedprice AS VARCHAR), CAST(l_discount AS VARCHAR))"""


@query(
    "exclude_by_fingerprint",
    f"""WITH {LI_COPIES}, ids AS (SELECT DISTINCT {FINGERPRINT} AS id FROM test)
  SELECT l_orderkey, l_linenumber, l_returnflag, label FROM li WHERE {FINGERPRINT} NOT IN (SELECT id FROM ids)""",
)
def exclude_by_fingerprint(spark, sf):
    cells = ("l_quantity", "l_extendedprice", "l_discount")

    def printed(df):
        return df.withColumn("fingerprint", E.row_fingerprint(*[F.col(c) for c in cells]))

    kept = T.exclude_by_fingerprint(
        printed(D.li(spark, sf)), printed(_li_test(spark, sf)), "fingerprint", 1000
    )
    return kept.select("l_orderkey", "l_linenumber", "l_returnflag", "label")


@query(
    "exclude_by_bitmap",
    f"""WITH {LI_COPIES}, ids AS (SELECT DISTINCT {FINGERPRINT} AS id FROM test)
  SELECT l_orderkey, l_linenumber, l_returnflag, label FROM li WHERE {FINGERPRINT} NOT IN (SELECT id FROM ids)""",
)
def exclude_by_bitmap(spark, sf):
    """The same for a test set of unknown size: only rows that its bitmap marks are shuffled."""
    cells = ("l_quantity", "l_extendedprice", "l_discount")

    def printed(df):
        return df.withColumn("fingerprint", E.row_fingerprint(*[F.col(c) for c in cells]))

    kept = T.exclude_by_fingerprint(printed(D.li(spark, sf)), printed(_li_test(spark, sf)), "fingerprint")
    return kept.select("l_orderkey", "l_linenumber", "l_returnflag", "label")


@query(
    "leakage_check",
    f"""WITH {DOC_TEST}, train AS (SELECT * FROM doc EXCEPT ALL SELECT doc_id, lang, category, quality, label FROM test),
  c AS (SELECT (SELECT count(*) FROM doc) AS total_rows, (SELECT count(*) FROM train) AS train_rows,
    (SELECT count(*) FROM test) AS test_rows, (SELECT count(*) FROM train SEMI JOIN test USING (doc_id)) AS overlap)
  SELECT *, total_rows = train_rows + test_rows AS adds_up, overlap = 0 AS leak_free FROM c""",
)
def leakage_check(spark, sf):
    """Checks a split as it is stored."""
    folder = work_folder(spark, "split")
    rows = D.doc(spark, sf)
    tables.add_test_set(_doc_test(spark, sf), join_path(folder, "test"))
    test = tables.read_test_set(spark, join_path(folder, "test")).select(*rows.columns)
    T.train_minus_test(rows, test, DOC_SIZE).write.parquet(join_path(folder, "train"))
    train = spark.read.parquet(join_path(folder, "train")).select(*rows.columns)
    return T.leakage_check(rows, train, test, DOC_SIZE)


@query(
    "dataset_composition_documents",
    f"""WITH {DOC}, n AS (SELECT count(*) AS all_rows FROM doc)
  SELECT 'label' AS part, CAST(label AS VARCHAR) AS value, count(*) AS n, {r('100.0 * count(*) / any_value(all_rows)')} AS percent FROM doc, n GROUP BY label
  UNION ALL SELECT 'category', category, count(*), {r('100.0 * count(*) / any_value(all_rows)')} FROM doc, n GROUP BY category
  UNION ALL SELECT 'total', NULL, count(*), {r('100.0')} FROM doc""",
)
def dataset_composition_documents(spark, sf):
    return P.dataset_composition(D.doc(spark, sf))


@query(
    "check_test_set",
    f"""WITH {EV}, {test_set('test', 'ev', 'event_id', 500, 'view', EV_TARGETS)},
  c AS (SELECT count(*) AS n, count_if(label = 0) AS a, count_if(label = 1) AS b FROM test)
  SELECT 'size' AS check_name, n = 500 AS passed, CAST(n AS VARCHAR) AS detail FROM c UNION ALL
  SELECT 'normal_percent', 100.0 * a / n BETWEEN 60 AND 85, printf('%.3f', 100::DOUBLE * a / n) FROM c UNION ALL
  SELECT 'anomaly_percent', 100.0 * b / n BETWEEN 15 AND 40, printf('%.3f', 100::DOUBLE * b / n) FROM c UNION ALL
  SELECT 'categories', true, '' FROM c""",
)
def check_test_set(spark, sf):
    test = T.fixed_test_set(D.ev(spark, sf), ["event_id"], **D.EV_KINDS)
    return Q.check_test_set(test, T.TEST_SIZE, ("view", *EV_TARGETS))
