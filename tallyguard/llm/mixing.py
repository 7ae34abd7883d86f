"""Mixing sources to target weights by nested hash thresholds.

A source's target is met by taking each document once or twice in whole rounds
and, in the last round, the documents whose hash lies under a threshold.  The
threshold is found without sorting documents: sizes are summed by source and
hash bucket, the bucket in which the running sum passes the budget is found,
and only that bucket is looked at again, with the next digits of the hash.
After ``LEVELS`` levels all 60 bits of the hash are fixed.  Thresholds are
nested: with a larger budget, the documents of a smaller one stay.

Defined cases: a null text has size 0 and takes nothing; a null source is a
source of its own, the last in order; rows that repeat a doc_id share one hash
and are taken or left together; an empty table gives an empty result; of the
input only the named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyguard.session import bounded_broadcast, join_path, work_folder

DIGITS = 3  # hexadecimal digits of a level: 4,096 buckets for each source
LEVELS = 5
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_REPEATS = 2.0


def hash_of(doc_id: str) -> Column:
    """15 hexadecimal digits; a null id counts as an empty one."""
    return F.substring(F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 1, DIGITS * LEVELS)


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size in words, and the hash as 15 hexadecimal digits."""
    return docs.select(
        "doc_id",
        "source",
        F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        hash_of("doc_id").alias("h"),
    )


def targets(
    sized: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most_repeats: float = MOST_REPEATS,
) -> DataFrame:
    """source, source_size, target: one row for each source.

    Sources by code point, null last, take the weights in turn.  Sharing the
    excess of full sources by weight until none is over comes to one common
    level: target = min(level * weight, most_repeats * size).  In order of
    size per weight the full sources come first, and the level is the first
    that leaves the next source under its limit.  The windows run over sources,
    not documents.
    """
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    limit = F.col("source_size") * F.lit(float(most_repeats))
    ranked = by_source.withColumn("weight", weight).withColumn("limit", limit)
    everything = Window.partitionBy()
    order = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranked.withColumns(
        {
            "total": F.sum("source_size").over(everything) * F.lit(float(share)),
            "full": F.coalesce(F.sum("limit").over(before), F.lit(0.0)),
            "open": F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing)),
        }
    )
    level = (F.col("total") - F.col("full")) / F.col("open")
    ranked = ranked.withColumn(
        "level", F.max(F.when(level * F.col("weight") <= F.col("limit"), level)).over(everything)
    )
    target = F.least(F.coalesce(F.col("level") * F.col("weight"), F.col("limit")), F.col("limit"))
    return ranked.select("source", "source_size", target.alias("target"))


def thresholds(sized: DataFrame, goals: DataFrame, n_sources: int) -> DataFrame:
    """source, source_size, target, rounds, cut: ``h < cut`` is taken once more.

    Of the two cuts beside the budget the nearer one is chosen.
    """
    rounds = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    kept = ("source_size", "target", "rounds")
    state = goals.withColumn("rounds", rounds.cast("int")).select(
        "source",
        *kept,
        (F.col("target") - F.col("rounds") * F.col("source_size")).alias("budget"),
        F.lit("").alias("prefix"),
    )
    for level in range(1, LEVELS + 1):
        s = state.withColumnsRenamed({c: f"s_{c}" for c in state.columns})
        inside = sized.join(
            bounded_broadcast(s, n_sources),
            F.col("source").eqNullSafe(F.col("s_source"))
            & (F.substring("h", 1, DIGITS * (level - 1)) == F.col("s_prefix")),
        )
        sums = inside.groupBy("source", F.substring("h", 1, DIGITS * level).alias("b")).agg(
            F.sum("size").alias("n"), *[F.first(f"s_{c}").alias(c) for c in (*kept, "budget")]
        )
        before = F.sum("n").over(Window.partitionBy("source").orderBy("b")) - F.col("n")
        # The last bucket whose start does not pass the budget.
        state = (
            sums.withColumn("before", before)
            .where(F.col("before") <= F.col("budget"))
            .groupBy("source")
            .agg(F.max(F.struct("b", "before", "n", "budget", *kept)).alias("x"))
            .select(
                "source",
                *[F.col(f"x.{c}").alias(c) for c in kept],
                (F.col("x.budget") - F.col("x.before")).alias("budget"),
                F.col("x.b").alias("prefix"),
                F.col("x.n").alias("n"),
            )
        ).select("source", *kept, "budget", "prefix", *(["n"] if level == LEVELS else []))
    nearer = F.col("n") - F.col("budget") < F.col("budget")
    cut = F.when(nearer, F.concat(F.col("prefix"), F.lit("~"))).otherwise(F.col("prefix"))
    return state.select("source", *kept, cut.alias("cut"))


def mixing_plan(spark: SparkSession, docs: DataFrame, **how) -> tuple[DataFrame, DataFrame]:
    """The sized documents and, for each source, its target, rounds and cut.

    Both are written to the shared work folder; the plan is broadcast to later
    joins only while its counted rows are few.
    """
    folder = work_folder(spark, "mix")

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(join_path(folder, name))
        return spark.read.parquet(join_path(folder, name))

    sized = written(sizes(docs), "sizes")
    goals = written(targets(sized, **how), "goals")
    n_sources = goals.count()
    plan = written(thresholds(sized, goals, n_sources), "plan")
    plan = plan.withColumnsRenamed({c: f"s_{c}" for c in plan.columns})
    return sized, bounded_broadcast(plan, n_sources)


def _same_source() -> Column:
    return F.col("source").eqNullSafe(F.col("s_source"))


def _times() -> Column:
    return F.col("s_rounds") + F.when(F.col("h") < F.col("s_cut"), 1).otherwise(0)


def mix(spark: SparkSession, docs: DataFrame, **how) -> DataFrame:
    """doc_id, source, size, source_size, target, taken for each row of ``docs``."""
    sized, plan = mixing_plan(spark, docs, **how)
    return sized.join(plan, _same_source()).select(
        "doc_id", "source", "size", F.col("s_source_size").alias("source_size"),
        F.col("s_target").alias("target"), (_times() * F.col("size")).cast("long").alias("taken"),
    )


def mixed_documents(spark: SparkSession, docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    _, plan = mixing_plan(spark, docs, **how)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(row.alias("row"), "source", hash_of("doc_id").alias("h")).join(plan, _same_source())
    rows = rows.select("row", _times().alias("times")).where("times > 0")
    rows = rows.select("row", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return rows.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def query(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source", "text")
    return mix(spark, docs).select("doc_id", "size", "source_size", "target", "taken")


ORACLE_SQL = r"""
WITH d AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
           substr(md5(CAST(doc_id AS VARCHAR)), 1, 15) AS h
    FROM documents
), s AS (
    SELECT source, sum(size) AS n, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
    FROM d GROUP BY source
), weighed AS (
    SELECT source, n, CASE place % 3 WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END AS w FROM s
), levels AS (
    SELECT source, n, w, (1.5 * sum(n) OVER () - coalesce(sum(2 * n) OVER (
               ORDER BY n / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
           / sum(w) OVER (ORDER BY n / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS l
    FROM weighed
), goals AS (
    SELECT source, n, least((SELECT max(l) FROM levels WHERE l * w <= 2 * n) * w, 2 * n) AS target FROM levels
), rounds AS (
    SELECT source, n, target, CASE WHEN n > 0 THEN floor(target / n) ELSE 0 END AS r FROM goals
), hashes AS (
    SELECT source, h, sum(size) AS n FROM d GROUP BY source, h
), running AS (
    SELECT source, h, n, sum(n) OVER (PARTITION BY source ORDER BY h ROWS UNBOUNDED PRECEDING) - n AS before
    FROM hashes
), cuts AS (
    SELECT x.source, max(x.h) AS h
    FROM running x JOIN rounds r ON x.source IS NOT DISTINCT FROM r.source
    WHERE x.before <= r.target - r.r * r.n GROUP BY x.source
), plan AS (
    SELECT r.source, r.n, r.target, r.r, c.h,
           x.n - (r.target - r.r * r.n - x.before) < r.target - r.r * r.n - x.before AS nearer
    FROM rounds r JOIN cuts c ON r.source IS NOT DISTINCT FROM c.source
    JOIN running x ON x.source IS NOT DISTINCT FROM c.source AND x.h = c.h
)
SELECT d.doc_id, CAST(d.size AS BIGINT) AS size, CAST(p.n AS BIGINT) AS source_size,
       CAST(p.target AS DOUBLE) AS target,
       CAST((p.r + CASE WHEN d.h < p.h OR (d.h = p.h AND p.nearer) THEN 1 ELSE 0 END) * d.size AS BIGINT) AS taken
FROM d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source
"""
