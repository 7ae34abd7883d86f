"""Benchmark decontamination by spaced seeds, in built-in expressions only.

Texts are lower-cased and cut into words of ASCII letters and digits and
non-ASCII characters, so case and punctuation do not matter.  A fixed mask picks
some of the words of a window; the hash of the picked words is joined between
benchmark and documents, so a changed word at an ignored place does not hide a
hit.  Around each hit the item is laid beside the document without gaps: equal
words are marked, and the best stretch is scored, +1 for an equal word and -1 for
a substituted one.  Places of one item that are shifted by a few words only (a
word was dropped or put in between) are taken together.  A document is
contaminated by an item if a stretch scores ``LEAST``, or if 80 % of the item's
words are equal.

``MASKS`` leave no pattern of substituted words in a stretch of 14 to 22 words
that scores ``LEAST`` without a hit, and ``SHORT_MASKS`` none in an item of 5 to 13
words of which 80 % are equal; the tests enumerate them.

Defined cases: null or empty texts have no words and no hits; an item of fewer
than ``SHORTEST`` words, which any text may hold by chance, is looked for as a
whole and contaminates only a document that consists of it; a document is known
by its doc_id and its text together, so rows that repeat both count once and no
clean text goes because of its id; empty tables give an empty result; only the
named columns are read.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyguard.session import bounded_broadcast

from .tables import Steps

# Words at a 1 are hashed, words at a 0 may differ.
MASKS = ("110111", "11010011", "111101", "1011101")
# For items of fewer than LONG words, which allow one or two substitutions.
SHORT_MASKS = ("1111", "10111", "11011", "11101")
LONG = 14
LEAST = 10
SHARE = 0.8
SHORTEST = 5
# Places of one item that are no further apart are taken together.
NEAR = 3
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def word_hashes(text: Column) -> Column:
    """Array of word hashes of a text, empty for null."""
    plain = F.lower(F.coalesce(text.cast("string"), F.lit("")))
    found = F.filter(F.split(plain, BREAKS), lambda w: w != "")
    return F.transform(found, lambda w: F.xxhash64(w))


def _seed(words: Column, at: Column, mask: str) -> Column:
    """Hash of the words that a mask picks at a place; NULL where the mask does not fit."""
    picked = [F.get(words, at + i) for i, bit in enumerate(mask) if bit == "1"]
    return F.when(at + len(mask) <= F.size(words), F.xxhash64(F.lit(mask), *picked))


def _seeds(df: DataFrame, keys: list[str], masks: list[str]) -> DataFrame:
    """A row for each place and mask that fits there: ``keys``, at, seed."""
    least = min(map(len, masks), default=1)
    places = df.where(F.size("words") >= least).select(
        *keys, "words", F.explode(F.sequence(F.lit(0), F.size("words") - least)).alias("at")
    )
    seeds = F.array(*[_seed(F.col("words"), F.col("at"), mask) for mask in masks]).cast("array<bigint>")
    return places.select(*keys, "at", F.explode(seeds).alias("seed")).where("seed IS NOT NULL")


def benchmark_items(steps: Steps, benchmark: DataFrame) -> DataFrame:
    """item_id, words and their number of every item with a word."""
    items = benchmark.select("item_id", word_hashes(F.col("text")).alias("words"))
    return steps.write(items.withColumn("n_item", F.size("words")).where("n_item > 0"))


def _masks_of(items: DataFrame) -> dict[str, tuple[str, ...]]:
    """Condition on the items, and the masks that these are looked for with; none for lengths that do not occur."""
    kinds = {
        f"n_item >= {LONG}": MASKS,
        f"n_item >= {SHORTEST} AND n_item < {LONG}": SHORT_MASKS,
        **{f"n_item = {n}": ("1" * n,) for n in range(1, SHORTEST)},
    }
    there = items.agg(*[F.count_if(F.expr(kind)).alias(kind) for kind in kinds]).first()
    return {kind: masks for kind, masks in kinds.items() if there[kind]}


def _best_stretch(a: Column, b: Column, shift: Column) -> Column:
    """Score, end and equal words of the best stretch of ``b`` laid on ``a`` at ``shift``."""
    low = F.greatest(F.lit(0), -shift)
    high = F.least(F.size(b), F.size(a) - shift) - 1
    start = F.struct(
        F.lit(0).alias("run"), F.lit(0).alias("same"), F.lit(0).alias("best"),
        F.lit(0).alias("equal"), F.lit(-1).alias("end"),
    )

    def step(s: Column, i: Column) -> Column:
        match = F.get(a, shift + i) == F.get(b, i)
        run = F.greatest(F.lit(0), s["run"] + F.when(match, 1).otherwise(-1))
        same = F.when(run == 0, 0).otherwise(s["same"] + match.cast("int"))
        better = run > s["best"]
        return F.struct(
            run.alias("run"), same.alias("same"), F.when(better, run).otherwise(s["best"]).alias("best"),
            F.when(better, same).otherwise(s["equal"]).alias("equal"),
            F.when(better, i).otherwise(s["end"]).alias("end"),
        )

    return F.aggregate(F.sequence(low, high), start, step)


def _equal_words(a: Column, b: Column, shift: Column) -> Column:
    """Places in ``b`` whose word is the same in ``a`` when ``b`` is laid on it at ``shift``."""
    low, high = F.greatest(F.lit(0), -shift), F.least(F.size(b), F.size(a) - shift) - 1
    return F.filter(F.sequence(low, high), lambda i: F.get(a, shift + i) == F.get(b, i))


KEYS = ["doc_id", "fp"]


def _documents(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select("doc_id", F.md5(text).alias("fp"), word_hashes(F.col("text")).alias("words"))


def _beside(left: DataFrame, right: DataFrame, keys: list[str], rows: int, how: str = "inner") -> DataFrame:
    """Join on ``keys``, null-safe; the right side is broadcast only if its counted rows are few."""
    side = right.withColumnsRenamed({k: f"right_{k}" for k in keys})
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"right_{k}")) for k in keys])
    joined = left.join(bounded_broadcast(side, rows), same, how)
    return joined.drop(*[f"right_{k}" for k in keys])


def find_overlaps(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, fp, item_id, score, n_equal, doc_end, n_item, n_doc: the best place of each item in each document.

    ``n_equal`` counts the words of the item that are equal there, ``doc_end`` is
    the word of the document behind its best stretch.  Seeds and hits are written
    and counted, and broadcast only while they are few; beyond that the joins
    shuffle, on seeds and on documents.
    """
    steps = Steps(spark, "decontaminate")
    items = benchmark_items(steps, benchmark)
    kinds = _masks_of(items)
    seeds = [_seeds(items.where(kind), ["item_id"], list(masks)) for kind, masks in kinds.items()]
    if not seeds:
        seeds = [_seeds(items, ["item_id"], ["1"])]
    seeds = steps.write(reduce(DataFrame.unionByName, seeds).withColumnsRenamed({"at": "item_at", "seed": "item_seed"}))
    masks = [mask for found in kinds.values() for mask in found] or ["1"]
    words = _documents(docs)
    places = _seeds(words, KEYS, masks)
    hits = places.join(bounded_broadcast(seeds, seeds.count()), F.col("seed") == F.col("item_seed"))
    hits = steps.write(hits.select(*KEYS, "item_id", (F.col("at") - F.col("item_at")).alias("shift")).distinct())

    n = hits.count()
    hit_docs = steps.write(hits.select(*KEYS).distinct())
    # Rows that repeat id and text are one document.
    found = _beside(words, hit_docs, KEYS, hit_docs.count(), "left_semi").dropDuplicates(KEYS)
    laid = _beside(found, hits, KEYS, n)
    laid = _beside(laid, items.withColumnRenamed("words", "item_words"), ["item_id"], items.count())
    a, b, shift = F.col("words"), F.col("item_words"), F.col("shift")
    laid = laid.select(
        *KEYS, "item_id", "shift", "n_item", F.size(a).alias("n_doc"),
        _best_stretch(a, b, shift).alias("x"), _equal_words(a, b, shift).alias("equal"),
    )
    laid = steps.write(laid)
    # Neighbouring places: a new run begins where the shift moves on by more than NEAR.
    of_item = Window.partitionBy(*KEYS, "item_id").orderBy("shift")
    far = F.coalesce(F.col("shift") - F.lag("shift").over(of_item) > NEAR, F.lit(True))
    runs = laid.withColumn("far", far.cast("int")).withColumn("run", F.sum("far").over(of_item))
    top = F.max(F.struct(F.col("x.best").alias("score"), (F.col("shift") + F.col("x.end") + 1).alias("doc_end"))).alias("top")
    judged = runs.groupBy(*KEYS, "item_id", "n_item", "n_doc", "run").agg(
        top, F.size(F.array_distinct(F.flatten(F.collect_list("equal")))).alias("n_equal")
    )
    enough = (F.col("top.score") >= LEAST) | (F.col("n_equal") >= F.ceil(F.col("n_item") * F.lit(SHARE)))
    whole = (F.col("n_item") >= SHORTEST) | (F.col("n_equal") == F.col("n_item"))
    best = F.max(F.struct("top.score", "n_equal", "top.doc_end")).alias("b")
    return (
        judged.where(enough & whole).groupBy(*KEYS, "item_id", "n_item", "n_doc").agg(best)
        .select(*KEYS, "item_id", "b.score", "b.n_equal", "b.doc_end", "n_item", "n_doc")
    )


def contaminations(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The overlaps that make a document unfit: of long enough items, or of items that are the whole document."""
    return find_overlaps(spark, docs, benchmark).where(f"n_item >= {SHORTEST} OR n_item = n_doc")


def clean_documents(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that no benchmark item contaminates."""
    steps = Steps(spark, "clean")
    bad = steps.write(contaminations(spark, docs, benchmark).select(*KEYS).distinct())
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        "doc_id",
        F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("fp"),
    )
    return _beside(packed, bad, KEYS, bad.count(), "left_anti").select("row.*")


def query(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    found = contaminations(spark, docs, spark.read.parquet(f"{sf}/benchmark.parquet"))
    return found.select("doc_id", "item_id", "score", "n_equal", "doc_end")
