"""Seeded, stratified test sets of a fixed size, and training data without them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import key_hash
from ..session import BROADCAST_ROWS, bounded_broadcast, one_row
from .encode import NORMAL_CATEGORY, TARGET_CATEGORIES, relabel_targets, select_target_categories

# Fixed values.
TEST_SIZE = 500
MIN_SYNTHETIC_ROWS = 500
SEED = 42
TARGET_SHARE = 0.2
NORMAL_SHARE = 0.8

# Leading hex digits of the row digest that make a histogram bucket.  Each task
# sends at most 2 * 16**4 histogram rows, and the bucket that is ranked holds one
# row in 16**4: 1.5 million of 100 billion.
HASH_DIGITS = 4
COPIES_PER_CHUNK = 65_536
# Ways in which a hot row is spread when the other side is too big to broadcast.
SALTS = 16
# A bitmap of a megabyte: a value that is not among m ids is marked with m in 8.4 million.
BITMAP_WORDS = 1 << 17

Quotas = Callable[[Column, Column], tuple[Column, Column]]


def targets_first(size: int) -> Quotas:
    """Targets get a fifth of the set if there are enough, normals the rest."""

    def quotas(normals: Column, targets: Column) -> tuple[Column, Column]:
        take_targets = F.least(F.lit(int(size * TARGET_SHARE)), targets)
        return F.least(F.lit(size) - take_targets, normals), take_targets

    return quotas


def normals_first(size: int) -> Quotas:
    """Normals get four fifths if there are enough, targets fill up the rest."""

    def quotas(normals: Column, targets: Column) -> tuple[Column, Column]:
        take_normals = F.least(F.lit(int(size * NORMAL_SHARE)), normals)
        return take_normals, F.least(F.lit(size) - take_normals, targets)

    return quotas


def sample_two_strata(
    df: DataFrame, is_target: Column, quotas: Quotas, key: Sequence[str], seed: int = SEED
) -> DataFrame:
    """The rows with the smallest seeded digest in each stratum, up to its quota.

    The same rows come out under any partitioning.  No stratum is sorted as a
    whole: a histogram over digest prefixes (at most 16**4 rows per stratum)
    finds the bucket in which the quota is reached; rows of earlier buckets are
    taken unseen and only single buckets are ranked.  ``key`` has to be unique,
    see ``with_copy_number``.
    """
    hashed = df.withColumns({"__target": is_target, "__hash": key_hash(seed, *key)}).withColumn(
        "__bucket", F.substring("__hash", 1, HASH_DIGITS)
    )
    histogram = (
        hashed.where(F.col("__target").isNotNull())
        .groupBy("__target", "__bucket")
        .agg(F.count("*").alias("__n"))
    )
    normals = F.coalesce(F.sum(F.when(~F.col("__target"), F.col("__n"))), F.lit(0))
    targets = F.coalesce(F.sum(F.when(F.col("__target"), F.col("__n"))), F.lit(0))
    totals = histogram.agg(normals.alias("normals"), targets.alias("targets"))
    take_normals, take_targets = quotas(F.col("normals"), F.col("targets"))
    wanted = totals.select(
        F.inline(
            F.array(
                F.struct(F.lit(False).alias("__target"), take_normals.cast("bigint").alias("__quota")),
                F.struct(F.lit(True).alias("__target"), take_targets.cast("bigint").alias("__quota")),
            )
        )
    )
    upto = Window.partitionBy("__target").orderBy("__bucket")
    cuts = (
        histogram.withColumn("__upto", F.sum("__n").over(upto))
        .join(F.broadcast(wanted), "__target")
        .withColumn("__need", F.col("__quota") - F.col("__upto") + F.col("__n"))
        .where((F.col("__upto") >= F.col("__quota")) & (F.col("__need") > 0))
        .select("__target", F.col("__bucket").alias("__cut"), "__need")
    )
    in_bucket = Window.partitionBy("__target", "__bucket").orderBy("__hash", *key)
    # At most one cut per stratum, so this side has two rows.
    return (
        hashed.join(F.broadcast(cuts), "__target")
        .where(F.col("__bucket") <= F.col("__cut"))
        .withColumn("__rank", F.row_number().over(in_bucket))
        .where((F.col("__bucket") < F.col("__cut")) | (F.col("__rank") <= F.col("__need")))
        .drop("__target", "__hash", "__bucket", "__cut", "__need", "__rank")
    )


def with_copy_number(df: DataFrame, into: str = "copy_no") -> DataFrame:
    """Number the copies of equal rows, so that content and number make a key.

    Equal rows are interchangeable: they are counted, which collapses them before
    the only shuffle of the table, and their numbers are drawn where the count
    lies.  Just the rows with more than ``COPIES_PER_CHUNK`` copies, of which
    there are few, are dealt out again in chunks, so that a row with very many
    copies never sits in one task.
    """
    cols = df.columns
    counted = df.groupBy(*cols).agg(F.count("*").alias("__n"))
    numbers = F.sequence(F.lit(1).cast("bigint"), F.col("__n"))
    few = counted.where(F.col("__n") <= COPIES_PER_CHUNK).withColumn(into, F.explode(numbers)).drop("__n")
    last_chunk = F.floor((F.col("__n") - 1) / F.lit(COPIES_PER_CHUNK))
    chunks = (
        counted.where(F.col("__n") > COPIES_PER_CHUNK)
        .withColumn("__chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), last_chunk)))
        .repartition(F.xxhash64(*cols), F.col("__chunk"))
    )
    first = F.col("__chunk") * COPIES_PER_CHUNK
    numbers = F.sequence(first + 1, F.least(first + COPIES_PER_CHUNK, F.col("__n")))
    return few.unionByName(chunks.withColumn(into, F.explode(numbers)).drop("__n", "__chunk"))


def fixed_test_set(
    df: DataFrame,
    key: Sequence[str],
    size: int = TEST_SIZE,
    seed: int = SEED,
    label: str = "label",
    category: str = "category",
    normal: str = NORMAL_CATEGORY,
    targets: Sequence[str] = TARGET_CATEGORIES,
) -> DataFrame:
    """Test set of normal and target rows, one fifth targets where possible."""
    chosen = select_target_categories(df, label, category, normal, targets)
    sampled = sample_two_strata(
        chosen, F.col("stratum") == "target", targets_first(size), key, seed
    )
    return sampled.drop("stratum")


def synthetic_test_set(
    df: DataFrame,
    key: Sequence[str],
    size: int = TEST_SIZE,
    seed: int = SEED,
    label: str = "label",
) -> DataFrame:
    """Test set by label: normals first, anomalies fill up."""
    by_label = F.when(F.col(label) == 0, F.lit(False)).when(F.col(label) == 1, F.lit(True))
    return sample_two_strata(df, by_label, normals_first(size), key, seed)


def has_at_least(df: DataFrame, n: int) -> bool:
    """Whether ``df`` has ``n`` rows, counted on the cluster."""
    return df.count() >= n


def choose_test_set(
    synthetic: DataFrame | None,
    fallback: DataFrame,
    key: Sequence[str],
    size: int = TEST_SIZE,
    min_rows: int = MIN_SYNTHETIC_ROWS,
    seed: int = SEED,
    label: str = "label",
    category: str = "category",
    normal: str = NORMAL_CATEGORY,
    targets: Sequence[str] = TARGET_CATEGORIES,
) -> tuple[DataFrame, bool]:
    """Synthetic test set if there are enough rows, else one from ``fallback``."""
    if synthetic is not None and has_at_least(synthetic, min_rows):
        return synthetic_test_set(synthetic, key, size, seed, label), True
    return fixed_test_set(fallback, key, size, seed, label, category, normal, targets), False


def _salted_join(
    df: DataFrame, side: DataFrame, same: Column, how: str, max_rows: int | None
) -> DataFrame:
    """Semi or anti join with a side that is broadcast only if it is small.

    A bigger side is joined by shuffle: its distinct rows are repeated once per
    salt, and a row of ``df`` takes the salt of the task that read it, so the
    copies of a hot row spread over the salts.
    """
    small = bounded_broadcast(side, max_rows)
    if small is not side:
        return df.join(small, same, how)
    salts = F.array(*[F.lit(i) for i in range(SALTS)])
    salted = df.withColumn("__salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    repeated = side.distinct().withColumn("__side_salt", F.explode(salts))
    return salted.join(repeated, same & (F.col("__salt") == F.col("__side_salt")), how).drop("__salt")


def _match_rows(
    df: DataFrame, other: DataFrame, how: str, max_rows: int | None
) -> DataFrame:
    """Semi or anti join on the whole row content, NULL equal to NULL."""
    cols = df.columns
    side = other.select(*[F.col(c).alias(f"__t_{c}") for c in cols])
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"__t_{c}")) for c in cols])
    return _salted_join(df, side, same, how, max_rows)


def train_minus_test(
    df: DataFrame, test: DataFrame, max_test_rows: int | None = None
) -> DataFrame:
    """Rows whose whole content is not in the test set; all copies of a test row go.

    Give the size of the test set where it is known: if small it is broadcast
    and the large side is not shuffled.
    """
    return _match_rows(df, test, "left_anti", max_test_rows)


def rows_in_test(
    df: DataFrame, test: DataFrame, max_test_rows: int | None = None
) -> DataFrame:
    """The rows that ``train_minus_test`` leaves out."""
    return _match_rows(df, test, "left_semi", max_test_rows)


def training_split(
    df: DataFrame,
    key: Sequence[str],
    size: int = TEST_SIZE,
    seed: int = SEED,
    label: str = "label",
    category: str = "category",
    normal: str = NORMAL_CATEGORY,
    targets: Sequence[str] = TARGET_CATEGORIES,
) -> DataFrame:
    """What is left for training, target rows relabelled, other categories kept."""
    relabelled = relabel_targets(df, label, category, targets)
    test = fixed_test_set(relabelled, key, size, seed, label, category, normal, targets)
    return train_minus_test(relabelled, test, size)


def _bit_of(value: Column) -> tuple[Column, Column]:
    """Word and bit of a value in a bitmap of ``BITMAP_WORDS`` words of 64 bits."""
    place = F.pmod(F.xxhash64(value), F.lit(BITMAP_WORDS * 64))
    return F.floor(place / F.lit(64)).cast("int"), F.pmod(place, F.lit(64)).cast("int")


def id_bitmap(ids: DataFrame) -> DataFrame:
    """One row ``bits``: a bitmap of fixed size that marks the hash of every id (its only column).

    The ids are combined with OR word by word, so only marked words meet, and the
    row has the same size however many ids there are.
    """
    word, bit = _bit_of(F.col(ids.columns[0]))
    marked = ids.select(word.alias("word"), F.call_function("shiftleft", F.lit(1).cast("bigint"), bit).alias("bits"))
    empty = ids.sparkSession.range(BITMAP_WORDS).select(
        F.col("id").cast("int").alias("word"), F.lit(0).cast("bigint").alias("bits")
    )
    words = marked.groupBy("word").agg(F.bit_or("bits").alias("bits")).unionByName(empty)
    words = words.groupBy("word").agg(F.bit_or("bits").alias("bits"))
    ordered = F.sort_array(F.collect_list(F.struct("word", "bits")))
    return words.agg(F.transform(ordered, lambda w: w["bits"]).alias("bits"))


def split_by_bitmap(df: DataFrame, bitmap: DataFrame, col: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose value may be in the bitmap, and rows whose value is not; neither moves a row."""
    word, bit = _bit_of(F.col(col))
    side = one_row(bitmap.select(F.col("bits").alias("__bits")))
    marked = F.getbit(F.get("__bits", word), bit) == 1
    return df.join(side, marked, "left_semi"), df.join(side, marked, "left_anti")


def exclude_by_fingerprint(
    df: DataFrame, test: DataFrame, fingerprint: str, max_test_rows: int | None = None
) -> DataFrame:
    """Drop every row that shares its fingerprint with a test row.

    A test set of small known size is broadcast.  Else a bitmap of its
    fingerprints, which has a fixed size, is broadcast: rows it does not mark stay
    where they are, and only the others are shuffled to be compared.
    """
    ids = test.select(F.col(fingerprint).alias("__id"))
    same = F.col(fingerprint) == F.col("__id")
    if max_test_rows is not None and max_test_rows <= BROADCAST_ROWS:
        return _salted_join(df, ids, same, "left_anti", max_test_rows)
    maybe, absent = split_by_bitmap(df, id_bitmap(ids), fingerprint)
    return absent.unionByName(_salted_join(maybe, ids, same, "left_anti", None))


def leakage_check(
    total: DataFrame, train: DataFrame, test: DataFrame, max_test_rows: int | None = None
) -> DataFrame:
    """Row counts of a split, the overlap, and whether the split is sound."""
    overlap = rows_in_test(train, test, max_test_rows)

    def rows(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count("*").alias(name))

    return (
        rows(total, "total_rows")
        .crossJoin(one_row(rows(train, "train_rows")))
        .crossJoin(one_row(rows(test, "test_rows")))
        .crossJoin(one_row(rows(overlap, "overlap")))
        .withColumns(
            {
                "adds_up": F.col("total_rows") == F.col("train_rows") + F.col("test_rows"),
                "leak_free": F.col("overlap") == 0,
            }
        )
    )
