"""Near-duplicate documents by consistent weighted sampling.

A document is the multiset of its five-word shingles (lower-cased A-Z, words
between ASCII white space).  Shingles are sampled by improved consistent
weighted sampling, once with weight tf * idf and once with tf alone.  Three samples
make a band, fifteen bands of each kind a signature; documents that share a band
are candidates, and a candidate pair is a link if the weighted Jaccard similarity
of the two multisets is 0.8 or more.  There the weights are the term frequencies
alone: a link should not be lost because a group is large and its shingles
therefore common.  The bands of tf sample just that similarity, so a pair at 0.8
shares none of them in (1 - 0.8^3)^15 = 0.002 % of cases, whatever the idf.

Document frequencies are kept in a table of ``COUNTERS`` hashed counters, whose
size does not depend on the corpus; it is the only thing that is broadcast
without a check.  A shingle that is rarer than about one document in ten
thousand gets the idf of its counter, at every corpus size.

Equal texts are one node from the start.  In every band the most popular node (the
one whose bands hold most members: a text that many others were made from) is
compared with all others and components of the links are formed, so most of a
large group is found by comparisons in proportion to its size.  Then all pairs of
a band are compared, each in the first band that it shares, but for those that
need not be: pairs in one component already, and pairs whose distances to a pivot
differ by more than two similar texts may (1 - weighted Jaccard similarity is a
metric).  So the classes are those of all candidate pairs.

Defined cases: a document without a word (null, empty, white space) is a group
of its own; a text of fewer than five words is one shingle; a class is named by
its smallest doc_id, and null ids count as the largest; rows that repeat a doc_id
with other texts are nodes of their own and appear with the class of each; ties
take the smallest id; an empty table gives an empty result; only the named
columns are read, and extra columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyguard.session import bounded_broadcast

from .tables import Steps, components
from .words import LOWER, Prefix, U, mix, shingles, slices, small_batches, text_bytes, word_spans

WIDTH = 5
SIMILARITY = 0.8
BANDS, ROWS = 15, 3  # bands of each kind of weight
COUNTERS = 1 << 22
CHUNK = 1 << 16
# Counts of BINS bins in unary: plane t holds a bit for each bin that counts more than t.
BINS, PLANES = 256, 8
WORDS = BINS * PLANES // 64
_KEEP = U((1 << 44) - 1)
# Pivots of a band that all its members are compared with before any pair of others is.
PIVOTS = 2


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, 44-bit shingle hash and term frequency, sorted by row and hash."""
    data, offsets = text_bytes(column)
    data = LOWER[data]
    starts, ends, bounds = word_spans(data, offsets)
    hashes, row = shingles(Prefix(data).of(starts, ends), bounds, WIDTH)
    key = np.sort((row.astype(U) << U(44)) | (hashes >> U(20)))
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(new)
    tf = np.diff(np.append(at, len(key)))
    key = key[at]
    return (key >> U(44)).astype(np.int64), key & _KEEP, tf


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One table of counters for a partition, in chunks."""
    counts = None
    for batch in batches:
        for part in slices(batch, "text"):
            if counts is None:
                counts = np.zeros(COUNTERS, U)
            _, hashes, _ = features(part.column("text"))
            np.add.at(counts, (hashes % U(COUNTERS)).astype(np.int64), U(1))
    if counts is not None:
        yield from _chunks(counts)


def _chunks(counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    for i in range(0, COUNTERS, CHUNK):
        # Byte planes: the high ones are nearly all zero and compress away.
        planes = np.ascontiguousarray(counts[i : i + CHUNK].view(np.uint8).reshape(-1, 8).T).tobytes()
        yield pa.RecordBatch.from_pydict(
            {"chunk": [i // CHUNK], "counts": [planes]}, schema=pa.schema([("chunk", pa.int32()), ("counts", pa.binary())])
        )


def _counts_of(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, -1).T).view(U).ravel()


def _sum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, planes in zip(batch.column(0).to_pylist(), batch.column(1)):
            counts = _counts_of(planes.as_buffer())
            total[chunk] = total[chunk] + counts if chunk in total else counts.copy()
    for chunk, counts in total.items():
        planes = np.ascontiguousarray(counts.view(np.uint8).reshape(-1, 8).T).tobytes()
        yield pa.RecordBatch.from_pydict(
            {"chunk": [chunk], "counts": [planes]}, schema=pa.schema([("chunk", pa.int32()), ("counts", pa.binary())])
        )


def document_frequencies(texts: DataFrame) -> np.ndarray:
    """Number of documents by hashed counter; its size is fixed, so the driver can hold it."""
    schema = "chunk int, counts binary"
    partial = texts.select("text").mapInArrow(_count, schema)
    summed = partial.repartition(COUNTERS // CHUNK, "chunk").mapInArrow(_sum, schema)
    out = np.zeros(COUNTERS, U)
    for row in summed.collect():
        out[row["chunk"] * CHUNK : (row["chunk"] + 1) * CHUNK] = _counts_of(bytes(row["counts"]))
    return out


@lru_cache(maxsize=1)
def _gamma() -> tuple[np.ndarray, np.ndarray]:
    """Quantiles of the gamma distribution of shape 2 for 16-bit uniforms, and their logarithms."""
    u = (np.arange(1 << 16) + 0.5) / (1 << 16)
    low, high = np.zeros_like(u), np.full_like(u, 40.0)
    for _ in range(60):
        x = (low + high) / 2
        below = 1 - (1 + x) * np.exp(-x) < u
        low, high = np.where(below, x, low), np.where(below, high, x)
    return low.astype(np.float32), np.log(low).astype(np.float32)


def signatures(row: np.ndarray, hashes: np.ndarray, idf: np.ndarray, tf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows that have features and the band keys of each: ``BANDS`` by tf * idf, then ``BANDS`` by tf.

    Sample k of a document is the pair (shingle, t) with the least ln a, where
    t = floor(ln w / r + b) and ln a = ln c - r (t - b) - r, with r and c from a
    gamma distribution and b uniform, all three drawn by hashing the shingle.
    Both weights are sampled by the same draws.  For a weight of 1, that of most
    shingles by tf, t is 0 and ln a is ln c - r (1 - b).
    """
    if not len(row):
        return row, np.zeros((0, BANDS * 2), np.int64)
    quantile, log_quantile = _gamma()
    starts = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
    place = np.cumsum(np.append(True, row[1:] != row[:-1])) - 1
    log_weight = np.log(tf * idf).astype(np.float32)
    many = np.flatnonzero(tf > 1)
    log_many = np.log(tf[many]).astype(np.float32)
    bands = np.zeros((len(starts), BANDS * 2), U)
    t_of_tf = np.zeros(len(row), np.float32)

    def least(log_a: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(log_a == np.minimum.reduceat(log_a, starts)[place])
        if len(at) > len(starts):  # of ties the smallest hash
            at = at[np.append(True, place[at][1:] != place[at][:-1])]
        return at

    for k in range(BANDS * ROWS):
        drawn = mix(hashes + U(k + 1) * U(0xA0761D6478BD642F))
        r = quantile[(drawn >> U(48)).astype(np.int32)]
        b = (drawn >> U(16)).astype(np.uint16).astype(np.float32) * np.float32(1 / 65536)
        by_tf = log_quantile[(drawn >> U(32)).astype(np.uint16)]
        by_tf -= r * (1 - b)
        t = np.floor(log_weight / r + b)
        by_both = by_tf - r * t
        if len(many):
            t_of_tf[many] = np.floor(log_many / r[many] + b[many])
            by_tf[many] -= r[many] * t_of_tf[many]
        for i, (log_a, index) in enumerate(((by_both, t), (by_tf, t_of_tf))):
            at = least(log_a)
            sample = mix(hashes[at] ^ (index[at].astype(np.int64).astype(U) << U(44)))
            band = i * BANDS + k // ROWS
            bands[:, band] = mix(bands[:, band] ^ (sample + U(band + 1)))
    return row[starts], bands.view(np.int64)


SIGNED = "doc_id bigint, fp string, size bigint, rest bigint, planes array<bigint>, bands array<bigint>"


def signed(texts: DataFrame, frequencies: np.ndarray, n_docs: int) -> DataFrame:
    """doc_id, fp (digest of the text), size (sum of tf), rest, planes and bands.

    ``planes`` are the term frequencies summed by some bits of the shingle, in
    unary, and ``rest`` is what goes beyond ``PLANES`` in all bins; ``bands`` are
    NULL without a word.
    """
    idf = np.log1p(n_docs / np.maximum(frequencies, 1).astype(np.float64)).astype(np.float32)
    shared = texts.sparkSession.sparkContext.broadcast(idf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                row, hashes, tf = features(part.column("text"))
                rows, bands = signatures(row, hashes, shared.value[(hashes % U(COUNTERS)).astype(np.int64)], tf)
                held = np.zeros(part.num_rows, np.int64)
                held[rows] = bands.shape[1]
                offsets = np.append(0, np.cumsum(held)).astype(np.int32)
                lists = pa.ListArray.from_arrays(offsets, bands.ravel(), mask=pa.array(held == 0))
                size = pa.array(np.bincount(row, tf, part.num_rows).astype(np.int64))
                counts = np.bincount(row * BINS + (hashes & U(BINS - 1)).astype(np.int64), tf, part.num_rows * BINS)
                counts = counts.reshape(-1, BINS)
                rest = np.maximum(counts - PLANES, 0).sum(axis=1).astype(np.int64)
                planes = np.concatenate([np.packbits(counts > t, axis=1) for t in range(PLANES)], axis=1).view(np.int64)
                offsets = np.arange(part.num_rows + 1, dtype=np.int32) * WORDS
                planes = pa.ListArray.from_arrays(offsets, planes.ravel())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("fp"), size, pa.array(rest), planes, lists],
                    ["doc_id", "fp", "size", "rest", "planes", "bands"],
                )

    return texts.select("doc_id", "fp", "text").mapInArrow(run, SIGNED)


def similarities(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Weighted Jaccard similarity of the texts in each row; 0 if neither has a word."""
    keys, weights = [], []
    for column in (a, b):
        row, hashes, tf = features(column)
        keys.append((row.astype(U) << U(44)) | hashes)
        weights.append(tf)
    total = sum(np.bincount((k >> U(44)).astype(np.int64), w, len(a)) for k, w in zip(keys, weights))
    _, at, bt = np.intersect1d(keys[0], keys[1], assume_unique=True, return_indices=True)
    both = np.bincount((keys[0][at] >> U(44)).astype(np.int64), np.minimum(weights[0][at], weights[1][bt]), len(a))
    return both / np.maximum(total - both, 1)


def _similarities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            found = similarities(part.column("text"), part.column("text_b"))
            yield pa.RecordBatch.from_arrays(
                [part.column("u"), part.column("v"), pa.array(found), pa.array(found)], ["u", "v", "least", "most"]
            )


MEASURED = "u bigint, v bigint, least double, most double"


def _side(rows: DataFrame, side: str) -> DataFrame:
    """``rows`` with names that end in ``side``."""
    return rows.select(*[F.col(c).alias(f"{c}_{side}") for c in rows.columns])


def _most() -> Column:
    """An upper bound of the similarity: what two texts share is at most the sum of the lesser counts.

    That of two counts in unary is the number of bits that both have.
    """
    both = F.zip_with("planes_u", "planes_v", lambda a, b: F.bit_count(a.bitwiseAND(b)).cast("long"))
    shared = F.aggregate(both, F.least("rest_u", "rest_v"), lambda t, n: t + n)
    return shared / (F.col("size_u") + F.col("size_v") - shared)


MAY_BE = SIMILARITY - 1e-9


def bounded(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs of nodes with bounds of their similarity, from their counts alone."""
    counted = nodes.select("node", "size", "rest", "planes")
    x, y = (_side(counted, side).withColumnRenamed(f"node_{side}", side) for side in "uv")
    return pairs.join(x, "u").join(y, "v").select("u", "v", F.lit(0.0).alias("least"), _most().alias("most"))


def measured(steps: Steps, texts: DataFrame, nodes: DataFrame, bounds: DataFrame, rows: int | None = None) -> DataFrame:
    """u, v and bounds of the similarity of each pair; they are equal wherever it may reach ``SIMILARITY``.

    Only the texts of those pairs are fetched.  ``rows`` is the most that
    ``bounds`` may hold, if known.
    """
    bounds = steps.write(bounds, rows)
    n = bounds.count()
    may_be = F.col("most") >= MAY_BE
    pairs = bounds.where(may_be).select("u", "v")
    ids = pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct()
    wanted = steps.write(nodes.select("node", "fp", F.col("name").alias("doc_id")).join(ids, "node"), 2 * n)
    n_wanted = wanted.count()
    same = texts["fp"].eqNullSafe(wanted["fp"]) & texts["doc_id"].eqNullSafe(wanted["doc_id"])
    found = texts.join(bounded_broadcast(wanted, n_wanted), same).select("node", "text")
    # A row may be repeated; its text is one all the same.
    needed = steps.write(found.groupBy("node").agg(F.first("text").alias("text")), n_wanted, 2_000)
    a = needed.select(F.col("node").alias("u"), "text")
    b = needed.select(F.col("node").alias("v"), F.col("text").alias("text_b"))
    rows = pairs.join(b, "v").join(a, "u").select("u", "v", "text", "text_b")
    return steps.write(rows.mapInArrow(_similarities, MEASURED)).unionByName(bounds.where(~may_be))


def _sizes_allow(a: str, b: str) -> Column:
    """A pair whose sizes differ by more cannot reach the similarity."""
    return F.least(a, b) >= F.greatest(a, b) * F.lit(SIMILARITY)


def _with_roots(rows: DataFrame, roots: DataFrame | None) -> DataFrame:
    """Rows with the component of their node, in bands that hold several components."""
    if roots is not None:
        rows = rows.drop("root").join(roots.withColumnRenamed("id", "node"), "node", "left")
        rows = rows.withColumn("root", F.coalesce("root", "node"))
    mixed = rows.groupBy("band").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a < b")
    return rows.join(mixed.select("band"), "band")


def _with_distance(rows: DataFrame, pivot: DataFrame, found: DataFrame, step: int) -> DataFrame:
    """Bounds of the distance (1 - similarity) of every member to the pivot of its band, as ``low``, ``high`` and the step."""
    low, high = f"low{step}", f"high{step}"
    rows = rows.join(pivot, "band").withColumns({"u": F.least("node", "p.node"), "v": F.greatest("node", "p.node")})
    sizes = F.least("size", "p.size") / F.greatest("size", "p.size")
    apart = F.col("root") != F.col("p.root")
    return rows.join(found, ["u", "v"], "left").select(
        *[c for c in rows.columns if c not in ("u", "v", "p")],
        F.coalesce(1 - F.col("most"), F.when(apart, 1 - sizes), F.lit(0.0)).alias(low),
        F.coalesce(1 - F.col("least"), F.lit(1.0)).alias(high),
    )


def _near_by_pivots(steps: int) -> Column:
    """False for pairs that the triangle inequality shows to be too far apart; the distance is a metric."""
    limit = 1 - SIMILARITY + 1e-9
    near = F.lit(True)
    for k in range(steps):
        near = near & (F.col(f"low{k}_u") - F.col(f"high{k}_v") <= limit) & (F.col(f"low{k}_v") - F.col(f"high{k}_u") <= limit)
    return near


def node_components(steps: Steps, texts: DataFrame, nodes: DataFrame) -> DataFrame | None:
    """id, root of every node that has a link; None without any."""
    member = nodes.select("node", "size", F.explode(F.array_distinct("bands")).alias("band"))
    shared = member.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # A node has at most 2 * BANDS bands, so its shared ones and their sum fit in one row.
    shared = member.join(shared, "band").groupBy("node", "size").agg(F.collect_list("band").alias("bands"), F.sum("n").alias("popular"))
    rows = shared.select(F.explode("bands").alias("band"), "node", "size", "popular", F.col("node").alias("root"))
    rows = steps.write(rows, nodes.count() * 2 * BANDS)
    links, roots, tried = None, None, None

    def linked(found: DataFrame) -> None:
        nonlocal links, roots
        more = found.where(F.col("least") >= SIMILARITY).select("u", "v")
        if not more.isEmpty():
            links = more if links is None else links.unionByName(more)
            roots = components(steps, links)

    done = 0
    while done < PIVOTS and not rows.isEmpty():
        order = F.struct(F.col("popular"), (-F.col("node")).alias("node"))
        pivot = rows.groupBy("band").agg(F.max_by(F.struct("node", "root", "size"), order).alias("p"))
        n = rows.count()
        pivot = steps.write(pivot, n)
        beside = rows.join(pivot, "band").where("node <> p.node").where("root <> p.root")
        pairs = beside.where(_sizes_allow("size", "p.size")).select(
            F.least("node", "p.node").alias("u"), F.greatest("node", "p.node").alias("v")
        )
        pairs = pairs.distinct() if tried is None else pairs.distinct().join(tried, ["u", "v"], "left_anti")
        found = measured(steps, texts, nodes, bounded(nodes, pairs), n)
        linked(found)
        rows = _with_distance(rows, pivot, found, done)
        rows = rows.join(pivot.select("band", F.col("p.node").alias("node")), ["band", "node"], "left_anti")
        rows = steps.write(_with_roots(rows, roots), n)
        compared = found.select("u", "v")
        tried = compared if tried is None else tried.unionByName(compared)
        done += 1
    rows = steps.write(rows.join(nodes.select("node", "bands", "rest", "planes"), "node"), rows.count(), 2_000)
    x, y = (_side(rows.drop("popular"), side).withColumnRenamed(f"band_{side}", "band") for side in "uv")
    # A pair comes from the first band that it shares, and from no other.
    first = F.get(F.array_intersect("bands_u", "bands_v"), F.lit(0)) == F.col("band")
    pairs = x.join(y, "band").where("node_u < node_v AND root_u <> root_v").where(_sizes_allow("size_u", "size_v"))
    # The dearest test comes last.
    pairs = pairs.where(_near_by_pivots(done)).where(first).where(_most() >= MAY_BE)
    pairs = pairs.select(F.col("node_u").alias("u"), F.col("node_v").alias("v"))
    if tried is not None:
        pairs = pairs.join(tried, ["u", "v"], "left_anti")
    linked(measured(steps, texts, nodes, pairs.select("u", "v", F.lit(0.0).alias("least"), F.lit(1.0).alias("most"))))
    return roots


def classified(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """A row for each of ``docs``: doc_id, fp (digest of the text), blank, class_id, and the node that the class keeps.

    ``keep_id`` and ``keep_fp`` are doc_id and digest of the first text of the class.
    """
    small_batches(spark)
    steps = Steps(spark, "near-duplicates")
    text = F.col("text").cast("string")
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.md5(F.coalesce(text, F.lit(""))).alias("fp")
    )
    n = texts.count()
    table = steps.write(signed(texts, document_frequencies(texts), n))
    nodes = table.where("bands IS NOT NULL").groupBy("fp").agg(
        F.min("doc_id").alias("name"), *[F.first(c).alias(c) for c in ("size", "rest", "planes", "bands")]
    )
    # Written at once, so that the numbers stay what they are.
    nodes = steps.write(nodes.withColumn("node", F.monotonically_increasing_id()), n, 5_000)
    roots = node_components(steps, texts, nodes)
    named = nodes.select("node", "fp", "name")
    if roots is None:
        named = named.withColumn("root", F.col("node"))
    else:
        named = named.join(roots.withColumnRenamed("id", "node"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = steps.write(named, n)
    first = F.min_by(F.struct("name", "fp"), F.struct(F.col("name").isNull(), F.col("name"), F.col("fp"))).alias("keep")
    classes = named.join(named.groupBy("root").agg(first), "root").select(
        "fp", F.col("keep.name").alias("keep_id"), F.col("keep.fp").alias("keep_fp")
    )
    found = table.select("doc_id", "fp", F.col("bands").isNull().alias("blank")).join(classes, "fp", "left")
    return found.withColumn("class_id", F.when(F.col("blank"), F.col("doc_id")).otherwise(F.col("keep_id")))


def duplicate_classes(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, class_id for each row of ``docs``."""
    return classified(spark, docs).select("doc_id", "class_id")


def one_of_each(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each class, and every row without a word.

    A row is known by its doc_id and its text together, both null-safe, so no
    text goes because of another one with the same id.
    """
    steps = Steps(spark, "one-of-each")
    rows = steps.write(classified(spark, docs).where("NOT blank"))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("fp") == F.col("keep_fp"))
    pairs = rows.groupBy("doc_id", "fp").agg(F.first(kept).alias("kept"), F.count(F.lit(1)).alias("n"))
    odd = steps.write(pairs.where("NOT kept OR n > 1").select(F.col("doc_id").alias("id"), F.col("fp").alias("digest"), "kept"))
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("fp"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("fp") == F.col("digest"))
    out = packed.join(bounded_broadcast(odd, odd.count()), same, "left_anti").select("row.*")
    again = odd.where("kept")
    if again.isEmpty():
        return out
    again = packed.join(bounded_broadcast(again, again.count()), same, "left_semi")
    return out.unionByName(again.groupBy("doc_id", "fp").agg(F.first("row").alias("row")).select("row.*"))


def query(spark: SparkSession, sf: str) -> DataFrame:
    return duplicate_classes(spark, spark.read.parquet(f"{sf}/documents.parquet"))
