"""Centroid clustering of embeddings over dictionaries of distinct subvectors.

A component x becomes the whole number floor(1024 x).  A task gathers chunks of
vectors and encodes each chunk without loss: the dimensions are cut into blocks,
the distinct subvectors of a block form its dictionary, and a vector keeps one
code for each block.  Blocks start as single dimensions, and neighbours of equal
width are merged while the dictionary of both together costs less than the codes
that it saves, so scattered vectors get narrow blocks and copies wide ones.  The
encoded chunks are written once and read in every round.

In a round the distance of every distinct subvector to every centroid's part is
computed once, and a vector's distance is the sum of the entries at its codes.
The sums of a cluster come from the codes as well: entries are counted by cluster
and multiplied with the dictionary.  All of it is done in whole numbers (of any
size, where a long does not do), so the result depends on no order.  A task sends
one number for each cluster and dimension; the driver holds the centroids.

Defined cases: vectors that are null, have another length than ``dims`` or hold
a component that is null or not finite (also after the scaling) are dropped;
with fewer vectors than clusters each is a centroid; the start ignores no copies,
equal hashes are ordered by the vector; a null id hashes as an empty one; ties go
to the smaller cluster; empty clusters keep their centroid and have no row; an
empty table gives an empty result; a distance or sum that a long cannot hold is
NULL; only the two named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import Steps
from .vectors import PARTS, blocks, number_parts, number_sums

SCALE, DIMS, CLUSTERS, ROUNDS, SEED = 1024, 64, 8, 10, 3
# Vectors of a chunk; codes have 16 bits.
CHUNK = 1 << 14
# Below this size differences, squares and their sums over 2^7 dimensions fit a long.
NARROW = 1 << 27
LONG = 1 << 63


def encode(found: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Dictionaries (distinct subvectors in rows) and codes of the blocks of a chunk.

    A block of width w with m distinct subvectors costs w m to compare with a
    centroid and one lookup for each vector.
    """
    rows = len(found)
    words, codes = [], []
    for column in found.T:
        distinct, code = np.unique(column, return_inverse=True)
        words.append(distinct[:, None])
        codes.append(code.astype(np.int64))
    width, merged = 1, True
    while merged:
        merged, next_words, next_codes, i = False, [], [], 0
        while i < len(words):
            a, b = words[i], words[i + 1] if i + 1 < len(words) else None
            if b is not None and a.shape[1] == b.shape[1] == width:
                both, code = np.unique(codes[i] * len(b) + codes[i + 1], return_inverse=True)
                if len(both) * 2 * width < (len(a) + len(b)) * width + rows:
                    next_words.append(np.hstack([a[both // len(b)], b[both % len(b)]]))
                    next_codes.append(code.astype(np.int64))
                    i, merged = i + 2, True
                    continue
            next_words.append(a)
            next_codes.append(codes[i])
            i += 1
        words, codes, width = next_words, next_codes, 2 * width
    return words, codes


def _encoded(named: DataFrame, dims: int) -> tuple[Callable, str]:
    kind = named.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, entries in blocks(batches, dims, CHUNK):
            with np.errstate(over="ignore"):
                found = np.floor(SCALE * entries)
            good = np.isfinite(found).all(axis=1)
            if not good.any():
                continue
            words, codes = encode(found[good])
            row = {
                "ids": [ids.filter(pa.array(good)).to_pylist()],
                "widths": [[w.shape[1] for w in words]],
                "sizes": [[len(w) for w in words]],
                "words": [b"".join(np.ascontiguousarray(w).tobytes() for w in words)],
                "codes": [b"".join(c.astype(np.uint16).tobytes() for c in codes)],
            }
            yield pa.RecordBatch.from_pydict(row, schema=arrow)

    arrow = pa.schema(
        [
            ("ids", pa.list_(_arrow_type(named.schema["id"].dataType))), ("widths", pa.list_(pa.int32())),
            ("sizes", pa.list_(pa.int32())), ("words", pa.binary()), ("codes", pa.binary()),
        ]
    )
    return run, f"ids array<{kind}>, widths array<int>, sizes array<int>, words binary, codes binary"


def _arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


Centroids = list[list[int]]


def chunk_of(row: dict) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Dictionaries and codes of an encoded row; entries are whole numbers of any size."""
    flat, codes = np.frombuffer(row["words"], np.float64), np.frombuffer(row["codes"], np.uint16)
    if not len(flat) or np.abs(flat).max() <= NARROW:
        flat = flat.astype(np.int64)
    else:
        flat = np.array([int(x) for x in flat.tolist()], object)
    words, start = [], 0
    for width, size in zip(row["widths"], row["sizes"]):
        words.append(flat[start : start + width * size].reshape(size, width))
        start += width * size
    return words, list(codes.reshape(len(words), -1))


def nearest(words: list[np.ndarray], codes: list[np.ndarray], centroids: Centroids) -> tuple[np.ndarray, np.ndarray]:
    """Cluster and squared distance of every vector: partial distances summed by code."""
    wide = words[0].dtype == object or max(abs(x) for c in centroids for x in c) > NARROW
    centres = np.array(centroids, object if wide else np.int64)
    total, at = np.zeros((len(codes[0]), len(centres)), centres.dtype), 0
    for word, code in zip(words, codes):
        apart = word[:, None, :] - centres[None, :, at : at + word.shape[1]]
        total += np.take((apart * apart).sum(axis=2), code, axis=0)
        at += word.shape[1]
    cluster = total.argmin(axis=1)
    return cluster, total[np.arange(len(total)), cluster]


def cluster_sums(words: list[np.ndarray], codes: list[np.ndarray], cluster: np.ndarray, k: int) -> np.ndarray:
    """Sums of the vectors of each cluster, from how often each code occurs in it."""
    sums = []
    for word, code in zip(words, codes):
        counts = np.bincount(cluster * len(word) + code, minlength=k * len(word)).reshape(k, len(word))
        sums.append(counts.astype(word.dtype) @ word)
    return np.concatenate(sums, axis=1)


def _round(centroids: Centroids):
    """Count, inertia and sums of each cluster of the rows of a task."""
    k, dims = len(centroids), len(centroids[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, dims + 2), object)
        for batch in batches:
            for row in batch.select(["widths", "sizes", "words", "codes"]).to_pylist():
                words, codes = chunk_of(row)
                cluster, distance = nearest(words, codes, centroids)
                total[:, 2:] += cluster_sums(words, codes, cluster, k)
                for c in range(k):
                    mine = distance[cluster == c]
                    total[c, 0] += len(mine)
                    total[c, 1] += sum(mine.tolist())
        yield number_parts(dict(enumerate(map(int, total.ravel().tolist()))))

    return run


def _figures(encoded: DataFrame, centroids: Centroids) -> list[list[int]]:
    """Count, inertia and sums of each cluster over all rows; one row a cluster and dimension reaches the driver."""
    width = len(centroids[0]) + 2
    numbers = number_sums(encoded.select("widths", "sizes", "words", "codes").mapInArrow(_round(centroids), PARTS))
    return [[numbers.get(c * width + j, 0) for j in range(width)] for c in range(len(centroids))]


def start(named: DataFrame, dims: int = DIMS, k: int = CLUSTERS) -> Centroids:
    """The vectors with the smallest digests of seed and id; a top-k, so no table is sorted."""
    whole = F.forall("vector", lambda x: F.abs(x.cast("double") * SCALE) < float("inf"))
    digest = F.sha2(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    good = named.where(F.size("vector") == dims).where(whole).select(digest.alias("digest"), "vector")
    rows = good.orderBy("digest", "vector").limit(k).collect()
    return [[int(np.floor(float(x) * SCALE)) for x in row["vector"]] for row in rows]


def clusters(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", dims: int = DIMS, k: int = CLUSTERS, rounds: int = ROUNDS
) -> tuple[DataFrame, Centroids, list[int]]:
    """key, cluster and distance of each clean vector; the final centroids; the inertia of each cluster."""
    named = df.select(F.col(f"`{key}`").alias("id"), F.col(f"`{vector}`").alias("vector"))
    kind = named.schema["id"].dataType.simpleString()
    schema = f"id {kind}, cluster int, distance bigint"
    centroids = start(named, dims, k)
    if not centroids:
        return df.sparkSession.createDataFrame([], schema).withColumnRenamed("id", key), [], []
    run, columns = _encoded(named, dims)
    encoded = Steps(df.sparkSession, "clusters").write(named.mapInArrow(run, columns))
    for _ in range(rounds):
        found = _figures(encoded, centroids)
        centroids = [[s // f[0] for s in f[2:]] if f[0] else c for f, c in zip(found, centroids)]
    inertia = [f[1] for f in _figures(encoded, centroids)]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, row in enumerate(batch.select(["widths", "sizes", "words", "codes"]).to_pylist()):
                cluster, distance = nearest(*chunk_of(row), centroids)
                fits = [d if d < LONG else None for d in distance.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("ids").slice(i, 1).flatten(), pa.array(cluster.astype(np.int32)), pa.array(fits, pa.int64())],
                    ["id", "cluster", "distance"],
                )

    return encoded.mapInArrow(assign, schema).withColumnRenamed("id", key), centroids, inertia


def query(spark: SparkSession, sf: str) -> DataFrame:
    rows, centroids, inertia = clusters(spark.read.parquet(f"{sf}/embeddings.parquet"))

    def long(value: int):
        return F.lit(value if value < LONG else None).cast("long")

    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    by_cluster = F.array(*[F.struct(long(i).alias("i"), F.lit(d).alias("d")) for i, d in zip(inertia, digests)])
    its = F.get(by_cluster, F.col("cluster")) if centroids else F.lit(None).cast("struct<i: bigint, d: string>")
    return rows.select(
        "vec_id",
        "cluster",
        "distance",
        its["i"].alias("cluster_inertia"),
        long(sum(inertia)).alias("inertia"),
        its["d"].alias("centroid_sha256"),
    )


def _sql() -> str:
    rounds = []
    for r in range(ROUNDS + 1):
        rounds.append(f"""
a{r} AS MATERIALIZED (
    SELECT id, min(d * {CLUSTERS} + c) AS best
    FROM (SELECT p.id, c.c, sum((p.x - c.x) * (p.x - c.x)) AS d FROM p JOIN c{r} AS c ON p.i = c.i GROUP BY p.id, c.c)
    GROUP BY id
)""")
        if r < ROUNDS:
            rounds.append(f"""
c{r + 1} AS MATERIALIZED (
    SELECT c.c, c.i, coalesce(n.x, c.x) AS x
    FROM c{r} AS c LEFT JOIN (
        SELECT best % {CLUSTERS} AS c, i, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS x
        FROM p JOIN a{r} USING (id) GROUP BY ALL
    ) AS n ON n.c = c.c AND n.i = c.i
)""")
    return f"""
WITH v AS MATERIALIZED (
    SELECT row_number() OVER () AS id, vec_id, embedding FROM embeddings
    WHERE len(embedding) = {DIMS} AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = {DIMS}
), p AS MATERIALIZED (
    SELECT id, i, CAST(floor({SCALE} * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS x FROM v, range(1, {DIMS + 1}) AS t(i)
), c0 AS MATERIALIZED (
    SELECT c, i, x FROM p JOIN (
        SELECT id, row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id), embedding) - 1 AS c FROM v QUALIFY c < {CLUSTERS}
    ) USING (id)
),{",".join(rounds)}, found AS (
    SELECT id, best % {CLUSTERS} AS c, best // {CLUSTERS} AS d FROM a{ROUNDS}
), digests AS (
    SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS digest FROM c{ROUNDS} GROUP BY c
)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
       CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
       digest AS centroid_sha256
FROM found JOIN v USING (id) JOIN digests USING (c)
"""


ORACLE_SQL = _sql()
