"""Whitening of embeddings from exact, bit-sliced second moments.

An entry c becomes the whole number x = floor(64 c) + 1000000.  A task gathers
blocks of vectors; in a block each dimension is shifted by its least value and
cut into bit planes, and each plane is packed across the rows into 64-bit words.
The sum over rows of the product of two dimensions is then the sum, over a plane
of each, of 2^(p + q) times the number of ones in the AND of the two planes.
Shifts are undone and tasks are added up in whole numbers, so count, sums and
cross-products are exact, whatever the order of the rows.  n C - S S' is formed
in whole numbers as well; only this centred matrix goes to the eigensolver.

The driver holds one number for each pair of dimensions and never a row.  The
number of planes follows the spread of each block, so wide values cost time and
no exactness.

Defined cases: null vectors and vectors with a null, NaN or infinite entry are
dropped; where lengths differ, the vectors of the most frequent length count
(of equally frequent ones the longest) and the others are dropped; an entry
beyond the range of a long is held at its end; components without variance
(constant dimensions, fewer rows than dimensions) do not exist, so a single
vector, equal vectors and an empty table give an empty result; a null or
repeated vec_id is a row like any other; a deviation that a long cannot hold is
NULL; only the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .vectors import PARTS, blocks, number_parts, number_sums, vectors

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
# Entries of a block; its rows are a multiple of 64.
BLOCK_ENTRIES = 1 << 18
LONG = 1 << 63


def _block_rows(dims: int) -> int:
    return max(64, BLOCK_ENTRIES // max(dims, 1) // 64 * 64)


def levels(entries: np.ndarray) -> np.ndarray:
    """floor(64 c) as long, which is x - ``OFFSET``: all figures are of differences, so the offset cancels."""
    floors = np.floor(SCALE * entries)
    inside = np.clip(floors, -float(LONG), float(LONG - (1 << 21)))
    return inside.astype(np.int64)


def bit_planes(shifted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed planes of unsigned columns, and dimension and weight (a power of 2) of each plane."""
    rows, dims = shifted.shape
    padded = np.zeros((dims, -(-rows // 64) * 64), np.uint64)
    padded[:, :rows] = shifted.T
    planes, dim, power = [], [], []
    tops = padded.max(axis=1) if rows else np.zeros(dims, np.uint64)
    for p in range(int(tops.max()).bit_length() if dims else 0):
        here = np.flatnonzero(tops >> np.uint64(p))
        bits = ((padded[here] >> np.uint64(p)) & np.uint64(1)).astype(np.uint8)
        planes.append(np.packbits(bits, axis=1).view(np.uint64))
        dim.append(here)
        power.append(np.full(len(here), p))
    if not planes:
        return np.zeros((0, 0), np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(planes), np.concatenate(dim), np.concatenate(power)


def cross_products(shifted: np.ndarray) -> np.ndarray:
    """Exact sums of products of unsigned columns, as Python integers."""
    dims = shifted.shape[1]
    planes, dim, power = bit_planes(shifted)
    out = np.zeros((dims, dims), object)
    narrow = not len(power) or 2 * int(power.max()) + len(shifted).bit_length() + 2 < 63
    weighted = np.zeros((dims, dims), np.int64)
    for i in range(len(planes)):
        ones = np.bitwise_count(planes[i:] & planes[i]).sum(axis=1, dtype=np.int64)
        if narrow:
            row = ones << (power[i:] + power[i])
            np.add.at(weighted, (dim[i], dim[i:]), row)
            np.add.at(weighted, (dim[i + 1 :], dim[i]), row[1:])
        else:
            for j, count in enumerate(ones.tolist(), i):
                out[dim[i], dim[j]] += count << int(power[i] + power[j])
                if j > i:
                    out[dim[j], dim[i]] += count << int(power[i] + power[j])
    return out + weighted


class Moments:
    """Count, sums and cross-products of whole vectors, exact."""

    def __init__(self, dims: int):
        self.n, self.sums, self.products = 0, np.zeros(dims, object), np.zeros((dims, dims), object)

    def add(self, found: np.ndarray) -> None:
        least = found.min(axis=0)
        shifted = (found.astype(np.uint64) - least.astype(np.uint64)).astype(np.uint64)
        shift = least.astype(object)
        high, low = (shifted >> np.uint64(32)).sum(axis=0), (shifted & np.uint64(0xFFFFFFFF)).sum(axis=0)
        sums, n = high.astype(object) * (1 << 32) + low.astype(object), len(found)
        products = cross_products(shifted)
        products = products + np.outer(shift, sums) + np.outer(sums, shift) + n * np.outer(shift, shift)
        self.n, self.sums, self.products = self.n + n, self.sums + sums + n * shift, self.products + products

    def numbers(self) -> dict[int, int]:
        """All figures under one key each: 0 the count, then the sums, then the upper triangle."""
        dims = len(self.sums)
        at = np.triu_indices(dims)
        values = [self.n, *self.sums.tolist(), *self.products[at].tolist()]
        return dict(enumerate(map(int, values)))


@dataclass
class Fit:
    """What the rows are projected with; its size depends on the number of dimensions alone."""

    n: int
    sums: list[int]
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # a unit eigenvector in each column
    total: float  # trace of the covariance


def _named(df: DataFrame, key: str, vector: str) -> DataFrame:
    return df.select(F.col(f"`{key}`").alias("id"), F.col(f"`{vector}`").alias("vector"))


def _lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        _, _, lengths, clean = vectors(batch.column("vector"))
        dims, rows = np.unique(lengths[clean], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(dims), pa.array(rows)], ["dims", "rows"])


def common_length(named: DataFrame) -> int:
    """The most frequent length of a clean vector, 0 if there is none."""
    lengths = named.select("vector").mapInArrow(_lengths, "dims bigint, rows bigint").where("dims > 0")
    top = lengths.groupBy("dims").agg(F.sum("rows").alias("rows")).orderBy(F.desc("rows"), F.desc("dims")).first()
    return top["dims"] if top else 0


def fit(named: DataFrame, dims: int) -> Fit:
    """Exact moments of all clean vectors, and the eigenvectors of their covariance."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moments = Moments(dims)
        for _, found in blocks(batches, dims, _block_rows(dims)):
            moments.add(levels(found))
        if moments.n:
            yield number_parts(moments.numbers())

    numbers = number_sums(named.mapInArrow(scan, PARTS))
    n, sums = numbers.get(0, 0), [numbers.get(1 + d, 0) for d in range(dims)]
    centred, pairs = np.zeros((dims, dims)), list(zip(*np.triu_indices(dims)))
    for k, (i, j) in enumerate(pairs):
        value = n * numbers.get(1 + dims + k, 0) - sums[i] * sums[j]
        centred[i, j] = centred[j, i] = value / (n * n) if n else 0.0
    if not n or not dims:
        return Fit(0, sums, np.zeros(0), np.zeros((dims, 0)), 0.0)
    values, columns = np.linalg.eigh(centred)
    values, columns = values[::-1], columns[:, ::-1]
    largest = columns[np.abs(columns).argmax(axis=0), np.arange(dims)]
    columns = columns * np.where(largest < 0, -1.0, 1.0)
    exists = values[:COMPONENTS] > max(values[0], 0.0) * dims * np.finfo(float).eps * 4
    keep = int(exists.sum())
    return Fit(n, sums, values[:keep], columns[:, :keep], float(np.trace(centred)))


def deviations(found: np.ndarray, fitted: Fit) -> list[int]:
    """The sum over dimensions of (n x - S)^2 of each row, exact."""
    n, sums = fitted.n, fitted.sums
    largest = max(map(abs, sums), default=0) + n * int(np.abs(found.astype(np.float64)).max(initial=0.0) + 1)
    if largest < LONG:
        apart = n * found - np.array(sums, np.int64)
        if int(np.abs(apart).max(initial=0)) ** 2 * found.shape[1] < LONG:
            return (apart * apart).sum(axis=1).tolist()
    exact = n * found.astype(object) - np.array(sums, object)
    return (exact * exact).sum(axis=1).tolist()


def projected(found: np.ndarray, fitted: Fit) -> np.ndarray:
    """x - S / n on each component, over the square root of its eigenvalue."""
    whole = [s // fitted.n for s in fitted.sums]
    rest = np.array([(s % fitted.n) / fitted.n for s in fitted.sums])
    if max(map(abs, whole)) + np.abs(found.astype(np.float64)).max() < LONG / 2:
        centred = (found - np.array(whole, np.int64)).astype(np.float64) - rest
    else:
        centred = (found.astype(object) - np.array(whole, object)).astype(np.float64) - rest
    weights, out = fitted.vectors / np.sqrt(fitted.values), np.zeros((len(found), len(fitted.values)))
    for d, weight in enumerate(weights):  # one order of addition, so a row's values do not depend on its block
        out += centred[:, d, None] * weight
    return out


WHITE = "deviation bigint, whitened array<double>"


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, Fit]:
    """key, deviation and the array of whitened values of each clean vector; and the fit."""
    named = _named(df, key, vector)
    dims = common_length(named)
    fitted = fit(named, dims)
    keep = len(fitted.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, entries in blocks(batches, dims, _block_rows(dims)):
            found = levels(entries)
            deviation = [d if d < LONG else None for d in deviations(found, fitted)]
            values = pa.array(projected(found, fitted).ravel())
            offsets = pa.array(np.arange(len(found) + 1, dtype=np.int32) * keep)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(deviation, pa.int64()), pa.ListArray.from_arrays(offsets, values)],
                ["id", "deviation", "whitened"],
            )

    kind = named.schema["id"].dataType.simpleString()
    if not keep:
        return named.sparkSession.createDataFrame([], f"id {kind}, {WHITE}").withColumnRenamed("id", key), fitted
    return named.mapInArrow(run, f"id {kind}, {WHITE}").withColumnRenamed("id", key), fitted


def identity_error(white: DataFrame, keep: int) -> float:
    """Largest absolute entry of the measured covariance of the whitened values minus the identity.

    The values are centred already; each task sends one sum for each pair of
    components, and Spark adds them up.
    """
    at = np.triu_indices(keep)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, np.zeros(keep), np.zeros((keep, keep))
        for batch in batches:
            w = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, keep)
            n, sums, products = n + len(w), sums + w.sum(axis=0), products + w.T @ w
        if n:
            values = np.concatenate([[float(n)], sums, products[at]])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], ["key", "value"])

    parts = white.select("whitened").mapInArrow(scan, "key bigint, value double")
    found = {r["key"]: r["value"] for r in parts.groupBy("key").agg(F.sum("value").alias("value")).collect()}
    if not found:
        return 0.0
    n, mean = found[0], np.array([found[1 + i] for i in range(keep)]) / found[0]
    products = np.array([found[1 + keep + i] for i in range(len(at[0]))]) / n
    return float(np.abs(products - mean[at[0]] * mean[at[1]] - (at[0] == at[1])).max())


def components(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """A row for each clean vector and component: key, component, n, deviation, whitened, explained, identity_error."""
    white, fitted = whiten(df, key, vector)
    keep = len(fitted.values)
    error = identity_error(white, keep) if keep else 0.0
    shares = F.array(*[F.lit(float(v / fitted.total)) for v in fitted.values]) if keep else F.array().cast("array<double>")
    rows = white.select(F.col(f"`{key}`"), "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return rows.select(
        F.col(f"`{key}`"),
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(fitted.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def query(spark: SparkSession, sf: str) -> DataFrame:
    return components(spark.read.parquet(f"{sf}/embeddings.parquet"))
