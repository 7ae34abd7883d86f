"""Words and their hashes over Arrow text columns, a batch of rows at a time.

A task gets Arrow batches; each is cut into slices of about a megabyte of text,
and every step works on the bytes of a whole slice at once.  The memory of a
task is a small multiple of one slice or of the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

SLICE_BYTES = 1_000_000
BATCH_ROWS = 1000
U = np.uint64
_A, _B, _C = U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)


def small_batches(spark: SparkSession) -> None:
    """Lets Spark hand out few rows at a time, as single texts may be long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values evenly."""
    x = (x ^ (x >> U(30))) * _B
    x = (x ^ (x >> U(27))) * _C
    return x ^ (x >> U(31))


def slices(batch: pa.RecordBatch, text: str, budget: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``budget`` bytes of text, at least a row each."""
    if not batch.num_rows:
        return
    _, offsets = text_bytes(batch.column(text))
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[start] + budget, "right")) - 1
        end = min(max(end, start + 1), batch.num_rows)
        yield batch.slice(start, end - start)
        start = end


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the offsets of each; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    _, offset_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[column.offset : column.offset + len(column) + 1]
    if data_buffer is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(data_buffer, np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def _table(members: Iterator[int]) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


SPACE = _table([0x20, *range(0x09, 0x0E)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def word_spans(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE):
    """Starts and ends of words in ``data`` and, for each text, the index of its first word."""
    inside = ~space[data]
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    start[first] = inside[first]
    last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    end[last] = inside[last]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


@lru_cache(maxsize=4)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64."""
    n, base = 1 << bits, 0xD1342543DE82EF95
    up, down = np.full(n, U(base)), np.full(n, U(pow(base, -1, 1 << 64)))
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


@lru_cache(maxsize=1)
def _byte_codes() -> np.ndarray:
    return mix((np.arange(256, dtype=U) + U(1)) * _A)


class Prefix:
    """Hashes of any span of some bytes, from running sums."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers(max(20, int(len(data) + 1).bit_length()))
        self.sums = np.zeros(len(data) + 1, U)
        codes = _byte_codes()[data]
        codes *= up[: len(data)]
        np.cumsum(codes, out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self.sums[ends] - self.sums[starts]) * self.down[starts]
        return mix(raw ^ ((ends - starts).astype(U) * _A))


def shingles(hashes: np.ndarray, bounds: np.ndarray, width: int):
    """Hashes of ``width`` consecutive words and the text of each.

    A text with fewer words, but at least one, is one shingle.
    """
    counts = np.diff(bounds)
    n = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    text = np.repeat(np.arange(len(counts)), n)
    first = np.cumsum(n) - n
    at = np.arange(int(n.sum())) - first[text] + bounds[:-1][text]
    out = np.zeros(len(at), U)
    last = bounds[1:][text]
    for k in range(width):
        here = at + k
        inside = here < last
        out = out * _A + (np.where(inside, hashes[np.where(inside, here, 0)], U(0)) if len(hashes) else U(0))
    return mix(out), text
