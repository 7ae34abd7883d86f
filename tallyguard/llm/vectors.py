"""Vector columns in Arrow batches, and sums of whole numbers of any size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A whole number travels as parts of so many bits, so that sums of parts fit a long.
PART_BITS = 30
PARTS = "key bigint, part int, value bigint"


def vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Entries as double, first entry and length of each vector, and whether it is clean.

    A vector is clean if it is not null and has no null, NaN or infinite entry.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten()
    known = flat.is_valid().to_numpy(zero_copy_only=False)
    entries = flat.fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64)
    bad = np.append(0, np.cumsum(~known | ~np.isfinite(entries)))
    starts = np.cumsum(lengths) - lengths
    clean = column.is_valid().to_numpy(zero_copy_only=False) & (bad[starts + lengths] == bad[starts])
    return entries, starts, lengths, clean


def matrix(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows with a clean vector of ``dims`` entries, and these vectors."""
    entries, starts, lengths, clean = vectors(column)
    rows = np.flatnonzero(clean & (lengths == dims))
    return rows, entries[starts[rows][:, None] + np.arange(dims)]


def number_parts(numbers: dict[int, int]) -> pa.RecordBatch:
    """A batch of ``PARTS``: each number by its key, cut into parts of ``PART_BITS`` bits."""
    keys, parts, values = [], [], []
    for key, number in numbers.items():
        sign, left, part = (-1 if number < 0 else 1), abs(number), 0
        while left or not part:
            keys.append(key)
            parts.append(part)
            values.append(sign * (left & ((1 << PART_BITS) - 1)))
            left >>= PART_BITS
            part += 1
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.int64()), pa.array(parts, pa.int32()), pa.array(values, pa.int64())], ["key", "part", "value"]
    )


def number_sums(parts: DataFrame) -> dict[int, int]:
    """The exact sum of the numbers of each key; Spark adds the parts, the driver gets one row a part."""
    sums: dict[int, int] = {}
    for row in parts.groupBy("key", "part").agg(F.sum("value").alias("value")).collect():
        sums[row["key"]] = sums.get(row["key"], 0) + (row["value"] << (PART_BITS * row["part"]))
    return sums


def blocks(batches: Iterator[pa.RecordBatch], dims: int, rows: int, vector: str = "vector"):
    """Arrow batches cut or gathered to ``rows`` clean vectors each: ids and vectors of every block."""
    ids, held, n = [], [], 0
    for batch in batches:
        at, found = matrix(batch.column(vector), dims)
        names = batch.column(0).take(pa.array(at))
        start = 0
        while start < len(at):
            end = min(len(at), start + rows - n)
            ids.append(names.slice(start, end - start))
            held.append(found[start:end])
            n += end - start
            start = end
            if n == rows:
                yield pa.concat_arrays(ids), np.concatenate(held)
                ids, held, n = [], [], 0
    if n:
        yield pa.concat_arrays(ids), np.concatenate(held)
