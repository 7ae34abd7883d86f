"""Token ids packed into rows of a fixed length by best-fit decreasing.

Every document becomes token ids and an end token.  A document longer than a
row is split without loss into full rows and a rest.  Within a block of
documents the pieces are packed longest first, each into the row with the least
room that still holds it; a segment tree over the room left finds that row.
Blocks are formed inside a partition, so nothing is shuffled and a lost task is
repeated alone; a block leaves at most a few rows unfilled.

Defined cases: a null or empty text gives the end token alone; rows that repeat
a doc_id are packed as often as they occur; an empty table gives an empty
result; only the named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .words import SPACE, slices, small_batches, text_bytes

ROW_TOKENS = 2048
BLOCK_TOKENS = 1 << 22
# Fixed value: the id that the vocabulary leaves free.
END = 50256
CACHE = 100_000
UNITS = 10_000
PACKED = (
    "doc_ids array<bigint>, offsets array<bigint>, cu_seqlens array<int>, "
    "n_tokens int, ids binary, position_ids binary"
)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=2)
def encoding(vocabulary: str):
    import public_tokenizers
    import tiktoken

    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "corpus", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


# White space beyond ASCII, as UTF-8.
WIDE_SPACES = [
    chr(c).encode()
    for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
]


def white_space(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to white space of any kind."""
    space = SPACE[data]
    for char in WIDE_SPACES:
        if len(data) >= len(char):
            n = len(data) - len(char) + 1
            at = np.flatnonzero(data[:n] == char[0])
            for k in range(1, len(char)):
                at = at[data[at + k] == char[k]]
            for k in range(len(char)):
                space[at + k] = True
    return space


def unit_bounds(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the texts can be cut so that the parts have the tokens of the whole.

    The tokenizer's pattern takes one space into the following word, and of a
    run of white space before a word all but the last character as one piece.
    So a cut is right before the last white space of a run, after it if it is
    no space, and at the end of each word.
    """
    cut = np.zeros(len(data) + 1, bool)
    if len(data):
        space = white_space(data)
        cut[offsets] = True
        # A word starts after white space of the same text.
        at = np.flatnonzero(~space[1:] & space[:-1] & ~cut[1:-1]) + 1
        last = at - 1
        for _ in range(2):  # to the first byte of that character
            last = last - ((data[last] & 0xC0) == 0x80)
        cut[last] = True
        cut[at[data[last] != 0x20]] = True
        cut[1:-1] |= space[1:] & ~space[:-1]
    cut[offsets] = True
    return np.flatnonzero(cut)


class Tokenizer:
    """Token ids of many texts; each different word is encoded once.

    The ids of a known word are held as the bytes of 32-bit numbers.  Once
    ``CACHE`` words are known they become the older ones, which go when the next
    ``CACHE`` are full; a word that is met again moves to the newer ones.
    """

    def __init__(self, vocabulary: str):
        self.encode = encoding(vocabulary).encode_ordinary
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids and the offsets of each text in them."""
        data, offsets = text_bytes(column)
        bounds = unit_bounds(data, offsets)
        units = pa.LargeStringArray.from_buffers(
            len(bounds) - 1, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))
        )
        coded = units.dictionary_encode()
        ids = []
        for begin in range(0, len(coded.dictionary), UNITS):
            for unit in coded.dictionary.slice(begin, UNITS).to_pylist():
                got = self.known.get(unit)
                if got is None:
                    got = self.older.get(unit)
                    if got is None:
                        got = array("I", self.encode(unit)).tobytes()
                    if len(self.known) >= CACHE:
                        self.older, self.known = self.known, {}
                    self.known[unit] = got
                ids.append(got)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), np.uint32)
        begins = np.cumsum(sizes) - sizes
        code = coded.indices.to_numpy(zero_copy_only=False)
        n = sizes[code] if len(code) else np.zeros(0, np.int64)
        ends = np.cumsum(n)
        at = np.repeat(begins[code] - (ends - n), n) + np.arange(int(ends[-1]) if len(ends) else 0)
        unit_of = np.searchsorted(bounds, offsets)
        return flat[at], np.concatenate([[0], ends])[unit_of]


class Rooms:
    """Rows by the room left in them; a segment tree finds the least that suffices."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def _add(self, room: int, n: int) -> None:
        node = room + self.leaves
        while node:
            self.count[node] += n
            node >>= 1

    def put(self, room: int, row: int) -> None:
        if room:
            self.rows[room].append(row)
            self._add(room, 1)

    def take(self, size: int) -> tuple[int, int] | None:
        """Room and row of the best fit for ``size``, removed from the tree."""
        count, node = self.count, size + self.leaves
        if not count[node]:
            while node > 1 and (node & 1 or not count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node <<= 1
                if not count[node]:
                    node += 1
        room = node - self.leaves
        self._add(room, -1)
        return room, self.rows[room].pop()


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Indices of the pieces in each row, in the order in which they were put there."""
    rooms, rows = Rooms(capacity), []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        found = rooms.take(lengths[i])
        if found is None:
            found = capacity, len(rows)
            rows.append([])
        rows[found[1]].append(i)
        rooms.put(found[0] - lengths[i], found[1])
    return rows


def _packed(pieces: list, row_tokens: int, pad: int, kind: np.dtype) -> Iterator[pa.RecordBatch]:
    """Rows of one block; a piece is (doc_id, offset in the document, its ids)."""
    rows = best_fit_decreasing([len(piece[2]) for piece in pieces], row_tokens)
    schema = pa.schema(
        [
            ("doc_ids", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int64())),
            ("cu_seqlens", pa.list_(pa.int32())), ("n_tokens", pa.int32()),
            ("ids", pa.binary()), ("position_ids", pa.binary()),
        ]
    )
    for begin in range(0, len(rows), 128):
        out = []
        for row in rows[begin : begin + 128]:
            ids, positions = np.full(row_tokens, pad, kind), np.zeros(row_tokens, "<u4")
            ends = [0]
            for i in row:
                n = len(pieces[i][2])
                ids[ends[-1] : ends[-1] + n] = pieces[i][2]
                positions[ends[-1] : ends[-1] + n] = np.arange(n)
                ends.append(ends[-1] + n)
            out.append(
                ([pieces[i][0] for i in row], [pieces[i][1] for i in row], ends, ends[-1],
                 ids.tobytes(), positions.tobytes())
            )
        yield pa.RecordBatch.from_arrays(
            [pa.array(column, field.type) for column, field in zip(zip(*out), schema)], schema=schema
        )


def pack(
    docs: DataFrame,
    vocabulary: str | None = None,
    row_tokens: int = ROW_TOKENS,
    end: int = END,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row for each packed row of ``row_tokens`` ids.

    ``ids`` holds little-endian 32-bit ids, filled up with ``end``;
    ``position_ids`` restart at 0 with each piece; piece ``i`` lies from
    ``cu_seqlens[i]`` to ``cu_seqlens[i + 1]`` and starts at token ``offsets[i]``
    of document ``doc_ids[i]``.
    """
    vocabulary = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, kind = Tokenizer(vocabulary), np.dtype("<u4")
        pieces, held = [], 0
        for batch in batches:
            for part in slices(batch, "text"):
                ids, bounds = tokenizer(part.column("text"))
                for i, doc in enumerate(part.column("key").to_pylist()):
                    own = np.append(ids[bounds[i] : bounds[i + 1]], np.uint32(end))
                    for at in range(0, len(own), row_tokens):
                        pieces.append((doc, at, own[at : at + row_tokens]))
                    held += len(own)
                    if held >= BLOCK_TOKENS:
                        yield from _packed(pieces, row_tokens, end, kind)
                        pieces, held = [], 0
        if pieces:
            yield from _packed(pieces, row_tokens, end, kind)

    small_batches(docs.sparkSession)
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    return rows.mapInArrow(run, PACKED)


def write_matrices(packed: DataFrame, folder: str, rows: int = 256) -> None:
    """Writes matrices of up to ``rows`` packed rows below each other, as Parquet in ``folder``.

    ``ids`` and ``position_ids`` are the matrices; ``row_splits`` says which
    entries of the other lists belong to which matrix row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []

        def matrix() -> pa.RecordBatch:
            flat = lambda name: [x for row in held for x in row[name]]
            splits = np.cumsum([0] + [len(row["doc_ids"]) for row in held]).tolist()
            ends = [x for row in held for x in row["cu_seqlens"]]
            columns = {
                "n_rows": [len(held)], "row_splits": [splits], "doc_ids": [flat("doc_ids")],
                "offsets": [flat("offsets")], "cu_seqlens": [ends],
                "ids": [b"".join(row["ids"] for row in held)],
                "position_ids": [b"".join(row["position_ids"] for row in held)],
            }
            return pa.RecordBatch.from_pydict(columns, schema=_MATRIX)

        for batch in batches:
            for row in batch.to_pylist():
                held.append(row)
                if len(held) == rows:
                    yield matrix()
                    held.clear()
        if held:
            yield matrix()

    schema = (
        "n_rows int, row_splits array<int>, doc_ids array<bigint>, offsets array<bigint>, "
        "cu_seqlens array<int>, ids binary, position_ids binary"
    )
    packed.mapInArrow(run, schema).write.mode("overwrite").parquet(folder)


_MATRIX = pa.schema(
    [
        ("n_rows", pa.int32()), ("row_splits", pa.list_(pa.int32())), ("doc_ids", pa.list_(pa.int64())),
        ("offsets", pa.list_(pa.int64())), ("cu_seqlens", pa.list_(pa.int32())),
        ("ids", pa.binary()), ("position_ids", pa.binary()),
    ]
)


def query(spark: SparkSession, sf: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf}/documents.parquet"))
