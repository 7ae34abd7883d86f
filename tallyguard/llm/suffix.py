"""Removal of long repeated byte strings with a logarithmic family of suffix arrays.

Every byte covered by a ``LENGTH``-byte string that also starts earlier (in a
document with a smaller id, or further left in the same one) is removed.

The suffix arrays are sparse.  In each ``LENGTH``-byte window the ``GRAM``-byte
gram with the least hash is its anchor, so equal windows have the same anchor at
the same place, and only one suffix in about 35 is kept: those that begin at an
anchor.  A suffix array orders them by the fingerprint of the first ``GRAM``
bytes and then by the fingerprint of the context, which is all the bytes of the
windows that the anchor stands for.

A batch of documents gets its suffix array in the task that reads it and sends a
part of it to each range of fingerprints.  There each arriving array is
merge-scanned against the levels present: an entry whose context is known
earlier is a match over its whole context and does not enter.  What is left
becomes a level, and levels of about equal size are merged, so sizes grow
geometrically.  Anchors that occur with different contexts lie at the borders of
repeats; their windows are compared one by one by hash.

Defined cases: a null text is empty; texts shorter than ``LENGTH`` bytes keep
all; rows that repeat a doc_id count as one document, in which an earlier start
counts; a null doc_id comes before all others; an empty table gives an empty
result; only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .katz import _BLOCK, _from_planes, _join, _planes, _runs, _split
from .tables import Steps
from .words import Prefix, U, mix, slices, small_batches, text_bytes

LENGTH = 100
GRAM = 32
BATCH_BYTES = 16_000_000
_HIGH = U(((1 << 40) - 1) << 24)
BLOCK = "p int, block binary"


def anchors(data: np.ndarray, offsets: np.ndarray):
    """Text, first window, number of windows, fingerprint of the gram and of the context of each anchor."""
    prefix = Prefix(data)
    sizes = np.diff(offsets)
    n = np.maximum(sizes - LENGTH + 1, 0)
    text = np.repeat(np.arange(len(sizes)), n)
    if not len(text):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty.astype(U), empty.astype(U), prefix
    window = np.arange(int(n.sum())) - (np.cumsum(n) - n)[text] + offsets[:-1][text]
    at = np.arange(len(data) - GRAM + 1)
    grams = prefix.of(at, at + GRAM)
    bits = U(max(20, int(len(data)).bit_length()))
    least = ((grams >> bits) << bits) | at.astype(U)
    span, covered = LENGTH - GRAM + 1, 1
    while 2 * covered <= span:
        least = np.minimum(least[:-covered], least[covered:])
        covered *= 2
    if covered < span:
        least = np.minimum(least[: len(least) - (span - covered)], least[span - covered :])
    anchor = (least[window] & ((U(1) << bits) - U(1))).astype(np.int64)
    first = _runs(anchor, text)
    count = np.diff(np.append(first, len(anchor)))
    place, low = anchor[first], window[first]
    context = mix(prefix.of(low, low + count - 1 + LENGTH) + (place - low).astype(U))
    return text[first], low - offsets[:-1][text[first]], count, grams[place], context, prefix


class Run:
    """A suffix array: entries in the order of ``key``, which is gram first, then context."""

    __slots__ = ("key", "gram", "context", "doc", "at", "count")

    def __init__(self, gram, context, doc, at, count, key=None):
        self.gram, self.context, self.doc, self.at, self.count = gram, context, doc, at, count
        self.key = (gram & _HIGH) | (context >> U(40)) if key is None else key

    def __len__(self) -> int:
        return len(self.key)

    def take(self, index) -> Run:
        return Run(*[getattr(self, c)[index] for c in ("gram", "context", "doc", "at", "count", "key")])

    def in_order(self) -> Run:
        """Sorted, with equal entries by document and place."""
        return self.take(np.lexsort((self.at, self.doc, self.context, self.gram, self.key)))


def joined(runs: list[Run]) -> Run:
    return Run(*[np.concatenate([getattr(r, c) for r in runs]) for c in ("gram", "context", "doc", "at", "count", "key")])


def earliest(run: Run) -> tuple[Run, Run]:
    """Of a sorted run the first entry of each context, and the others that start later."""
    first = _runs(run.key, run.gram, run.context)
    lead = np.repeat(first, np.diff(np.append(first, len(run))))
    later = (run.doc != run.doc[lead]) | (run.at != run.at[lead])
    return run.take(first), run.take(np.flatnonzero(later))


class Levels:
    """A family of suffix arrays whose sizes grow geometrically."""

    def __init__(self):
        self.levels: list[Run] = []

    def add(self, run: Run) -> list[Run]:
        """Scans a sorted run against all levels, lets the rest enter, and gives the matches."""
        matches = []
        for level in self.levels:
            if not len(run) or not len(level):
                continue
            at = np.minimum(np.searchsorted(level.key, run.key), len(level) - 1)
            same = (level.gram[at] == run.gram) & (level.context[at] == run.context)
            here, there = np.flatnonzero(same), at[same]
            sooner = (run.doc[here] < level.doc[there]) | (
                (run.doc[here] == level.doc[there]) & (run.at[here] < level.at[there])
            )
            equal = (run.doc[here] == level.doc[there]) & (run.at[here] == level.at[there])
            matches.append(run.take(here[~sooner & ~equal]))
            # Entries that start sooner take the place of the level's.
            new, old = here[sooner], there[sooner]
            matches.append(level.take(old))
            level.doc[old], level.at[old] = run.doc[new], run.at[new]
            run = run.take(np.flatnonzero(~same))
        while self.levels and len(self.levels[-1]) <= 2 * len(run):
            both = joined([self.levels.pop(), run])
            run, later = earliest(both.in_order())
            matches.append(later)
        if len(run):
            self.levels.append(run)
        return [m for m in matches if len(m)]

    def finish(self) -> tuple[Run | None, list[Run]]:
        if not self.levels:
            return None, []
        run, later = earliest(joined(self.levels).in_order())
        return run, [later] if len(later) else []


class Spans:
    """Collects spans of documents and packs them by document for the next exchange."""

    def __init__(self, classes: int):
        self.classes, self.held, self.n = classes, {}, 0

    def add(self, checked: bool, run: Run, extra: int) -> Iterator[pa.RecordBatch]:
        if len(run):
            self.held.setdefault(checked, []).append((run.doc, run.at, run.count + extra))
            self.n += len(run)
        if self.n >= 1_000_000:
            yield from self.blocks()

    def blocks(self) -> Iterator[pa.RecordBatch]:
        for checked, held in self.held.items():
            doc, lo, size = (np.concatenate(x) for x in zip(*held))
            p = (mix(doc.astype(U)) % U(self.classes)).astype(np.int64)
            order = np.lexsort((lo, doc, p))
            doc, lo, size, p = doc[order], lo[order], size[order], p[order]
            cuts = np.searchsorted(p, np.arange(self.classes + 1))
            for k in range(self.classes):
                if cuts[k] < cuts[k + 1]:
                    own = slice(cuts[k], cuts[k + 1])
                    first = _runs(doc[own])
                    block = _join([
                        _planes(np.diff(doc[own][first], prepend=0)),
                        _planes(np.diff(np.append(first, cuts[k + 1] - cuts[k])).astype(np.uint32)),
                        _planes(np.diff(lo[own], prepend=0)), _planes(size[own].astype(np.uint32)),
                    ])
                    yield pa.RecordBatch.from_pydict({"checked": [checked], "p": [k], "block": [block]}, schema=_SPANS)
        self.held, self.n = {}, 0


FOUND = "checked boolean, p int, block binary"
_SPANS = pa.schema([("checked", pa.bool_()), ("p", pa.int32()), ("block", pa.binary())])
BY_DOCUMENT = "_doc bigint, los array<bigint>, his array<bigint>"


def _by_document(merge: bool):
    """The spans of each document in order; touching ones become one if ``merge``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list[bytes]] = {}
        for batch in batches:
            for p, block in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                found.setdefault(p, []).append(block)
        for p in sorted(found):
            parts = []
            for block in found.pop(p):
                a = _split(block, 4)
                doc = np.repeat(np.cumsum(_from_planes(a[0], np.int64)), _from_planes(a[1], np.uint32))
                parts.append((doc, np.cumsum(_from_planes(a[2], np.int64)), _from_planes(a[3], np.uint32).astype(np.int64)))
            doc, lo, size = (np.concatenate(x) for x in zip(*parts))
            order = np.lexsort((lo, doc))
            doc, lo, hi = doc[order], lo[order], lo[order] + size[order]
            of_doc = _runs(doc)
            if merge:
                # Places of all documents in one line, so that one running maximum serves all.
                shift = np.zeros(len(of_doc), np.int64)
                tops = np.maximum.reduceat(hi, of_doc) + 1
                shift[1:] = np.cumsum(tops)[:-1]
                shift = np.repeat(shift, np.diff(np.append(of_doc, len(doc))))
                reach = np.maximum.accumulate(hi + shift)
                new = np.ones(len(lo), bool)
                new[1:] = lo[1:] + shift[1:] > reach[:-1]
                first = np.flatnonzero(new)
                hi = np.maximum.reduceat(hi, first)
                doc, lo = doc[first], lo[first]
                of_doc = _runs(doc)
            offsets = pa.array(np.append(of_doc, len(doc)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[of_doc]), pa.ListArray.from_arrays(offsets, pa.array(lo)), pa.ListArray.from_arrays(offsets, pa.array(hi))],
                ["_doc", "los", "his"],
            )

    return run


def _send(classes: int):
    """The suffix array of each batch of documents, cut by fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for part in slices(batch, "text"):
                data, offsets = text_bytes(part.column("text"))
                text, low, count, gram, context, _ = anchors(data, offsets)
                doc = part.column("doc_id").to_numpy(zero_copy_only=False)
                held.append(Run(gram, context, doc[text], low, count))
                size += len(data)
                if size >= BATCH_BYTES:
                    yield from _array_blocks(held, classes)
                    held, size = [], 0
        if held:
            yield from _array_blocks(held, classes)

    return run


def _array_blocks(held: list[Run], classes: int) -> Iterator[pa.RecordBatch]:
    array = joined(held).in_order()
    p = (mix(array.gram) % U(classes)).astype(np.int64)
    order = np.argsort(p, kind="stable")
    cuts = np.searchsorted(p[order], np.arange(classes + 1))
    for k in range(classes):
        if cuts[k] < cuts[k + 1]:
            block = _encode(array.take(order[cuts[k] : cuts[k + 1]]))
            yield pa.RecordBatch.from_pydict({"p": [k], "block": [block]}, schema=_BLOCK)


def _encode(run: Run) -> bytes:
    ids, doc = np.unique(run.doc, return_inverse=True)
    return _join([
        _planes(np.diff(run.gram, prepend=U(0))), _planes(run.context),
        _planes(np.diff(ids, prepend=0)), _planes(doc.astype(np.uint32)), _planes(run.at), _planes(run.count.astype(np.uint32)),
    ])


def _decode(block: bytes) -> Run:
    a = _split(block, 6)
    ids = np.cumsum(_from_planes(a[2], np.int64))
    return Run(np.cumsum(_from_planes(a[0], U), dtype=U), _from_planes(a[1], U), ids[_from_planes(a[3], np.uint32)],
               _from_planes(a[4], np.int64), _from_planes(a[5], np.uint32).astype(np.int64))


def _merge(classes: int, extra: int):
    """Matches, and the anchors that occur with several contexts, packed by document.

    ``extra`` is what the last window of an entry covers beyond its start.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        families: dict[int, Levels] = {}
        spans = Spans(classes)
        for batch in batches:
            for p, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                array, later = earliest(_decode(block))
                for match in [later, *families.setdefault(p, Levels()).add(array)]:
                    yield from spans.add(False, match, extra)
        for p in sorted(families):
            array, later = families.pop(p).finish()
            for match in later:
                yield from spans.add(False, match, extra)
            if array is not None:
                order = np.argsort(array.gram, kind="stable")
                first = _runs(array.gram[order])
                n = np.diff(np.append(first, len(array)))
                yield from spans.add(True, array.take(order[np.repeat(n > 1, n)]), 0)
        yield from spans.blocks()

    return run


def _send_windows(classes: int):
    """Each window that has to be compared, as an entry whose gram is the whole window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for part in slices(batch, "text"):
                data, offsets = text_bytes(part.column("text"))
                prefix = Prefix(data)
                lo, hi = part.column("los"), part.column("his")
                row = np.repeat(np.arange(part.num_rows), lo.value_lengths().to_numpy(zero_copy_only=False))
                low, high = (c.flatten().to_numpy(zero_copy_only=False) for c in (lo, hi))
                inside = high + LENGTH - 1 <= np.diff(offsets)[row]  # another row of the same doc_id may be shorter
                row, low, high = row[inside], low[inside], high[inside]
                n = high - low
                at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
                row = np.repeat(row, n)
                begin = at + offsets[:-1][row]
                doc = part.column("doc_id").to_numpy(zero_copy_only=False)[row]
                whole = prefix.of(begin, begin + LENGTH)
                held.append(Run(whole, np.zeros(len(at), U), doc, at, np.ones(len(at), np.int64)))
                size += len(at)
                if size >= BATCH_BYTES // 16:
                    yield from _array_blocks(held, classes)
                    held, size = [], 0
        if held:
            yield from _array_blocks(held, classes)

    return run


def repeats(spark: SparkSession, docs: DataFrame, steps: Steps) -> DataFrame:
    """_doc, los, his: the maximal removed runs of each document that has any."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    classes = 2 * parts
    found = docs.mapInArrow(_send(classes), BLOCK).repartition(parts, "p")
    found = steps.write(found.mapInArrow(_merge(classes, LENGTH - 1), FOUND))

    # Windows of anchors with several contexts, in the documents that have them.
    open_ = found.where("checked").repartition(parts, "p").mapInArrow(_by_document(False), BY_DOCUMENT)
    open_ = steps.write(open_)
    texts = docs.join(open_.hint("merge"), F.col("doc_id") == F.col("_doc")).select("doc_id", "text", "los", "his")
    windows = texts.mapInArrow(_send_windows(classes), BLOCK).repartition(parts, "p")
    windows = steps.write(windows.mapInArrow(_merge(classes, LENGTH - 1), FOUND))
    spans = found.where(~F.col("checked")).unionByName(windows.where(~F.col("checked"))).repartition(parts, "p")
    return steps.write(spans.mapInArrow(_by_document(True), BY_DOCUMENT))


KEPT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"


def _remove(with_bytes: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            columns = (batch.column(name).to_pylist() for name in ("doc_id", "text", "los", "his"))
            for doc, text, los, his in zip(*columns):
                data = (text or "").encode("utf-8", "surrogatepass")
                kept, end, n_spans = [], 0, 0
                for lo, hi in zip(los or (), his or ()):
                    if lo < len(data):
                        kept.append(data[end:lo])
                        end, n_spans = min(hi, len(data)), n_spans + 1
                rest = b"".join([*kept, data[end:]])
                rows.append((doc, len(data), len(data) - len(rest), n_spans, hashlib.sha256(rest).hexdigest(),
                             rest if with_bytes else None))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)], [f.split()[0] for f in KEPT.split(", ")]
            )

    return run


def remove_repeats(spark: SparkSession, docs: DataFrame, with_bytes: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the kept bytes of each row."""
    small_batches(spark)
    steps = Steps(spark, "suffix")
    lowest = -(1 << 63)
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(lowest)).alias("doc_id"), F.col("text").cast("string").alias("text"))
    joined_ = docs.join(repeats(spark, docs, steps).hint("merge"), F.col("doc_id") == F.col("_doc"), "left")
    out = joined_.select("doc_id", "text", "los", "his").mapInArrow(_remove(with_bytes), KEPT)
    return out.withColumn("doc_id", F.when(F.col("doc_id") != lowest, F.col("doc_id")))


def query(spark: SparkSession, sf: str) -> DataFrame:
    return remove_repeats(spark, spark.read.parquet(f"{sf}/documents.parquet"), with_bytes=False).drop("kept")
