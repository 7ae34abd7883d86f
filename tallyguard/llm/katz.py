"""Scores of a Katz backoff bigram model, learned from and evaluated over whole texts.

Tokens are the words of a text (lower-cased A-Z, between ASCII white space) and
one end token; the first word's history is a start mark.

P(w | h) is d(c) c(h w) / c(h) for a bigram seen in training, where d is the
Good-Turing discount of counts up to 5, and a(h) P1(w) otherwise.  The weight
a(h) is the discounted mass over 1 - sum of P1 over the successors of h, so the
distribution after every history sums to one.  P1 is Good-Turing discounted in
the same way; what it takes away is the probability of an unknown word.  Words
rarer than one token in ``FREQUENT`` are not in the table that every task needs,
which keeps that at a fixed size.  Their P1 stays in a table partitioned by word
and is joined to the tokens that back off to it and, where a history with a
backed-off token has rare successors, to these before a(h) is formed.

Bigrams are kept in tables partitioned by history; a history with more than half
a partition's share of tokens is split by successor.  Each token is sent once to
the partition of its history as part of a packed block, counted there, scored
there, and summed by document.  Hashes have 64 bits for words and 40 bits for
the successors of one history.

Defined cases: null and empty texts have the end token alone; rows that repeat a
doc_id are one document in several rows and share one score, the sum over them;
without training text every score but n_tokens is that of an empty model; an
empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import Steps
from .words import LOWER, Prefix, U, mix, slices, small_batches, text_bytes, word_spans

MOST_DISCOUNTED = 5
FREQUENT = 1 << 21
BLOCK_TOKENS = 1_000_000
START, END = U(0x1234567890ABCDEF), U(0x0FEDCBA987654321)
W40 = U((1 << 40) - 1)
BLOCK = "p int, block binary"
_BLOCK = pa.schema([("p", pa.int32()), ("block", pa.binary())])


def token_pairs(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """History, token and row of every token."""
    data, offsets = text_bytes(column)
    data = LOWER[data]
    starts, ends, bounds = word_spans(data, offsets)
    row = np.repeat(np.arange(len(column)), np.diff(bounds))
    token = np.full(len(starts) + len(column), END, U)
    token[np.arange(len(starts)) + row] = Prefix(data).of(starts, ends)
    history = np.empty_like(token)
    history[1:] = token[:-1]
    history[bounds[:-1] + np.arange(len(column))] = START
    return history, token, np.repeat(np.arange(len(column)), np.diff(bounds) + 1)


def _planes(x: np.ndarray) -> bytes:
    """Bytes by significance; the high ones are mostly zero and compress away."""
    x = np.ascontiguousarray(x)
    return x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes()


def _from_planes(raw: memoryview, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(kind).ravel()


def _join(parts: list[bytes]) -> bytes:
    return np.array([len(p) for p in parts], "<i8").tobytes() + b"".join(parts)


def _split(raw: pa.Buffer, n: int) -> list[memoryview]:
    ends = 8 * n + np.cumsum(np.frombuffer(raw[: 8 * n], "<i8"))
    return [memoryview(raw)[a:b] for a, b in zip([8 * n, *ends[:-1]], ends)]


def _buffers(column: pa.Array) -> list[pa.Buffer]:
    """The blocks of a batch where they lie, not copied."""
    return [block.as_buffer() for block in column]


def _sum_by(keys: list[np.ndarray], values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order, and the sum of the values of each."""
    found, place = np.unique(np.concatenate(keys), return_inverse=True)
    return found, np.bincount(place, np.concatenate(values), len(found))


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for x in columns:
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def _lengths(starts: np.ndarray, total: int) -> np.ndarray:
    return np.diff(np.append(starts, total))


# Word counts: every task sends its different words once to their partition.


def _count_words(classes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def blocks() -> Iterator[pa.RecordBatch]:
            words = np.concatenate(held)
            held.clear()
            words.sort()
            at = _runs(words)
            words, counts = words[at], _lengths(at, len(words))
            p = (mix(words) % U(classes)).astype(np.int64)
            order = np.argsort(p, kind="stable")
            cuts = np.searchsorted(p[order], np.arange(classes + 1))
            for k in range(classes):
                own = order[cuts[k] : cuts[k + 1]]
                if len(own):
                    parts = [_planes(np.diff(words[own], prepend=U(0))), _planes(counts[own].astype(np.uint32))]
                    yield pa.RecordBatch.from_pydict({"p": [k], "block": [_join(parts)]}, schema=_BLOCK)

        for batch in batches:
            for part in slices(batch, "text"):
                _, token, _ = token_pairs(part.column("text"))
                held.append(token)
                n += len(token)
                if n >= 2 * BLOCK_TOKENS:
                    yield from blocks()
                    n = 0
        if held:
            yield from blocks()

    return run


def _sum_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[int, list[pa.Buffer]] = {}
    for batch in batches:
        for p, block in zip(batch.column(0).to_pylist(), _buffers(batch.column(1))):
            found.setdefault(p, []).append(block)
    for blocks in found.values():
        split = [_split(block, 2) for block in blocks]
        words = np.concatenate([np.cumsum(_from_planes(a, U), dtype=U) for a, _ in split])
        counts = np.concatenate([_from_planes(b, np.uint32) for _, b in split]).astype(np.int64)
        order = np.argsort(words, kind="stable")
        at = _runs(words[order])
        yield pa.RecordBatch.from_pydict(
            {"w": words[order][at].view(np.int64), "c": np.add.reduceat(counts[order], at)}
        )


def discounts(n: list[int]) -> np.ndarray:
    """Good-Turing discounts by count 0..MOST_DISCOUNTED + 1 from counts of counts n[1..]; 1 where undefined."""
    k, d = MOST_DISCOUNTED, np.ones(MOST_DISCOUNTED + 2)
    if n[1] <= 0 or (k + 1) * n[k + 1] >= n[1]:
        return d
    rest = (k + 1) * n[k + 1] / n[1]
    for r in range(1, k + 1):
        if n[r] > 0 and n[r + 1] > 0:
            value = ((r + 1) * n[r + 1] / (r * n[r]) - rest) / (1 - rest)
            if 0 < value < 1:
                d[r] = value
    return d


class Unigrams:
    """P1 of the frequent words, and the histories that are split."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, unknown: float, scale: float, parts: dict[int, int]):
        order = np.argsort(words & W40)
        self.full, self.words, self.counts = words[np.argsort(words)], (words & W40)[order], counts[order]
        self.probability = counts[order] * scale
        self.unknown = unknown
        self.full_counts = counts[np.argsort(words)]
        self.split = np.array(sorted(parts), U)
        self.parts = np.array([parts[h] for h in sorted(parts)], np.int64)
        self.split_counts = np.zeros(len(parts))

    def find(self, words: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(table):
            return np.zeros(len(words), np.int64), np.zeros(len(words), bool)
        at = np.minimum(np.searchsorted(table, words), len(table) - 1)
        return at, table[at] == words

    def of(self, words40: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P1 of words (0 for rare ones) and which are frequent."""
        at, frequent = self.find(words40, self.words)
        return (np.where(frequent, self.probability[at], 0.0) if len(self.words) else np.zeros(len(words40))), frequent


# Bigrams: every token goes to the partition of its history.


def _send_pairs(shared, classes: int):
    """Blocks of (history, token, document, times) and rows of rare words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        held, n, docs, flags = [], 0, [], []

        def blocks() -> Iterator[pa.RecordBatch]:
            h, w, d = (np.concatenate(x) for x in zip(*held))
            held.clear()
            w &= W40
            p = mix(h)
            at, is_split = model.find(h, model.split)
            if is_split.any():
                p[is_split] += mix(w[is_split] % model.parts[at[is_split]].astype(U) + U(1))
            p = (p % U(classes)).astype(np.int32)
            order = np.lexsort((w, h, p))
            # One column after the other, so that only one is there twice.
            h = h[order]
            w = w[order]
            d = d[order]
            p = p[order]
            del order
            at = _runs(p, h, w, d)
            times, h, w, d, p = _lengths(at, len(h)), h[at], w[at], d[at], p[at]
            cuts = np.searchsorted(p, np.arange(classes + 1))
            ids, held_out = np.array(docs, np.int64), np.array(flags, np.uint8)
            for k in range(classes):
                own = slice(cuts[k], cuts[k + 1])
                if cuts[k] < cuts[k + 1]:
                    yield pa.RecordBatch.from_pydict(
                        {"p": [k], "block": [_encode(h[own], w[own], d[own], times[own], ids, held_out)]}, schema=_BLOCK
                    )

        for batch in batches:
            for part in slices(batch, "text"):
                h, w, row = token_pairs(part.column("text"))
                held.append((h, w, (row + len(docs)).astype(np.uint32)))
                docs += part.column("doc_id").to_pylist()
                flags += part.column("held_out").to_pylist()
                n += len(h)
                if n >= BLOCK_TOKENS:
                    yield from blocks()
                    n, docs, flags = 0, [], []
        if held:
            yield from blocks()

    return run


def _encode(h, w, d, times, ids, held_out) -> bytes:
    pair = _runs(h, w)
    first = _runs(h[pair])
    used, d = np.unique(d, return_inverse=True)
    w5 = np.ascontiguousarray(w[pair]).view(np.uint8).reshape(-1, 8)[:, :5].tobytes()
    return _join([
        _planes(np.diff(h[pair][first], prepend=U(0))), _planes(_lengths(first, len(pair)).astype(np.uint32)),
        w5, _planes(_lengths(pair, len(h)).astype(np.uint32)), _planes(d.astype(np.uint32)),
        _planes(times.astype(np.uint32)), _planes(np.diff(ids[used], prepend=0)), held_out[used].tobytes(),
    ])


def _decode(block: pa.Buffer):
    a = _split(block, 8)
    w5 = np.frombuffer(a[2], np.uint8).reshape(-1, 5)
    w = np.zeros((len(w5), 8), np.uint8)
    w[:, :5] = w5
    pairs, entries = _from_planes(a[1], np.uint32), _from_planes(a[3], np.uint32)
    h = np.repeat(np.cumsum(_from_planes(a[0], U), dtype=U), pairs)
    d = _from_planes(a[4], np.uint32)
    ids, held_out = np.cumsum(_from_planes(a[6], np.int64)), np.frombuffer(a[7], np.uint8)
    return (np.repeat(h, entries), np.repeat(w.view(U).ravel(), entries), ids[d], held_out[d].astype(bool),
            _from_planes(a[5], np.uint32).astype(np.int64))


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The merged table of each partition, sorted by history and successor, and its columns after the block."""
    found: dict[int, list[pa.Buffer]] = {}
    extra: list = []
    for batch in batches:
        for p, block in zip(batch.column(0).to_pylist(), _buffers(batch.column(1))):
            found.setdefault(p, []).append(block)
        if batch.num_columns > 2 and batch.num_rows and not extra:
            extra = batch.slice(0, 1).to_pylist()
    for p in sorted(found):
        h, w, doc, held_out, times = (np.concatenate(x) for x in zip(*map(_decode, found.pop(p))))
        order = np.lexsort((w, h))
        # One column after the other, so that only one is there twice.
        h = h[order]
        w = w[order]
        doc = doc[order]
        held_out = held_out[order]
        times = times[order]
        del order
        pair = _runs(h, w)
        count = np.add.reduceat(np.where(held_out, 0, times), pair)
        yield h, w, doc, times, pair, count, extra[0] if extra else None


def _counts_of_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(MOST_DISCOUNTED + 2, np.int64)
    for *_, count, _ in _tables(batches):
        total += np.bincount(np.minimum(count, MOST_DISCOUNTED + 2), minlength=MOST_DISCOUNTED + 3)[:-1]
    yield pa.RecordBatch.from_pydict({"r": np.arange(len(total), dtype=np.int32), "n": total})


SCORED = "kind int, key bigint, doc_id bigint, n double, value double, block binary"
_SUM, _RARE, _SPLIT, _LATE, _WEIGHT, _TAKEN = range(6)


def _score_pairs(shared, classes: int):
    """Sums by document, packed; what needs another partition's knowledge goes out as rows.

    ``_RARE``: an unseen bigram with a rare word, known or not; ``_SPLIT`` and
    ``_LATE``: an unseen bigram after a split history and after one with rare
    successors; ``_WEIGHT``: the parts of a(h) of these histories known here, and
    ``_TAKEN``: their rare successors.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, ids, total = shared.value, np.zeros(0, np.int64), np.zeros(0)
        for h, w, doc, times, pair, count, extra in _tables(batches):
            d = discounts([0] + [extra[f"n{r}"] for r in range(1, MOST_DISCOUNTED + 2)])
            first = _runs(h[pair])
            n_pairs = _lengths(first, len(pair))
            history = h[pair][first]
            at, is_split = model.find(history, model.split)
            size = np.add.reduceat(count, first).astype(float)
            if is_split.any():
                size[is_split] = model.split_counts[at[is_split]]
            p1, frequent = model.of(w[pair])
            discount = d[np.minimum(count, MOST_DISCOUNTED + 1)]
            seen = count > 0
            kept_size = np.maximum(size, 1)
            mass = np.add.reduceat((1 - discount) * count, first) / kept_size
            taken = np.add.reduceat(np.where(seen, p1, 0.0), first)
            rare_seen = seen & ~frequent
            is_late = np.logical_or.reduceat(~seen, first) & np.logical_or.reduceat(rare_seen, first) & ~is_split
            open_ = is_split | is_late
            # Without a discounted successor, a share of one in c(h) + 1 is set apart.
            least = 1 / (kept_size + 1)
            plain = (mass < least) & ~is_split
            scale = np.where(plain, (1 - least) / np.maximum(1 - mass, 1e-12), 1.0)
            mass = np.where(plain, least, mass)
            weight = np.where(size > 0, mass / np.maximum(1 - taken, model.unknown), 1.0)
            of_pair = np.repeat(np.arange(len(first)), n_pairs)
            log = np.empty(len(pair))
            log[seen] = np.log10(discount[seen] * count[seen] * scale[of_pair[seen]] / size[of_pair[seen]])
            back = ~seen
            log[back] = np.log10(np.where(open_, 1.0, weight)[of_pair[back]]) + np.log10(np.where(frequent, p1, 1.0)[back])
            entry = np.repeat(np.arange(len(pair)), _lengths(pair, len(h)))
            ids, total = _sum_by([ids, doc], [total, log[entry] * times])
            rare = (back & ~frequent)[entry]
            if rare.any():
                yield _rows(_RARE, w[rare].view(np.int64), doc[rare], times[rare], np.zeros(rare.sum()))
            for kind, which in ((_SPLIT, is_split), (_LATE, is_late)):
                wait = (back & which[of_pair])[entry]
                if wait.any():
                    yield _rows(kind, h[wait].view(np.int64), doc[wait], times[wait], np.zeros(wait.sum()))
            if open_.any():
                here = history[open_].view(np.int64)
                yield _rows(_WEIGHT, here, is_split[open_].astype(np.int64), mass[open_], taken[open_])
                of = rare_seen & open_[of_pair]
                yield _rows(_TAKEN, w[pair][of].view(np.int64), h[pair][of].view(np.int64), count[of], np.zeros(of.sum()))
        if len(ids):
            p = (mix(ids.astype(U)) % U(classes)).astype(np.int64)
            order = np.argsort(p, kind="stable")
            cuts = np.searchsorted(p[order], np.arange(classes + 1))
            for k in range(classes):
                own = order[cuts[k] : cuts[k + 1]]
                if len(own):
                    block = _join([_planes(np.diff(ids[own], prepend=0)), total[own].tobytes()])
                    yield _rows(_SUM, np.array([k]), np.zeros(1, np.int64), [0], [0], [block])

    return run


def _sum_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up the packed sums of each document."""
    ids, values = [], []
    for batch in batches:
        for block in _buffers(batch.column(1)):
            a, b = _split(block, 2)
            ids.append(np.cumsum(_from_planes(a, np.int64)))
            values.append(np.frombuffer(b, float))
    if ids:
        doc, value = _sum_by(ids, values)
        yield pa.RecordBatch.from_pydict({"doc_id": doc, "value": value})


def _rows(kind: int, key, doc, n, value, block=None) -> pa.RecordBatch:
    columns = [pa.array(np.full(len(key), kind, np.int32)), pa.array(np.ascontiguousarray(key)), pa.array(doc)]
    columns += [pa.array(np.asarray(n, float)), pa.array(np.asarray(value, float))]
    columns.append(pa.array(block or [None] * len(key), pa.binary()))
    return pa.RecordBatch.from_arrays(columns, ["kind", "key", "doc_id", "n", "value", "block"])


def _frequent_tokens(shared):
    """For each document its tokens, those known among the frequent, and their base; rare words as rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                _, token, row = token_pairs(part.column("text"))
                at, frequent = model.find(token, model.full)
                doc = part.column("doc_id").to_numpy(zero_copy_only=False)
                n = np.bincount(row, minlength=part.num_rows)
                log = np.log10(model.full_counts[at[frequent]] + 1.0)
                yield _rows(-1, n.astype(np.int64), doc, np.bincount(row[frequent], minlength=part.num_rows),
                            np.bincount(row[frequent], log, part.num_rows))
                token, row = token[~frequent], row[~frequent]
                order = np.lexsort((token, row))
                token, row = token[order], row[order]
                starts = _runs(row, token)
                times = _lengths(starts, len(row))
                yield _rows(0, token[starts].view(np.int64), doc[row[starts]], times, np.zeros(len(starts)))

    return run


def score(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Scores of rows (doc_id, text, held_out); rows that are not held out are learned from.

    doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.
    """
    small_batches(spark)
    steps = Steps(spark, "katz")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("doc_id"), F.col("text").cast("string").alias("text"), "held_out"
    )
    classes = 4 * parts
    train = docs.where(~F.col("held_out")).select("text")
    words = train.mapInArrow(_count_words(classes), BLOCK).repartition(parts, "p")
    words = steps.write(words.mapInArrow(_sum_words, "w bigint, c bigint"))

    # Figures of the word counts; the frequent words have a fixed size.
    n_r = [F.count(F.when(F.col("c") == r, 1)).alias(f"n{r}") for r in range(1, MOST_DISCOUNTED + 2)]
    row = words.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v"), *n_r).first()
    n, v = row["n"], row["v"]
    d = discounts([0] + [row[f"n{r}"] for r in range(1, MOST_DISCOUNTED + 2)])
    unknown = sum((1 - d[r]) * r * row[f"n{r}"] for r in range(1, MOST_DISCOUNTED + 1)) / max(n, 1)
    rest = 1 - unknown
    unknown = max(unknown, 1 / (n + 1))
    scale = (1 - unknown) / rest / max(n, 1) if rest > 0 else 0.0
    discounted = F.col("c") * F.element_at(F.array(*[F.lit(float(x)) for x in d]), F.least("c", F.lit(MOST_DISCOUNTED + 1)).cast("int") + 1)
    often = F.col("c") * F.lit(FREQUENT) >= F.lit(n)
    top = words.where(often).select("w", "c", discounted.alias("m")).toArrow()
    w, c = top.column("w").to_numpy().view(U), top.column("c").to_numpy()
    n_train = int(c[w == END][0]) if (w == END).any() else docs.where(~F.col("held_out")).count()
    share = max(1.0, n / classes)
    hot = {int(x): int(np.ceil(y / share)) for x, y in zip(w, c) if y > share and x != END}
    if n_train > share:
        hot[int(START)] = int(np.ceil(n_train / share))
    model = Unigrams(w, c, unknown, scale, hot)
    model.probability = top.column("m").to_numpy()[np.argsort(w & W40)] * scale
    known = {**{int(x): float(y) for x, y in zip(w, c)}, int(START): float(n_train)}
    model.split_counts = np.array([known[h] for h in sorted(hot)])
    shared = spark.sparkContext.broadcast(model)

    # Exact counts: frequent words on the spot, the others by a join on the word.
    tokens = steps.write(docs.mapInArrow(_frequent_tokens(shared), SCORED))
    rare = tokens.where("kind = 0").join(words, F.col("key") == F.col("w"))
    base = tokens.where("kind < 0").select("doc_id", F.col("key").alias("n_tokens"), F.col("n").alias("n_known"), "value").unionByName(
        rare.select("doc_id", F.lit(0).cast("long").alias("n_tokens"), F.col("n").alias("n_known"), (F.col("n") * F.log10(F.col("c") + 1.0)).alias("value"))
    )

    # The blocks are dealt out once; both uses read the same exchange.
    pairs = docs.mapInArrow(_send_pairs(shared, classes), BLOCK).repartition(parts, "p")
    counted = pairs.mapInArrow(_counts_of_counts, "r int, n bigint")
    n_r = counted.agg(*[F.sum(F.when(F.col("r") == r, F.col("n"))).alias(f"n{r}") for r in range(1, MOST_DISCOUNTED + 2)])
    scored = steps.write(pairs.crossJoin(F.broadcast(n_r)).mapInArrow(_score_pairs(shared, classes), SCORED))
    sums = scored.where(F.col("kind") == _SUM).select(F.col("key").cast("int").alias("p"), "block")
    sums = sums.repartition(parts, "p").mapInArrow(_sum_documents, "doc_id bigint, value double")
    zero = F.lit(0).cast("long")
    back = scored.where(F.col("kind") == _RARE).withColumnRenamed("key", "w40")
    w40 = F.col("w").bitwiseAND(F.lit(int(W40)))
    rare_p1 = steps.write(words.where(~often).groupBy(w40.alias("k40")).agg((F.sum(discounted) * F.lit(scale)).alias("p1")))
    back = back.join(rare_p1, F.col("w40") == F.col("k40"), "left")
    back = back.select("doc_id", (F.col("n") * F.log10(F.coalesce("p1", F.lit(unknown)))).alias("value"))
    # a(h) of the histories left open: the parts from every partition, and P1 of the rare successors.
    taken = scored.where(F.col("kind") == _TAKEN).join(rare_p1, F.col("key") == F.col("k40"))
    taken = taken.select(F.col("doc_id").alias("key"), F.lit(0.0).alias("mass"), F.col("p1").alias("taken"), zero.alias("split"))
    known_here = scored.where(F.col("kind") == _WEIGHT).select("key", F.col("n").alias("mass"), F.col("value").alias("taken"), F.col("doc_id").alias("split"))
    weights = known_here.unionByName(taken).groupBy("key").agg(F.sum("mass").alias("mass"), F.sum("taken").alias("taken"), F.max("split").alias("split"))
    alpha = F.greatest("mass", F.lit(1e-12)) / F.greatest(1 - F.col("taken"), F.lit(unknown))
    weights = steps.write(weights.select(F.col("key").alias("h"), F.log10(alpha).alias("log_alpha"), "split"))
    # Split histories are at most twice the classes; the others have no more tokens than a partition's share.
    split = scored.where(F.col("kind") == _SPLIT).join(F.broadcast(weights.where("split = 1")), F.col("key") == F.col("h"))
    late = scored.where(F.col("kind") == _LATE).join(weights.where("split = 0"), F.col("key") == F.col("h"))
    late = split.unionByName(late).select("doc_id", (F.col("n") * F.col("log_alpha")).alias("value"))
    parts_ = [x.select("doc_id", zero.alias("n_tokens"), F.lit(0.0).alias("n_known"), F.lit(0.0).alias("base"), F.col("value").alias("score")) for x in (sums, back, late)]
    every = base.select("doc_id", "n_tokens", "n_known", F.col("value").alias("base"), F.lit(0.0).alias("score"))
    for x in parts_:
        every = every.unionByName(x)
    total = every.groupBy("doc_id").agg(*[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base", "score")])
    keys = docs.select("doc_id", "held_out").withColumnRenamed("doc_id", "_doc")
    return keys.join(total, F.col("_doc") == F.col("doc_id")).select(
        "doc_id", "held_out", "n_tokens", F.col("n_known").cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * F.lit(float(np.log10(n + 1.0 * (v + 1))))).alias("base_score"), "score",
    )


def query(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 == 2
    return score(spark, docs.select("doc_id", "text", held_out.alias("held_out")))
