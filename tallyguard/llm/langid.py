"""Language identification by a linear-chain conditional random field.

Every word of a text gets a distribution over the learned languages, so
code-switched texts are labelled word by word.  A word's features are the word
itself, its prefixes and suffixes, its character n-grams and whether it is in a
language's lexicon (words that are common in it and rare elsewhere); transitions
between languages are learned.  The chain is fitted by maximum likelihood on a
bounded sample: ``SAMPLE_DOCS`` documents of each language and ``WINDOWS``
windows of ``WINDOW_WORDS`` words of each; some training chains join windows of
different documents, which is where switches are learned from.  Prediction runs
forward-backward over all words of a text.

Defined cases: a null text or one without a letter is ``und`` with score 0; words
without letters are neutral; without any labelled row every text is ``und``;
ties take the first language by code point; repeated rows are judged one by one;
an empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import Steps, with_ids
from .words import SPACE, Prefix, U, mix, slices, small_batches, text_bytes, word_spans

SAMPLE_DOCS = 150
WINDOWS = 6
WINDOW_WORDS = 40
SWITCHED = 0.3  # share of training windows that continue another document's chain
LEXICON = 500
BUCKETS = 1 << 17
AFFIXES = (2, 3, 4)  # bytes, the mark at the word's end included
NGRAMS = (2, 3)
PART_BYTES = 4_000_000
ROUNDS = 40
UNKNOWN = "und"
CACHE = 500_000


def word_features(words: list[str], lexicon: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of lower-case words and the word that each belongs to.

    Affixes and n-grams are taken from the UTF-8 bytes between word marks.
    """
    marked = [f"<{word}>".encode("utf-8", "surrogatepass") for word in words]
    lengths = np.array([len(m) for m in marked], np.int64)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    spans = [(starts, ends)]
    spans += [(starts, np.minimum(starts + k, ends)) for k in AFFIXES]
    spans += [(np.maximum(ends - k, starts), ends) for k in AFFIXES]
    owners = [np.arange(len(words))] * len(spans)
    for k in NGRAMS:
        n = np.maximum(lengths - k + 1, 0)
        owner = np.repeat(np.arange(len(words)), n)
        at = starts[owner] + np.arange(int(n.sum())) - (np.cumsum(n) - n)[owner]
        spans.append((at, at + k))
        owners.append(owner)
    hashes = Prefix(np.frombuffer(b"".join(marked), np.uint8))
    ids = [mix(hashes.of(*span) + U(kind)) % U(BUCKETS) for kind, span in enumerate(spans)]
    listed = [(i, lexicon[word]) for i, word in enumerate(words) if word in lexicon]
    owners.append(np.array([i for i, _ in listed], np.int64))
    ids.append(mix(np.array([BUCKETS + y for _, y in listed], U)) % U(BUCKETS))
    return np.concatenate(ids).astype(np.int64), np.concatenate(owners)


def has_letter(word: str) -> bool:
    return any(c.isalpha() for c in word)


def posteriors(emit: np.ndarray, starts: np.ndarray, lengths: np.ndarray, move: np.ndarray, first: np.ndarray):
    """Forward-backward over many chains at once.

    ``emit`` has the (unnormalised) emission of each word; chains run from
    ``starts``.  Gives the distribution of each word, and forward, backward and
    scale, from which the expected transitions follow.
    """
    order = np.argsort(-lengths, kind="stable")
    begin, size = starts[order], lengths[order]
    longest = int(size[0]) if len(size) else 0
    active = np.searchsorted(-size, -np.arange(longest), "left")  # chains longer than t
    forward, backward = np.zeros_like(emit), np.ones_like(emit)
    scale = np.ones(len(emit))
    for t in range(longest):
        at = begin[: active[t]] + t
        a = emit[at] * (first if t == 0 else forward[at - 1] @ move)
        total = a.sum(axis=1)
        scale[at] = total
        forward[at] = a / total[:, None]
    for t in range(longest - 2, -1, -1):
        at = begin[: active[t + 1]] + t
        backward[at] = (emit[at + 1] * backward[at + 1]) @ move.T / scale[at + 1][:, None]
    both = forward * backward
    return both / both.sum(axis=1, keepdims=True), forward, backward, scale


class Chain:
    """Weights of the field: hashed features, transitions and first labels."""

    def __init__(self, languages: list[str], lexicon: dict[str, int]):
        n = len(languages)
        self.languages, self.lexicon = languages, lexicon
        self.weights = np.zeros((BUCKETS, n))
        self.moves, self.first = np.zeros((n, n)), np.zeros(n)

    def emission(self, features: np.ndarray, owner: np.ndarray, n_words: int) -> np.ndarray:
        columns = range(len(self.languages))
        return np.stack([np.bincount(owner, self.weights[features, y], n_words) for y in columns], axis=1)

    def fit(self, chains: list[list[tuple[str, int]]], rounds: int = ROUNDS, rate: float = 0.15) -> None:
        """Maximum likelihood with a small quadratic penalty, by Adam over all chains."""
        n = len(self.languages)
        words = sorted({word for chain in chains for word, _ in chain})
        number = {word: i for i, word in enumerate(words)}
        features, owner = word_features(words, self.lexicon)
        token = np.array([number[word] for chain in chains for word, _ in chain])
        label = np.array([y for chain in chains for _, y in chain])
        lengths = np.array([len(chain) for chain in chains])
        starts = np.cumsum(lengths) - lengths
        inner = np.ones(len(token), bool)
        inner[starts] = False
        at = np.flatnonzero(inner)
        gold = np.eye(n)[label]
        gold_moves = np.zeros((n, n))
        np.add.at(gold_moves, (label[at - 1], label[at]), 1)
        state = [[x, np.zeros_like(x), np.zeros_like(x)] for x in (self.weights, self.moves, self.first)]
        for step in range(1, rounds + 1):
            emit = self.emission(features, owner, len(words))[token]
            emit = np.exp(emit - emit.max(axis=1, keepdims=True))
            move, first = np.exp(self.moves), np.exp(self.first)
            gamma, forward, backward, scale = posteriors(emit, starts, lengths, move, first)
            right = emit[at] * backward[at] / scale[at][:, None]
            expected = move * (forward[at - 1].T @ right)
            gap = gold - gamma
            by_word = np.stack([np.bincount(token, gap[:, y], len(words)) for y in range(n)], axis=1)
            g = np.stack([np.bincount(features, by_word[owner, y], BUCKETS) for y in range(n)], axis=1)
            gradients = (g / len(token), (gold_moves - expected) / len(token), gap[starts].sum(axis=0) / len(token))
            for (x, m, v), grad in zip(state, gradients):
                grad = grad - 1e-7 * x
                m += 0.1 * (grad - m)
                v += 0.01 * (grad**2 - v)
                x += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)


class Labeller:
    """Language of whole texts; each different word's emission is computed once."""

    def __init__(self, chain: Chain):
        self.chain = chain
        self.known: dict[str, tuple[np.ndarray, bool]] = {}
        n = len(chain.languages)
        self.move, self.first = np.exp(chain.moves), np.exp(chain.first)
        self.neutral = np.ones(n)

    def _learn(self, units: list[str]) -> None:
        """Emissions of words that were not met before."""
        words = [unit.strip() for unit in units]
        total = self.chain.emission(*word_features(words, self.chain.lexicon), len(words))
        emit = np.exp(total - total.max(axis=1, keepdims=True)) + 1e-30
        for unit, word, row in zip(units, words, emit):
            self.known[unit] = (row, True) if has_letter(word) else (self.neutral, False)

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sum of word distributions of each text, number of words with letters,
        distribution of each word, and the first word of each text."""
        data, offsets = text_bytes(pc.utf8_lower(column))
        starts, _, first_word = word_spans(data, offsets, SPACE)
        cut = np.zeros(len(data) + 1, bool)
        cut[starts] = cut[offsets] = True
        bounds = np.flatnonzero(cut)
        units = pa.LargeStringArray.from_buffers(
            max(0, len(bounds) - 1), pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))
        )
        coded = units.dictionary_encode()
        if len(self.known) > CACHE:
            self.known.clear()
        different = coded.dictionary.to_pylist()
        new = [unit for unit in different if unit not in self.known]
        if new:
            self._learn(new)
        rows = [self.known[unit] for unit in different]
        n = len(self.chain.languages)
        if not len(starts):
            return np.zeros((len(column), n)), np.zeros(len(column)), np.zeros((0, n)), first_word
        code = coded.indices.to_numpy(zero_copy_only=False)[np.searchsorted(bounds, starts)]
        emit = np.array([row[0] for row in rows])[code]
        letters = np.array([row[1] for row in rows])[code]
        lengths = np.diff(first_word)
        some = np.flatnonzero(lengths)
        gamma, *_ = posteriors(emit, first_word[:-1][some], lengths[some], self.move, self.first)
        text = np.repeat(np.arange(len(column)), lengths)
        sums = np.stack([np.bincount(text, gamma[:, y] * letters, len(column)) for y in range(n)], axis=1)
        return sums, np.bincount(text, letters, len(column)), gamma, first_word


def windows_of(text: str) -> list[list[str]]:
    """At most ``WINDOWS`` windows of ``WINDOW_WORDS`` words with letters, spread over a text."""
    words = [w for w in text.lower().split() if has_letter(w)]
    spread = np.linspace(0, max(0, len(words) - WINDOW_WORDS), WINDOWS).astype(int)
    return [words[at : at + WINDOW_WORDS] for at in sorted(set(spread.tolist())) if words]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cut = pa.array([windows_of(text.as_py()) for text in batch.column("text")], pa.list_(pa.list_(pa.string())))
        yield pa.RecordBatch.from_arrays(
            [batch.column("lang"), batch.column("place"), batch.column("doc_id"), cut], ["lang", "place", "doc_id", "windows"]
        )


def training_rows(steps: Steps, docs: DataFrame, per_language: int = SAMPLE_DOCS) -> list:
    """The sample, on the driver: windows of at most ``per_language`` texts of each language.

    Rows are ranked by a hash, first within salted parts of a language, so a
    frequent language is not ranked in one task.  Of rows that repeat a doc_id
    one is used, and the windows are cut where the texts are.
    """
    place = F.xxhash64(F.col("doc_id"), F.lit("language"))
    usable = docs.where("lang IS NOT NULL AND text IS NOT NULL")
    rows = usable.select("doc_id", "lang", place.alias("place")).distinct()
    rows = rows.withColumn("salt", F.pmod("place", F.lit(64)))
    for keys in (["lang", "salt"], ["lang"]):
        w = Window.partitionBy(*keys).orderBy("place", "doc_id")
        rows = rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= per_language)
    found = with_ids(steps, usable, rows.select("doc_id"))
    found = found.groupBy("lang", place.alias("place"), "doc_id").agg(F.min(F.col("text").cast("string")).alias("text"))
    kind = found.schema["doc_id"].dataType.simpleString()
    cut = found.mapInArrow(_cut, f"lang string, place bigint, doc_id {kind}, windows array<array<string>>")
    return cut.orderBy("lang", "place", "doc_id").collect()


def learn(rows: list) -> Chain:
    """A chain fitted on (lang, windows) rows."""
    languages = sorted({row["lang"] for row in rows})
    number = {lang: i for i, lang in enumerate(languages)}
    windows, counts = [], [Counter() for _ in languages]
    for row in rows:
        for part in row["windows"]:
            counts[number[row["lang"]]].update(part)
            windows.append([(word, number[row["lang"]]) for word in part])
    lexicon = {}
    totals = [max(1, sum(c.values())) for c in counts]
    for y, count in enumerate(counts):
        for word, n in count.most_common(LEXICON):
            others = max((counts[z][word] / totals[z] for z in range(len(counts)) if z != y), default=0.0)
            if n >= 3 and n / totals[y] > 5 * others:
                lexicon[word] = y
    chain = Chain(languages, lexicon)
    random = np.random.default_rng(7)
    chains: list[list[tuple[str, int]]] = []
    for i in random.permutation(len(windows)):
        if chains and random.random() < SWITCHED and len(chains[-1]) < 4 * WINDOW_WORDS:
            chains[-1] = chains[-1] + windows[i]
        else:
            chains.append(windows[i])
    if chains:
        chain.fit(chains)
    return chain


def identify(spark: SparkSession, docs: DataFrame, chain: Chain | None) -> DataFrame:
    """doc_id, lang_pred, score, n_switches for each row; no column but the text is used."""
    small_batches(spark)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    shared = spark.sparkContext.broadcast(chain)
    schema = f"doc_id {rows.schema[0].dataType.simpleString()}, lang_pred string, score double, n_switches bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label = Labeller(shared.value) if shared.value is not None else None
        for batch in batches:
            for part in slices(batch, "text", PART_BYTES):
                names, scores, switches = [UNKNOWN] * part.num_rows, np.zeros(part.num_rows), np.zeros(part.num_rows)
                if label is not None:
                    sums, n, gamma, first = label(part.column("text"))
                    best = sums.argmax(axis=1)
                    known = n > 0
                    names = [label.chain.languages[y] if ok else UNKNOWN for y, ok in zip(best, known)]
                    scores = np.where(known, np.clip(sums.max(axis=1) / np.maximum(n, 1), 0, 1), 0.0)
                    word_best = gamma.argmax(axis=1)
                    changed = np.append(0, np.cumsum(word_best[1:] != word_best[:-1])) if len(word_best) else np.zeros(1)
                    last = np.maximum(first[1:] - 1, 0)
                    head = np.minimum(first[:-1], len(changed) - 1)
                    switches = np.where(np.diff(first) > 0, changed[last] - changed[head], 0)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64()),
                     pa.array(switches.astype(np.int64))],
                    ["doc_id", "lang_pred", "score", "n_switches"],
                )

    return rows.mapInArrow(run, schema)


def remainder(n: int):
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % n


def query(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    rows = training_rows(Steps(spark, "language"), docs.where(remainder(3) != 1))
    found = identify(spark, docs.select("doc_id", "text"), learn(rows) if rows else None)
    return found.select("doc_id", (remainder(3) == 1).alias("held_out"), "lang_pred", "score", "n_switches")
