"""The operators against brute force on small inputs with the odd cases in them."""

import hashlib
import math
import re
import tracemalloc
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyguard.llm.tables import Steps
from tallyguard.llm import decontaminate, html_main, katz, langid, licenses, mixing, neardup, quality, suffix

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h string, words int"
ORDER = list(quality.RULES)
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def prose(seed, n):
    return " ".join("w%d" % (zlib.crc32(f"{seed}-{i}".encode()) % 997) for i in range(n))


@pytest.fixture(scope="module")
def texts():
    base = prose(1, 300)
    near = base.split()
    near[50] = "changed"
    found = {
        1: base, 2: base, 3: " ".join(near), 4: None, 5: "", 6: "  \n", 7: "one two", 8: "one two",
        9: prose(2, 400), 10: prose(3, 60) + " " + base[:700], 11: "same line\n" * 40, 12: "é ü ñ " * 30,
        13: prose(4, 5000), 14: "### $$$ " * 50, 15: "Licensed under the MIT License.",
    }
    return found


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(k, v, "en" if k % 2 else None, None if k == 9 else f"s{k % 3}", 0, "x", 0) for k, v in texts.items()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_quality_figures(docs, texts):
    for row in quality.judge(docs, order=ORDER).collect():
        text, q = texts[row.doc_id] or "", row._q
        words = WORD.findall(text)
        grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
        inside = {i + k for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for k in range(5)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        assert (q.n_words, q.word_chars, q.n_repeat_words) == (len(words), sum(map(len, words)), len(inside))
        assert q.n_dup_lines == len(lines) - len(set(lines))
        assert q.n_symbols == sum(c in "#*$%&|<>" for c in text)
        assert row._base_failed == (len(words) < 10 or 100 * len(inside) > 20 * len(words))
    kept = {r.doc_id for r in quality.keep_good(docs, order=ORDER).collect()}
    assert kept == {r.doc_id for r in quality.judge(docs, order=ORDER).where("_kept").collect()} >= {1, 2, 3, 9, 13}
    assert quality.keep_good(docs, order=ORDER).columns == docs.columns and quality.keep_good(docs.limit(0), order=ORDER).isEmpty()


def test_mixture_meets_its_targets(spark, docs):
    rows = mixing.mix(spark, docs).collect()
    assert sum(r.size for r in rows) * 1.5 == pytest.approx(sum({r.source: r.target for r in rows}.values()))
    assert all(r.taken in (0, r.size, 2 * r.size) and r.target <= 2 * r.source_size for r in rows)
    taken = {r.doc_id: r.taken // r.size for r in rows if r.size}
    copies = Counter(r.doc_id for r in mixing.mixed_documents(spark, docs).where("size(split(trim(text), ' ')) > 0").collect())
    assert all(copies[k] == n for k, n in taken.items())
    assert mixing.mix(spark, docs.limit(0)).isEmpty()


def test_licence_expressions():
    assert licenses.parse("(MIT OR Apache-2.0) AND GPL-2.0 WITH x") == ["mit", "apache-2.0", "or", "gpl-2.0", "x", "with", "and"]
    assert licenses.parse("MIT OR") is None and licenses.parse("(MIT") is None and licenses.parse("") is None
    assert licenses.scan("SPDX-License-Identifier: MIT OR CC-BY-NC-4.0")["restricted"] is False
    assert licenses.scan("SPDX-License-Identifier: MIT AND CC-BY-NC-4.0")["restricted"] is True
    got = licenses.scan("MIT license, mit License; the Lesser General Public License")
    assert (got["n_base"], got["first_word"], got["last_word"], got["base_labels"]) == (3, 0, 6, "gpl,mit")
    assert got["labels"] == "gpl,lgpl,mit" and licenses.scan(None)["score"] == 0.0
    assert licenses.scan("submit license")["n_base"] == 0


def test_columns_may_have_any_names(spark, docs):
    odd = docs.selectExpr("*", "1 AS _qt", "2 AS _qw", "3 AS _q", "4 AS _q_n_words", "5 AS _kept", "6 AS _gone", "7 AS id", "8 AS c0")
    kept = quality.keep_good(odd, order=ORDER)
    assert kept.columns == odd.columns and kept.select("_qt", "_q", "_q_n_words", "_kept", "c0").distinct().collect() == [(1, 3, 4, 5, 8)]
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in quality.keep_good(docs, order=ORDER).collect()}
    judged = quality.judge(odd, order=ORDER)
    assert {(r._qt, r._gone, r.c0) for r in judged.collect()} == {(1, 6, 8)} and judged.where("_kept").count() == kept.count()
    bench = spark.createDataFrame([(1, prose(9, 30))], "item_id long, text string")
    assert decontaminate.clean_documents(spark, odd, bench).columns == odd.columns


def test_near_duplicates_and_links(spark, docs):
    classes = {r.doc_id: r.class_id for r in neardup.duplicate_classes(spark, docs).collect()}
    assert classes[1] == classes[2] == classes[3] == 1 and classes[8] == classes[7] == 7
    assert all(classes[k] == k for k in classes if k not in (2, 3, 8))
    assert {r.doc_id for r in neardup.one_of_each(spark, docs).collect()} == set(classes) - {2, 3, 8}
    assert neardup.duplicate_classes(spark, docs.limit(0)).isEmpty()


def test_no_text_is_lost_by_its_id(spark):
    """Repeated and null ids, and columns with the names that are used inside."""
    a, b = prose(31, 40), prose(32, 40)
    schema = "doc_id long, text string, fp string, row int, id int, digest int, keep_id int, node int"

    def kept(rows):
        frame = spark.createDataFrame([(k, t, "x", 1, 2, 3, 4, 5) for k, t in rows], schema).repartition(3)
        out = neardup.one_of_each(spark, frame)
        assert out.columns == frame.columns
        return sorted(((r.doc_id, r.text) for r in out.collect()), key=str)

    assert kept([(5, a), (5, b), (9, a), (2, b)]) == sorted([(5, a), (2, b)], key=str)
    assert kept([(None, a), (None, a), (3, b)]) == sorted([(None, a), (3, b)], key=str)
    assert kept([(None, a), (7, a), (7, a), (8, None), (8, None), (8, " ")]) == sorted(
        [(7, a), (8, None), (8, None), (8, " ")], key=str
    )


def test_pivots_find_what_all_pairs_find(spark, monkeypatch):
    """Chains, hubs and loners; the classes are those of all pairs at 0.8, whether or not pivots are tried."""
    import random

    rnd, found = random.Random(4), {}
    for group in range(6):
        words = prose(50 + group, 120).split()
        for member in range(12):
            if group % 2:
                words = list(words)
            edited = words if group % 2 else list(words)
            for _ in range(rnd.randint(0, 3)):
                edited[rnd.randrange(120)] = "e%d" % rnd.randrange(10**6)
            found[group * 100 + rnd.randrange(100)] = " ".join(edited)
    ids = sorted(found)
    near = neardup.similarities(pa.array([found[a] for a in ids for _ in ids]), pa.array([found[b] for _ in ids for b in ids]))
    root = {a: a for a in ids}
    for (a, b), s in zip(((a, b) for a in ids for b in ids), near):
        if s >= 0.8 and root[a] != root[b]:
            low, high = sorted((root[a], root[b]))
            root = {k: low if v == high else v for k, v in root.items()}
    rows = spark.createDataFrame(list(found.items()), "doc_id long, text string").repartition(3)
    for pivots in (0, neardup.PIVOTS):
        monkeypatch.setattr(neardup, "PIVOTS", pivots)
        assert {r.doc_id: r.class_id for r in neardup.duplicate_classes(spark, rows).collect()} == root


def test_samples_collide_as_the_similarity(spark):
    """Shares of equal samples of two weighted sets against their weighted Jaccard similarity."""
    rng = np.random.default_rng(8)
    hashes = np.sort(rng.integers(0, 1 << 44, 300).astype(np.uint64))
    a, b = np.where(np.arange(300) < 240, 1, 3), np.where(np.arange(300) < 240, 1, 1 + np.arange(300) % 4)
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    equal = total = 0
    for trial in range(40):
        shifted = np.sort(neardup.mix(hashes + np.uint64(trial)) >> np.uint64(20))
        row = np.repeat([0, 1], 300)
        _, bands = neardup.signatures(row, np.tile(shifted, 2), np.ones(600), np.concatenate([a, b]))
        equal += (bands[0] == bands[1]).sum()
        total += bands.shape[1]
    assert abs(equal / total - want**neardup.ROWS) < 0.05


@pytest.mark.parametrize("appended", [False, True])
def test_near_duplicates_of_a_common_text(spark, appended):
    """A third of the rows are one text with edits of their own that leave 0.80 to 0.85 of it."""
    base = prose(20, 304).split()
    found = {1000: " ".join(base)}
    for i in range(60):
        words = list(base)
        if appended:
            words += ["new%d-%d" % (i, k) for k in range(56 + i % 18)]
        else:
            for k in range(5 + i % 2):
                words[20 + 50 * k] = "new%d-%d" % (i, k)
        found[i] = " ".join(words)
    found |= {2000 + i: prose(100 + i, 300) for i in range(120)}
    near = neardup.similarities(pa.array([found[1000]] * 60), pa.array([found[i] for i in range(60)]))
    assert 0.8 <= near.min() and near.max() < 0.86
    rows = spark.createDataFrame(list(found.items()), "doc_id long, text string").repartition(3)
    classes = {r.doc_id: r.class_id for r in neardup.duplicate_classes(spark, rows).collect()}
    assert classes == {i: i if i >= 2000 else 0 for i in found}


def test_weighted_jaccard():
    a, b = "a b c d e f a b c d e", "a b c d e f g"
    grams = lambda t: Counter(tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4))
    x, y = grams(a), grams(b)
    want = sum((x & y).values()) / sum((x | y).values())
    assert neardup.similarities(pa.array([a, a, ""]), pa.array([b, a, ""])).tolist() == pytest.approx([want, 1.0, 0.0])


def test_repeated_bytes(spark, docs, texts):
    seen, want = set(), {}
    for doc in sorted(texts):
        data = (texts[doc] or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - 99):
            if data[i : i + 100] in seen:
                gone[i : i + 100] = b"\1" * 100
            seen.add(data[i : i + 100])
        kept = bytes(x for x, g in zip(data, gone) if not g)
        runs = sum(gone[i] and not (i and gone[i - 1]) for i in range(len(gone)))
        want[doc] = (len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest(), kept)
    got = suffix.remove_repeats(spark, docs).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) for r in got} == want
    assert suffix.remove_repeats(spark, docs.limit(0)).isEmpty()


def test_contaminated_documents(spark):
    item = prose(9, 30)
    words = item.split()
    for i in (6, 13, 22):
        words[i] = "other"
    rows = [(1, f"{prose(10, 50)} {item.upper()}. {prose(11, 9)}"), (2, prose(12, 80)), (3, " ".join(words)), (4, None), (5, ""),
            (6, "the"), (7, "the end"), (1, prose(60, 30)), (None, item), (None, prose(61, 20)), (3, " ".join(words))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, item), (2, None), (3, "the"), (4, prose(13, 6))], "item_id long, text string")
    found = {(r.doc_id, r.item_id): r.n_equal for r in decontaminate.find_overlaps(spark, docs, bench).collect()}
    assert found == {(1, 1): 30, (3, 1): 27, (None, 1): 30, (6, 3): 1, (7, 3): 1}
    kept = sorted(((r.doc_id, r.text) for r in decontaminate.clean_documents(spark, docs, bench).collect()), key=str)
    assert kept == sorted([rows[1], rows[3], rows[4], rows[6], rows[7], rows[9]], key=str)
    assert decontaminate.find_overlaps(spark, docs, bench.limit(0)).isEmpty()
    assert decontaminate.find_overlaps(spark, docs.limit(0), bench).isEmpty()


def overlap_by_hand(words, item):
    """Score of the best stretch over all shifts, and equal words over places that lie together."""
    score, places = 0, {}
    for shift in range(-len(item) + 1, len(words)):
        run = 0
        same = {i for i in range(len(item)) if 0 <= shift + i < len(words) and words[shift + i] == item[i]}
        for i in range(len(item)):
            if 0 <= shift + i < len(words):
                run = max(0, run + (1 if i in same else -1))
                score = max(score, run)
        places[shift] = same
    return score, max((len(same) for same in places.values()), default=0)


def test_contamination_against_all_places(spark):
    import random

    rnd = random.Random(11)
    items = {i: ["b%d" % rnd.randrange(400) for _ in range(n)] for i, n in enumerate([5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 20, 30])}
    rows = {}
    for i, item in items.items():
        for k in range(12):
            part = list(item[rnd.randrange(len(item) // 2) if k % 3 == 2 else 0 :])
            for at in rnd.sample(range(len(part)), min(len(part), k // 2)):
                part[at] = "s%d" % rnd.randrange(10**6)
            rows[i * 100 + k] = ["x%d" % rnd.randrange(50) for _ in range(k)] + part + ["x%d" % rnd.randrange(50) for _ in range(5)]
    docs = spark.createDataFrame([(k, " ".join(v)) for k, v in rows.items()], "doc_id long, text string")
    bench = spark.createDataFrame([(k, " ".join(v)) for k, v in items.items()], "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.score, r.n_equal) for r in decontaminate.find_overlaps(spark, docs, bench).collect()}
    want = {}
    for k, words in rows.items():
        for i, item in items.items():
            score, equal = overlap_by_hand(words, item)
            if score >= 10 or equal >= math.ceil(0.8 * len(item)):
                want[k, i] = score
    assert got.keys() == want.keys() and all(got[key][0] == score for key, score in want.items())


def test_a_dropped_word_does_not_hide_an_item(spark):
    item = prose(70, 16).split()
    rows = [(1, " ".join(item[:8] + item[9:])), (2, " ".join(item[:8] + ["new"] + item[8:])), (3, " ".join(item[:8])), (4, " ".join(item[8:]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    found = {r.doc_id: r.n_equal for r in decontaminate.find_overlaps(spark, docs, bench).collect()}
    assert found == {1: 15, 2: 16}


def test_masks_leave_no_pattern_without_a_hit():
    import itertools

    def hit(equal, masks):
        return any(
            all(equal[at + i] for i, bit in enumerate(mask) if bit == "1")
            for mask in masks
            for at in range(len(equal) - len(mask) + 1)
        )

    for n, changed in [(10, 0), (12, 1), (14, 2), (16, 3), (18, 4), (20, 5), (22, 6)]:  # score 10 each
        missed = sum(
            not hit([i not in gone for i in range(n)], decontaminate.MASKS) for gone in map(set, itertools.combinations(range(n), changed))
        )
        assert missed == 0, (n, changed, missed)
    for n in range(decontaminate.SHORTEST, decontaminate.LONG):
        for gone in map(set, itertools.combinations(range(n), n - math.ceil(0.8 * n))):
            assert hit([i not in gone for i in range(n)], decontaminate.SHORT_MASKS), (n, gone)


@pytest.mark.parametrize(("frequent", "rel"), [(katz.FREQUENT, 1e-6), (400, 1e-3)])
def test_katz_equals_one_loop(spark, docs, texts, monkeypatch, frequent, rel):
    monkeypatch.setattr(katz, "FREQUENT", frequent)
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in texts}
    tokens = {d: WORD.findall(lower(t or "")) + [None] for d, t in texts.items()}
    c = Counter(w for d in tokens if not held[d] for w in tokens[d])
    pairs = Counter(p for d in tokens if not held[d] for p in zip(["<s>", *tokens[d]], tokens[d]))
    n, v = sum(c.values()), len(c)
    counts = lambda x: [0] + [sum(y == r for y in x.values()) for r in range(1, 7)]
    d1, d2 = katz.discounts(counts(c)), katz.discounts(counts(pairs))
    lost = sum((1 - d1[min(x, 6)]) * x for x in c.values()) / n
    unknown = max(lost, 1 / (n + 1))
    p1 = lambda w: d1[min(c[w], 6)] * c[w] / n * (1 - unknown) / (1 - lost) if c[w] else unknown
    after: dict = {}
    for (h, w), k in pairs.items():
        after.setdefault(h, []).append((w, k))
    total = 0.0
    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    got = {r.doc_id: r for r in katz.score(spark, docs.select("doc_id", "text", held_out.alias("held_out"))).collect()}
    for d, row in got.items():
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens[d])
        assert (row.n_tokens, row.n_known, row.train_tokens) == (len(tokens[d]), sum(c[w] > 0 for w in tokens[d]), n)
        assert row.base_score == pytest.approx(base)
        want = 0.0
        for h, w in zip(["<s>", *tokens[d]], tokens[d]):
            seen = after.get(h, [])
            size = sum(k for _, k in seen)
            mass = sum((1 - d2[min(k, 6)]) * k for _, k in seen) / max(size, 1)
            scale = 1.0
            if size and mass < 1 / (size + 1):
                scale, mass = (1 - 1 / (size + 1)) / (1 - mass), 1 / (size + 1)
            k = pairs[h, w]
            weight = mass / (1 - sum(p1(x) for x, _ in seen)) if size else 1.0
            want += math.log10(d2[min(k, 6)] * k * scale / size) if k else math.log10(weight * p1(w))
        total += abs(want)
        # Rare words share the mean of their bucket, here nearly always one word.
        assert row.score == pytest.approx(want, rel=rel)
    assert total > 0 and katz.score(spark, docs.limit(0).select("doc_id", "text", F.lit(True).alias("held_out"))).isEmpty()


@pytest.mark.parametrize("frequent", [katz.FREQUENT, 400, 32])
def test_katz_keeps_rare_words_apart(spark, monkeypatch, frequent):
    """Rare words whose hashes end in the same 20 bits have their own P1, also after a history that is split ("the")."""
    words, same = ["x%d" % i for i in range(60000)], {}
    for word, token in zip(words, katz.token_pairs(pa.array([" ".join(words)]))[1].tolist()):
        same.setdefault(token % (1 << 20), []).append(word)
    pool = [word for found in same.values() if len(found) > 1 for word in found]
    texts = {i: " ".join("the " + pool[zlib.crc32(b"%d-%d" % (i, k)) ** 2 % 9973 % (3 + k)] for k in range(300)) for i in range(1, 31)}
    texts |= {100 + i: " ".join(pool[zlib.crc32(b"%d.%d" % (i, k)) % 400] for k in range(200)) for i in range(10)}
    texts |= {200: None, 201: "never seen the never"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    test_katz_equals_one_loop(spark, docs, texts, monkeypatch, frequent, 1e-9)


def test_katz_task_holds_sums_by_document_not_tokens():
    """The memory of a task that scores many classes is that of one class, a document's sums and the packed blocks."""
    classes, n = 24, 40_000
    rnd = np.random.default_rng(1)
    model = katz.Unigrams(np.arange(50, dtype=np.uint64), np.full(50, 9), 0.01, 0.001, {})
    figures = {f"n{r}": 1000 // r**2 for r in range(1, katz.MOST_DISCOUNTED + 2)}

    def batches(of):
        for k in range(of):
            h, w = (np.sort(rnd.integers(0, 1 << 39, n).astype(np.uint64)) for _ in range(2))
            d = rnd.integers(0, 100, n)
            block = katz._encode(h, w, d, np.ones(n, np.int64), np.arange(100), np.zeros(100, np.uint8))
            yield pa.RecordBatch.from_pylist([{"p": k, "block": block, **figures}])

    def most(of):
        given = list(batches(of))
        tracemalloc.start()
        rows = [r for b in katz._score_pairs(SimpleNamespace(value=model), classes)(iter(given)) for r in b.to_pylist()]
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        sums = [katz._split(pa.py_buffer(r["block"]), 2) for r in rows if r["kind"] == katz._SUM]
        assert sorted(x for a, _ in sums for x in np.cumsum(katz._from_planes(a, np.int64))) == list(range(100))
        return peak

    assert most(classes) < 1.3 * most(4)


def test_languages_word_by_word(spark):
    a = ["alpha" + x for x in "abcdefgh"]
    b = ["über" + x for x in "stuvwxyz"]
    rows = [{"lang": "a", "text": " ".join(a * 8)}, {"lang": "b", "text": " ".join(b * 8)}]
    rows = [{"lang": row["lang"], "windows": langid.windows_of(row["text"])} for row in rows]
    chain = langid.learn(rows * 6)
    texts = [(1, " ".join(a * 3)), (2, " ".join(a * 2 + b * 9)), (3, None), (4, "12 !"), (5, "")]
    got = {r.doc_id: r for r in langid.identify(spark, spark.createDataFrame(texts, "doc_id long, text string"), chain).collect()}
    assert [got[i].lang_pred for i in range(1, 6)] == ["a", "b", "und", "und", "und"]
    assert got[2].n_switches == 1 and 0 < got[2].score < got[1].score <= 1 and got[3].score == 0
    assert langid.identify(spark, spark.createDataFrame(texts, "doc_id long, text string"), None).where("lang_pred <> 'und'").isEmpty()


def test_minimum_cut_equals_all_labellings():
    odds, edges = [2.0, -0.5, 1.0, -3.0, -0.2], [(0, 1, 0.6), (1, 2, 0.6), (2, 3, 0.5), (3, 4, 0.6), (0, 2, 0.3)]

    def cost(keep):
        ends = sum(x for x, k in zip(odds, keep) if x > 0 and not k) - sum(x for x, k in zip(odds, keep) if x < 0 and k)
        return ends + sum(w for a, b, w in edges if keep[a] != keep[b])

    every = [[bool(i >> k & 1) for k in range(5)] for i in range(32)]
    assert cost(html_main.minimum_cut(odds, edges)) == pytest.approx(min(map(cost, every)))


def test_main_text(spark):
    page = (
        "<title>T</title><header><a href=/>Home</a></header><nav><ul><li><a>Menu</a></ul></nav><div id=content><h1>A &amp; B</h1>"
        "<p>First   para\nwith <a href=x>a link</a> in a sentence.<p>Second.</p><div class='ad'>Buy, buy now, it is cheap.</div></div>"
        "<aside>More here, long enough for text.</aside><section id=comments><p>I liked it a lot, thank you.</p></section><footer>&copy;"
    )
    rows = [(1, "u", page), (2, "v", None), (3, "w", ""), (4, "x", "<p"), (5, "y", "<script>a<b</script>")]
    got = html_main.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert got[0].text == "A & B\nFirst para with a link in a sentence.\nSecond." and got[0].n_chars == len(got[0].text)
    assert [r.text for r in got[1:]] == [""] * 4


@pytest.mark.parametrize("raw", [
    "<script>for(i=0;i<n;i++){f(i)}</script>", "<script>if (a<b && c>'d') x = \"it's</p>\";</SCRIPT >",
    "<script><!-- document.write('x')</script>", "<script><!--\nvar s = '<script>f()</script>';\n--></script>",
    "<style>/* don't <!-- */ a<b{}</style>", "<title>a <b 'c</title>", "<noscript><style>a<b</style></noscript>",
    "<form><textarea><!-- a<b 'c</textarea></form>", "<svg><style>a</style><title/></svg>", "<script>a<!-->b</script>",
])
def test_main_text_after_raw_elements(raw):
    article = "<article><p>The article has a sentence that is long enough.</p><script>x</script><p>It has another.</p></article>"
    kept = [text for text, good in html_main.label_blocks(f"<html><body>{raw}{article}</body></html>") if good]
    assert kept == ["The article has a sentence that is long enough.", "It has another."]


def test_markup_never_becomes_text():
    page = (
        "<article><p title=it's>Second sentence of some length goes here, as it were.</p>"
        "<p class='a>b' data-x=\"<p>\">Third one, a < b, is longer still and ends as it should.</p></ >"
        "<p a=b'c\"d>Fourth one has odd values, and it is just as long as the others.</p></article><nav><a href=x>menu</a></nav>"
        '<p title="never closed> tail </p> and more'
    )
    kept = [text for text, good in html_main.label_blocks(page) if good]
    assert kept == [
        "Second sentence of some length goes here, as it were.",
        "Third one, a < b, is longer still and ends as it should.",
        "Fourth one has odd values, and it is just as long as the others.",
    ]


@pytest.mark.parametrize(
    "page",
    [
        lambda n: "<a " * n + '"',
        lambda n: "<div>" * n + "text",
        lambda n: "<div>" * n + "</b>" * n,
        lambda n: "<span>" * n + "<i><li>x</li>" * n,
        lambda n: ("<p>" + "This is a paragraph of content. " * 9 + "</p><nav>menu</nav>") * (n // 10),
        lambda n: "<!-" * n + "x='" * n,
    ],
)
def test_reading_time_follows_the_length(page):
    import time

    def seconds(n):
        start = time.perf_counter()
        html_main.label_blocks(page(n))
        return time.perf_counter() - start

    seconds(1000)
    assert seconds(32_000) < 8 * seconds(8000) + 0.5


def test_blocking_flow_equals_all_labellings():
    import itertools
    import random

    rnd = random.Random(3)
    for _ in range(60):
        n = rnd.randint(1, 8)
        odds = [rnd.choice([-3, -1, -0.5, 0.4, 1, 2.5]) for _ in range(n)]
        edges = [(i, i + 1, 0.5) for i in range(n - 1)] + [(a, b, 0.7) for a, b in itertools.combinations(range(n), 2) if rnd.random() < 0.3]

        def cost(keep, odds=odds, edges=edges):
            return sum(abs(x) for x, k in zip(odds, keep) if (x > 0) != k) + sum(w for a, b, w in edges if keep[a] != keep[b])

        found = html_main.minimum_cut(odds, edges)
        assert cost(found) == pytest.approx(min(cost(k) for k in itertools.product([False, True], repeat=n)))


def test_pages_of_an_empty_table(spark):
    assert html_main.main_text(spark.createDataFrame([], "page_id long, url string, html string")).isEmpty()


def test_licences_against_a_loop():
    import random

    rnd = random.Random(2)
    vocabulary = ["MIT", "mit", "License", "license", "apache", "general", "public", "é", "the", "MIT-License"]
    for _ in range(300):
        text = "".join(rnd.choice(vocabulary) + rnd.choice([" ", ".", "\n", "-", ""]) for _ in range(rnd.randint(0, 30)))
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
        places = [
            (i, label)
            for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
            for i in range(len(words))
            if words[i : i + len(phrase.split())] == phrase.split()
        ]
        got = licenses.scan(text)
        assert (got["n_words"], got["n_base"]) == (len(words), len(places))
        assert (got["first_word"], got["last_word"]) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert got["base_labels"] == ",".join(sorted({label for _, label in places}))
        assert set(got["base_labels"].split(",")) <= set(got["labels"].split(",")) and 0 <= got["score"] <= 1


def test_licences_of_long_and_empty_inputs(spark):
    import time

    start = time.perf_counter()
    assert licenses.scan("mit license " * 100_000)["n_base"] == 100_000 and time.perf_counter() - start < 20
    assert licenses.scan_licenses(spark.createDataFrame([], "doc_id long, text string")).isEmpty()


def test_forward_backward_against_all_labellings():
    import itertools

    rng = np.random.default_rng(6)
    lengths = np.array([1, 4, 3])
    starts = np.cumsum(lengths) - lengths
    emit, move, first = rng.random((8, 3)) + 0.1, rng.random((3, 3)) + 0.1, rng.random(3) + 0.1
    gamma, *_ = langid.posteriors(emit, starts, lengths, move, first)
    for start, length in zip(starts, lengths):
        want = np.zeros((length, 3))
        for path in itertools.product(range(3), repeat=int(length)):
            weight = first[path[0]] * np.prod([emit[start + t, y] for t, y in enumerate(path)])
            weight *= np.prod([move[a, b] for a, b in zip(path, path[1:])])
            for t, y in enumerate(path):
                want[t, y] += weight
        assert gamma[start : start + length] == pytest.approx(want / want.sum(axis=1, keepdims=True))


def test_language_sample_is_bounded(spark):
    rows = [(1, "a b " * 5000, "x")] * 40 + [(i, f"word{i} more", "x" if i % 2 else "y") for i in range(2, 60)] + [(None, "a", None), (61, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    found = langid.training_rows(Steps(spark, "sample"), docs, 10)
    assert sorted(r.lang for r in found) == ["x"] * 10 + ["y"] * 10
    assert all(len(r.windows) <= langid.WINDOWS and all(len(w) <= langid.WINDOW_WORDS for w in r.windows) for r in found)
    assert langid.training_rows(Steps(spark, "sample"), docs.limit(0)) == []


def test_pipeline_accounts_for_every_document(spark, tmp_path):
    """Rejected, copied, contaminated or packed: each document has one fate."""
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    pytest.importorskip("public_tokenizers")
    item = prose(9, 30)
    good = {i: prose(200 + i, 60) for i in range(12)}
    found = [(i, t, "en", "s1", 0) for i, t in good.items()]
    found += [(100, good[3], "en", "s1", 0), (3, good[4], "en", "s2", 0), (101, "too short", "en", "s1", 0), (102, None, None, None, 0)]
    found += [(103, prose(80, 40) + " " + item + " " + prose(81, 30), "en", "s1", 0), (None, prose(82, 50), "en", None, 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(found, schema).repartition(3)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:3]:
        kept = Steps(spark, name).write(stage(spark, kept, str(tmp_path)))
    assert kept.columns == docs.columns
    texts = sorted(r.text for r in kept.collect())
    assert texts == sorted([*good.values(), prose(82, 50)])
    assert not corpus_pipeline.run(spark, str(tmp_path)).isEmpty()
