"""Token packing: exact tokens, exact round trip, and the best fit."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from tallyguard.llm.packing import (
    END, Tokenizer, best_fit_decreasing, default_vocabulary, encoding, pack, write_matrices,
)
from tallyguard.session import work_folder


@pytest.fixture(scope="module")
def vocabulary():
    pytest.importorskip("public_tokenizers")
    return default_vocabulary()


def test_units_give_the_tokens_of_the_whole_text(vocabulary):
    rnd = random.Random(1)
    parts = [" ", "  ", "\n", "\t", "a", "bc", "'s", "1", "é", ".", "!?", "\x1c", "\x0b", "\r\n", "ß", "漢字", "\x85", "\xa0", " "]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 12))) for _ in range(4000)] + [None, ""]
    ids, bounds = Tokenizer(vocabulary)(pa.array(texts))
    encode = encoding(vocabulary).encode_ordinary
    for i, text in enumerate(texts):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == encode(text or ""), repr(text)


def test_known_words_take_little_memory(vocabulary):
    """Ids of known words are packed, the oldest words go, and the ids stay those of the encoder."""
    tokenizer, encode = Tokenizer(vocabulary), encoding(vocabulary).encode_ordinary
    tokenizer(pa.array(["warm up"]))
    tracemalloc.start()
    for k in range(5):
        texts = [" ".join(f"the w{k}{i}x{j}" for j in range(100)) for i in range(700)]
        ids, bounds = tokenizer(pa.array(texts))
        assert ids[bounds[5] : bounds[6]].tolist() == encode(texts[5])
        del texts, ids, bounds
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 50e6, held


def test_best_fit_equals_a_search_over_all_rows():
    rnd = random.Random(2)
    for capacity in (1, 7, 50):
        lengths = [rnd.randint(1, capacity) for _ in range(300)]
        rooms = []
        for n in sorted(lengths, reverse=True):
            fits = [r for r in range(len(rooms)) if rooms[r] >= n]
            if fits:
                rooms[min(fits, key=lambda r: rooms[r])] -= n
            else:
                rooms.append(capacity - n)
        rows = best_fit_decreasing(lengths, capacity)
        assert sorted(capacity - sum(lengths[i] for i in row) for row in rows) == sorted(rooms)
        assert sorted(i for row in rows for i in row) == list(range(300))


def unpacked(rows, width):
    documents = {}
    for row in rows:
        ids, positions = (np.frombuffer(row[c], "<u4") for c in ("ids", "position_ids"))
        ends = row["cu_seqlens"]
        assert len(ids) == len(positions) == width and ends[-1] == row["n_tokens"] <= width
        for doc, offset, a, b in zip(row["doc_ids"], row["offsets"], ends, ends[1:]):
            assert positions[a:b].tolist() == list(range(b - a))
            documents.setdefault(doc, []).append((offset, ids[a:b].tolist()))
    return {doc: [i for _, part in sorted(parts) for i in part] for doc, parts in documents.items()}


def test_round_trip(spark, vocabulary):
    texts = {1: "one two", 2: None, 3: "", 4: "word " * 500, 5: "ñandú\n\nzwei"}
    schema = "ids string, doc_id long, text string, key int"
    docs = spark.createDataFrame([("x", k, v, 0) for k, v in texts.items()], schema)
    packed = pack(docs, row_tokens=64)
    rows = packed.collect()
    got, decode = unpacked(rows, 64), encoding(vocabulary).decode
    assert {k: decode(v[:-1]) for k, v in got.items()} == {k: v or "" for k, v in texts.items()}
    assert all(v[-1] == END for v in got.values())
    assert pack(docs.limit(0)).count() == 0

    folder = work_folder(spark, "matrices")
    write_matrices(packed, folder, rows=3)
    matrices = spark.read.parquet(folder).collect()
    assert sum(m["n_rows"] for m in matrices) == len(rows)
    assert all(len(m["ids"]) == 4 * 64 * m["n_rows"] for m in matrices)
