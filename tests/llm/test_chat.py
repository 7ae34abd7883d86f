"""Chat formatting: exact round trips of odd turns, and the SQL on a small table."""

import hashlib
import random

from tallyguard.llm import chat
from tests.oracle import differences

SCHEMA = "conv_id long, turn long, role string, text string, turns int, pieces string"
PARTS = ["<s>", "</s>", "[INST]", "[/INST]", " [NEXT] ", " </s>", "[", "<", "\\", "s>", "INST]", "[OUT] ", " ", "\n", "é", "$1", "[TEXT]", "x"]


def odd_rows():
    rnd = random.Random(5)
    rows = []
    for conv in range(120):
        for turn in range(rnd.randint(1, 7)):
            text = "".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 9)))
            role = rnd.choice(["user", "assistant", "system", "tool", " [TEXT] ", "[ROLE] <s>", "", None])
            rows.append((conv if conv else None, rnd.choice([turn, 1, None]), role, rnd.choice([text, text, None]), 0, "p"))
    rows += rows[:3]  # repeated rows
    return rows


def by_hand(rows):
    found = {}
    for conv, turn, role, text, *_ in rows:
        found.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {conv: [(r, t) for _, _, r, t in sorted(turns)] for conv, turns in found.items()}


def test_round_trip(spark):
    rows = odd_rows()
    done = chat.formatted(spark.createDataFrame(rows, SCHEMA).repartition(3))
    read = {r.conv_id: r for r in done.select("*", chat.turns_of(done["formatted"]).alias("turns")).collect()}
    want = by_hand(rows)
    assert read.keys() == want.keys()
    for conv, r in read.items():
        assert [tuple(t) for t in r.turns] == want[conv]
        merged = 1 + sum(a[0] != b[0] for a, b in zip(want[conv], want[conv][1:]))
        closings = sum(r.formatted.count(c) for c in (" [/SYS]", " [/INST]", " </s>", " [/ROLE]"))
        assert closings == merged and r.formatted.count("<s>") == 1
        spans = [r.formatted[s.start : s.start + s.length] for s in r.loss]
        assert len(spans) == sum(role == "assistant" for role, _ in want[conv])
    for r in chat.digests(done).collect():
        turns = want[r.conv_id]
        trained = "".join(t for role, t in turns if role == "assistant")
        assert r.n_turns == len(turns) and r.loss_chars == len(trained)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(trained.encode()).hexdigest()
        assert r.formatted_chars == len(read[r.conv_id].formatted)


def test_plain_conversation(spark):
    rows = [(1, 2, "assistant", "Hello"), (1, 1, "user", "Hi"), (1, 0, "system", "Be kind"), (1, 3, "assistant", "again")]
    row = chat.formatted(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).first()
    assert row.formatted == "<s>[SYS] Be kind [/SYS][INST] Hi [/INST][OUT] Hello [NEXT] again </s>"
    assert [row.formatted[s.start : s.start + s.length] for s in row.loss] == ["Hello", "again"]


def test_long_conversation_and_empty_table(spark):
    turns = [(9, i, "user" if i % 3 else "assistant", f"text {i} é") for i in range(5000)] + [(8, 0, "user", "a" * 300_000)]
    done = chat.digests(chat.formatted(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")))
    found = {r.conv_id: r for r in done.collect()}
    said = "".join(t for c, _, r, t in turns if r == "assistant")
    assert found[9].n_turns == 5000 and found[9].loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert (found[8].n_turns, found[8].loss_chars, found[8].formatted_chars) == (1, 0, 300_000 + 3 + 7 + 8)
    assert chat.formatted(spark.createDataFrame([], SCHEMA)).isEmpty()


def test_query_and_sql(spark, tmp_path):
    import duckdb

    rows = [r[:4] for r in odd_rows()]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    found = chat.query(spark, str(tmp_path))
    assert found.columns == ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    assert differences(con, found, chat.ORACLE_SQL) == []
    assert found.where("conv_id = -7").first().loss_chars == len(chat.PROBE_TEXT)
