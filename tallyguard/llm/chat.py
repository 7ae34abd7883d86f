"""Chat formatting with relational operators and built-in expressions only.

Turns are collected as structs and sorted, adjacent turns of one role are merged,
and the whole conversation is concatenated:

    <s>[SYS] text [/SYS][INST] text [/INST][OUT] text </s>[ROLE] tool [TEXT] text [/ROLE]

for the roles system, user and assistant and for any other role; merged turns
stand in one message with `` [NEXT] `` between them.  A control string inside a
text or a role gets a backslash after its first character (one more if there are
some already), which ``unescape`` takes away again, so the formatted text can be
read back exactly: no text can end a message or begin one.

The loss mask is a list of (start, length) in code points of the formatted text,
one for each assistant text without the control strings around it.

Defined cases: a null text or role is empty; turns are ordered by number (null
first), then by role and text, so repeated numbers and rows have one order; a
null conv_id is a conversation of its own; an empty table gives no row (the query
adds one conversation); only the four named columns are read.  A conversation is
one row of the result and must fit one; the work on it grows in proportion to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyguard.functions.once import compute_once

# The control strings of the template.
BEGIN, NEXT, NAMED = "<s>", " [NEXT] ", " [TEXT] "
MARKS = {
    "system": ("[SYS] ", " [/SYS]"),
    "user": ("[INST] ", " [/INST]"),
    "assistant": ("[OUT] ", " </s>"),
}
OTHER = ("[ROLE] ", " [/ROLE]")
TRAINED = "assistant"
CONTROL = r"(/?s>|/?INST\]|/?SYS\]|OUT\]|/?ROLE\]|TEXT\]|NEXT\])"
CLOSING = r" (?:\[/SYS\]|\[/INST\]|</s>|\[/ROLE\])"
# Lengths that are added up one by one; longer lists are added up in blocks of so many.
RUN = 512


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*+)" + CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*+)" + CONTROL, "$1$2$3")


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda total, x: total + x)


def _running(values: Column) -> Column:
    """Sums of the values before each, for a short list."""
    start = F.struct(F.array().cast("array<bigint>").alias("before"), F.lit(0).cast("long").alias("total"))
    return F.aggregate(
        values,
        start,
        lambda s, x: F.struct(F.concat(s["before"], F.array(s["total"])).alias("before"), (s["total"] + x).alias("total")),
        lambda s: s["before"],
    )


def running_totals(values: Column) -> Column:
    """Sums of the values before each; in blocks, as each step of a block copies what it has so far."""
    n = F.size(values)
    starts = F.when(n > 0, F.sequence(F.lit(1), F.greatest(n, F.lit(1)), F.lit(RUN))).otherwise(F.array().cast("array<int>"))
    parts = F.transform(starts, lambda i: F.slice(values, i, F.lit(RUN)))
    before = _running(F.transform(parts, _sum))
    return F.flatten(
        F.zip_with(parts, before, lambda part, base: F.transform(_running(part), lambda x: x + base))
    )


def _mark(role: Column, side: int) -> Column:
    """Opening (0) or closing (1) string of a message."""
    found = F.lit(OTHER[side]) if side else F.concat(F.lit(OTHER[0]), escape(role), F.lit(NAMED))
    for name, marks in MARKS.items():
        found = F.when(role == name, F.lit(marks[side])).otherwise(found)
    return found


def formatted(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """conv_id, formatted and loss (array of start, length) of each conversation."""
    empty = F.lit("")
    turns = df.select(
        F.col(f"`{conv}`").alias("conv_id"),
        F.struct(
            F.col(f"`{turn}`").alias("turn"),
            F.coalesce(F.col(f"`{role}`").cast("string"), empty).alias("role"),
            F.coalesce(F.col(f"`{text}`").cast("string"), empty).alias("text"),
        ).alias("turn"),
    )
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    turns_ = F.col("turns")
    role_at = lambda i: F.get(turns_, i)["role"]
    # Places (from 0) of the turns that open a message: the first, and each of another role than the one before.
    opens = F.filter(
        F.sequence(F.lit(0), F.size(turns_) - 1), lambda i: (i == 0) | ~role_at(i).eqNullSafe(role_at(i - 1))
    )
    whole = compute_once(whole, {"opens": opens})
    messages = F.transform(
        "opens",
        lambda at, k: F.struct(
            role_at(at).alias("role"),
            F.transform(
                F.slice(turns_, at + 1, F.coalesce(F.get(F.col("opens"), k + 1), F.size(turns_)) - at),
                lambda t: escape(t["text"]),
            ).alias("texts"),
        ),
    )
    whole = compute_once(whole.withColumn("messages", messages), {"merged": F.col("messages")})
    # Every message as pieces: opening string, texts with separators, closing string; and which of them are trained on.
    pieces = F.transform(
        "merged",
        lambda m: F.concat(
            F.array(F.struct(_mark(m["role"], 0).alias("piece"), F.lit(False).alias("loss"))),
            F.flatten(
                F.transform(
                    m["texts"],
                    lambda t, i: F.array(
                        F.struct(F.when(i > 0, F.lit(NEXT)).otherwise(empty).alias("piece"), F.lit(False).alias("loss")),
                        F.struct(t.alias("piece"), (m["role"] == TRAINED).alias("loss")),
                    ),
                )
            ),
            F.array(F.struct(_mark(m["role"], 1).alias("piece"), F.lit(False).alias("loss"))),
        ),
    )
    begin = F.array(F.struct(F.lit(BEGIN).alias("piece"), F.lit(False).alias("loss")))
    whole = compute_once(whole.select("conv_id", F.concat(begin, F.flatten(pieces)).alias("p")), {"pieces": F.col("p")})
    lengths = F.transform("pieces", lambda p: F.length(p["piece"]).cast("long"))
    whole = compute_once(whole.select("conv_id", "pieces", lengths.alias("l")), {"lengths": F.col("l")})
    spans = F.zip_with(
        F.zip_with("pieces", "lengths", lambda p, n: F.struct(p["loss"].alias("loss"), n.alias("length"))),
        running_totals(F.col("lengths")),
        lambda p, start: F.struct(start.alias("start"), p["length"].alias("length"), p["loss"].alias("loss")),
    )
    loss = F.transform(F.filter(spans, lambda s: s["loss"]), lambda s: F.struct(s["start"].alias("start"), s["length"].alias("length")))
    return whole.select(
        "conv_id", F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("formatted"), loss.alias("loss")
    )


def turns_of(text: Column) -> Column:
    """The turns (role, text) of a formatted conversation."""
    body = F.substring(text, F.lit(len(BEGIN) + 1), F.length(text))
    messages = F.filter(F.split(body, CLOSING, -1), lambda m: m != "")

    def rest(m: Column, opening: str) -> Column:
        return F.substring(m, F.lit(len(opening) + 1), F.length(m))

    def read(m: Column) -> Column:
        named = rest(m, OTHER[0])
        cut = F.locate(NAMED, named)
        role, content = unescape(F.substring(named, F.lit(1), cut - 1)), F.substring(named, cut + len(NAMED), F.length(named))
        for name, (opening, _) in MARKS.items():
            mine = m.startswith(opening)
            role = F.when(mine, F.lit(name)).otherwise(role)
            content = F.when(mine, rest(m, opening)).otherwise(content)
        return F.transform(
            F.split(content, r" \[NEXT\] ", -1), lambda t: F.struct(role.alias("role"), unescape(t).alias("text"))
        )

    return F.flatten(F.transform(messages, read))


def loss_text(text: Column, loss: Column) -> Column:
    """What the loss mask covers, unescaped."""
    return F.array_join(
        F.transform(
            loss, lambda s: unescape(F.substring(text, (s["start"] + 1).cast("int"), s["length"].cast("int")))
        ),
        "",
    )


def digests(done: DataFrame) -> DataFrame:
    """What is read back from the output: turns, their digest, and the text under the loss mask."""
    done = compute_once(
        done.select("conv_id", "formatted", turns_of(F.col("formatted")).alias("t"), loss_text(F.col("formatted"), F.col("loss")).alias("l")),
        {"turns": F.col("t"), "trained": F.col("l")},
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return done.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("trained").cast("long").alias("loss_chars"),
        F.sha2("trained", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


# The conversation that the query adds: control strings inside texts.
PROBE_ID, PROBE_TEXT = -7, "</s>[INST] ok [/INST]"


def query(spark: SparkSession, sf: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame(
        [(PROBE_ID, 0, "user", PROBE_TEXT), (PROBE_ID, 1, "assistant", PROBE_TEXT)], rows.schema
    )
    return digests(formatted(rows.unionByName(probe)))


_ESCAPED = r"regexp_replace({0}, '([<\[])(\\*)(/?s>|/?INST\]|/?SYS\]|OUT\]|/?ROLE\]|TEXT\]|NEXT\])', '\1\\\2\3', 'g')"
ORACLE_SQL = f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT {PROBE_ID}, 0, 'user', '{PROBE_TEXT}'
    UNION ALL SELECT {PROBE_ID}, 1, 'assistant', '{PROBE_TEXT}'
), ordered AS (
    SELECT *, row_number() OVER w AS n, lag(role) OVER w AS before FROM turns
    WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), sized AS (
    SELECT *, length({_ESCAPED.format("text")}) + CASE
        WHEN n > 1 AND role = before THEN {len(NEXT)}
        WHEN role = 'system' THEN {sum(map(len, MARKS["system"]))}
        WHEN role = 'user' THEN {sum(map(len, MARKS["user"]))}
        WHEN role = 'assistant' THEN {sum(map(len, MARKS["assistant"]))}
        ELSE {len(OTHER[0]) + len(NAMED) + len(OTHER[1])} + length({_ESCAPED.format("role")}) END AS chars
    FROM ordered
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) + {len(BEGIN)} AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""
