"""Quality rules as a short-circuit cascade, in built-in expressions only.

Every document gets the base figures of its whole text.  The verdict is the
conjunction of all rules, so their order changes the time and never the result:
cost and rejection rate of each rule are measured on a bounded sample, and the
cascade asks first the rule that rejects most per second.

Defined cases: a null or empty text has no words, figures 0, and is rejected by
the length rule; repeated rows are judged one by one; an empty table gives an
empty result; columns of the input may have any names, because all work is done
on columns known by their place (``judge`` alone replaces columns that have the
names of its results).
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyguard.functions.once import compute_once

SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\f\r"
# The symbols that are counted.
SYMBOLS = "#*$%&|<>"
WINDOW = 5
# Rows that the cost and selectivity of the rules are measured on.
SAMPLE_ROWS = 1000


def words(text: Column) -> Column:
    """Words of a text that is not null, as an array."""
    inner = F.btrim(text, F.lit(SPACE_CHARS))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SPACE))


def _with_text(df: DataFrame, text: str) -> DataFrame:
    """Adds ``_qt``, the text without null, and ``_qw``, its words."""
    return df.withColumn("_qt", F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))).withColumn(
        "_qw", words(F.col("_qt"))
    )


def _grams(hashes: Column) -> Column:
    """Hash of each window of five words, from the hashes of the words."""
    return F.transform(
        F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - (WINDOW - 1), F.lit(0))),
        lambda x, i: F.xxhash64(x, *[F.get(hashes, i + k) for k in range(1, WINDOW)]),
    )


def _n_repeat_words(df: DataFrame) -> tuple[DataFrame, Column]:
    """Number of words inside windows found twice or more.

    Only a text whose windows are not all different pays for the position sort:
    equal windows become neighbours, and each covers the words up to the next
    one's start or its own end.
    """
    df = df.withColumn("_qh", F.transform("_qw", lambda x: F.xxhash64(x)))
    df = df.withColumn("_qg", _grams(F.col("_qh")))
    g, pairs = F.col("_qg"), F.col("_qp")
    df = df.withColumn(
        "_qp",
        F.when(
            F.size(F.array_distinct(g)) < F.size(g),
            F.sort_array(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    hash_at = lambda i: F.get(pairs, i)["h"]
    repeated = F.filter(
        pairs,
        lambda x, i: F.coalesce(x["h"] == hash_at(i - 1), F.lit(False))
        | F.coalesce(x["h"] == hash_at(i + 1), F.lit(False)),
    )
    df = df.withColumn("_qs", F.sort_array(F.transform(repeated, lambda x: x["i"])))
    starts = F.col("_qs")
    covered = F.aggregate(
        F.transform(
            starts,
            lambda s, i: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, i + 1), s + WINDOW) - s),
        ),
        F.lit(0),
        lambda total, n: total + n,
    )
    return df, F.coalesce(covered, F.lit(0))


def _lines(df: DataFrame) -> DataFrame:
    if "_ql" in df.columns:
        return df
    lines = F.filter(F.split(F.col("_qt"), "\n"), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != "")
    return df.withColumn("_ql", lines)


# How each figure is found; a builder may first add helper columns.
FIGURES = {
    "n_words": lambda df: (df, F.size("_qw")),
    "word_chars": lambda df: (df, F.length(F.array_join("_qw", ""))),
    "n_symbols": lambda df: (df, F.length(F.regexp_replace("_qt", f"[^{SYMBOLS}]+", ""))),
    "n_dup_lines": lambda df: (_lines(df), F.size("_ql") - F.size(F.array_distinct("_ql"))),
    "n_lines": lambda df: (_lines(df), F.size("_ql")),
    "n_repeat_words": _n_repeat_words,
}
HELPERS = ("_qt", "_qw", "_qh", "_qg", "_qp", "_qs", "_ql")


def with_figures(
    df: DataFrame, text: str = "text", names: tuple[str, ...] = tuple(FIGURES), once: bool = False
) -> DataFrame:
    """Adds the struct ``_q`` of the named figures; other columns stay.

    With ``once`` a later filter does not compute the figures again; without it
    they are found below a limit, so that only figures are shuffled.
    """
    df, fields = _with_text(df, text), []
    for name in names:
        df, figure = FIGURES[name](df)
        fields.append(figure.cast("long").alias(name))
    found = {"_q": F.struct(*fields)}
    return (compute_once(df, found) if once else df.withColumns(found)).drop(*HELPERS)


def _q(name: str) -> Column:
    return F.col("_q")[name]


# Name of each rule, the figures it needs, and when it rejects.
RULES = {
    "too_few_words": (("n_words",), lambda q: q("n_words") < 10),
    "repeated_windows": (
        ("n_words", "n_repeat_words"),
        lambda q: 100 * q("n_repeat_words") > 20 * q("n_words"),
    ),
    "symbols": (("n_words", "n_symbols"), lambda q: 5 * q("n_symbols") > q("n_words")),
    "word_length": (
        ("n_words", "word_chars"),
        lambda q: (q("word_chars") < 2 * q("n_words")) | (q("word_chars") > 20 * q("n_words")),
    ),
    "repeated_lines": (("n_lines", "n_dup_lines"), lambda q: 2 * q("n_dup_lines") > q("n_lines")),
}
BASE_RULES = ("too_few_words", "repeated_windows")


def cascade_order(df: DataFrame, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[str]:
    """Names of the rules, most rejections per second of evaluation first.

    Each rule is run alone over the first ``sample_rows`` rows that Spark hands
    out, with the figures that it needs.  The sample decides the order alone.
    """
    rows, value = df.select(F.col(f"`{text}`").alias("text")).limit(sample_rows), {}
    for name, (needs, rejects) in RULES.items():
        sample = with_figures(rows, "text", needs)
        start = time.perf_counter()
        row = sample.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(rejects(_q), 1)).alias("bad")).first()
        cost = max(time.perf_counter() - start, 1e-6)
        value[name] = (row["bad"] + 1) / (row["n"] + 2) / cost
    return sorted(RULES, key=lambda name: (-value[name], name))


def verdict(order: list[str], q=_q) -> Column:
    """True if no rule rejects; a rule is asked only if those before it passed."""
    passed = F.lit(True)
    for name in reversed(order):
        passed = F.when(RULES[name][1](q), False).otherwise(passed)
    return passed


def _by_place(df: DataFrame) -> DataFrame:
    """The columns named ``c0``, ``c1``, ..., which no helper is named."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def judge(df: DataFrame, text: str = "text", order: list[str] | None = None) -> DataFrame:
    """``df`` with ``_q`` (all figures), ``_base_failed`` and ``_kept``."""
    order = order or cascade_order(df, text)
    base = [name for name in order if name in BASE_RULES]
    found = with_figures(_by_place(df), f"c{df.columns.index(text)}", once=True)
    old = [F.col(f"c{i}").alias(c) for i, c in enumerate(df.columns) if c not in ("_q", "_base_failed", "_kept")]
    return found.select(*old, "_q", (~verdict(base)).alias("_base_failed"), verdict(order).alias("_kept"))


def keep_good(df: DataFrame, text: str = "text", order: list[str] | None = None) -> DataFrame:
    """The rows that every rule passes, with the columns of ``df``.

    A figure is computed when the first rule asks for it, so a rejected row
    never pays for the rules after that; each figure is computed once.
    """
    order = order or cascade_order(df, text)
    out, known = _with_text(_by_place(df), f"c{df.columns.index(text)}"), set()
    for name in order:
        needs, rejects = RULES[name]
        fresh = {}
        for figure in needs:
            if figure not in known:
                out, value = FIGURES[figure](out)
                fresh[f"_q_{figure}"] = value.cast("long")
                known.add(figure)
        out = compute_once(out, fresh) if fresh else out
        out = out.where(~rejects(lambda figure: F.col(f"_q_{figure}")))
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(df.columns)])


def query(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    figures = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judge(docs).select(
        "doc_id",
        *[_q(name).alias(name) for name in figures],
        F.col("_base_failed").alias("base_failed"),
        F.col("_kept").alias("kept"),
    )


ORACLE_SQL = r"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), grams AS (
    SELECT doc_id, i, array_to_string(list_slice(w, i, i + 4), ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)
), twice AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1
), covered AS (
    SELECT doc_id, sum(least(5, coalesce(following - i, 5))) AS n
    FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS following FROM twice)
    GROUP BY doc_id
), lines AS (
    SELECT doc_id, count(*) AS n_lines, count(DISTINCT line) AS n_kinds
    FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
    GROUP BY doc_id
), figures AS (
    SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
           CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
           CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(coalesce(n_lines - n_kinds, 0) AS BIGINT) AS n_dup_lines,
           CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines,
           CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
    FROM d LEFT JOIN lines ON d.doc_id = lines.doc_id LEFT JOIN covered ON d.doc_id = covered.doc_id
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR 5 * n_symbols > n_words
            OR word_chars < 2 * n_words OR word_chars > 20 * n_words OR 2 * n_dup_lines > n_lines) AS kept
FROM figures
"""
