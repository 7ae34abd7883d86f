"""Licence scans: Aho-Corasick phrases and licence expressions.

A text is lower-cased (A-Z) and cut into words of ASCII letters and digits and
any non-ASCII characters.  One automaton holds all phrases with word borders
around them, so its matches are consecutive whole words.  Identifier tags
(``SPDX-License-Identifier: <expression>``) are found by the same automaton; the
expression behind a tag is read by a shunting-yard parser.

Defined cases: a null or empty text has no words, no places, no labels and score
0; repeated rows are scanned one by one; an empty table gives an empty result;
only the named columns are read, so other columns cannot clash; an expression
that cannot be parsed gives the label ``unknown`` and no others.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# The base phrases and their labels.
BASE_PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
# Notice phrases of the method: words and the label.
NOTICES = {
    "permission is hereby granted free of charge": "mit",
    "apache software foundation": "apache",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "redistribution and use in source and binary forms": "bsd",
    "bsd license": "bsd",
    "isc license": "isc",
    "creative commons": "cc",
    "cc by": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "cc0": "cc0",
    "public domain": "public-domain",
    "all rights reserved": "reserved",
}
TAG = "spdx license identifier"
# Families of licence identifiers: the start of the identifier and the label.
FAMILIES = {
    "mit": "mit", "apache": "apache", "gpl": "gpl", "lgpl": "lgpl", "agpl": "agpl", "mpl": "mpl",
    "epl": "epl", "bsd": "bsd", "isc": "isc", "cc0": "cc0", "cc-by-nc-nd": "cc-by-nc-nd",
    "cc-by-nc-sa": "cc-by-nc-sa", "cc-by-nc": "cc-by-nc", "cc-by-nd": "cc-by-nd",
    "cc-by-sa": "cc-by-sa", "cc-by": "cc-by", "unlicense": "public-domain",
}
# Families that do not allow free reuse of the text.
RESTRICTED = {"cc-by-nc", "cc-by-nc-nd", "cc-by-nc-sa", "cc-by-nd", "reserved"}

# Every ASCII byte that is not a letter or digit becomes a space.
_BREAKS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
_TAG_LINE = re.compile(r"spdx-license-identifier:[ \t]*([^\r\n]*)", re.ASCII | re.IGNORECASE)
_TOKEN = re.compile(r"[ \t]*(?:([()])|([A-Za-z0-9.+:-]+)|(\S))")
# Higher binds closer.
_BINDING = {"or": 1, "and": 2, "with": 3}


def parse(expression: str) -> list[str] | None:
    """The expression in postfix order by the shunting yard; None if it is none.

    Reading stops at the first character that cannot belong to an expression,
    such as the end of a comment.
    """
    out: list[str] = []
    stack: list[str] = []
    operand_next = True
    for match in _TOKEN.finditer(expression):
        bracket, word, other = match.groups()
        if other:
            break
        token = (bracket or word).lower()
        if token == "(" and operand_next:
            stack.append(token)
        elif token == ")" and not operand_next:
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                break
            stack.pop()
        elif token in _BINDING and not operand_next:
            while stack and stack[-1] != "(" and _BINDING[stack[-1]] >= _BINDING[token]:
                out.append(stack.pop())
            stack.append(token)
            operand_next = True
        elif token in _BINDING or token in "()" or not operand_next:
            if operand_next:
                return None
            break
        else:
            out.append(token)
            operand_next = False
    if operand_next or "(" in stack:
        return None
    return out + stack[::-1]


def family(identifier: str) -> str:
    found = [start for start in FAMILIES if identifier.startswith(start)]
    return FAMILIES[max(found, key=len)] if found else "unknown"


def evaluate(postfix: list[str]) -> tuple[frozenset[str], bool]:
    """All labels named, and whether some choice of the ``or`` sides is free of restriction."""
    stack: list[tuple[frozenset[str], bool]] = []
    for token in postfix:
        if token == "with":
            stack.pop()  # an exception only adds rights
        elif token in _BINDING:
            (b, free_b), (a, free_a) = stack.pop(), stack.pop()
            stack.append((a | b, free_a or free_b if token == "or" else free_a and free_b))
        else:
            name = family(token)
            stack.append((frozenset([name]), name not in RESTRICTED and name != "unknown"))
    return stack[0]


@lru_cache(maxsize=1)
def _automaton() -> ahocorasick.Automaton:
    machine = ahocorasick.Automaton()
    kinds: dict[str, list] = {}
    for phrase, label in BASE_PHRASES.items():
        kinds.setdefault(phrase, []).append(("base", label))
    for phrase, label in NOTICES.items():
        kinds.setdefault(phrase, []).append(("notice", label))
    kinds.setdefault(TAG, []).append(("tag", ""))
    for phrase, found in kinds.items():
        machine.add_word(f" {phrase} ", (len(phrase.split(" ")), found))
    machine.make_automaton()
    return machine


def scan(text: str | None) -> dict:
    """Figures, labels and the places of all matches of one text."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_BREAKS).split()
    line = (b" " + b" ".join(words) + b" ").decode("latin-1") if words else ""
    base, base_labels, notices, tags, places = [], set(), {}, 0, []
    before = seen = 0  # words that end before the place ``seen``; matches come in the order of their ends
    for end, (width, kinds) in _automaton().iter(line) if line else ():
        before, seen = before + line.count(" ", seen, end), end
        word = before - width
        for kind, label in kinds:
            places.append((word, kind, label))
            if kind == "base":
                base.append(word)
                base_labels.add(label)
            elif kind == "tag":
                tags += 1
            else:  # of notices with one start the longest is found last
                notices[word] = label
    labels, free = set(notices.values()), []
    if tags:
        for found in _TAG_LINE.finditer(text):
            postfix = parse(found[1])
            names, is_free = evaluate(postfix) if postfix else (frozenset(["unknown"]), False)
            labels |= names
            free.append(is_free)
    labels |= base_labels
    strong = len(base) + 2 * len(free)
    return {
        "n_words": len(words),
        "n_base": len(base),
        "first_word": min(base) if base else None,
        "last_word": max(base) if base else None,
        "base_labels": ",".join(sorted(base_labels)),
        "labels": ",".join(sorted(labels)),
        # Grows with the number of signs; a tag counts as two phrases.
        "score": 1.0 - 0.5 ** (strong + 0.5 * (len(labels) - len(base_labels))) if labels else 0.0,
        "restricted": bool(labels & RESTRICTED) and not any(free),
        "places": [{"word": w, "kind": k, "label": x} for w, k, x in sorted(places)],
    }


FIGURES = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, restricted boolean, places array<struct<word:long,kind:string,label:string>>"
)


def scan_licenses(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and the figures of each row; ``places`` lists every match by its first word."""
    rows = docs.select(key, text)
    names = [part.split()[0] for part in FIGURES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None
        for batch in batches:
            found = [scan(value.as_py()) for value in batch.column(1)]
            columns = [batch.column(0)]
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.bool_()]
            types.append(pa.list_(pa.struct([("word", pa.int64()), ("kind", pa.string()), ("label", pa.string())])))
            columns += [pa.array([x[name] for x in found], kind) for name, kind in zip(names, types)]
            schema = schema or [key, *names]
            yield pa.RecordBatch.from_arrays(columns, schema)

    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(run, f"`{key}` {kind}, {FIGURES}")


def query(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return scan_licenses(docs).drop("places")
