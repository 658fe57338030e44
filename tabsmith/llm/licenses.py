"""Licence scan: Aho-Corasick finds identifier tags and notice phrases, a shunting-yard parser evaluates expressions.

One automaton holds all phrases, so a text is read once whatever their number. After an identifier tag the rest of the
line is parsed as a licence expression (and / or / with, brackets) into postfix order and evaluated.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith.llm.common import packed, q, read, unpacked

# fixed values: the base phrases and their labels
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Notice phrases of the method's own (words joined by one space) → (label, weight as evidence of a licence notice).
NOTICE_PHRASES = {
    "mit license": ("mit", 0.9),
    "permission is hereby granted free of charge": ("mit", 0.9),
    "apache license": ("apache", 0.9),
    "apache software license": ("apache", 0.9),
    "bsd license": ("bsd", 0.9),
    "redistribution and use in source and binary forms": ("bsd", 0.9),
    "mozilla public license": ("mpl", 0.9),
    "eclipse public license": ("epl", 0.9),
    "lesser general public license": ("lgpl", 0.9),
    "affero general public license": ("agpl", 0.9),
    "isc license": ("isc", 0.9),
    "boost software license": ("bsl", 0.9),
    "creative commons": ("cc", 0.8),
    "cc by nc": ("cc-by-nc", 0.9),
    "cc by sa": ("cc-by-sa", 0.9),
    "cc by nd": ("cc-by-nd", 0.9),
    "cc0": ("cc0", 0.8),
    "public domain": ("public-domain", 0.6),
    "the unlicense": ("unlicense", 0.8),
    "licensed under the": ("notice", 0.5),
    "released under the": ("notice", 0.5),
    "this work is licensed": ("notice", 0.5),
    "copyright c": ("copyright", 0.5),
    "no part of this": ("reserved", 0.4),
}
BASE_WEIGHTS = {"cc-by": 0.9, "gpl": 0.9, "reserved": 0.7}
IDENTIFIER_TAG = "spdx license identifier"

# Families of SPDX identifiers by the beginning of the lower-cased id, the longest match first.
PERMISSIVE = ("mit", "apache", "bsd", "isc", "bsl", "cc0", "unlicense", "zlib", "cc-by")
COPYLEFT = ("gpl", "lgpl", "agpl", "mpl", "epl", "cc-by-sa")
RESTRICTED = ("cc-by-nc", "cc-by-nd")

_DELIMITERS = [*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]
_TABLE = bytes(32 if b in _DELIMITERS else b for b in range(256))
_TAG = re.compile(r"spdx-license-identifier[ \t]*:[ \t]*([^\n]*)", re.IGNORECASE)
_TOKEN = re.compile(r"\(|\)|[A-Za-z0-9.+:-]+")
PRECEDENCE = {"or": 1, "and": 2, "with": 3}


def words_of(text: str | None) -> list[bytes]:
    """Words of the whole text, A-Z lower-cased, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").lower().translate(_TABLE).split()


def to_postfix(expression: str) -> tuple[list[tuple[str, str]], str]:
    """Shunting-yard: ([(kind, token)], rest). Reads the longest start of the line that is an expression.

    Operators bind with > and > or and are left-associative. Tokens after a complete expression (a comment's end, say)
    are left over. A missing operand or bracket makes the result empty.
    """
    out, stack, operand_next, complete = [], [], True, ([], expression)
    depth = 0
    for m in _TOKEN.finditer(expression):
        tok = m.group()
        low = tok.lower()
        if low in PRECEDENCE:
            if operand_next:
                break
            while stack and stack[-1] != "(" and PRECEDENCE[stack[-1]] >= PRECEDENCE[low]:
                out.append(("op", stack.pop()))
            stack.append(low)
            operand_next = True
        elif tok == "(":
            if not operand_next:
                break
            stack.append("(")
            depth += 1
        elif tok == ")":
            if operand_next or not depth:
                break
            while stack[-1] != "(":
                out.append(("op", stack.pop()))
            stack.pop()
            depth -= 1
        else:
            if not operand_next:
                break
            out.append(("id", tok))
            operand_next = False
        if not operand_next and not depth:
            complete = (out + [("op", o) for o in reversed(stack)], expression[m.end():])
    return complete


def family(licence: str) -> str:
    low = licence.lower()
    for names, kind in ((RESTRICTED, "restricted"), (COPYLEFT, "copyleft"), (PERMISSIVE, "permissive")):
        if low.startswith(names):
            return kind
    return "unknown"


ORDER = ("permissive", "copyleft", "unknown", "restricted")  # from the freest to the least free


def evaluate(postfix: list[tuple[str, str]]) -> tuple[list[str], str]:
    """(licence ids, obligation): or chooses the freest side, and binds to the strictest, with keeps its licence's."""
    stack = []
    for kind, tok in postfix:
        if kind == "id":
            stack.append(([tok.lower()], family(tok)))
            continue
        (right, rk), (left, lk) = stack.pop(), stack.pop()
        if tok == "with":
            stack.append((left, lk))  # the right side names an exception, not a licence
        else:
            pick = min if tok == "or" else max
            stack.append((left + right, pick(lk, rk, key=ORDER.index)))
    return stack[0] if stack else ([], "none")


class Scanner:
    """The automaton and its phrase table; built once per Python worker."""

    def __init__(self) -> None:
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        entries: dict[str, list[tuple[str, float, bool]]] = {}
        for phrase, label in BASE_PHRASES.items():
            entries.setdefault(phrase, []).append((label, BASE_WEIGHTS[label], True))
        for phrase, (label, weight) in NOTICE_PHRASES.items():
            entries.setdefault(phrase, []).append((label, weight, False))
        entries[IDENTIFIER_TAG] = [("", 0.0, False)]
        for phrase, what in entries.items():
            self.automaton.add_word(f" {phrase} ", (phrase, what))  # a space on either side: whole words only
        self.automaton.make_automaton()

    def scan(self, text: str | None) -> tuple:
        words = words_of(text)
        # one byte a character: positions are those of the UTF-8 words, and no two words can run together
        line = (b" " + b" ".join(words) + b" ").decode("latin-1") if words else ""
        n_base, starts, base, labels, tagged, miss = 0, [], set(), set(), False, 1.0
        at, counted = 0, 0
        hits = []
        for end, (phrase, what) in (self.automaton.iter(line) if line else ()):
            hits.append((end - len(phrase) - 1, phrase, what))
        seen = set()
        for pos, phrase, what in sorted(hits, key=lambda h: h[0]):
            counted += line.count(" ", at, pos)
            at = pos
            for label, weight, is_base in what:
                if is_base:
                    n_base += 1
                    starts.append(counted)
                    base.add(label)
                if label and phrase not in seen:
                    labels.add(label)
                    miss *= 1 - weight
            seen.add(phrase)
            tagged |= phrase == IDENTIFIER_TAG
        expressions, obligation = [], "none"
        if tagged:
            kinds = []
            for m in _TAG.finditer(text):
                ids, kind = evaluate(to_postfix(m.group(1))[0])
                if ids:
                    expressions.append(m.group(1).strip())
                    labels.update(ids)
                    kinds.append(kind)
                    miss *= 0.01
            if kinds:
                obligation = max(kinds, key=ORDER.index)
        join = lambda s: ",".join(sorted(s))
        return (len(words), n_base, starts[0] if starts else None, starts[-1] if starts else None, join(base),
                join(labels), 1.0 - miss, expressions, obligation)


FIELDS = ("n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
          "score double, expressions array<string>, obligation string")
NAMES = [f.strip().split(" ")[0] for f in FIELDS.split(",")]
_scanner: list[Scanner] = []


def scanner() -> Scanner:
    """This Python worker's scanner."""
    if not _scanner:
        _scanner.append(Scanner())
    return _scanner[0]


def scan_column():
    @F.pandas_udf(FIELDS)
    def scan(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in texts:
            out = pd.DataFrame([scanner().scan(t) for t in s], columns=NAMES)
            for c in ("first_word", "last_word"):
                out[c] = out[c].astype("Int64")
            yield out

    return scan


def license_scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` with the scan of its whole text.

    ``n_words``, ``n_base`` (places of base phrases), ``first_word`` / ``last_word`` (their smallest and largest start
    word, null if none), ``base_labels`` and ``labels`` (distinct, sorted, comma-joined; empty string if none),
    ``score`` (0 to 1, the evidence of different phrases and valid identifier expressions combined as one minus the
    product of what each leaves open), ``expressions`` (those after identifier tags) and their ``obligation``
    (permissive, copyleft, unknown, restricted; none without one; the strictest of several). Null and empty texts have
    no words and score 0. Repeated rows appear once each; input columns named like an output are replaced.
    """
    rows = docs.select(packed(docs).alias("_row"), scan_column()(F.col(q(text_col)).cast("string")).alias("_scan"))
    rows = rows.select("_row", *[F.col("_scan").getField(n).alias(n) for n in NAMES])
    return unpacked(rows, docs.columns, NAMES)


def op9_license_scan(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return license_scan(docs).drop("text")
