"""Licences that texts name, by an Aho-Corasick scan, and what their expressions allow.

One automaton over the words of a batch finds licence names, identifiers, exceptions, operators
and the tags that open a licence expression (``SPDX-License-Identifier:``, ``licensed under``).
After a tag the words are read as an expression up to the end of the line or to a word that can
not stand in one; a shunting-yard parser puts it into postfix order (WITH binds before AND, AND
before OR) and it is evaluated: AND gives the stricter side, OR the freer one, WITH a known
exception lifts a copyleft licence to a weak one.

Words are runs of ASCII letters (A-Z lowered), digits and characters beyond ASCII. The four base
labels come from the places of the base phrases alone; the method adds the labels of the other
names and of the operands of expressions, and ``exception`` where WITH has a known exception.

``score`` says how freely the text may be used: the least grade of all names and expressions in
it (0 to 1), and 0 where none is found.

Rows: a missing text is an empty one: no words, no labels (empty strings), no places (null).
Repeated rows are scanned alike, other columns are not read, and an empty table gives an empty
result. A long text needs memory in proportion to its length.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tavola.llm.pieces import expand
from tavola.llm.resident import resident
from tavola.llm.words import spans, text_slices

SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, "
    "base_labels string, labels string, score double"
)

#: The phrases of the base and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Other names of licences, with their labels.
NAMES = {
    "gnu lesser general public license": "lgpl",
    "gnu library general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "isc license": "isc",
    "zlib license": "zlib",
    "boost software license": "boost",
    "unlicense": "unlicense",
    "creative commons zero": "cc0",
    "creative commons attribution": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "all rights reserved": "reserved",
}

#: Identifiers that are licences only inside an expression.
IDENTIFIERS = {
    "mit": "mit",
    "apache": "apache",
    "gpl": "gpl",
    "gnu gpl": "gpl",
    "lgpl": "lgpl",
    "agpl": "agpl",
    "mpl": "mpl",
    "epl": "epl",
    "bsd": "bsd",
    "0bsd": "bsd",
    "isc": "isc",
    "zlib": "zlib",
    "bsl": "boost",
    "cc0": "cc0",
}

EXCEPTIONS = ("classpath exception", "gcc exception", "linking exception", "llvm exception", "font exception")

TAGS = (
    "spdx license identifier",
    "licensed under",
    "released under",
    "distributed under",
    "available under",
    "dual licensed under",
)

OPERATORS = {"or": 1, "and": 2, "with": 3}

#: Words that may stand between the operands of an expression.
FILLERS = frozenset("the a an either both terms of license licence licenses version v only later clause international".split())

#: How freely a licence may be used.
GRADES = {
    "unlicense": 1.0, "cc0": 1.0,
    "mit": 0.9, "bsd": 0.9, "isc": 0.9, "zlib": 0.9, "boost": 0.9, "apache": 0.9, "cc-by": 0.8,
    "mpl": 0.6, "epl": 0.6, "lgpl": 0.6,
    "gpl": 0.4, "cc-by-sa": 0.4, "agpl": 0.3,
    "cc-by-nc": 0.2, "cc-by-nc-sa": 0.2, "cc-by-nd": 0.2, "cc-by-nc-nd": 0.15, "reserved": 0.05,
}
#: An operand that is no known licence, and what an exception makes of copyleft.
UNKNOWN, WEAK = 0.1, 0.6


class Hit(NamedTuple):
    """A phrase at words ``start`` to ``end`` - 1 of a text."""

    start: int
    end: int
    kind: str
    label: str


def postfix(tokens: list[str | float]) -> list[str | float]:
    """Operands (numbers and exceptions), operators and parentheses in postfix order.

    Two operands in a row are joined by ``and``. An operator without an operand on one side and
    a parenthesis without a partner are left out.
    """
    out: list[str | float] = []
    waiting: list[str] = []
    operand_before = False
    due: str | None = None

    def operator(name: str) -> None:
        while waiting and waiting[-1] != "(" and OPERATORS[waiting[-1]] >= OPERATORS[name]:
            out.append(waiting.pop())
        waiting.append(name)

    for token in tokens:
        if token in OPERATORS:
            if operand_before:
                due = token
        elif token == ")":
            if "(" in waiting and operand_before:
                due = None
                while waiting[-1] != "(":
                    out.append(waiting.pop())
                waiting.pop()
        else:
            if operand_before:
                operator(due or "and")
            due = None
            if token == "(":
                waiting.append(token)
                operand_before = False
            else:
                out.append(token)
                operand_before = True
    out += [name for name in reversed(waiting) if name != "("]
    return out


def evaluate(tokens: list[str | float]) -> float | None:
    """The grade of an expression; none without an operand."""
    stack: list[str | float] = []
    for token in postfix(tokens):
        if token not in OPERATORS:
            stack.append(token)
            continue
        if len(stack) < 2:  # the other side was an open parenthesis with nothing in it
            continue
        right, left = stack.pop(), stack.pop()
        if token == "with":
            lifted = right == "exception" and left != "exception"
            stack.append(max(left, WEAK) if lifted else left if left != "exception" else right)
            continue
        sides = [side for side in (left, right) if side != "exception"]
        stack.append((max if token == "or" else min)(sides) if sides else "exception")
    grades = [grade for grade in stack if grade != "exception"]
    return min(grades) if grades else None


class Scanner:
    """The automaton over all phrases."""

    def __init__(self) -> None:
        self.automaton = ahocorasick.Automaton()
        kinds = (
            [(p, "base", label) for p, label in BASE.items()]
            + [(p, "name", label) for p, label in NAMES.items()]
            + [(p, "identifier", label) for p, label in IDENTIFIERS.items()]
            + [(p, "exception", p) for p in EXCEPTIONS]
            + [(p, "tag", p) for p in TAGS]
        )
        for phrase, kind, label in kinds:
            padded = f" {phrase} "
            self.automaton.add_word(padded, (len(padded), phrase.count(" ") + 1, kind, label))
        self.automaton.make_automaton()

    def hits(self, lowered: str) -> Iterator[tuple[int, int, str, str]]:
        """Place of the first character, number of words, kind and label of every phrase."""
        for end, (size, words, kind, label) in self.automaton.iter(lowered):
            yield end - size + 2, words, kind, label


def _best(hits: list[Hit]) -> dict[int, Hit]:
    """The longest licence or exception that starts at each word."""
    best: dict[int, Hit] = {}
    for hit in hits:
        if hit.kind != "tag" and (hit.start not in best or hit.end > best[hit.start].end):
            best[hit.start] = hit
    return best


def read_expression(
    at: int, words: list[bytes], gaps: list[bytes], best: dict[int, Hit]
) -> tuple[list[str | float], set[str], int]:
    """From word ``at`` on: the tokens of the expression, its labels, and the word after it.

    ``gaps[k]`` is what stands in the text before word ``k``.
    """
    tokens: list[str | float] = []
    labels: set[str] = set()
    k = at
    while k < len(words):
        # the first gap holds the tag's own colon; a line or a sentence ends the expression
        if k > at and (b"\n" in gaps[k] or b";" in gaps[k] or gaps[k].startswith(b". ")):
            break
        tokens += [chr(c) for c in gaps[k] if c in b"()"]
        word = words[k].decode()
        if word in OPERATORS:
            tokens.append(word)
        elif k in best:
            hit = best[k]
            tokens.append("exception" if hit.kind == "exception" else GRADES[hit.label])
            if hit.kind != "exception":
                labels.add(hit.label)
            elif "with" in tokens[-2:]:
                labels.add("exception")
            k = hit.end
            continue
        elif word not in FILLERS and not word.isdigit():
            # after WITH, and after a tag for machines, an unknown name is an operand
            if not (tokens and tokens[-1] == "with"):
                break
            tokens.append(UNKNOWN)
        k += 1
    if k < len(words) and k > at:
        tokens += [chr(c) for c in gaps[k].split(b"\n")[0] if c == ord(")")]
    return tokens, labels, k


def judge(hits: list[Hit], words: list[bytes], gaps: list[bytes]) -> tuple[str, str, float]:
    """base_labels, labels and score of one text."""
    base = {hit.label for hit in hits if hit.kind == "base"}
    best = _best(hits)
    labels, grades, covered = set(base), [], [0, -1]
    for tag in sorted(hit for hit in hits if hit.kind == "tag"):
        if tag.end <= covered[1]:
            continue
        tokens, found, after = read_expression(tag.end, words, gaps, best)
        labels |= found
        grade = evaluate(tokens)
        if grade is not None:
            grades.append((grade, tag.end, after))
            covered = [tag.end, after]
    for start, hit in best.items():
        if hit.kind in ("base", "name"):
            labels.add(hit.label)
            if not any(a <= start < b for _, a, b in grades):
                grades.append((GRADES[hit.label], 0, 0))
    score = min((grade for grade, _, _ in grades), default=0.0)
    return ",".join(sorted(base)), ",".join(sorted(labels)), score


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] = _LOWER[97:123]


def _lowered(data: np.ndarray, first: np.ndarray, end: np.ndarray, row: np.ndarray) -> tuple[str, np.ndarray]:
    """The words with one space before each, texts held apart, and the place of each word."""
    opens = np.ones(len(row), dtype=bool)
    opens[1:] = row[1:] != row[:-1]
    size = end - first
    lead = np.where(opens, 3, 1)
    place = np.cumsum(size + lead) - size
    out = np.full(int(place[-1] + size[-1]) + 1, 32, dtype=np.uint8)
    out[place[opens] - 2] = 10
    out[expand(place, place + size)] = _LOWER[data[expand(first, end)]]
    return out.tobytes().decode("latin-1"), place


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scanner = resident("licences", Scanner)
    for batch in batches:
        doc_ids = batch.column("doc_id")
        for at, texts in text_slices(batch.column("text")):
            texts = texts.fill_null(b"")
            n = len(texts)
            data, first, end, row = spans(texts, letters=True)
            n_words = np.bincount(row, minlength=n)
            begin = np.cumsum(n_words) - n_words
            found: dict[int, list[Hit]] = {}
            if len(row):
                lowered, place = _lowered(data, first, end, row)
                for where, words, kind, label in scanner.hits(lowered):
                    k = int(np.searchsorted(place, where))
                    start = k - int(begin[row[k]])
                    found.setdefault(int(row[k]), []).append(Hit(start, start + words, kind, label))
            columns = [[0] * n, [None] * n, [None] * n, [""] * n, [""] * n, [0.0] * n]
            for k, hits in found.items():
                places = [hit.start for hit in hits if hit.kind == "base"]
                if places:
                    columns[0][k], columns[1][k], columns[2][k] = len(places), min(places), max(places)
                if any(hit.kind in ("base", "name", "tag") for hit in hits):
                    columns[3][k], columns[4][k], columns[5][k] = judge(
                        hits, *_words(texts[k].as_py(), first, end, begin[k], n_words[k])
                    )
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [
                    doc_ids.slice(at, n),
                    pa.array(n_words.astype(np.int64)),
                    *[pa.array(column, kind) for column, kind in zip(columns, types)],
                ],
                names=[field.split()[0] for field in SCHEMA.split(", ")],
            )


def _words(
    text: bytes, first: np.ndarray, end: np.ndarray, begin: int, count: int
) -> tuple[list[bytes], list[bytes]]:
    """Lowered words of one text of a batch, and what stands before each."""
    a, b = first[begin : begin + count], end[begin : begin + count]
    # places in the batch, from the first word's place in the text
    skip = 0
    while skip < len(text) and not (text[skip] >= 128 or chr(text[skip]).isalnum()):
        skip += 1
    a, b = (a - a[0] + skip).tolist(), (b - first[begin] + skip).tolist()
    low = text.lower()  # of bytes: A-Z alone
    return [low[x:y] for x, y in zip(a, b)], [text[x:y] for x, y in zip([0, *b], a)]


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score of every row."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_scan, SCHEMA)
