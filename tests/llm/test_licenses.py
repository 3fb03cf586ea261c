"""Licence scan: base columns by brute force, expressions, and odd rows."""

import random
import re

import pytest

from tavola.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def _brute(text):
    words = WORD.findall((text or "").translate(LOWER))
    places, labels = [], set()
    for phrase, label in licenses.BASE.items():
        parts = phrase.split()
        for k in range(len(words) - len(parts) + 1):
            if words[k : k + len(parts)] == parts:
                places.append(k)
                labels.add(label)
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))


def _scanned(docs_of, texts):
    rows = licenses.scan(docs_of(list(enumerate(texts)))).collect()
    assert [r["doc_id"] for r in sorted(rows)] == list(range(len(texts)))
    return {r["doc_id"]: r for r in rows}


def _base(row):
    return (row["n_words"], row["n_base"], row["first_word"], row["last_word"], row["base_labels"])


def test_base_against_brute_force(docs_of):
    rng = random.Random(4)
    parts = "gnu general public license Apache LICENSE cc by BY-NC mit ſ été 日本 0 x, . \n \t - __ (".split(" ")
    texts = [" ".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(400)]
    texts += ["MIT LicenseMIT License", "mit license mit license", "cc\x7fby", "CC-BY", "ccby", "cc by\ncc", "\x00mit\x00license"]
    texts += [None, "", " ", "mit", "license", "mit license", "mit\nlicense " * 3, "x" * 200_000 + " cc by " + "y " * 50_000]
    found = _scanned(docs_of, texts)
    for k, text in enumerate(texts):
        assert _base(found[k]) == _brute(text), text and text[:80]


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    found = licenses.scan(docs).collect()
    assert len(found) == len(texts)
    for row in found:
        assert _base(row) == _brute(texts[row["doc_id"]])
        assert set(filter(None, row["base_labels"].split(","))) <= set(row["labels"].split(","))
        assert 0 <= row["score"] <= 1


@pytest.mark.parametrize(
    "text, labels, score",
    [
        ("SPDX-License-Identifier: MIT", "mit", 0.9),
        ("# SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0", "exception,gpl", 0.6),
        ("SPDX-License-Identifier: GPL-2.0 WITH Own-Thing", "gpl", 0.4),
        ("SPDX-License-Identifier: MIT OR GPL-3.0-or-later\nmore", "gpl,mit", 0.9),
        ("SPDX-License-Identifier: MIT AND GPL-3.0-only", "gpl,mit", 0.4),
        ("SPDX-License-Identifier: (MIT OR GPL-2.0) AND MPL-2.0", "gpl,mit,mpl", 0.6),
        ("SPDX-License-Identifier: MIT OR GPL-2.0 AND MPL-2.0", "gpl,mit,mpl", 0.9),
        ("SPDX-License-Identifier: MIT OR", "mit", 0.9),
        ("SPDX-License-Identifier: ((MIT", "mit", 0.9),
        ("SPDX-License-Identifier: ) OR", "", 0.0),
        ("Dual-licensed under the MIT License or the GNU General Public License, version 2.", "gpl,mit", 0.9),
        ("Licensed under MIT, BSD and GPL. The mit is a place.", "bsd,gpl,mit", 0.4),
        ("This work is licensed under the GNU General Public License, version 3.", "gpl", 0.4),
        ("Licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc", 0.2),
        ("Released under the MIT License.", "mit", 0.9),
        ("Some GPL code by MIT people", "", 0.0),
        ("MIT License. All rights reserved", "mit,reserved", 0.05),
        ("licensed under nothing", "", 0.0),
        ("licensed under", "", 0.0),
        ("GNU Lesser General Public License", "lgpl", 0.6),
    ],
)
def test_expressions(docs_of, text, labels, score):
    words = WORD.finditer(text.translate(LOWER))
    row = _scanned(docs_of, [text])[0]
    assert (row["labels"], row["score"]) == (labels, score)
    assert row["n_words"] == len(list(words))


def test_postfix_order():
    assert licenses.postfix([0.9, "or", 0.4, "and", 0.6]) == [0.9, 0.4, 0.6, "and", "or"]
    assert licenses.postfix(["(", 0.9, "or", 0.4, ")", "and", 0.6]) == [0.9, 0.4, "or", 0.6, "and"]
    assert licenses.postfix([0.4, "with", "exception", "or", 0.6]) == [0.4, "exception", "with", 0.6, "or"]
    assert licenses.postfix([0.9, 0.4]) == [0.9, 0.4, "and"]
    assert licenses.postfix(["or", 0.9, "and", ")"]) == [0.9]


def test_evaluation_against_python():
    """Random expressions over grades, as Python's min and max give them."""
    rng = random.Random(8)

    def make(depth):
        if depth == 0 or rng.random() < 0.3:
            grade = rng.choice([0.1, 0.4, 0.6, 0.9])
            if rng.random() < 0.3:
                return [grade, "with", "exception"], max(grade, 0.6)
            return [grade], grade
        parts = [make(depth - 1) for _ in range(rng.randrange(1, 4))]
        name, pick = rng.choice([("and", min), ("or", max)])
        tokens = []
        for side, _ in parts:
            tokens += ([name] if tokens else []) + ["(", *side, ")"]
        return tokens, pick(grade for _, grade in parts)

    for _ in range(300):
        tokens, grade = make(4)
        assert licenses.evaluate(tokens) == grade


def test_empty_table(docs_of):
    assert licenses.scan(docs_of([])).collect() == []
