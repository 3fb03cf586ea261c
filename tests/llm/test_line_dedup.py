import random

import pytest

from tavola.llm import linededup


def n_words(line):
    return len(line.replace("\t", " ").split(" ")) - line.replace("\t", " ").split(" ").count("")


def brute(docs, least):
    """Delete the lines of every run of ``least`` words or more that occurs further up."""
    seen, out = set(), []
    runs = []
    for _, text in docs:
        lines = [(k, x.strip(" \t")) for k, x in enumerate((text or "").split("\n")) if x.strip(" \t")]
        found = []
        for a in range(len(lines)):
            total = 0
            for b in range(a, len(lines)):
                total += n_words(lines[b][1])
                if total >= least:
                    found.append((tuple(x for _, x in lines[a : b + 1]), {k for k, _ in lines[a : b + 1]}))
        runs.append(found)
    for (_, text), found in zip(docs, runs):
        gone = set()
        for key, places in found:
            if key in seen:
                gone |= places
            seen.add(key)
        kept = "\n".join(x for k, x in enumerate((text or "").split("\n")) if k not in gone) if gone else text
        out.append((kept, len(gone)))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_equals_brute_force(spark, docs_of, seed):
    rng = random.Random(seed)
    pool = [" ".join(rng.choice("abcdef") for _ in range(rng.choice((1, 1, 2, 3, 8)))) for _ in range(9)]
    docs = []
    for i in range(40):
        lines = []
        for _ in range(rng.randint(0, 14)):
            lines.append(rng.choice((rng.choice(pool), f"u{rng.random()}", "", f" {rng.choice(pool)}\t")))
        if docs and rng.random() < 0.4:
            lines = (docs[-1][1] or "").split("\n")[rng.randint(0, 2) :] + lines
        docs.append((i - 3, "\n".join(lines) if rng.random() > 0.05 else None))
    least = (1, 4, 7, 10)[seed]
    rows = linededup.cleaned(docs_of(docs).select("doc_id", "text"), least).collect()
    got = {r["doc_id"]: (r["text"], r["_gone"]) for r in rows}
    assert [got[i] for i, _ in docs] == brute(docs, least)


def test_long_runs_and_hot_lines(spark, docs_of):
    passage = "\n".join(f"line number {k} of it" for k in range(40))
    docs = [(i, f"own start {i}\n{passage}\nown end {i}") for i in range(60)]
    rows = {r["doc_id"]: r for r in linededup.cleaned(docs_of(docs)).collect()}
    assert rows[0]["text"] == docs[0][1]
    assert all(rows[i]["text"] == f"own start {i}\nown end {i}" and rows[i]["_gone"] == 40 for i in range(1, 60))


def test_edge_rows(spark, docs_of):
    docs = docs_of([(None, "x y z\nq"), (1, "x y z\nq"), (1, "x y z\nq"), (1, "x y z\nw"), (2, None), (3, "")])
    rows = [(r["doc_id"], r["text"], r["_removed"]) for r in linededup.cleaned(docs, 3).collect()]
    assert sorted(rows, key=str) == sorted(
        [(None, "x y z\nq", False), (1, "", True), (1, "", True), (1, "w", False), (2, None, False), (3, "", False)], key=str
    )
    kept = linededup.drop_copies(docs, 3)
    assert kept.schema == docs.schema and kept.count() == 4
    assert {r["text"]: r["n_chars"] for r in kept.collect()}["w"] == 1


def test_columns_of_any_name_stay(spark, docs_of):
    names = ("_gone", "_removed", "_lines", "_id", "_part", "_own1", "gone", "doc")
    docs = docs_of([(1, "x y z\nq"), (2, "x y z\nw")]).selectExpr("*", *[f"'{c}' AS `{c}`" for c in names])
    kept = linededup.drop_copies(docs, 3)
    assert kept.columns == docs.columns
    rows = sorted(kept.collect(), key=lambda r: r["doc_id"])
    assert [(r["doc_id"], r["text"], r["n_chars"]) for r in rows] == [(1, "x y z\nq", 7), (2, "w", 1)]
    assert all(r[c] == c for r in rows for c in names)


def test_empty_table(spark, docs_of):
    assert linededup.digest(docs_of([(1, "x")]).limit(0)).collect() == []
