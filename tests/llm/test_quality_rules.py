import random

import pytest

from tavola.llm import quality


def words(text):
    for blank in "\t\n\x0b\x0c\r":
        text = text.replace(blank, " ")
    return [w for w in text.split(" ") if w]


def expected(text):
    w = words(text or "")
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    repeated = set()
    for i, x in enumerate(windows):
        if windows.count(x) > 1:
            repeated |= set(range(i, i + 8))
    lines = [x for x in (text or "").split("\n") if words(x)]
    failed = len(w) < 20 or 100 * len(repeated) > 30 * len(w)
    return {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": sum((text or "").count(c) for c in "#*$%&|<>"),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(repeated),
        "base_failed": failed,
    }


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(2)
    out = [None, "", "   \n\t", "one", "a b c d e f g h", "a b c d e f g h " * 2, "x " * 40, "# $ % & | < > *", "é漢🙂 ß " * 30]
    for _ in range(60):
        n = rng.randint(0, 60)
        out.append("".join(rng.choice("ab") + rng.choice((" ", "\n", "\t", "  ", "\r\n", "\x0b", " ")) for _ in range(n)))
    out.append(" ".join(f"w{i % 700}" for i in range(5000)))
    return out


def test_measures_equal_brute_force(spark, docs_of, texts):
    rows = {r["doc_id"]: r for r in quality.digest(docs_of(list(enumerate(texts)))).collect()}
    for k, text in enumerate(texts):
        assert {n: rows[k][n] for n in expected(text)} == expected(text), text


def test_verdict_does_not_depend_on_the_order(spark, docs_of, texts):
    docs = docs_of(list(enumerate(texts)))
    one = {r["doc_id"]: r["kept"] for r in quality.judge(docs.select("doc_id", "text")).collect()}
    other = quality.judge(docs.select("doc_id", "text"), tuple(reversed(quality.RULES)), 5).collect()
    assert {r["doc_id"]: r["kept"] for r in other} == one


def test_cascade_puts_rejecting_rules_first(spark, docs_of):
    shouted = " ".join(f"WORD{i}X" for i in range(40))
    docs = docs_of([(i, shouted + str(i)) for i in range(50)]).select("doc_id", "text")
    assert quality.order_rules(docs)[0].name == "capitals"


def test_kept_rows_keep_their_columns(spark, docs_of):
    clean = " ".join(f"word{i}" for i in range(50))
    docs = docs_of([(1, clean), (1, clean), (None, clean), (2, "short"), (3, None), (4, "a|b # " * 30)])
    kept = quality.keep_good(docs)
    assert kept.schema == docs.schema
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "1", "None"]


def test_empty_table(spark, docs_of):
    assert quality.digest(docs_of([(1, "x")]).limit(0)).collect() == []


def test_no_python_in_the_plan(spark, docs_of):
    plan = quality.judge(docs_of([(1, "x")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
