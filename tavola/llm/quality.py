"""Quality rules as a short-circuit cascade, in native columns only.

Every rule rejects a document or lets it pass; a document is kept when no rule rejects it, so
the verdict does not depend on the order. The order decides only what is computed: it is
chosen from a sample, rules with the highest rejection per cost first, and a later rule is not
evaluated for a document that an earlier one has rejected.

Rows: nothing is dropped by ``judge``. A missing text is an empty one: no words, rejected by
the base rule. Repeated rows are judged alike, other columns pass through unchanged, and an
empty table gives an empty result. The longest text is one array of words in one row.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tavola.llm.shared import stored

BLANKS = "\t\n\x0b\x0c\r"
WORD = "[^ \t\n\x0b\x0c\r]"
SYMBOLS = "#*$%&|<>"
WINDOW = 8


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def pieces(text: Column) -> Column:
    """The text cut at every white-space character; a word or nothing lies between two cuts."""
    text = F.coalesce(text, F.lit(""))
    for blank in BLANKS:
        text = F.replace(text, F.lit(blank), F.lit(" "))
    return F.split(text, " ")


def words_of(text: Column) -> Column:
    """Runs of characters other than the six ASCII white-space characters."""
    return F.array_remove(pieces(text), "")


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words that lie in a window of ``window`` words found twice or more in the text.

    Windows are named by hashes, from the names of their halves. Only a text with equal names
    is sorted: windows equal to a neighbour are repeated, and the words that they cover are the
    gaps between their starts, up to the window's length.
    """
    half = window // 2

    def named(parts: Column) -> Column:
        return F.slice(
            F.transform(parts, lambda x, i: F.xxhash64(x, F.get(parts, i + half))),
            F.lit(1),
            F.greatest(F.size(parts) - (window - 1), F.lit(0)),
        )

    names = let(
        F.transform(
            words, lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, half)])
        ),
        named,
    )

    def covered(starts: Column) -> Column:
        return F.aggregate(
            starts,
            F.struct(F.lit(0).alias("n"), F.lit(-window).alias("last")),
            lambda s, at: F.struct(
                (s["n"] + F.least(F.lit(window), at - s["last"])).alias("n"), at.alias("last")
            ),
            lambda s: s["n"],
        )

    def equal_to_neighbour(ordered: Column) -> Column:
        return F.filter(
            ordered,
            lambda x, i: (x["name"] == F.get(ordered, i + 1)["name"])
            | (x["name"] == F.get(ordered, i - 1)["name"]),
        )

    def count(a: Column) -> Column:
        placed = F.transform(a, lambda x, i: F.struct(x.alias("name"), i.alias("at")))
        repeated = let(F.sort_array(placed), equal_to_neighbour)
        starts = F.sort_array(F.transform(repeated, lambda x: x["at"]))
        return F.when(F.size(F.array_distinct(a)) == F.size(a), F.lit(0)).otherwise(covered(starts))

    return F.when(F.size(words) <= window, F.lit(0)).otherwise(let(names, count)).cast("long")


def measures(docs: DataFrame) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed,
    and n_lines, n_bullets and n_ellipses, which count lines with a word."""
    text = F.coalesce(F.col("text"), F.lit(""))

    def of_pieces(cut: Column) -> Column:
        return let(
            F.array_remove(cut, ""),
            lambda words: F.struct(
                F.size(words).cast("long").alias("n_words"),
                (F.size(cut) - 1).alias("n_blanks"),
                repeated_words(words).alias("n_repeat_words"),
            ),
        )

    def of_lines(lines: Column) -> Column:
        return F.struct(
            F.size(lines).alias("n"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("repeats"),
            F.size(F.filter(lines, lambda x: F.rlike(x, F.lit("^[ \t]*[-*•]")))).alias("bullets"),
            F.size(
                F.filter(
                    lines,
                    lambda x: F.endswith(F.rtrim(x), F.lit("...")) | F.endswith(F.rtrim(x), F.lit("…")),
                )
            ).alias("ellipses"),
        )

    lines = F.filter(F.split(text, "\n"), lambda line: F.rlike(line, F.lit(WORD)))
    return (
        docs.withColumn("_w", let(pieces(F.col("text")), of_pieces))
        .withColumn("_l", let(lines, of_lines))
        .withColumn("n_words", F.col("_w.n_words"))
        .withColumn("word_chars", (F.length(text) - F.col("_w.n_blanks")).cast("long"))
        .withColumn("n_symbols", F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("long"))
        .withColumn("n_dup_lines", F.col("_l.repeats"))
        .withColumn("n_repeat_words", F.col("_w.n_repeat_words"))
        .withColumn("n_lines", F.col("_l.n"))
        .withColumn("n_bullets", F.col("_l.bullets"))
        .withColumn("n_ellipses", F.col("_l.ellipses"))
        .withColumn(
            "base_failed",
            (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")),
        )
        .drop("_w", "_l")
    )


@dataclass(frozen=True)
class Rule:
    """``rejects`` is true for a document that the rule throws out; it is never null."""

    name: str
    rejects: Callable[[], Column]


def _capitals() -> Column:
    """Capitals A-Z are more than half of the characters in words."""
    return 2 * F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit("[A-Z]")) > F.col("word_chars")


#: Rules on the measures cost little; the one on the text scans it with a pattern.
RULES = (
    Rule("symbols", lambda: 10 * F.col("n_symbols") > F.col("n_words")),
    Rule("short_words", lambda: F.col("word_chars") < 2 * F.col("n_words")),
    Rule("long_words", lambda: F.col("word_chars") > 20 * F.col("n_words")),
    Rule("repeated_lines", lambda: 50 * F.col("n_dup_lines") > 3 * F.col("n_words")),
    Rule("capitals", _capitals),
    Rule("bullets", lambda: (F.col("n_lines") >= 5) & (10 * F.col("n_bullets") > 9 * F.col("n_lines"))),
    Rule("ellipses", lambda: (F.col("n_lines") >= 5) & (10 * F.col("n_ellipses") > 3 * F.col("n_lines"))),
)


def order_rules(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = 2000
) -> list[Rule]:
    """Rules by rejection per cost on a sample of about ``sample_rows`` rows.

    Cost is the time to evaluate a rule over the sample, less that of an empty pass;
    selectivity the share it rejects. Only speed depends on the outcome.
    """
    share = min(1.0, sample_rows / max(docs.count(), 1))
    some = measures(docs.select("text").sample(share, seed=11)).where(~F.col("base_failed"))
    sample = stored(some, "sample")
    total = max(sample.count(), 1)

    def timed(column: Column) -> tuple[float, int]:
        began = time.perf_counter()
        hits = sample.agg(F.coalesce(F.sum(column.cast("long")), F.lit(0)).alias("n")).first()["n"]
        return time.perf_counter() - began, hits

    timed(F.col("n_words") < 0)
    empty = min(timed(F.col("n_words") < 0)[0] for _ in range(2))
    scored = []
    for k, rule in enumerate(rules):
        seconds, hits = timed(rule.rejects())
        cost = max(seconds - empty, 1e-3)
        scored.append((-(hits / total) / cost, k, rule))
    return [rule for _, _, rule in sorted(scored, key=lambda x: x[:2])]


def judge(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = 2000
) -> DataFrame:
    """``docs`` with its measures, ``kept`` and ``rejected_by`` (the first rule in the cascade).

    The cascade is one CASE expression: Spark evaluates a branch only when all before it
    have not matched.
    """
    measured = measures(docs)
    ordered = order_rules(docs, rules, sample_rows)
    cascade = F.when(F.col("base_failed"), F.lit("base"))
    for rule in ordered:
        cascade = cascade.when(rule.rejects(), F.lit(rule.name))
    return measured.withColumn("rejected_by", cascade).withColumn(
        "kept", F.col("rejected_by").isNull()
    )


def digest(docs: DataFrame) -> DataFrame:
    """The measures and the verdict of every row, by doc_id."""
    return judge(docs.select("doc_id", "text")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with their own columns.

    Only the text is judged, so columns of any name may stand beside it.
    """
    own = [F.col(f"`{c}`").alias(f"_own{k}") for k, c in enumerate(docs.columns)]
    kept = judge(docs.select("text", *own)).where("kept")
    return kept.select(*[F.col(f"_own{k}").alias(c) for k, c in enumerate(docs.columns)])


#: DuckDB SQL for the measures and the verdict.
SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^ \t\n\v\f\r]+') AS w
  FROM documents
), m AS (
  SELECT doc_id, text, len(w) AS n_words, w,
         length(regexp_replace(text, '[ \t\n\v\f\r]', '', 'g')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         list_filter(string_split(text, chr(10)),
                     lambda x: regexp_matches(x, '[^ \t\n\v\f\r]')) AS lines,
         list_transform(range(1, greatest(len(w) - 6, 1)),
                        lambda i: array_to_string(w[i:i + 7], ' ')) AS g
  FROM t
), k AS (
  SELECT row_number() OVER () AS k, * FROM m
), g AS (
  SELECT k, unnest(g) AS gram, unnest(range(len(g))) AS pos FROM k
), r AS (
  SELECT k, pos FROM g QUALIFY count(*) OVER (PARTITION BY k, gram) > 1
), c AS (
  SELECT k, sum(least(8, pos - coalesce(last, -8))) AS n
  FROM (SELECT k, pos, lag(pos) OVER (PARTITION BY k ORDER BY pos) AS last FROM r) GROUP BY k
), b AS (
  SELECT doc_id, text, n_words, word_chars, n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM k LEFT JOIN c USING (k)
), s AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
         length(regexp_replace(text, '[^A-Z]', '', 'g')) AS capitals,
         len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ \t\n\v\f\r]'))) AS lines,
         len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '^[ \t]*[-*•]') AND regexp_matches(x, '[^ \t\n\v\f\r]'))) AS bullets,
         len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '(\.\.\.|…) *$'))) AS dotted
  FROM b
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words
            OR word_chars < 2 * n_words OR word_chars > 20 * n_words
            OR 50 * n_dup_lines > 3 * n_words
            OR 2 * capitals > word_chars
            OR lines >= 5 AND 10 * bullets > 9 * lines
            OR lines >= 5 AND 10 * dotted > 3 * lines) AS kept
FROM s
"""
