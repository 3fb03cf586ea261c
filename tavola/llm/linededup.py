"""Line dedup over a suffix array of line ids, in native columns only.

The corpus is one sequence of line ids, document after document in the order of doc_id (nulls
first) and text hash; blank lines are left out, lines are compared without white space at their
ends. Lines that occur once cannot lie in a repeated run; they cut the sequence, and only the
others are sorted.

*Prefix doubling.* ``r0`` is the rank of a line, ``r(k+1)`` the rank of the pair (rk at a place,
rk at the place 2**k further on) in sorted order: the order of suffixes by their first 2**(k+1)
lines. Ranks come from a range-partitioned sort. A pair that occurs once names a suffix that is
settled, and drops out.

*Intervals.* The suffixes that agree on their first l lines are an interval of the suffix array,
named by l and by the ranks of the two halves, overlapping if need be, that cover these lines.
A run qualifies with ``min_words`` words. It is enough to look at the shortest qualifying run
that starts at each line and the shortest that ends at each line: a line of a longer repeated
run lies in one of those, and what they cover together is what the maximal repeated runs cover.
In each interval the first place is kept; at all others the lines of the run are deleted.

Rows: rows of equal doc_id and text are one document and are treated alike. Missing and empty
texts have no lines and pass through. A document that loses its last line with a word is a copy
of earlier text and is removed. Columns other than doc_id and text pass through, n_chars is
counted anew, and an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tavola.llm.quality import WORD, words_of
from tavola.llm.shared import stored

MIN_WORDS = 50


def _lines(docs: DataFrame) -> DataFrame:
    """doc_id, part, seq (place among lines with a word), idx (place among all), line, words."""
    placed = F.transform(
        F.split("text", "\n"),
        lambda x, i: F.struct(
            i.alias("idx"), F.regexp_replace(x, r"^[ \t\x0B\f\r]+|[ \t\x0B\f\r]+$", "").alias("line")
        ),
    )
    return (
        docs.select("doc_id", F.xxhash64("text").alias("part"), F.filter(placed, lambda x: x["line"] != "").alias("lines"))
        .select("doc_id", "part", F.posexplode("lines").alias("seq", "at"))
        .select(
            "doc_id",
            "part",
            "seq",
            F.col("at.idx").alias("idx"),
            F.xxhash64("at.line").alias("r0"),
            F.size(words_of(F.col("at.line"))).alias("words"),
        )
    )


def _repeated(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Numbers of the documents in order, and the places of lines that occur at least twice."""
    lines = stored(_lines(docs).distinct(), "lines")
    often = lines.groupBy("r0").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("r0")
    # written apart, so that a hot line can be split in the join
    places = lines.join(stored(often, "often"), "r0")
    places = stored(places, "repeated")
    numbers = (
        places.select(F.col("doc_id").alias("id"), F.col("part").alias("of"))
        .distinct()
        .orderBy(F.col("id").asc_nulls_first(), "of")
        .withColumn("doc", F.monotonically_increasing_id())
    )
    numbers = stored(numbers, "numbers")
    places = places.join(
        numbers, places["doc_id"].eqNullSafe(numbers["id"]) & (places["part"] == numbers["of"])
    ).select("doc", "seq", "idx", "r0", "words")
    return numbers, stored(places, "places")


def _windows(places: DataFrame, min_words: int) -> DataFrame:
    """doc, start and l of the shortest qualifying runs from and up to each place."""
    by_doc = Window.partitionBy("doc").orderBy("seq")
    run = Window.partitionBy("doc", "run")
    cut = places.withColumn("run", F.col("seq") - F.row_number().over(by_doc))
    summed = cut.withColumn("upto", F.sum("words").over(run.orderBy("seq"))).withColumn(
        "before", F.col("upto") - F.col("words")
    )
    reach = summed.withColumn("total", F.sum("words").over(run))
    forward = run.orderBy("before").rangeBetween(0, min_words - 1)
    backward = run.orderBy("upto").rangeBetween(-(min_words - 1), 0)
    counted = reach.withColumn("ahead", F.count(F.lit(1)).over(forward)).withColumn(
        "behind", F.count(F.lit(1)).over(backward)
    )
    from_here = counted.where(F.col("total") - F.col("before") >= min_words).select(
        "doc", F.col("seq").alias("start"), F.col("ahead").cast("int").alias("l")
    )
    to_here = counted.where(F.col("upto") >= min_words).select(
        "doc", (F.col("seq") - F.col("behind") + 1).cast("int").alias("start"), F.col("behind").cast("int").alias("l")
    )
    return from_here.union(to_here).distinct()


def suffix_ranks(places: DataFrame, levels: int) -> DataFrame:
    """``places`` with the ranks r1..r(levels) by prefix doubling; null where settled."""
    step = 1
    for k in range(1, levels + 1):
        last, new = f"r{k - 1}", f"r{k}"
        by_doc = Window.partitionBy("doc").orderBy("seq")
        ahead = places.withColumn("_next", F.lead(last, step).over(by_doc)).withColumn(
            "_there", F.lead("seq", step).over(by_doc) == F.col("seq") + step
        )
        ahead = ahead.withColumn("_next", F.when(F.col("_there"), F.col("_next"))).drop("_there")
        pairs = (
            ahead.where(F.col(last).isNotNull() & F.col("_next").isNotNull())
            .groupBy(last, "_next")
            .agg(F.count(F.lit(1)).alias("n"))
            .where("n > 1")
            .select(last, "_next")
            .orderBy(last, "_next")
        )
        # ids that grow along a range-partitioned sort are ranks
        ranks = stored(pairs.withColumn(new, F.monotonically_increasing_id()), "ranks")
        places = stored(ahead.join(ranks, [last, "_next"], "left").drop("_next"), "doubled")
        step *= 2
    return places


def later_copies(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, part (hash of the text) and the sorted places ``gone`` of lines to delete."""
    numbers, places = _repeated(docs)
    windows = stored(_windows(places, min_words), "windows")
    longest = windows.agg(F.max("l")).first()[0] or 1
    levels = longest.bit_length() - 1
    ranked = suffix_ranks(places, levels)

    def rank(side: DataFrame) -> DataFrame:
        return side.select(
            F.col("doc").alias("_doc"), F.col("seq").alias("_seq"), F.array(*[f"r{k}" for k in range(levels + 1)]).alias("_r")
        )

    level = F.floor(F.log2(F.col("l") + 0.5)).cast("int")
    named = windows.withColumn("level", level).withColumn(
        "second", F.col("start") + F.col("l") - F.expr("shiftleft(1, level)")
    )
    for place, name in (("start", "first_rank"), ("second", "second_rank")):
        named = named.join(
            rank(ranked), (F.col("doc") == F.col("_doc")) & (F.col(place) == F.col("_seq"))
        ).select(*named.columns, F.get("_r", F.col("level")).alias(name))
        named = named.where(F.col(name).isNotNull())
    interval = ["l", "first_rank", "second_rank"]
    firsts = named.groupBy(*interval).agg(
        F.min(F.struct("doc", "start")).alias("kept"), F.count(F.lit(1)).alias("n")
    )
    again = (
        named.join(stored(firsts.where("n > 1"), "firsts"), interval)
        .where(F.struct("doc", "start") != F.col("kept"))
        .select("doc", F.explode(F.sequence("start", F.col("start") + F.col("l") - 1)).alias("seq"))
        .distinct()
    )
    return (
        again.join(places.select("doc", "seq", "idx"), ["doc", "seq"])
        .groupBy("doc")
        .agg(F.sort_array(F.collect_list("idx")).alias("gone"))
        .join(numbers, "doc")
        .select(F.col("id").alias("doc_id"), F.col("of").alias("part"), "gone")
    )


def _cleaned(docs: DataFrame, min_words: int) -> tuple[DataFrame, list]:
    """The rows of ``cleaned`` under names that no column of ``docs`` can clash with, and the
    columns that give those of ``docs`` back."""
    own = {c: f"_own{k}" for k, c in enumerate(docs.columns)}
    rows = docs.select(*[F.col(f"`{c}`").alias(name) for c, name in own.items()])
    text = F.col(own["text"])
    copies = later_copies(docs.select("doc_id", "text"), min_words).select(
        F.col("doc_id").alias("_id"), F.col("part").alias("_part"), F.col("gone").alias("_lines")
    )
    # what is deleted grows with the corpus: it is never broadcast
    copies = stored(copies, "copies").hint("merge")
    joined = rows.join(
        copies, F.col(own["doc_id"]).eqNullSafe(F.col("_id")) & (F.xxhash64(text) == F.col("_part")), "left"
    )
    lines = F.split(text, "\n")
    # the lines are cut once, whatever the number that stay
    left = F.get(
        F.transform(
            F.array(lines),
            lambda cut: F.concat_ws(
                "\n",
                F.transform(
                    F.array_except(F.sequence(F.lit(0), F.size(cut) - 1), F.col("_lines")),
                    lambda i: F.get(cut, i),
                ),
            ),
        ),
        F.lit(0),
    )
    changed = F.col("_lines").isNotNull()
    joined = joined.withColumn(own["text"], F.when(changed, left).otherwise(text))
    if "n_chars" in own:
        counted = F.length(text).cast(docs.schema["n_chars"].dataType)
        joined = joined.withColumn(own["n_chars"], F.when(changed, counted).otherwise(F.col(own["n_chars"])))
    joined = joined.select(
        *own.values(),
        F.coalesce(F.size("_lines"), F.lit(0)).alias("_gone"),
        (changed & ~F.rlike(text, F.lit(WORD))).alias("_removed"),
    )
    return joined, [F.col(name).alias(c) for c, name in own.items()]


def cleaned(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the later copies deleted from text, and the columns _gone (number of lines
    deleted) and _removed (no line with a word is left of some)."""
    rows, own = _cleaned(docs, min_words)
    return rows.select(*own, "_gone", "_removed")


def digest(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, the text that is left, n_deleted lines, and whether nothing is left."""
    return cleaned(docs.select("doc_id", "text")).select(
        "doc_id",
        "text",
        F.col("_gone").cast("long").alias("n_deleted"),
        F.col("_removed").alias("removed"),
    )


def drop_copies(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with later copies of lines deleted, without documents of which nothing is left.

    Columns of any name may stand beside doc_id and text.
    """
    rows, own = _cleaned(docs, min_words)
    return rows.where("not _removed").select(*own)
