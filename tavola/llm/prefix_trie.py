"""Trie of the prefixes that conversations share, from adaptive radix trees of many tasks.

A turn's id is the 128-bit MD5 of its role and text. A conversation is the sequence of its turns'
ids, so conversations with equal first turns share the first nodes of a radix tree. Each task
builds trees of the rows it has, whichever they are, and gives out what they know of each node
at a whole turn; the parts of a node are added up afterwards. A first turn that all
conversations share is one row for each tree.

Sums over a subtree are sums over conversations. What counts each node once, however many
conversations pass it, is brought by the node's owner, its smallest member: a conversation owns
the lower end of its path, from a depth that the first pass finds. The second pass reads owners
alone.

Nothing gathers a whole conversation or all members of a node. Turns are numbered along a
range-partitioned sort, and a conversation of more than ``segment`` turns is cut into segments
that start where the last one ended. Digests of members read sorted pieces of the list in turn.

Rows: turns are in the order of ``turn`` (missing first), those of equal ``turn`` in the order of
their ids; repeated rows are turns of their own. A missing role or text is empty. Rows without
conv_id belong to no conversation and are left out. An empty table has no nodes, not even a
root. Other columns are not read; long texts are only hashed and measured.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tavola.llm.radix import NEVER, ROOT, RadixTree, next_start
from tavola.llm.shared import stored

#: Turns of a segment, and bytes of keys that a tree holds before it is given out.
SEGMENT, TREE = 256, 16_000_000
#: Ids in a piece of a member list.
PIECE = 4096
#: The most turns that are taken from the conversation that opens a hundred.
OPENING = 5

EMPTY_SHA = hashlib.sha256(b"").hexdigest()

_NUMBERED = "conv_id long, lane int, opening int, opened long, nth long, id binary, chars int"
_PARTS = (
    "node binary, parent binary, depth long, n long, first long, ends array<long>, "
    "chars long, owned long, leaves long"
)


def turn_rows(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, id and chars (code points of the text) of every turn."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    told = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("turn"),
        F.unhex(F.md5(told)).alias("id"),
        F.char_length(text).cast("int").alias("chars"),
    )


def own_from(conv_id: str = "conv_id") -> Column:
    """How many turns a conversation takes from the one that opens its hundred."""
    return F.pmod(F.crc32(F.col(conv_id).cast("string").cast("binary")), F.lit(OPENING + 1)).cast("int")


def _opened_rows(turns: DataFrame) -> DataFrame:
    """All conversations with the turns that they take over: conv_id, opening (0 for a row that
    only says that the conversation is there, 1 for a turn taken over, 2 for one of its own),
    place (among the turns of the other), turn, id and chars."""
    first = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "id")
    heads = (
        turns.where("conv_id % 100 = 0")
        .withColumn("place", F.row_number().over(first))
        .where(F.col("place") <= OPENING)
        .select(F.col("conv_id").alias("base"), "place", "id", "chars")
    )
    there = turns.select("conv_id").distinct()
    taken = (
        there.select("conv_id", (F.col("conv_id") - F.col("conv_id") % 100).alias("base"), own_from().alias("h"))
        .join(heads, "base")
        .where("place <= h")
    )
    nothing = F.lit(None)
    columns = ["conv_id", "opening", "place", "turn", "id", "chars"]
    turn_type = turns.schema["turn"].dataType
    marks = there.select(
        "conv_id",
        F.lit(0).alias("opening"),
        F.lit(0).alias("place"),
        nothing.cast(turn_type).alias("turn"),
        nothing.cast("binary").alias("id"),
        F.lit(0).alias("chars"),
    )
    taken = taken.withColumns({"opening": F.lit(1), "turn": nothing.cast(turn_type)}).select(*columns)
    own = turns.withColumns({"opening": F.lit(2), "place": F.lit(0)}).select(*columns)
    return marks.union(taken).union(own)


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Along sorted rows: the partition, the turns taken over so far, and the place of each row
    among the own turns of its conversation, as far as this partition goes."""
    lane = TaskContext.get().partitionId()
    conv, opened, nth = None, 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = batch.column("conv_id").to_numpy()
        kind = batch.column("opening").to_numpy()
        start = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
        run = np.searchsorted(start, np.arange(len(ids)), side="right") - 1
        seen, own = np.cumsum(kind == 1), np.cumsum(kind == 2)
        base_seen = (seen - (kind == 1))[start]
        base_own = (own - (kind == 2))[start]
        if conv is not None and ids[0] == conv:
            base_seen[0] -= opened
            base_own[0] -= nth
        seen, own = seen - base_seen[run], own - base_own[run]
        conv, opened, nth = ids[-1], seen[-1], own[-1]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("conv_id"),
                pa.array(np.full(len(ids), lane, np.int32)),
                batch.column("opening"),
                pa.array(seen.astype(np.int64)),
                pa.array((own - 1).astype(np.int64)),
                batch.column("id"),
                batch.column("chars"),
            ],
            names=["conv_id", "lane", "opening", "opened", "nth", "id", "chars"],
        )


def rebuilt(conversations: DataFrame) -> DataFrame:
    """conv_id, at (place from 0; null for the row that each conversation has besides its turns),
    id and chars of the turns of all rebuilt conversations."""
    rows = _opened_rows(turn_rows(conversations)).withColumn("tie", F.monotonically_increasing_id())
    ordered = rows.orderBy("conv_id", "opening", "place", F.asc_nulls_first("turn"), "id", "tie").drop("tie")
    numbered = stored(
        ordered.select("conv_id", "opening", "id", "chars").mapInArrow(_number, _NUMBERED), "numbered"
    )
    # a conversation can only go on from one partition of the sort to the next as the last of one
    # and the first of the other: two rows for each partition at most, whatever the data
    ends = numbered.groupBy("lane").agg(F.min("conv_id").alias("low"), F.max("conv_id").alias("high"))
    runs = (
        numbered.join(F.broadcast(ends), "lane")
        .where("conv_id = low or conv_id = high")
        .groupBy("conv_id", "lane")
        .agg(
            F.count(F.when(F.col("opening") == 1, 1)).alias("opened"),
            F.count(F.when(F.col("opening") == 2, 1)).alias("own"),
        )
    )
    lower = Window.partitionBy("conv_id").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    before = runs.select(
        "conv_id",
        "lane",
        F.sum("opened").over(lower).alias("opened_before"),
        F.sum("own").over(lower).alias("own_before"),
    ).where("own_before > 0 or opened_before > 0")
    told = numbered.join(F.broadcast(before), ["conv_id", "lane"], "left")
    opened = F.col("opened") + F.coalesce("opened_before", F.lit(0))
    nth = F.col("nth") + F.coalesce("own_before", F.lit(0)) - own_from()
    at = F.when(F.col("opening") == 1, opened - 1).when(F.col("opening") == 2, opened + nth)
    return told.where((F.col("opening") < 2) | (nth >= 0)).select("conv_id", at.alias("at"), "id", "chars")


def _chain(segment: int):
    """Along segments in order of conversation and level: the node at which each one starts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, start = None, ROOT
        for batch in batches:
            starts = []
            for conv_id, turns in zip(batch.column("conv_id").to_pylist(), batch.column("turns").to_pylist()):
                if conv_id != conv:
                    conv, start = conv_id, ROOT
                starts.append(start)
                start = next_start(start, turns)
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("level"), pa.array(starts, pa.binary())],
                names=["conv_id", "level", "start"],
            )

    return run


def _later(segments: DataFrame, size: Column) -> DataFrame:
    """``rest``: the sum of ``size`` over later segments of the same conversation."""
    later = Window.partitionBy("conv_id").orderBy(F.desc("level")).rowsBetween(Window.unboundedPreceding, -1)
    return segments.withColumn("rest", F.coalesce(F.sum(size).over(later), F.lit(0)).cast("long"))


def _total(chars: Column) -> Column:
    return F.aggregate(chars, F.lit(0).cast("long"), lambda a, b: a + b)


def segments_of(turns: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """Segments of ``segment`` turns at most: conv_id, level, ids, chars, start (the node above),
    last, and rest (code points of later segments); one at least for each conversation."""
    level = F.coalesce(F.floor(F.col("at") / segment), F.lit(0)).cast("long")
    turn = F.when(F.col("at").isNotNull(), F.struct("at", "id", "chars"))
    cut = (
        turns.groupBy("conv_id", level.alias("level"))
        .agg(F.sort_array(F.collect_list(turn)).alias("turns"))
        .select("conv_id", "level", F.col("turns.id").alias("ids"), F.col("turns.chars").alias("chars"))
    )
    cut = stored(cut, "segments")
    # a short first segment is the whole conversation; the others are few and are told apart
    short = (F.col("level") == 0) & (F.size("ids") < segment)
    long = cut.where(~short)
    digest = F.unhex(F.md5(F.aggregate("ids", F.lit(b""), lambda a, b: F.concat(a, b))))
    starts = (
        long.select("conv_id", "level", digest.alias("turns"))
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "level")
        .mapInArrow(_chain(segment), "conv_id long, level long, start binary")
    )
    counted = long.select("conv_id", "level", _total(F.col("chars")).alias("size"))
    rest = _later(counted, F.col("size")).drop("size")
    deepest = counted.groupBy("conv_id").agg(F.max("level").alias("deepest"))
    many = (
        long.join(starts, ["conv_id", "level"])
        .join(rest, ["conv_id", "level"])
        .join(deepest, "conv_id")
        .withColumn("last", F.col("level") == F.col("deepest"))
    )
    columns = ["conv_id", "level", "ids", "chars", "start", "last", "rest"]
    one = cut.where(short).withColumns(
        {"start": F.lit(ROOT), "last": F.lit(True), "rest": F.lit(0).cast("long")}
    )
    return stored(one.select(*columns).union(many.select(*columns)), "starts")


def _trees(segment: int, most: int, owners: bool):
    names = ["node", "parent", "depth", "n", "first", "ends", "chars", "owned", "leaves"]
    types = [pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())] + [pa.int64()] * 3

    def given_out(tree: RadixTree) -> Iterator[pa.RecordBatch]:
        rows = []
        for part in tree.parts():
            rows.append(part)
            if len(rows) == 10_000:
                yield table(rows)
                rows = []
        if rows:
            yield table(rows)

    def table(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(zip(*rows), types)], names=names
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = RadixTree(segment)
        for batch in batches:
            columns = [batch.column(c) for c in ("conv_id", "level", "start", "ids", "chars", "last", "rest")]
            if owners:
                columns += [batch.column(c) for c in ("above", "rest_owned", "leaves")]
            for at in range(0, batch.num_rows, 1000):
                for row in zip(*(c.slice(at, 1000).to_pylist() for c in columns)):
                    tree.add(*row)
                    if tree.held > most:
                        yield from given_out(tree)
                        tree = RadixTree(segment)
        yield from given_out(tree)

    return run


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Along rows in order of node and conversation: comma-joined ids of up to PIECE members."""
    node, ids = None, []

    def piece() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array([node], pa.binary()),
                pa.array([ids[0]], pa.int64()),
                pa.array([",".join(map(str, ids))], pa.string()),
            ],
            names=["node", "low", "members"],
        )

    out: list[pa.RecordBatch] = []
    for batch in batches:
        for key, conv_id in zip(batch.column("node").to_pylist(), batch.column("conv_id").to_pylist()):
            if ids and (key != node or len(ids) == PIECE):
                out.append(piece())
                ids = []
            node = key
            ids.append(conv_id)
        if out:
            yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]
            out = []
    if ids:
        yield piece()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Along pieces in order: the SHA-256 of each node's whole list."""
    node, going = None, None
    for batch in batches:
        done = []
        for key, members in zip(batch.column("node").to_pylist(), batch.column("members").to_pylist()):
            if key != node:
                if node is not None:
                    done.append((node, going.hexdigest()))
                node, going = key, hashlib.sha256()
            else:
                going.update(b",")
            going.update(members.encode())
        if done:
            yield _digest_rows(done)
    if node is not None:
        yield _digest_rows([(node, going.hexdigest())])


def _digest_rows(done: list[tuple[bytes, str]]) -> pa.RecordBatch:
    nodes, digests = zip(*done)
    return pa.RecordBatch.from_arrays(
        [pa.array(nodes, pa.binary()), pa.array(digests, pa.string())], names=["node", "ends_sha256"]
    )


def build(conversations: DataFrame, segment: int = SEGMENT, most: int = TREE) -> DataFrame:
    """The nodes of the trie of rebuilt conversations.

    node and parent (128-bit names), conv_id (the smallest member), parent_conv_id, depth,
    n_convs, n_children, n_leaves, saved_tokens and ends_sha256.
    """
    cut = segments_of(rebuilt(conversations), segment)
    parts = stored(cut.mapInArrow(_trees(segment, most, False), _PARTS), "parts")
    nodes = stored(
        parts.groupBy("node").agg(
            F.min("parent").alias("parent"),
            F.min("depth").alias("depth"),
            F.sum("n").alias("n"),
            F.min("first").alias("first"),
            F.sum(F.size("ends")).cast("long").alias("ended"),
            F.sum("chars").alias("chars"),
        ),
        "nodes",
    )
    # a node's owner is its smallest member, which owns the lower end of its own path
    owners = nodes.groupBy(F.col("first").alias("conv_id")).agg(
        (F.min("depth") - 1).alias("above"),
        F.max((F.col("ended") == F.col("n")).cast("long")).alias("leaves"),
    )
    owned = cut.join(owners, "conv_id")
    whole = (F.col("level") == 0) & F.col("last")
    mine = F.filter("chars", lambda c, k: F.col("level") * segment + k + 1 > F.col("above"))
    some = owned.where(~whole).select("conv_id", "level", _total(mine).alias("size"))
    later = _later(some, F.col("size")).select("conv_id", "level", F.col("rest").alias("rest_owned"))
    owned = owned.where(whole).withColumn("rest_owned", F.lit(0).cast("long")).unionByName(
        owned.where(~whole).join(later, ["conv_id", "level"])
    )
    once = owned.mapInArrow(_trees(segment, most, True), _PARTS)
    members = parts.select("node", F.explode("ends").alias("conv_id")).orderBy("node", "conv_id")
    listed = (
        members.mapInArrow(_pieces, "node binary, low long, members string")
        .repartition("node")
        .sortWithinPartitions("node", "low")
        .mapInArrow(_digests, "node binary, ends_sha256 string")
    )
    facts = {
        "parent": "binary",
        "depth": "long",
        "n": "long",
        "first": "long",
        "chars": "long",
        "children": "long",
        "owned": "long",
        "leaves": "long",
        "ends_sha256": "string",
    }

    def fact(df: DataFrame, *given: str) -> DataFrame:
        return df.select(
            "node", *[(F.col(c) if c in given else F.lit(None)).cast(t).alias(c) for c, t in facts.items()]
        )

    below = nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(
        F.count(F.lit(1)).alias("children")
    )
    single = once.groupBy("node").agg(F.sum("owned").alias("owned"), F.sum("leaves").alias("leaves"))
    all_facts = (
        fact(nodes, "parent", "depth", "n", "first", "chars")
        .union(fact(below, "children"))
        .union(fact(single, "owned", "leaves"))
        .union(fact(listed, "ends_sha256"))
    )
    # every fact is of one row of a node, so the largest is the one that is there
    known = stored(all_facts.groupBy("node").agg(*[F.max(c).alias(c) for c in facts]), "facts")
    parents = known.select(F.col("node").alias("parent"), F.col("first").alias("parent_conv_id"))
    return known.join(parents, "parent", "left").select(
        "node",
        "parent",
        F.col("first").alias("conv_id"),
        "parent_conv_id",
        "depth",
        F.col("n").alias("n_convs"),
        F.coalesce("children", F.lit(0).cast("long")).alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        (F.col("chars") - F.col("owned")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"),
    )


def digest(conversations: DataFrame) -> DataFrame:
    return build(conversations).drop("node", "parent")


#: DuckDB SQL for the rows of ``digest``.
SQL = r"""
WITH t AS (
  SELECT conv_id, length(coalesce(text, '')) AS chars,
         md5(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS id, turn
  FROM conversations WHERE conv_id IS NOT NULL
), o AS (
  SELECT conv_id, id, chars, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, id) - 1 AS pos FROM t
), c AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base,
         xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
             lambda x: list_concat([CAST(ascii(x) AS BIGINT)], list_transform(range(8), lambda y: CAST(-1 AS BIGINT)))))),
           lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a >> 1, CAST(3988292384 AS BIGINT)) ELSE a >> 1 END),
         CAST(4294967295 AS BIGINT)) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM t)
), g AS (
  SELECT c.conv_id, c.h, least(c.h, count(o.id)) AS g FROM c LEFT JOIN o ON o.conv_id = c.base GROUP BY c.conv_id, c.h
), r AS (
  SELECT c.conv_id, o.pos AS nth, o.id, o.chars FROM c JOIN o ON o.conv_id = c.base AND o.pos < c.h
  UNION ALL
  SELECT conv_id, o.pos - g.h + g.g, o.id, o.chars FROM o JOIN g USING (conv_id) WHERE o.pos >= g.h
), p AS (
  SELECT conv_id, 0 AS depth, '' AS prefix, 0 AS chars FROM c
  UNION ALL
  SELECT conv_id, nth + 1, string_agg(id, '') OVER (PARTITION BY conv_id ORDER BY nth), chars FROM r
), l AS (
  SELECT conv_id, max(depth) AS len FROM p GROUP BY conv_id
), n AS (
  SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n, any_value(chars) AS chars,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len = depth), '')) AS ends
  FROM p JOIN l USING (conv_id) GROUP BY prefix, depth
), k AS (
  SELECT n.prefix, count(m.prefix) AS children
  FROM n LEFT JOIN n m ON m.depth = n.depth + 1 AND m.prefix[:32 * n.depth] = n.prefix GROUP BY n.prefix
), s AS (
  SELECT a.prefix[:32 * d] AS prefix, sum((a.n - 1) * a.chars) AS saved, count(*) FILTER (k.children = 0) AS leaves
  FROM (SELECT *, unnest(range(depth + 1)) AS d FROM n) a JOIN k ON k.prefix = a.prefix GROUP BY ALL
)
SELECT n.conv_id, u.conv_id AS parent_conv_id, CAST(n.depth AS BIGINT) AS depth, n.n AS n_convs,
       k.children AS n_children, s.leaves AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, n.ends AS ends_sha256
FROM n JOIN k ON k.prefix = n.prefix JOIN s ON s.prefix = n.prefix
LEFT JOIN n u ON u.depth = n.depth - 1 AND n.prefix[:32 * u.depth] = u.prefix
"""
