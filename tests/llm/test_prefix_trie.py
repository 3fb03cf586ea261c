"""Conversation prefix trie: brute force, segments, layouts and odd rows."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tavola.llm import prefix_trie
from tavola.llm.radix import ROOT, Node, RadixTree

SCHEMA = "conv_id long, turn int, role string, text string, node string, `at.b` int"


def _turn_id(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()


def _rebuild(rows):
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own[conv_id].append((turn is not None, turn or 0, _turn_id(role or "", text or ""), role or "", text or ""))
    own = {c: [turn[3:] for turn in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return out


def _brute(rows):
    built = _rebuild(rows)
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = set()
    for node, convs in members.items():
        below = [m for m in members if m[: len(node)] == node]
        children = [m for m in below if len(m) == len(node) + 1]
        leaves = [m for m in below if not any(len(x) > len(m) and x[: len(m)] == m for x in below)]
        saved = sum((len(members[m]) - 1) * len(m[-1][1]) for m in below if m)
        ends = ",".join(str(c) for c in sorted(convs) if len(built[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.add((min(convs), parent, len(node), len(convs), len(children), len(leaves), saved,
                 hashlib.sha256(ends.encode()).hexdigest()))
    return out


COLUMNS = "conv_id parent_conv_id depth n_convs n_children n_leaves saved_tokens ends_sha256".split()


def _rows(spark, rows, **options):
    frame = spark.createDataFrame([(*row, "x", 1) for row in rows], SCHEMA)
    found = prefix_trie.build(frame, **options).select(*COLUMNS).collect()
    assert len(found) == len(set(found))
    return {tuple(row) for row in found}


def _random_rows(seed, convs, turns, texts):
    rng = random.Random(seed)
    rows = []
    for _ in range(convs):
        c = rng.choice([0, 100, 200]) + rng.randrange(100)
        rows += [(c, t, rng.choice(["user", "assistant"]), rng.choice(texts)) for t in range(rng.randrange(1, turns))]
    for base in (0, 100):
        rows += [(base, t, "user", f"opening {t}") for t in range(rng.randrange(4))]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = _random_rows(seed, 60, 9, ["a", "bé", "", "long 日本 text"])
    assert _rows(spark, rows) == _brute(rows)


def test_segments_and_small_trees_change_nothing(spark):
    rows = _random_rows(5, 40, 14, ["a", "b"])
    # conversations that share their first segments, one the whole of another, and one very long
    for c in (301, 302, 303, 401):
        rows += [(c, t, "user", "same" if t < 6 + c % 5 else f"{c}") for t in range(7 + c % 7)]
    rows += [(555, t, "user", str(t % 3)) for t in range(120)]
    expected = _brute(rows)
    assert _rows(spark, rows, segment=3, most=500) == expected
    assert _rows(spark, rows, segment=4) == expected


def test_odd_rows(spark):
    rows = [
        (None, 1, "user", "nobody's"),
        (7, None, None, None),
        (7, 1, "user", "x"),
        (7, 1, "user", "x"),
        (7, 1, "", "userx"),
        (-3, 2, "user", "x"),
        (8, 0, "user", "w" * 100_000),
        (100, 0, "a", "b"),
        (101, 0, "a", "b"),
    ]
    # -3 % 100 is -3 here: the conversation that opens its hundred is 0, which is not there
    assert _rows(spark, [r for r in rows if r[0] != -3]) == _brute([r for r in rows if r[0] != -3])
    assert {row[0] for row in _rows(spark, rows)} >= {-3}


def test_turnless_conversations_are_members_of_the_root(spark):
    few = next(c for c in range(1, 99) if zlib.crc32(str(c).encode()) % 6 > 1)
    found = _rows(spark, [(few, 0, "user", "gone")])
    assert found == {(few, None, 0, 1, 0, 1, 0, hashlib.sha256(str(few).encode()).hexdigest())}


def test_empty_table(spark):
    assert _rows(spark, []) == set()


def test_a_member_list_longer_than_a_piece(spark, monkeypatch):
    alone = [c for c in range(1, 100_000) if zlib.crc32(str(c).encode()) % 6 == 0][:9000]
    frame = spark.createDataFrame([(c, 0, "user", "hello", "x", 1) for c in alone], SCHEMA)
    rows = {r["depth"]: r for r in prefix_trie.build(frame).collect()}
    assert rows[1]["n_convs"] == 9000 and rows[1]["n_leaves"] == 1
    assert rows[1]["saved_tokens"] == 8999 * 5
    assert rows[1]["ends_sha256"] == hashlib.sha256(",".join(map(str, alone)).encode()).hexdigest()


def test_node_layouts_grow():
    node, order = Node(b""), random.Random(3).sample(range(256), 256)
    rooms = []
    for k, byte in enumerate(order, 1):
        node.put(byte, Node(bytes([byte])))
        rooms.append(node.room)
        assert [kid.path[0] for kid in node.children()] == sorted(order[:k])
        assert all((node.find(b) is not None) == (b in order[:k]) for b in range(256))
    assert [rooms.index(r) + 1 for r in (4, 16, 48, 256)] == [1, 5, 17, 49]


def test_paths_are_compressed_and_cut_between_turns():
    tree = RadixTree(100)
    a, b, c = bytes(15) + b"\x01", bytes(15) + b"\x02", b"\x09" * 16
    tree.add(1, 0, ROOT, [c, a], [1, 2], True)
    tree.add(2, 0, ROOT, [c, b], [1, 3], True)
    # the paths part at the last byte of the second turn: no node there, but at each whole turn
    assert [(p.depth, p.n, p.first, p.chars) for p in tree.parts()] == [(2, 1, 1, 2), (2, 1, 2, 3), (1, 2, 1, 7), (0, 2, 1, 7)]
    (below,) = tree.top.children()
    assert len(below.path) == 16 * 3 - 1 and len(below.children()) == 2
