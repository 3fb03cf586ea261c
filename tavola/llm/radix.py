"""An adaptive radix tree over byte keys that are sequences of turns.

A key is 16 bytes that name where it starts (the root, or the node that a long conversation has
reached) and 16 bytes for each turn, all big-endian. Nodes hold their children in one of four
layouts and take the next larger one when full; a node without a choice is part of the path of
the node below it. Paths break at any byte. Only depths that are whole turns are given out.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from typing import NamedTuple

WIDTH = 16
ROOT = bytes(WIDTH)
#: no conversation of a key owns a node
NEVER = 1 << 62


class Node:
    """Bytes of the path into the node, its children, and the keys that end here.

    Layouts: up to 4 or 16 children with their bytes in order; up to 48 behind an index of 256
    places; 256 places.
    """

    __slots__ = ("path", "room", "bytes", "kids", "end")

    def __init__(self, path: bytes) -> None:
        self.path = path
        self.room = 4
        self.bytes = bytearray()
        self.kids: list = []
        self.end: list | None = None

    def find(self, byte: int) -> Node | None:
        if self.room <= 16:
            at = self.bytes.find(byte)
            return self.kids[at] if at >= 0 else None
        if self.room == 48:
            at = self.bytes[byte]
            return self.kids[at] if at < 255 else None
        return self.kids[byte]

    def put(self, byte: int, child: Node) -> None:
        """Set the child of ``byte``, in a larger layout if there is no place left."""
        if self.room <= 16:
            at = bisect_left(self.bytes, byte)
            if at < len(self.bytes) and self.bytes[at] == byte:
                self.kids[at] = child
                return
            if len(self.kids) < self.room:
                self.bytes.insert(at, byte)
                self.kids.insert(at, child)
                return
            self._grow()
            self.put(byte, child)
        elif self.room == 48:
            at = self.bytes[byte]
            if at < 255:
                self.kids[at] = child
            elif len(self.kids) < 48:
                self.bytes[byte] = len(self.kids)
                self.kids.append(child)
            else:
                self._grow()
                self.put(byte, child)
        else:
            self.kids[byte] = child

    def _grow(self) -> None:
        if self.room == 4:
            self.room = 16
        elif self.room == 16:
            index = bytearray(b"\xff" * 256)
            for at, byte in enumerate(self.bytes):
                index[byte] = at
            self.room, self.bytes = 48, index
        else:
            places: list = [None] * 256
            for byte, at in enumerate(self.bytes):
                if at < 255:
                    places[byte] = self.kids[at]
            self.room, self.bytes, self.kids = 256, bytearray(), places

    def children(self) -> list[Node]:
        """The children in the order of their bytes."""
        if self.room <= 16:
            return self.kids
        if self.room == 48:
            return [self.kids[at] for at in self.bytes if at < 255]
        return [kid for kid in self.kids if kid is not None]


class Part(NamedTuple):
    """What the keys of one tree say about a node; trees of other tasks add to it."""

    node: bytes
    parent: bytes | None
    depth: int
    #: keys below, the smallest of their conversations, and those that end here for good
    n: int
    first: int
    ends: list[int]
    #: code points of the last turn of each node of the subtree, times the keys through it; of
    #: the nodes owned by a key; and the leaves that keys bring
    chars: int
    owned: int
    leaves: int


class RadixTree:
    """Keys of conversations, cut into segments of ``segment`` turns."""

    def __init__(self, segment: int) -> None:
        self.segment = segment
        self.top = Node(b"")
        self.level: dict[bytes, int] = {}
        self.chars: dict[bytes, int] = {}
        self.held = 0

    def add(
        self,
        conv_id: int,
        level: int,
        start: bytes,
        turns: list[bytes],
        chars: list[int],
        last: bool,
        rest: int = 0,
        above: int = NEVER,
        rest_owned: int = 0,
        leaves: int = 0,
    ) -> None:
        """A segment of a conversation: its ``level``, the node it starts at, and its turns.

        ``last``: the conversation ends with it. ``rest``: code points of later segments.
        ``above``: the conversation owns the nodes below that depth, ``rest_owned`` code points
        of them in later segments. ``leaves``: 1 if its last node is a leaf that it owns.
        """
        self.level[start] = level
        self.chars.update(zip(turns, chars))
        end = self._end(start + b"".join(turns))
        self.held += WIDTH * (len(turns) + 8)
        if end.end is None:
            end.end = [0, conv_id, [], 0, above, 0, 0]
        e = end.end
        e[0] += 1
        e[1] = min(e[1], conv_id)
        if last:
            e[2].append(conv_id)
        e[3] += rest
        e[4] = min(e[4], above)
        e[5] += rest_owned
        e[6] += leaves

    def _end(self, key: bytes) -> Node:
        """The node where ``key`` ends, made if it is not there."""
        node, at = self.top, 0
        while at < len(key):
            child = node.find(key[at])
            if child is None:
                child = Node(key[at:])
                node.put(key[at], child)
                return child
            path = child.path
            if key.startswith(path, at):
                node, at = child, at + len(path)
                continue
            same = 1
            most = min(len(path), len(key) - at)
            while same < most and path[same] == key[at + same]:
                same += 1
            middle = Node(path[:same])
            child.path = path[same:]
            middle.put(child.path[0], child)
            node.put(key[at], middle)
            node, at = middle, at + same
        return node

    def parts(self) -> Iterator[Part]:
        """Every node at a depth of whole turns, children before parents."""
        path = bytearray()
        # by units of 16 bytes: the node's name, and the hash that its children's names go on from
        names: list[bytes] = [b""]
        hashes: list = [None]
        # frames: node, bytes above it, children left to visit, sums of the children seen
        stack = [(self.top, 0, iter(self.top.children()), [0, NEVER, 0, NEVER, 0, 0])]
        while stack:
            node, above, left, sums = stack[-1]
            child = next(left, None)
            if child is not None:
                at = above + len(node.path)
                del path[at:]
                path += child.path
                for unit in range(at // WIDTH + 1, len(path) // WIDTH + 1):
                    self._name(path, unit, names, hashes)
                stack.append((child, at, iter(child.children()), [0, NEVER, 0, NEVER, 0, 0]))
                continue
            stack.pop()
            n, first, chars, owner, owned, leaves = sums
            ends: list[int] = []
            if node.end is not None:
                e = node.end
                n, first, ends, chars = n + e[0], min(first, e[1]), e[2], chars + e[3]
                owner, owned, leaves = min(owner, e[4]), owned + e[5], leaves + e[6]
            bottom = above + len(node.path)
            if bottom:
                level = self.level[bytes(path[:WIDTH])] if bottom >= WIDTH else 0
            for unit in range(bottom // WIDTH, above // WIDTH, -1):
                here = ends if unit * WIDTH == bottom else []
                depth = level * self.segment + unit - 1
                if unit == 1:
                    if level == 0:
                        yield Part(ROOT, None, 0, n, first, here, chars, owned, leaves)
                    continue
                size = self.chars[bytes(path[(unit - 1) * WIDTH : unit * WIDTH])]
                chars += n * size
                if owner < depth:
                    owned += size
                yield Part(names[unit], names[unit - 1], depth, n, first, here, chars, owned, leaves)
            if stack:
                up = stack[-1][3]
                up[0] += n
                up[1] = min(up[1], first)
                up[2] += chars
                up[3] = min(up[3], owner)
                up[4] += owned
                up[5] += leaves
                del path[above:]

    def _name(self, path: bytearray, unit: int, names: list[bytes], hashes: list) -> None:
        del names[unit:], hashes[unit:]
        turn = bytes(path[(unit - 1) * WIDTH : unit * WIDTH])
        if unit == 1:
            names.append(turn)
            hashes.append(hashlib.md5(turn))
            return
        going = hashes[unit - 1].copy()
        going.update(turn)
        hashes.append(going)
        if unit - 1 == self.segment:
            names.append(next_start(names[1], hashlib.md5(path[WIDTH : unit * WIDTH]).digest()))
        else:
            names.append(going.digest())


def next_start(start: bytes, turns: bytes) -> bytes:
    """The node at the end of a whole segment, by the node at its start and the MD5 of its turns."""
    return hashlib.md5(b"segment" + start + turns).digest()
