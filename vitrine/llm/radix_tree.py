"""An adaptive radix tree over byte strings: path compression, and inner nodes whose layout grows with their children.

Keys may be prefixes of each other and may repeat: a node keeps what ends at it. ``Sorted`` holds up to 4, then up
to 16 children beside a sorted list of their bytes; ``Indexed`` up to 48 behind a table of places; ``Direct`` has
a place for each byte.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from typing import Any


class Sorted:
    __slots__ = ("bytes", "nodes", "room")

    def __init__(self, room: int = 4) -> None:
        self.bytes, self.nodes, self.room = bytearray(), [], room

    def get(self, byte: int) -> Node | None:
        at = self.bytes.find(byte)
        return self.nodes[at] if at >= 0 else None

    def put(self, byte: int, node: Node) -> Layout:
        if len(self.nodes) < self.room:
            at = bisect_left(self.bytes, byte)
            self.bytes.insert(at, byte)
            self.nodes.insert(at, node)
            return self
        if self.room == 4:
            larger = Sorted(16)
            larger.bytes, larger.nodes = self.bytes, self.nodes
        else:
            larger = Indexed()
            for b, n in self.items():
                larger.put(b, n)
        return larger.put(byte, node)

    def items(self) -> Iterator[tuple[int, Node]]:
        return zip(self.bytes, self.nodes)


class Indexed:
    __slots__ = ("places", "nodes")
    room = 48

    def __init__(self) -> None:
        self.places, self.nodes = bytearray(256), []

    def get(self, byte: int) -> Node | None:
        place = self.places[byte]
        return self.nodes[place - 1] if place else None

    def put(self, byte: int, node: Node) -> Layout:
        if len(self.nodes) < self.room:
            self.nodes.append(node)
            self.places[byte] = len(self.nodes)
            return self
        larger = Direct()
        for b, n in self.items():
            larger.put(b, n)
        return larger.put(byte, node)

    def items(self) -> Iterator[tuple[int, Node]]:
        return ((b, self.nodes[p - 1]) for b, p in enumerate(self.places) if p)


class Direct:
    __slots__ = ("nodes",)
    room = 256

    def __init__(self) -> None:
        self.nodes: list[Node | None] = [None] * 256

    def get(self, byte: int) -> Node | None:
        return self.nodes[byte]

    def put(self, byte: int, node: Node) -> Layout:
        self.nodes[byte] = node
        return self

    def items(self) -> Iterator[tuple[int, Node]]:
        return ((b, n) for b, n in enumerate(self.nodes) if n is not None)


Layout = Sorted | Indexed | Direct


class Node:
    """``prefix``: the bytes after the one that leads here; ``ends``: the values of the keys that end here."""

    __slots__ = ("prefix", "ends", "kids", "key", "note")

    def __init__(self, prefix: bytes, key: bytes) -> None:
        self.prefix, self.key = prefix, key  # any key below starts with this node's bytes; one of them is kept
        self.ends: list = []
        self.kids: Layout = Sorted()
        self.note: Any = None


class RadixTree:
    """The root stands for the empty string."""

    def __init__(self) -> None:
        self.root = Node(b"", b"")

    def insert(self, key: bytes, value: Any) -> None:
        node, at = self.root, 0
        while True:
            prefix = node.prefix
            if not key.startswith(prefix, at):
                same = next((i for i, (a, b) in enumerate(zip(prefix, key[at:])) if a != b), min(len(prefix), len(key) - at))
                lower = Node(prefix[same + 1 :], node.key)
                lower.ends, lower.kids = node.ends, node.kids
                node.prefix, node.ends, node.kids = prefix[:same], [], Sorted().put(prefix[same], lower)
                prefix = node.prefix
            at += len(prefix)
            if at == len(key):
                node.ends.append(value)
                return
            kid = node.kids.get(key[at])
            if kid is None:
                kid = Node(key[at + 1 :], key)
                kid.ends.append(value)
                node.kids = node.kids.put(key[at], kid)
                return
            node, at = kid, at + 1

    def walk(self) -> Iterator[tuple[Node, int, int]]:
        """Nodes before their children, with the lengths of their parent's and their own strings (-1 above the root)."""
        left = [(self.root, -1, 0)]
        while left:
            node, start, end = left.pop()
            yield node, start, end
            left.extend((kid, end, end + 1 + len(kid.prefix)) for _, kid in node.kids.items())
