"""A compressed (radix) trie of byte strings with rows at its terminals."""

from __future__ import annotations

from collections.abc import Iterator

#: What a node takes beside its label, roughly.
NODE_BYTES = 250


class Node:
    __slots__ = ("label", "below", "rows")

    def __init__(self, label: bytes) -> None:
        self.label = label
        self.below: dict[int, Node] = {}
        self.rows = None


def common(label: bytes, data: bytes, at: int) -> int:
    """How many leading bytes of ``label`` stand in ``data`` at ``at``."""
    low, high = 0, min(len(label), len(data) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if label[low:middle] == data[at + low:at + middle]:
            low = middle
        else:
            high = middle - 1
    return low


class Trie:
    """``size`` is about the memory it takes; a text that shares its beginning with others stores only the rest."""

    def __init__(self) -> None:
        self.root = Node(b"")
        self.size = 0

    def insert(self, data: bytes) -> Node:
        """The terminal of a text; its ``rows`` is None if the text is new."""
        node, at = self.root, 0
        while at < len(data):
            child = node.below.get(data[at])
            if child is None:
                child = node.below[data[at]] = Node(data[at:])
                self.size += len(child.label) + NODE_BYTES
                return child
            if not data.startswith(child.label, at):
                cut = common(child.label, data, at)
                middle = node.below[data[at]] = Node(child.label[:cut])
                child.label = child.label[cut:]
                middle.below[child.label[0]] = child
                self.size += NODE_BYTES
                child = middle
            at += len(child.label)
            node = child
        return node

    def terminals(self) -> Iterator[tuple[bytes, Node]]:
        """Every text that was inserted, with its terminal."""
        open_ = [(b"", self.root)]
        while open_:
            before, node = open_.pop()
            text = before + node.label
            if node.rows is not None:
                yield text, node
            open_.extend((text, child) for child in node.below.values())
