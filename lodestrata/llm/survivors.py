"""Viterbi survivors that hand out their common past and keep only what is unresolved.

Every state has one survivor, the head of a path in a tree of backpointers.  A node counts
the nodes that point back to it; one that none needs any more is freed, and so are its
ancestors.  As soon as the root has a single child, all survivors share that step: it is
emitted and the child becomes the root.  Equal costs are settled by the whole unresolved
paths, from where they part to their ends.
"""

from __future__ import annotations

from collections.abc import Iterable


class Node:
    __slots__ = ("kids", "label", "parent", "state")

    def __init__(self, parent: Node | None, label, state: int):
        self.parent, self.label, self.state, self.kids = parent, label, state, []


class Survivors:
    """Least-cost paths by state; labels of one step are comparable and none is a prefix of another."""

    def __init__(self, start: int):
        self.root = Node(None, None, start)
        self.heads: dict[int, tuple[int, Node]] = {start: (0, self.root)}
        self.emitted: list[tuple] = []

    def _past(self, a: Node, b: Node) -> tuple[list, list]:
        """Labels of both paths from where they part."""
        left, right = [], []
        while a is not b:
            left.append(a.label)
            right.append(b.label)
            a, b = a.parent, b.parent
        return left[::-1], right[::-1]

    def less(self, a: Node, last_a, b: Node, last_b) -> bool:
        left, right = self._past(a, b)
        return [*left, last_a] < [*right, last_b]

    def step(self, options: Iterable[tuple]) -> None:
        """One step along ``options``: (from, to, cost, label)."""
        best: dict[int, tuple] = {}
        for source, to, cost, label in options:
            if source in self.heads:
                before, node = self.heads[source]
                total, held = before + cost, best.get(to)
                if held is None or total < held[0] or (total == held[0] and self.less(node, label, held[1], held[2])):
                    best[to] = (total, node, label)
        old, self.heads = self.heads, {}
        for to, (total, node, label) in best.items():
            head = Node(node, label, to)
            node.kids.append(head)
            self.heads[to] = (total, head)
        for _, node in old.values():
            self._free(node)
        self._emit()

    def drop(self, states: list[int]) -> None:
        """Give up the survivors of ``states``."""
        for state in states:
            self._free(self.heads.pop(state)[1])
        self._emit()

    def _free(self, node: Node) -> None:
        while not node.kids and node is not self.root:
            parent = node.parent
            parent.kids.remove(node)
            node = parent

    def _emit(self) -> None:
        while len(self.root.kids) == 1:
            self.root = self.root.kids[0]
            self.root.parent = None
            self.emitted.append((self.root.label, self.root.state))

    def path(self, state: int) -> list[tuple]:
        """(label, state) of each step of a state's survivor."""
        node, out = self.heads[state][1], []
        while node is not self.root:
            out.append((node.label, node.state))
            node = node.parent
        return self.emitted + out[::-1]
