"""A prefix tree over ordered sets, and the search for similar sets in it."""

from __future__ import annotations

import numpy as np


class PrefixTree:
    """Sets of ordered 64-bit names, stored so that equal beginnings are kept once.

    A node holds a run of names, its children, and the lengths of the sets that pass through it.
    """

    __slots__ = ("root", "sizes")

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = [len(s) for s in sets]
        order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u8").tobytes())
        self.root = self._node([sets[i] for i in order], order, 0)

    def _node(self, sets: list[np.ndarray], ids: list[int], depth: int) -> tuple:
        """(run of names, ids of the sets that end here, children, shortest set, longest set)."""
        first, last = sets[0], sets[-1]
        n = min(min(len(s) for s in sets), len(last))
        differ = np.flatnonzero(first[depth:n] != last[depth:n])
        end = depth + int(differ[0]) if len(differ) else n
        ended = [i for s, i in zip(sets, ids) if len(s) == end]
        children, at = [], 0
        while at < len(sets):
            if len(sets[at]) == end:
                at += 1
                continue
            stop, name = at + 1, sets[at][end]
            while stop < len(sets) and len(sets[stop]) > end and sets[stop][end] == name:
                stop += 1
            children.append(self._node(sets[at:stop], ids[at:stop], end))
            at = stop
        lengths = [len(s) for s in sets]
        return first[depth:end], ended, children, min(lengths), max(lengths)

    def similar(self, probe: np.ndarray, percent: int) -> list[int]:
        """Indices of the sets with 100 * intersection >= percent * union, most of the tree unread.

        On the way down the overlap with a node's names is counted once for all sets below it; a
        subtree is left when even all remaining names of either side could not reach the overlap that
        its shortest set needs.
        """
        found, n = [], len(probe)
        stack = [(self.root, 0, 0)]
        while stack:
            (run, ended, children, shortest, longest), depth, overlap = stack.pop()
            if 100 * min(n, longest) < percent * max(n, shortest):
                continue
            passed = 0
            if len(run):
                at = np.searchsorted(probe, run)
                at[at == n] = 0
                overlap += int(np.count_nonzero(probe[at] == run))
                passed = int(np.searchsorted(probe, run[-1], side="right"))
                depth += len(run)
            for i in ended:
                if 100 * overlap >= percent * (n + self.sizes[i] - overlap):
                    found.append(i)
            if children:
                if not len(run):
                    passed = 0
                reach = overlap + min(n - passed, longest - depth)
                if (100 + percent) * reach >= percent * (n + max(shortest, depth)):
                    stack.extend((child, depth, overlap) for child in children)
        return found
