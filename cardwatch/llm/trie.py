"""A trie over ordered sets that links the similar ones of a group.

Sets are sequences of token ranks, the group's most frequent tokens first, so that similar sets share
long paths. A probe walks down from the root: the overlap with a path is counted once for all sets
below it, and a subtree is left as soon as even its longest continuation could not reach the overlap
that its smallest set asks for, or if all its sets are linked with the probe already.
"""

from __future__ import annotations

import numpy as np


class Trie:
    """Path-compressed; node ``i`` covers the sorted sets ``lo[i]`` to ``hi[i]``."""

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray) -> None:
        self.sets, self.sizes = sets, sizes
        self.lengths = np.array([len(s) for s in sets])
        shared = [0] + [_common(a, b) for a, b in zip(sets, sets[1:])]
        self.shared = np.array(shared)
        self.nodes: list[tuple] = []
        self._build()

    def _build(self) -> None:
        todo = [(0, len(self.sets), 0, -1)]
        self.children: list[list[int]] = []
        while todo:
            lo, hi, depth, parent = todo.pop()
            node = len(self.nodes)
            if parent >= 0:
                self.children[parent].append(node)
            self.children.append([])
            if hi - lo == 1:
                to = int(self.lengths[lo])
                cuts = np.zeros(0, int)
            else:
                inner = self.shared[lo + 1 : hi]
                to = int(inner.min())
                cuts = np.flatnonzero(inner == to) + lo + 1
            edge = self.sets[lo][depth:to]
            last = int(self.sets[lo][to - 1]) if to else -1
            self.nodes.append(
                (lo, hi, edge, last, int(self.sizes[lo:hi].min()), int(self.lengths[lo:hi].max()) - to)
            )
            if len(cuts):
                bounds = [lo, *cuts.tolist(), hi]
                todo += [(p, q, to, node) for p, q in zip(bounds, bounds[1:])]

    def link(self, percent: int) -> np.ndarray:
        """A label per set: sets with equal labels are connected by pairs of that similarity."""
        n = len(self.sets)
        label = np.arange(n)
        width = 1 + max((int(s[-1]) for s in self.sets if len(s)), default=0)
        mask = np.zeros(width, bool)
        more = 100 + percent
        for x, mine in enumerate(self.sets):
            mask[mine] = True
            size = int(self.sizes[x])
            todo = [(0, 0)]
            while todo:
                node, overlap = todo.pop()
                lo, hi, edge, last, least, longest = self.nodes[node]
                if hi <= x + 1 or (label[max(lo, x + 1) : hi] == label[x]).all():
                    continue
                overlap += int(np.count_nonzero(mask[edge]))
                left = len(mine) - int(np.searchsorted(mine, last, "right"))
                if more * (overlap + min(left, longest)) < percent * (size + least):
                    continue
                if hi - lo == 1:
                    if more * overlap >= percent * (size + int(self.sizes[lo])):
                        label[label == label[lo]] = label[x]
                else:
                    todo += [(c, overlap) for c in self.children[node]]
            mask[mine] = False
        return label


def _common(a: np.ndarray, b: np.ndarray) -> int:
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    return int(differ[0]) if len(differ) else n


def linked(keys: np.ndarray, tokens: list[np.ndarray], sizes: np.ndarray, percent: int) -> np.ndarray:
    """For each set of a group the least key of the sets it is linked with, itself included.

    ``sizes`` are those of the whole sets; ``tokens`` may leave out what no other set has.
    """
    if len(keys) == 1:
        return keys.copy()
    everything = np.concatenate(tokens)
    values, place, counts = np.unique(everything, return_inverse=True, return_counts=True)
    rank = np.empty(len(values), np.int64)
    rank[np.lexsort((values, -counts))] = np.arange(len(values))
    ranks, common = rank[place], counts[place] > 1
    ends = np.cumsum([len(t) for t in tokens])
    ordered = []
    for a, z in zip([0, *ends[:-1].tolist()], ends.tolist()):
        ordered.append(np.sort(ranks[a:z][common[a:z]]))
    by = sorted(range(len(keys)), key=lambda i: ordered[i].astype(">u4").tobytes())
    label = Trie([ordered[i] for i in by], sizes[by]).link(percent)
    out = np.empty_like(keys)
    for group in np.unique(label):
        members = np.array(by)[label == group]
        out[members] = keys[members].min()
    return out
