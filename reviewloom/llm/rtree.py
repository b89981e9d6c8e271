"""A packed R-tree over points of token counts, and the join that searches it.

A set's point holds the number of its tokens in each coarse group. For two sets the sum of
the coordinate minima bounds the size of their intersection from above; for a set and all
sets below a node of the tree the minima with the node's upper corner do.
"""

from __future__ import annotations

import numpy as np

#: Coarse groups of a point.
GROUPS = 64
#: Points of a leaf, and children of an inner node.
FANOUT = 16
#: Sets verified between two looks at what has been joined meanwhile.
AT_ONCE = 8
_SHIFT = np.uint64(58)


def points(tokens: np.ndarray, starts: np.ndarray, groups: int = GROUPS) -> np.ndarray:
    """The number of tokens of each set in each coarse group, of sets laid end to end."""
    sizes = np.diff(starts)
    cell = np.repeat(np.arange(len(sizes)), sizes) * groups + (tokens >> _SHIFT).astype(np.int64)
    return np.bincount(cell, minlength=len(sizes) * groups).reshape(len(sizes), groups).astype(np.int32)


class Tree:
    """Levels from the root down; each node has the corners of what is below it.

    Points are packed by size, then along the groups that hold most. ``upper``: the largest
    count in each group. ``least`` and ``most``: of the sizes. ``one``: a member, and
    ``pure``: whether all members were of one component from the start.
    """

    def __init__(self, at: np.ndarray, sizes: np.ndarray, label: np.ndarray):
        # sets of one component stay together, so that whole nodes can be left out
        order = np.lexsort((at.argmax(axis=1), sizes, label)) if len(at) else np.zeros(0, dtype=np.int64)
        self.order = order
        self.levels = []
        upper, least, most = at[order], sizes[order], sizes[order]
        one, pure = order, np.ones(len(order), dtype=bool)
        while len(upper) > 1:
            starts = np.arange(0, len(upper), FANOUT)
            upper = np.maximum.reduceat(upper, starts, axis=0)
            least, most = np.minimum.reduceat(least, starts), np.maximum.reduceat(most, starts)
            first = label[one]
            alike = pure & (first == np.repeat(first[starts], FANOUT)[: len(first)])
            one, pure = one[starts], np.logical_and.reduceat(alike, starts)
            self.levels.append((upper, least, most, one, pure))
        self.levels.reverse()

    def near(self, point, size: int, own: int, label: np.ndarray, num: int, den: int) -> np.ndarray:
        """Places in the packing of sets below leaves that may hold a set that is linked with
        the given one and of another component, found from the root down."""
        found = np.zeros(1, dtype=np.int64)
        for upper, least, most, one, pure in self.levels:
            found = found[found < len(least)]
            # an intersection of num * (na + nb) / (num + den) is needed, sizes within num / den
            ok = (most[found] * den >= size * num) & (least[found] * num <= size * den)
            ok &= ~(pure[found] & (label[one[found]] == own))
            found = found[ok]
            reach = np.minimum(point, upper[found]).sum(axis=1)
            found = found[reach * (num + den) >= num * (size + least[found])]
            found = (found[:, None] * FANOUT + np.arange(FANOUT)).ravel()
        return found[found < len(self.order)]


def links(
    tokens: np.ndarray, starts: np.ndarray, comps: np.ndarray, sides: np.ndarray, num: int, den: int
) -> list[tuple[int, int]]:
    """Links between sets of different components, verified on the sets, at most one for
    two components that no earlier link has joined.

    Sets of side 0 are joined among themselves, those of side 1 with those of side 2.
    """
    sizes = np.diff(starts)
    at = points(tokens, starts)
    _, label = np.unique(comps, return_inverse=True)
    right = np.flatnonzero(sides != 1)
    tree = Tree(at[right], sizes[right], label[right])
    # the tree speaks of places among the right sets
    tree.levels = [(u, lo, hi, right[one], pure) for u, lo, hi, one, pure in tree.levels]
    packed = right[tree.order]
    # tokens as numbers from 0, so that one set can be marked
    _, number = np.unique(tokens, return_inverse=True)
    mark = np.zeros(int(number.max()) + 1 if len(number) else 0, dtype=bool)
    out: list[tuple[int, int]] = []
    for own in np.flatnonzero(sides != 2).tolist():
        size = int(sizes[own])
        near = packed[tree.near(at[own], size, label[own], label, num, den)]
        near = near[label[near] != label[own]]
        if not len(near):
            continue
        reach = np.minimum(at[own], at[near]).sum(axis=1)
        other = sizes[near]
        small, large = np.minimum(size, other), np.maximum(size, other)
        fits = (np.minimum(reach, small) * (num + den) >= num * (size + other)) & (small * den >= large * num)
        near, reach = near[fits], reach[fits]
        near = near[np.argsort(-reach, kind="stable")]
        mine = number[starts[own] : starts[own + 1]]
        mark[mine] = True
        while len(near):
            for other in near[:AT_ONCE].tolist():
                if label[other] == label[own]:
                    continue
                both = int(np.count_nonzero(mark[number[starts[other] : starts[other + 1]]]))
                if both * (num + den) >= num * (size + int(sizes[other])):
                    out.append((own, other))
                    label[label == label[other]] = label[own]
            near = near[AT_ONCE:]
            near = near[label[near] != label[own]]
        mark[mine] = False
    return out
