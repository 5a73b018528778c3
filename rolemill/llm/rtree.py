"""An R-tree over count vectors, for finding sets that may overlap enough.

A set's point has, for each of a number of groups that its members are hashed to, how many fall there. Two sets share at
most the sum of the smaller coordinates of their points; a node's upper corner bounds that for all points below it.
"""

from __future__ import annotations

import numpy as np

GROUPS = 128
FAN = 16


def point(members: np.ndarray, groups: int = GROUPS) -> np.ndarray:
    """Count vector of a set of 64-bit hashes; groups is a power of two."""
    return np.bincount((members & np.uint64(groups - 1)).astype(np.int64), minlength=groups).astype(np.int32)


class RTree:
    """Bulk-loaded: points are sorted by size and cut along their widest coordinates into leaves of FAN points."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.points, self.sizes = points, sizes
        self.order = self._tiled(np.argsort(sizes, kind="stable"))
        upper, low, high = points[self.order], sizes[self.order], sizes[self.order]
        self.levels = []
        while len(upper) > 1:
            cuts = np.arange(0, len(upper), FAN)
            upper, low, high = np.maximum.reduceat(upper, cuts), np.minimum.reduceat(low, cuts), np.maximum.reduceat(high, cuts)
            self.levels.append((upper, low, high))
        self.levels.reverse()

    def _tiled(self, rows: np.ndarray) -> np.ndarray:
        if len(rows) <= FAN:
            return rows
        part = self.points[rows]
        spread = part.max(0) - part.min(0)
        rows = rows[np.argsort(part[:, int(spread.argmax())], kind="stable")]
        half = max(FAN, 1 << ((len(rows) - 1).bit_length() - 1))
        return np.concatenate([self._tiled(rows[:half]), self._tiled(rows[half:])]) if half < len(rows) else rows

    def reaching(self, point: np.ndarray, size: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """Points whose bound allows a Jaccard similarity of percent with a set of this point and size, best bound first."""
        nodes = np.arange(1)
        for depth, (upper, low, high) in enumerate(self.levels):
            if depth:
                nodes = (nodes[:, None] * FAN + np.arange(FAN)).ravel()
                nodes = nodes[nodes < len(upper)]
            keep = self._may(np.minimum(upper[nodes], point).sum(1), low[nodes], high[nodes], size, percent)
            nodes = nodes[keep]
        if self.levels:
            nodes = (nodes[:, None] * FAN + np.arange(FAN)).ravel()
            nodes = nodes[nodes < len(self.order)]
        rows = self.order[nodes]
        bound = np.minimum(self.points[rows], point).sum(1)
        keep = self._may(bound, self.sizes[rows], self.sizes[rows], size, percent)
        rows, bound = rows[keep], bound[keep]
        best = np.argsort(-bound, kind="stable")
        return rows[best], bound[best]

    @staticmethod
    def _may(bound, low, high, size: int, percent: int):
        """100 * shared >= percent * union, with union = size + other - shared; and no set shares more than its size."""
        enough = (100 + percent) * bound >= percent * (size + low)
        return enough & (high * 100 >= percent * size) & (low * percent <= 100 * size)


class Groups:
    """Sets that are known to be connected."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, a: int, b: int) -> None:
        keep, gone = sorted((self.root[a], self.root[b]))
        self.root[self.root == gone] = keep


def fine_groups(size: int) -> int:
    """Coordinates of the point of a set that is told apart from unrelated ones of its size: about one for eight members."""
    return max(32, 1 << (-(-size // 8) - 1).bit_length())


def folded(point: np.ndarray, groups: int) -> np.ndarray:
    """The point of the same set with fewer groups."""
    return point.reshape(-1, groups).sum(0)


def reachable_links(points: list[np.ndarray], sizes: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links that connect whatever the bounds of the points allow to be linked; points have fine_groups() coordinates.

    Sets that can be linked have equal numbers of coordinates, or one has twice as many; of each pair the smaller number counts.
    """
    groups, found = Groups(len(sizes)), []
    widths = np.array([len(x) for x in points])
    for width in np.unique(widths):
        near = np.flatnonzero((widths == width) | (widths == 2 * width))
        grid = np.array([folded(points[i], width) for i in near], np.int64)
        _reach(grid, sizes[near], widths[near] == width, near, percent, groups, found)
    return found


def _reach(points, sizes, asked, names, percent: int, groups: Groups, found: list, stars: int = 8) -> None:
    """Adds links of pairs with an asked point. Some asked points are first held against all others at once. Only what isn't
    in the largest group then is looked up in a tree: of two points that aren't connected yet, one at least is.
    """

    def link(i: int, near: np.ndarray) -> None:
        for j in near.tolist():
            a, b = int(names[i]), int(names[j])
            if groups.root[a] != groups.root[b]:
                groups.join(a, b)
                found.append((a, b))

    rest = np.arange(len(sizes))
    for _ in range(stars):
        first = rest[asked[rest]]
        if not len(first):
            break
        i = int(first[0])
        bound = np.minimum(points, points[i]).sum(1)
        link(i, np.flatnonzero(RTree._may(bound, sizes, sizes, int(sizes[i]), percent)))
        roots = groups.root[names]
        rest = np.flatnonzero(roots != np.bincount(roots).argmax())
    if not len(rest):
        return
    tree = RTree(points, sizes)
    for i in rest.tolist():
        near = tree.reaching(points[i], int(sizes[i]), percent)[0]
        link(i, near if asked[i] else near[asked[near]])


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets without repeats have 100 * shared >= percent * union."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    shared = int(np.count_nonzero(b[np.minimum(at, len(b) - 1)] == a)) if len(b) else 0
    return 100 * shared >= percent * (len(a) + len(b) - shared) and shared > 0


def spanning_links(sets: list[np.ndarray], percent: int, queries: list[int] | None = None, known: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that connect whatever links among the sets connect; at most one fewer than there are sets.

    Each set looks through the tree and is compared with those in reach, closest bound first, that aren't connected with it
    yet; so sets that are already one group cost no comparison. queries: only pairs with one of these sets matter.
    known: groups that are connected already.
    """
    if len(sets) < 2:
        return []
    points, sizes = np.array([point(s) for s in sets]), np.array([len(s) for s in sets])
    tree, groups, found = RTree(points, sizes), Groups(len(sets)), []
    if known is not None:
        groups.root = np.unique(known, return_index=True)[1][np.unique(known, return_inverse=True)[1]]
    asked = range(len(sets)) if queries is None else queries
    for i in asked:
        near = tree.reaching(points[i], int(sizes[i]), percent)[0]
        if queries is None:
            near = near[near < i]
        near = near[groups.root[near] != groups.root[i]]
        while len(near):
            j, near = int(near[0]), near[1:]
            if similar(sets[i], sets[j], percent):
                groups.join(i, j)
                found.append((i, j))
                near = near[groups.root[near] != groups.root[i]]
    return found
