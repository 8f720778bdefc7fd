"""A packed R-tree over count vectors, searched for pairs whose bound on their overlap reaches what a link needs.

Two sets of x and y elements with Jaccard of at least t share at least t / (1 + t) * (x + y) of them, and no more than
the sum over groups of the lesser of their counts. A node keeps the greatest count of each group and the range of sizes
below it: this bounds the overlap of a query with anything below.
"""

from __future__ import annotations

import numpy as np

LEAF, FAN = 48, 12


class RTree:
    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        """points (n, groups) of counts. Sort-tile-recursive packing: by size, then in slabs by the group that varies most."""
        self.order = np.argsort(sizes, kind="stable")
        slab = LEAF * max(1, int(np.sqrt(max(1, len(sizes) // LEAF))))
        widest = int(np.argmax(points.astype(np.float32).var(0))) if len(points) > LEAF else 0
        for i in range(0, len(sizes), slab):
            own = self.order[i : i + slab]
            self.order[i : i + slab] = own[np.argsort(points[own, widest], kind="stable")]
        self.points, self.sizes = points[self.order], sizes[self.order]
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.at: np.ndarray | None = None
        hi, least, most, step = self.points, self.sizes, self.sizes, LEAF
        while True:
            at = np.arange(0, len(hi), step)
            hi, least, most = np.maximum.reduceat(hi, at), np.minimum.reduceat(least, at), np.maximum.reduceat(most, at)
            self.levels.append((hi, least, most))
            if len(hi) <= FAN:
                break
            step = FAN

    @staticmethod
    def _fits(bound: np.ndarray, x: int, least: np.ndarray, most: np.ndarray, share: tuple[int, int]) -> np.ndarray:
        """Whether sets of least to most elements can link with one of x, of whose elements they hold bound at most."""
        a, b = share
        y = np.maximum(least, -(-a * x // b))  # the least size below that can link
        return (y <= most) & (y <= b * x // a) & (bound * (a + b) >= a * (x + y))

    def search(self, point: np.ndarray, size: int, share: tuple[int, int]) -> np.ndarray:
        """Places, in the order given to the tree, of points that may link: 100 * overlap >= share of the union."""
        nodes = np.arange(len(self.levels[-1][0]))
        for depth in range(len(self.levels) - 1, -1, -1):
            hi, least, most = self.levels[depth]
            nodes = nodes[self._fits(np.minimum(hi[nodes], point).sum(1, dtype=np.int64), size, least[nodes], most[nodes], share)]
            step, n = (FAN, len(self.levels[depth - 1][0])) if depth else (LEAF, len(self.sizes))
            nodes = (nodes[:, None] * step + np.arange(step)).ravel()
            nodes = nodes[nodes < n]
        own = self.sizes[nodes]
        return self.order[nodes[self._fits(np.minimum(self.points[nodes], point).sum(1, dtype=np.int64), size, own, own, share)]]

    def _nearest(self, point: np.ndarray, size: int, share: tuple[int, int], most: int) -> tuple[np.ndarray, np.ndarray]:
        """The best of the points in the two leaves that a descent by the highest bounds reaches, and their bounds."""
        nodes = np.arange(len(self.levels[-1][0]))
        for depth in range(len(self.levels) - 1, -1, -1):
            hi, least, most_size = self.levels[depth]
            bound = np.minimum(hi[nodes], point).sum(1, dtype=np.int64)
            kept = np.flatnonzero(self._fits(bound, size, least[nodes], most_size[nodes], share))
            nodes = nodes[kept[np.argsort(-bound[kept], kind="stable")[:2]]]
            step, n = (FAN, len(self.levels[depth - 1][0])) if depth else (LEAF, len(self.sizes))
            nodes = (nodes[:, None] * step + np.arange(step)).ravel()
            nodes = nodes[nodes < n]
        bound, own = np.minimum(self.points[nodes], point).sum(1, dtype=np.int64), self.sizes[nodes]
        kept = np.flatnonzero(self._fits(bound, size, own, own, share))
        kept = kept[np.argsort(-bound[kept] / (own[kept] + size), kind="stable")[:most]]
        return self.order[nodes[kept]], bound[kept]

    def pairs(self, points: np.ndarray, sizes: np.ndarray, share: tuple[int, int], nearest: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of queries (points, sizes), places of what the tree finds for them, and their bounds; with nearest, so many of each query at most."""
        if len(self.sizes) <= LEAF and len(points) * points.shape[1] <= 1 << 16:  # a single leaf: all queries at once
            bound = np.minimum(points[:, None, :], self.points[None]).sum(2, dtype=np.int64)
            fits = self._fits(bound, sizes[:, None], self.sizes[None], self.sizes[None], share)
            if nearest and len(self.sizes) > nearest:
                score = np.where(fits, bound / (sizes[:, None] + self.sizes), -1.0)
                last = -np.partition(-score, nearest - 1, 1)[:, nearest - 1 : nearest]
                fits &= score >= last
            q, r = np.nonzero(fits)
            return q, self.order[r], bound[q, r]
        found = []
        for point, size in zip(points, sizes.tolist(), strict=True):
            if nearest:
                found.append(self._nearest(point, size, share, nearest))
            else:
                places = self.search(point, size, share)
                found.append((places, self.bounds(point, places)))
        q = np.repeat(np.arange(len(points)), [len(x) for x, _ in found])
        return q, np.concatenate([x for x, _ in found]), np.concatenate([b for _, b in found])

    def bounds(self, point: np.ndarray, places: np.ndarray) -> np.ndarray:
        if self.at is None:
            self.at = np.argsort(self.order)
        return np.minimum(self.points[self.at[places]], point).sum(1, dtype=np.int64)
