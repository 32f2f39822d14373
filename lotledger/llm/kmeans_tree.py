"""A hierarchical k-means tree over unit vectors, walked best bin first."""

from __future__ import annotations

import heapq

import numpy as np

# Children of a node, rounds of k-means.
BRANCHES, ROUNDS = 8, 10
# Vectors that go down the tree together.
TOGETHER = 4096


def unit(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors; a power of two is taken out first, which changes no digit of a cosine."""
    scaled = np.ldexp(vectors, -np.frexp(np.abs(vectors).max(1, initial=0.0))[1][:, None])
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


def cosines(query: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Cosine of one vector with each of several, in double precision, from the original components."""
    q = np.ldexp(query, -int(np.frexp(np.abs(query).max())[1]))
    o = np.ldexp(others, -np.frexp(np.abs(others).max(1))[1][:, None])
    # one product per row: a result does not depend on the rows beside it
    own = np.dot(q, q)
    return np.array([np.dot(q, x) / np.sqrt(own * np.dot(x, x)) for x in o])


def _k_means(points: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray] | None:
    """(centers, nearest center of every point), or None where the points cannot be parted."""
    first = int(rng.integers(len(points)))
    chosen, nearest = [first], points @ points[first]
    while len(chosen) < BRANCHES:
        weight = np.maximum(1 - nearest, 0)
        weight[weight < 1e-9] = 0
        if not weight.sum():
            break
        chosen.append(int(rng.choice(len(points), p=weight / weight.sum())))
        nearest = np.maximum(nearest, points @ points[chosen[-1]])
    if len(chosen) < 2:
        return None
    centers = points[chosen].copy()
    for _ in range(ROUNDS):
        own = (points @ centers.T).argmax(1)
        sums = np.zeros_like(centers)
        np.add.at(sums, own, points)
        size = np.sqrt(np.einsum("ij,ij->i", sums, sums))
        moved = np.where(size[:, None] > 1e-12, sums / np.maximum(size, 1e-12)[:, None], centers)
        if np.abs(moved - centers).max() < 1e-6:
            break
        centers = moved
    own = (points @ centers.T).argmax(1)
    held = np.unique(own)
    return None if len(held) < 2 else (centers[held], np.searchsorted(held, own))


class Tree:
    """Nodes with the centers of their children; leaves are numbered in order.

    ``first[node]`` and ``count[node]`` say where a node's children stand in
    ``centers`` and ``child``; a child is a node (>= 0) or a leaf (``~leaf``).
    """

    def __init__(self, points: np.ndarray, leaf_points: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.leaves = 0
        first, count, centers, child = [], [], [], []
        waiting = [(np.arange(len(points)), None)]
        while waiting:
            members, parent = waiting.pop(0)
            parts = _k_means(points[members], rng) if len(members) > leaf_points else None
            if parts is None:
                if parent is not None:
                    child[parent] = ~self.leaves
                self.leaves += 1
                continue
            if parent is not None:
                child[parent] = len(first)
            first.append(len(centers))
            count.append(len(parts[0]))
            for k, center in enumerate(parts[0]):
                waiting.append((members[parts[1] == k], len(centers)))
                centers.append(center)
                child.append(0)
        self.first, self.count, self.child = first, count, np.array(child, np.int64)
        self.centers = np.array(centers, np.float32).reshape(len(centers), points.shape[1] if points.ndim == 2 else 0)

    def leaf_of(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf that every vector belongs to: the nearest child at each level."""
        out = np.zeros(len(vectors), np.int64)
        for at in range(0, len(vectors), TOGETHER):
            part = vectors[at:at + TOGETHER].astype(np.float32)
            node = np.zeros(len(part), np.int64) if self.first else np.full(len(part), -1, np.int64)
            while (open_ := np.unique(node[node >= 0])).size:
                for n in open_:
                    rows = np.flatnonzero(node == n)
                    start, stop = self.first[n], self.first[n] + self.count[n]
                    node[rows] = self.child[start + (part[rows] @ self.centers[start:stop].T).argmax(1)]
            out[at:at + len(part)] = ~node
        return out

    def walk(self, vector: np.ndarray):
        """Leaves from the most promising on: the queue holds every bin seen, the nearest center is opened next."""
        if not self.first:
            yield 0
            return
        vector, queue = vector.astype(np.float32), [(-2.0, 0, 0)]
        while queue:
            _, _, node = heapq.heappop(queue)
            if node < 0:
                yield ~node
                continue
            start, stop = self.first[node], self.first[node] + self.count[node]
            for k, near in enumerate((self.centers[start:stop] @ vector).tolist(), start):
                heapq.heappush(queue, (-near, k, int(self.child[k])))


def visits(tree: Tree, vector: np.ndarray, held: np.ndarray, least: int, wanted: int) -> list[int]:
    """The first ``least`` leaves of the walk that hold rows, and more while they hold fewer than ``wanted`` rows."""
    out, rows = [], 0
    for leaf in tree.walk(vector):
        if held[leaf]:
            out.append(leaf)
            rows += int(held[leaf])
            if len(out) >= least and rows >= wanted:
                break
    return out


def needed_visits(tree: Tree, queries: np.ndarray, leaves_of_true: list[list[int]], held: np.ndarray, recall: float) -> tuple[int, float]:
    """(visits, recall): the fewest leaf visits at which ``recall`` of the true neighbours is met."""
    ranks = []
    for vector, leaves in zip(queries, leaves_of_true, strict=True):
        order = {leaf: i for i, leaf in enumerate(leaf for leaf in tree.walk(vector) if held[leaf])}
        ranks += [order[leaf] for leaf in leaves]
    if not ranks:
        return 1, 1.0
    ranks = np.sort(np.array(ranks))
    most = int(ranks[min(len(ranks) - 1, int(np.ceil(recall * len(ranks))) - 1)]) + 1
    return most, float((ranks < most).mean())
