"""A hierarchical navigable small-world graph of one shard, searched many queries at a time."""

from __future__ import annotations

import numpy as np

# Links per node: upper levels, and level 0.
LINKS, GROUND = 12, 24
# Beam while building, first beam of a search, and the widest before exact products take over.
BUILD_BEAM, FIRST_BEAM, WIDEST_BEAM = 48, 48, 192
# Queries that walk the graph together, and nodes that each expands per step.
TOGETHER, EXPAND = 256, 4
# Audit: queries drawn at a time, true links to be seen, and the share of them that must be found.
AUDITED, AUDITED_LINKS, RECALL = 128, 512, 0.99


def normalized(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors in double precision; scaled first, so squares neither overflow nor vanish."""
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


def _top(ids: np.ndarray, sims: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` best columns of every row, best first."""
    if sims.shape[1] > count:
        part = np.argpartition(-sims, count - 1, axis=1)[:, :count]
        ids, sims = np.take_along_axis(ids, part, 1), np.take_along_axis(sims, part, 1)
    order = np.argsort(-sims, axis=1, kind="stable")
    return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)


def _select(points: np.ndarray, own: np.ndarray, ids: np.ndarray, sims: np.ndarray, count: int) -> np.ndarray:
    """Diverse neighbours: candidates, best first, unless nearer to one already taken than to the point.

    Free places are filled with the best of the others. (rows, count), -1 padded.
    """
    ids = np.where(ids == own[:, None], -1, ids)
    valid = ids >= 0
    vectors = points[np.maximum(ids, 0)]
    among = np.einsum("rcd,red->rce", vectors, vectors)
    rows, width = ids.shape
    taken, rest = np.zeros((rows, width), bool), np.full((rows, width), -1)
    for c in range(width):
        nearer = (taken[:, :c] & (among[:, c, :c] > sims[:, c, None])).any(1) if c else np.zeros(rows, bool)
        room = taken.sum(1) < count
        taken[:, c] = valid[:, c] & room & ~nearer
        rest[:, c] = np.where(valid[:, c] & ~taken[:, c], ids[:, c], -1)
    # taken first, then the others, both best first
    rank = np.where(taken, 0, np.where(rest >= 0, 1, 2)) * width + np.arange(width)
    order = np.argsort(rank, axis=1)[:, :count]
    out = np.take_along_axis(np.where(valid, ids, -1), order, 1)
    return np.pad(out, ((0, 0), (0, count - out.shape[1])), constant_values=-1) if out.shape[1] < count else out


class Graph:
    """Unit vectors (float32) of a shard and the links of every level."""

    def __init__(self, vectors: np.ndarray, seed: int = 11):
        self.points = np.ascontiguousarray(vectors, np.float32)
        count = len(vectors)
        rng = np.random.default_rng(seed)
        self.level = np.minimum((-np.log(rng.random(count) + 1e-12) / np.log(LINKS)).astype(int), 6)
        order = np.argsort(-self.level, kind="stable")  # the top level's nodes come first
        self.entry = int(order[0]) if count else -1
        self.links = [np.full((count, GROUND if i == 0 else LINKS), -1, np.int32) for i in range(int(self.level.max(initial=0)) + 1)]
        at, size = 1, 1
        while at < count:
            new = order[at:at + size]
            self._insert(np.asarray(new))
            at += len(new)
            size = min(2 * size, TOGETHER)

    def _insert(self, new: np.ndarray) -> None:
        """Add nodes that see the graph before them, and one another."""
        queries = self.points[new]
        among = queries @ queries.T
        np.fill_diagonal(among, -2)
        for level in range(len(self.links) - 1, -1, -1):
            own = self.level[new] >= level
            if not own.any():
                continue
            start = self._descend(queries[own], level)
            ids, sims = self._beam(queries[own], start, BUILD_BEAM, level)
            mates = np.where(own[None, :], among[own], -2)
            near_ids, near_sims = _top(np.tile(new, (own.sum(), 1)), mates, min(16, len(new)))
            ids = np.concatenate([ids, np.where(near_sims > -2, near_ids, -1)], 1)
            sims = np.concatenate([sims, near_sims.astype(np.float32)], 1)
            ids, sims = _top(ids, np.where(ids >= 0, sims, -2), BUILD_BEAM)
            width = self.links[level].shape[1]
            chosen = _select(self.points, new[own], ids, sims, width // 2 if level == 0 else width)
            self.links[level][new[own], :chosen.shape[1]] = chosen
            self._link_back(new[own], chosen, level)

    def _link_back(self, new: np.ndarray, chosen: np.ndarray, level: int) -> None:
        links = self.links[level]
        width = links.shape[1]
        to, source = chosen.ravel(), np.repeat(new, chosen.shape[1])
        kept = to >= 0
        to, source = to[kept], source[kept]
        order = np.argsort(to, kind="stable")
        to, source = to[order], source[order]
        nodes, starts, counts = np.unique(to, return_index=True, return_counts=True)
        fresh = np.full((len(nodes), counts.max(initial=0)), -1)
        fresh[np.repeat(np.arange(len(nodes)), counts), np.arange(len(to)) - np.repeat(starts, counts)] = source
        ids = np.concatenate([links[nodes], fresh], 1)
        # a mate that chose this node may be linked already
        ids = np.sort(ids, 1)
        ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = -1
        sims = np.where(ids >= 0, np.einsum("rcd,rd->rc", self.points[np.maximum(ids, 0)], self.points[nodes]), -2)
        full = (ids >= 0).sum(1) > width
        some_ids, some_sims = _top(ids, sims, max(width, min(ids.shape[1], 2 * width)))
        out = some_ids[:, :width].copy()
        if full.any():
            out[full] = _select(self.points, nodes[full], some_ids[full], some_sims[full], width)
        links[nodes] = out

    def _descend(self, queries: np.ndarray, level: int) -> np.ndarray:
        """Nearest node found greedily on the levels above ``level``."""
        at = np.full(len(queries), self.entry)
        best = queries @ self.points[self.entry]
        for upper in range(len(self.links) - 1, level, -1):
            moving = np.arange(len(queries))
            while len(moving):
                ids = self.links[upper][at[moving]]
                sims = np.where(ids >= 0, np.einsum("qmd,qd->qm", self.points[np.maximum(ids, 0)], queries[moving]), -2)
                step = sims.argmax(1)
                value = sims[np.arange(len(moving)), step]
                better = value > best[moving]
                at[moving[better]], best[moving[better]] = ids[better, step[better]], value[better]
                moving = moving[better]
        return at

    def _beam(self, queries: np.ndarray, start: np.ndarray, width: int, level: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``width`` nearest nodes that each query's beam meets on ``level``, best first (-1 padded)."""
        count, links = len(queries), self.links[level]
        rows = np.arange(count)
        ids, sims = np.full((count, width), -1), np.full((count, width), -2, np.float32)
        ids[:, 0], sims[:, 0] = start, np.einsum("qd,qd->q", queries, self.points[start])
        expanded = np.zeros((count, width), bool)
        stamp = np.full((count, len(self.points)), -1, np.int16)
        stamp[rows, start] = 0
        active = rows
        while len(active):
            open_sims = np.where(expanded[active] | (ids[active] < 0), -2, sims[active])
            take = np.argpartition(-open_sims, min(EXPAND, width) - 1, axis=1)[:, :EXPAND]
            usable = np.take_along_axis(open_sims, take, 1) > -2
            live = usable.any(1)
            active, take, usable = active[live], take[live], usable[live]
            if not len(active):
                break
            expanded[active[:, None], take] |= usable
            found = np.where(usable[:, :, None], links[np.where(usable, ids[active[:, None], take], 0)], -1).reshape(len(active), -1)
            safe = np.maximum(found, 0)
            new = (found >= 0) & (stamp[active[:, None], safe] < 0)
            # the same node by two expanded ones counts once
            slots = np.broadcast_to(np.arange(found.shape[1], dtype=np.int16), found.shape)
            r, c = np.nonzero(new)
            stamp[active[r], found[r, c]] = slots[r, c]
            new &= stamp[active[:, None], safe] == slots
            near = np.where(new, np.einsum("qmd,qd->qm", self.points[safe], queries[active]), np.float32(-2))
            all_ids = np.concatenate([ids[active], np.where(new, found, -1)], 1)
            all_sims = np.concatenate([sims[active], near], 1)
            all_done = np.concatenate([expanded[active], np.zeros(new.shape, bool)], 1)
            best = np.argpartition(-all_sims, width - 1, axis=1)[:, :width]
            ids[active] = np.take_along_axis(all_ids, best, 1)
            sims[active] = np.take_along_axis(all_sims, best, 1)
            expanded[active] = np.take_along_axis(all_done, best, 1)
        return _top(ids, sims, width)

    def search(self, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        queries = np.ascontiguousarray(queries, np.float32)
        return self._beam(queries, self._descend(queries, 0), min(width, len(self.points)), 0)


def _audit(vectors: np.ndarray, queries: np.ndarray, least: float, settled: np.ndarray, hits: list, same: bool) -> bool:
    """Whether the hits of the ``settled`` queries hold enough of their true links.

    Queries are drawn until AUDITED_LINKS true links are seen or all are; what
    is drawn gets its exact hits.
    """
    drawn = np.random.default_rng(13).permutation(settled)
    seen = there = 0
    for at in range(0, len(drawn), AUDITED):
        part = drawn[at:at + AUDITED]
        near = queries[part] @ vectors.T >= least
        if same:
            near[np.arange(len(part)), part] = False
        for row, q in enumerate(part):
            true = np.flatnonzero(near[row])
            there += len(true)
            seen += len(np.intersect1d(true, hits[q]))
            hits[q] = true
        if there >= AUDITED_LINKS and at + AUDITED < len(drawn):
            return seen >= RECALL * there
    return True


def range_search(graph: Graph, vectors: np.ndarray, queries: np.ndarray, least: float, same: bool = False):
    """(hits per query, exact): nodes with cosine >= ``least`` in double precision.

    ``same``: the queries are the graph's own vectors, which do not hit
    themselves. A beam that ends inside the range has not seen its end: those
    queries search again with a beam twice as wide. The others are audited
    against blocked exact products, and all beams widen until the audit passes.
    What would need more than the widest beam is answered by exact products
    (``exact`` is then true for the query).
    """
    count = len(queries)
    hits: list = [None] * count
    exact = np.zeros(count, bool)
    width, todo = FIRST_BEAM, np.arange(count)
    floor = np.float32(least - 1e-5)
    while len(todo):
        if width > WIDEST_BEAM or width >= len(vectors):
            exact[todo] = True
            break
        wider = []
        for at in range(0, len(todo), TOGETHER):
            part = todo[at:at + TOGETHER]
            ids, sims = graph.search(queries[part], width)
            wider.append(part[sims[:, -1] >= floor])
            near = sims >= floor
            for row, q in enumerate(part):
                found = ids[row, near[row]]
                found = found[vectors[found] @ queries[q] >= least] if len(found) else found
                hits[q] = found[found != q] if same else found
        wider = np.concatenate(wider)
        width *= 2
        settled = np.setdiff1d(todo, wider)
        todo = wider if _audit(vectors, queries, least, settled, hits, same) else np.arange(count)
    return hits, exact
