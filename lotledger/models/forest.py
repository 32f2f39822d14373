"""Regression forests grown level by level from sums that Spark aggregates.

Rows are dealt out once, by category, and stored as blocks that hold all rows of
a category; after that a row never moves. In a level a task walks its blocks
down the trees and hands on weighted target sums per (tree, node, column, bin)
and, as it has a category's rows whole, only its best category per (tree, node):
both are bounded by nodes and bins, not by rows or categories. Categories of
more rows than a block's task should hold are spread, and summed like bins.
Only the best cut of every open node reaches the driver, where the model lives.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
from pyspark.ml import Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import byte_bound_batches, materialize

# Bins of a numeric column; columns with fewer values are cut between all of them.
BINS = 64
# Leaves of one tree at most: the fullest nodes are opened first.
MAX_LEAVES = 4096
# Rows of a stored block, more where its last category goes on; and bytes of blocks that stand in memory at a time.
BLOCK_ROWS, BLOCK_BYTES = 20_000, 16 << 20
# Categories of more than one row in so many (and than a block) are spread over tasks.
SPREAD = 1000
# Sums per (node, bin) that a task adds up in arrays; where a level has more, every block hands on its own.
DENSE_CELLS = 2_000_000
# Weights that a bootstrap draws: P(weight <= k) of a Poisson variable with mean 1.
_POISSON = [sum(math.exp(-1) / math.factorial(i) for i in range(k + 1)) for k in range(10)]


class Tree:
    """Nodes in arrays: a node's column (-1: leaf), what it is cut at, its first child (the second follows), its value."""

    def __init__(self):
        self.column, self.cut, self.child, self.value, self.rows = [-1], [0], [0], [0.0], [0]

    def split(self, node: int, column: int, cut, left: tuple[float, float], right: tuple[float, float]) -> tuple[int, int]:
        self.column[node], self.cut[node], self.child[node] = column, cut, len(self.column)
        for n, total in (left, right):
            self.column.append(-1)
            self.cut.append(0)
            self.child.append(0)
            self.value.append(total / n)
            self.rows.append(n)
        return len(self.column) - 2, len(self.column) - 1


class Shape:
    """A forest's trees as matrices, to walk many rows at a time."""

    def __init__(self, trees: Sequence[Tree], numeric: int):
        size = max(len(t.column) for t in trees)
        fill = lambda values, kind: np.array([v + [0] * (size - len(v)) for v in values], kind)
        self.numeric = numeric
        self.column = np.array([t.column + [-1] * (size - len(t.column)) for t in trees], np.int32)
        self.child, self.value = fill([t.child for t in trees], np.int32), fill([t.value for t in trees], np.float64)
        self.at = fill([[c if k < numeric else 0.0 for k, c in zip(t.column, t.cut, strict=True)] for t in trees], np.float64)
        self.code = fill([[c if k >= numeric else 0 for k, c in zip(t.column, t.cut, strict=True)] for t in trees], np.int64)

    def leaves(self, t: int, numbers: np.ndarray, codes: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """The leaf in tree ``t`` of the given rows; ``numbers`` and ``codes`` have a line per column."""
        column, child, cut, code = self.column[t], self.child[t], self.at[t], self.code[t]
        out, moving, node = np.zeros(len(rows), np.int32), np.arange(len(rows)), np.zeros(len(rows), np.int32)
        while True:
            at = column.take(node)
            inner = at >= 0
            if not inner.all():
                out[moving[~inner]] = node[~inner]
                moving, rows, node, at = moving[inner], rows[inner], node[inner], at[inner]
            if not len(moving):
                return out
            right = np.ones(len(at), bool)
            if self.numeric:
                value = numbers.ravel().take(at.astype(np.int64) * numbers.shape[1] + rows, mode="clip")
                right = ~(value <= cut.take(node))
            other = np.flatnonzero(at >= self.numeric)
            right[other] = codes[at[other] - self.numeric, rows[other]] != code.take(node[other])
            node = child.take(node) + right

    def nodes(self, numbers: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """(rows, trees): the leaf of every row."""
        rows, numbers, codes = np.arange(len(numbers)), np.ascontiguousarray(numbers.T), np.ascontiguousarray(codes.T)
        return np.stack([self.leaves(t, numbers, codes, rows) for t in range(len(self.column))], 1)

    def predict(self, numbers: np.ndarray, codes: np.ndarray) -> np.ndarray:
        nodes = self.nodes(numbers, codes)
        return self.value[np.arange(len(self.column)), nodes].mean(1)


def _number(column: str) -> Column:
    return F.coalesce(F.col(column).cast("double"), F.lit(float("nan")))


def _code(column: str) -> Column:
    """64 bits that stand for a category; they do not depend on the target."""
    return F.xxhash64(F.coalesce(F.col(column).cast("string"), F.lit("\0null")))


def _matrix(column, kind) -> np.ndarray:
    return np.concatenate(column.to_numpy()).astype(kind, copy=False).reshape(len(column), -1)


def _inputs(numeric: Sequence[str], categories: Sequence[str]) -> tuple[Column, Column]:
    return F.array(*[_number(c) for c in numeric]), F.array(*[_code(c) for c in categories])


def find_cuts(df: DataFrame, numeric: Sequence[str], bins: int = BINS) -> dict[str, list[float]]:
    """Cut points per column: between all values where there are few, else at approximate quantiles."""
    points = [i / bins for i in range(1, bins)]
    counts = df.agg(*[F.approx_count_distinct(c, 0.01).alias(c) for c in numeric]).first()
    few = {c for c in numeric if counts[c] <= bins}
    found = df.agg(*[F.array_sort(F.collect_set(c)).alias(c) if c in few else F.percentile_approx(c, points, 100 * bins).alias(c) for c in numeric]).first()
    return {c: [float(x) for x in (found[c][:-1] if c in few else sorted(set(found[c] or [])))] for c in numeric}


_U = [np.uint64(x) for x in (0, 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)]


def _turned(h: np.ndarray, bits: int) -> np.ndarray:
    return (h << np.uint64(bits)) | (h >> np.uint64(64 - bits))


def _hashed(value: np.ndarray, seed: np.ndarray, whole: bool) -> np.ndarray:
    """Spark's xxhash64 of a long (``whole``) or an int on top of the hash so far."""
    if whole:
        h = (seed + _U[5] + np.uint64(8)) ^ (_turned(value * _U[2], 31) * _U[1])
        h = _turned(h, 27) * _U[1] + _U[4]
    else:
        h = (seed + _U[5] + np.uint64(4)) ^ ((value & np.uint64(0xFFFFFFFF)) * _U[1])
        h = _turned(h, 23) * _U[2] + _U[3]
    h = (h ^ (h >> np.uint64(33))) * _U[2]
    h = (h ^ (h >> np.uint64(29))) * _U[3]
    return h ^ (h >> np.uint64(32))


def draw_weights(rows: np.ndarray, trees: int, seed: int) -> np.ndarray:
    """(trees, rows): Poisson weights from ``xxhash64(row, tree, seed)``, trees counted from one."""
    out = np.empty((trees, len(rows)), np.uint8)
    drawn = np.array([seed], np.int64).view(np.uint64)
    first = _hashed(np.asarray(rows, np.int64).view(np.uint64), np.array([42], np.uint64), True)
    for t in range(trees):
        h = _hashed(drawn, _hashed(np.array([t + 1], np.uint64), first, False), not -2 ** 31 <= seed < 2 ** 31)
        out[t] = np.searchsorted(_POISSON, h.view(np.int64) / 2.0 ** 64 + 0.5)
    return out


def _lines(column, width: int) -> np.ndarray:
    """(width, rows) of an Arrow column of lists of ``width``."""
    return np.ascontiguousarray(column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width).T)


class _Blocks:
    """Stored rows in blocks of whole categories of one column (``place``), and the categories that are spread."""

    def __init__(self, stored: DataFrame, place: int, spread: Sequence[int]):
        self.stored, self.place, self.spread = stored, place, spread


def _bin_type(cuts: Sequence[Sequence[float]]):
    return np.uint8 if max((len(c) for c in cuts), default=0) < 256 else np.int32


def _blocks(rows: DataFrame, total: int, cuts: Sequence[Sequence[float]], categories: int, place: int, trees: int, seed: int, bootstrap: bool) -> _Blocks:
    """Targets, bins, codes and bootstrap weights of many rows at a time."""
    edges, kind, held_rows = [np.array(c, float) for c in cuts], _bin_type(cuts), BLOCK_ROWS
    spread: list[int] = []
    if categories:
        code = F.col("codes")[place]
        many = rows.groupBy(code.alias("c")).count().where(F.col("count") > max(BLOCK_ROWS, total // SPREAD))
        spread = sorted(r["c"] for r in many.collect())  # at most SPREAD
        key = F.when(code.isin(spread), F.col("row")).otherwise(code) if spread else code
        rows = rows.repartition(key).sortWithinPartitions(code)

    def pack(batches):
        import pyarrow as pa

        def block(y, row, numbers, codes):
            bins = np.array([np.searchsorted(e, x) for e, x in zip(edges, numbers, strict=True)], kind)  # NaN after all
            weights = draw_weights(row, trees, seed) if bootstrap else np.zeros(0, np.uint8)
            parts = [np.ascontiguousarray(x).tobytes() for x in (y, bins, codes, weights)]
            return pa.RecordBatch.from_arrays([pa.array([p], pa.binary()) for p in parts], names=["y", "bins", "codes", "weights"])

        held: list[tuple] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            named = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            held.append((named["y"].to_numpy(), named["row"].to_numpy(), _lines(named["numbers"], len(edges)) if edges else np.zeros((0, batch.num_rows)),
                         _lines(named["codes"], categories) if categories else np.zeros((0, batch.num_rows), np.int64)))
            if sum(len(h[0]) for h in held) < held_rows:
                continue
            whole = tuple(np.concatenate(x, -1) for x in zip(*held))
            end = len(whole[0])
            if categories and whole[3][place, -1] not in spread:  # its rows may go on
                at = whole[3][place]
                end = int(np.flatnonzero(at != at[-1])[-1]) + 1 if at[0] != at[-1] else 0
            if end:
                yield block(*[x[..., :end] for x in whole])
            held = [tuple(x[..., end:] for x in whole)] if end < len(whole[0]) else []
        if held:
            yield block(*[np.concatenate(x, -1) for x in zip(*held)])

    # a row is a block, so a reader must not take many of them at a time
    packed = rows.mapInArrow(pack, "y binary, bins binary, codes binary, weights binary")
    return _Blocks(materialize(packed, "blocks", **{"parquet.block.size": str(BLOCK_BYTES)}), place, spread)


def _unpacked(batches, numeric: int, kind, trees: int) -> Iterator[tuple]:
    """(targets, bins, codes, weights) of every block, a line per column or tree."""
    for batch in batches:
        for i in range(batch.num_rows):
            y, bins, codes, weights = (batch.column(c)[i].as_buffer() for c in range(4))
            y = np.frombuffer(y, np.float64)
            bins = np.frombuffer(bins, kind).reshape(numeric, len(y)) if numeric else np.zeros((0, len(y)), kind)
            codes = np.frombuffer(codes, np.int64).reshape(-1, len(y)) if codes.size else np.zeros((0, len(y)), np.int64)
            weights = np.frombuffer(weights, np.uint8).reshape(trees, len(y)) if weights.size else np.broadcast_to(np.uint8(1), (trees, len(y)))
            yield y, bins, codes, weights


def _summed(key: np.ndarray, w: np.ndarray, wy: np.ndarray, keys: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, sum of w, sum of wy) of the keys that occur, ascending; all are below ``keys``."""
    if keys <= 16 * len(key):
        n = np.bincount(key, w, keys)
        found = np.flatnonzero(n)
        return found, n[found], np.bincount(key, wy, keys)[found]
    order = np.argsort(key, kind="stable")
    key = key[order]
    start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    return key[start], np.add.reduceat(w[order], start) if len(key) else w, np.add.reduceat(wy[order], start) if len(key) else wy


class _BestCodes:
    """The category of largest gain per open node so far; ties go to the least code."""

    def __init__(self, nodes: int):
        self.gain, self.code = np.full(nodes, -np.inf), np.full(nodes, np.iinfo(np.int64).max)
        self.n, self.s = np.zeros(nodes), np.zeros(nodes)

    def offer(self, slot, code, n, s, all_n, all_s, least) -> None:
        rest = all_n - n
        fits = (n >= least) & (rest >= least)
        slot, code, n, s, all_n, all_s, rest = (x[fits] for x in (slot, code, n, s, all_n, all_s, rest))
        gain = s * s / n + (all_s - s) * (all_s - s) / rest - all_s * all_s / all_n
        top = self.gain.copy()
        np.maximum.at(top, slot, gain)
        few = np.flatnonzero(gain == top[slot])
        few = few[np.lexsort((code[few], slot[few]))]
        few = few[np.r_[True, slot[few][1:] != slot[few][:-1]]] if len(few) else few
        at = slot[few]
        few = few[(gain[few] > self.gain[at]) | (code[few] < self.code[at])]
        at = slot[few]
        self.gain[at], self.code[at], self.n[at], self.s[at] = gain[few], code[few], n[few], s[few]


def _level_sums(blocks: _Blocks, sent, numeric: int, kind, widths: Sequence[int], trees: int, least: int) -> DataFrame:
    """Sums per open node of bins and spread categories, and the best of the other categories of every task."""
    place, spread, width = blocks.place, np.array(blocks.spread, np.int64), sum(widths)
    offsets = np.cumsum([0, *widths])
    counted = numeric if place == 0 else 0  # numbers are summed over the blocks of one column only

    def sums(batches):
        import pyarrow as pa

        shape, slots, start, all_n, all_s, tree, node = sent.value
        column_of, cut_of = np.repeat(np.arange(len(widths)), widths), np.concatenate([np.arange(w) for w in widths] or [np.zeros(0, int)])
        best, dense = _BestCodes(len(tree)), len(tree) * width <= DENSE_CELLS
        total_n, total_s = (np.zeros(len(tree) * width if dense and counted else 0) for _ in range(2))

        def rows(slot, column, cut, n, s):
            arrays = [tree[slot], node[slot], np.asarray(column, np.int32), np.asarray(cut, np.int64), n.astype(np.int64), s, all_n[slot].astype(np.int64), all_s[slot]]
            return pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=["tree", "node", "column", "cut", "n", "s", "all_n", "all_s"])

        for y, bins, codes, weights in _unpacked(batches, numeric, kind, trees):
            if len(codes):
                own = codes[place]
                starts = np.r_[True, own[1:] != own[:-1]]
                where, named = np.cumsum(starts) - 1, own[starts]  # categories of the block
                is_spread = np.isin(named, spread)
            for t in range(trees):
                nodes = start[t + 1] - start[t]
                if not nodes:
                    continue
                at = np.flatnonzero(weights[t])
                slot = slots[t].take(shape.leaves(t, bins, codes, at))
                at, slot = at[slot >= 0], slot[slot >= 0]
                if not len(at):
                    continue
                w = weights[t].take(at).astype(float)
                wy = w * y.take(at)
                if counted:
                    cells = [slot * width + (offsets[c] + bins[c].take(at)) for c in range(numeric)]
                    cell, n, s = _summed(np.concatenate(cells), np.tile(w, numeric), np.tile(wy, numeric), nodes * width)
                    if dense:
                        total_n[start[t] * width + cell] += n
                        total_s[start[t] * width + cell] += s
                    else:
                        yield rows(start[t] + cell // width, column_of[cell % width], cut_of[cell % width], n, s)
                if len(codes):
                    group, n, s = _summed(where.take(at) * nodes + slot, w, wy, len(named) * nodes)
                    code, held = group // nodes, start[t] + group % nodes
                    if spread.size and is_spread[code].any():
                        out = is_spread[code]
                        yield rows(held[out], np.full(out.sum(), numeric + place), named[code[out]], n[out], s[out])
                        code, held, n, s = code[~out], held[~out], n[~out], s[~out]
                    best.offer(held, named[code], n, s, all_n[held], all_s[held], least)
        if dense and counted:
            cell = np.flatnonzero(total_n)
            yield rows(cell // width, column_of[cell % width], cut_of[cell % width], total_n[cell], total_s[cell])
        at = np.flatnonzero(best.gain > -np.inf)
        yield rows(at, np.full(len(at), numeric + place), best.code[at], best.n[at], best.s[at])

    return blocks.stored.mapInArrow(sums, "tree int, node int, column int, cut long, n long, s double, all_n long, all_s double")


def _best_cuts(stored: Sequence[_Blocks], shape: Shape, kind, widths: Sequence[int], opened: Sequence[set[int]], whole: Sequence[dict], least: int) -> list:
    """(tree, node, column, bin or code, rows and sum left, rows and sum in all) of every open node that a cut improves."""
    numeric, trees = shape.numeric, len(opened)
    nodes = [sorted(o) for o in opened]
    slots = np.full(shape.column.shape, -1, np.int64)
    for t, held in enumerate(nodes):
        slots[t, held] = np.arange(len(held))
    known = [whole[t][n] for t, held in enumerate(nodes) for n in held]
    tree, node = np.repeat(np.arange(trees), [len(h) for h in nodes]).astype(np.int32), np.array([n for held in nodes for n in held], np.int32)
    sent = stored[0].stored.sparkSession.sparkContext.broadcast(
        (shape, slots, np.cumsum([0, *map(len, nodes)]), np.array([n for n, _ in known], float), np.array([s for _, s in known], float), tree, node))
    sums = None
    for blocks in stored:
        part = _level_sums(blocks, sent, numeric, kind, widths, trees, least)
        sums = part if sums is None else sums.unionByName(part)
    sums = sums.groupBy("tree", "node", "column", "cut", "all_n", "all_s").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    sums = materialize(sums, "sums")  # read twice below
    upto = Window.partitionBy("tree", "node", "column").orderBy("cut").rowsBetween(Window.unboundedPreceding, 0)  # bins of a node
    ordered = sums.where(F.col("column") < numeric).withColumns({"n": F.sum("n").over(upto), "s": F.sum("s").over(upto)})
    cuts = ordered.unionByName(sums.where(F.col("column") >= numeric))
    left, rest = F.col("n"), F.col("all_n") - F.col("n")
    cuts = cuts.where((left >= least) & (rest >= least))
    gain = (F.col("s") * F.col("s") / left + (F.col("all_s") - F.col("s")) * (F.col("all_s") - F.col("s")) / rest
            - F.col("all_s") * F.col("all_s") / F.col("all_n"))
    # the largest gain; ties go to the first column, then to the least cut
    ranked = F.max(F.struct(gain.alias("gain"), (-F.col("column")).alias("_c"), (-F.col("cut")).alias("_b"), "column", "cut", "n", "s", "all_n", "all_s"))
    found = cuts.groupBy("tree", "node").agg(ranked.alias("b")).select("tree", "node", "b.*").where("gain > 1e-9 * (1 + abs(all_s * all_s / all_n))").collect()
    sent.destroy()
    return found


def _tree_totals(blocks: _Blocks, numeric: int, kind, trees: int) -> dict[int, tuple[int, float]]:
    """Rows and target sum of every tree, weighted."""
    def add(batches):
        import pyarrow as pa

        n, s = np.zeros(trees), np.zeros(trees)
        for y, _, _, weights in _unpacked(batches, numeric, kind, trees):
            for t in range(trees):
                w = weights[t].astype(float)
                n[t], s[t] = n[t] + w.sum(), s[t] + (w * y).sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(trees, dtype=np.int32)), pa.array(n.astype(np.int64)), pa.array(s)], names=["tree", "n", "s"])

    found = blocks.stored.mapInArrow(add, "tree int, n long, s double").groupBy("tree").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()
    return {r["tree"]: (r["n"], r["s"]) for r in found}


def grow(df: DataFrame, target: str, numeric: Sequence[str], categories: Sequence[str] = (), trees: int = 200, depth: int = 30, seed: int = 42,
         bootstrap: bool = True, least_rows: int = 1, max_leaves: int = MAX_LEAVES, bins: int = BINS,
         cuts: Mapping[str, Sequence[float]] | None = None) -> tuple[list[Tree], dict[str, list[float]]]:
    """(trees, cut points): variance-reducing trees over binned numbers and categories.

    A numeric cut sends values up to a cut point left; a category cut sends one
    category left, as a tree over one-hot columns does, so the number of
    categories bounds nothing but a task's pass over its rows. Every tree weighs
    rows by a Poisson draw of their own. Growth ends at ``depth`` levels, where a
    part would hold fewer than ``least_rows``, or at ``max_leaves`` per tree.
    """
    cuts = dict(cuts) if cuts is not None else find_cuts(df, numeric, bins)
    points = [cuts[c] for c in numeric]
    kind, widths = _bin_type(points), [len(p) + 1 for p in points]
    numbers, codes = _inputs(numeric, categories)
    rows = materialize(df.where(F.col(target).isNotNull()).select(
        F.col(target).cast("double").alias("y"), numbers.cast("array<double>").alias("numbers"), codes.cast("array<bigint>").alias("codes"),
        F.monotonically_increasing_id().alias("row")), "binned")
    total = rows.count()
    if not total:
        raise ValueError("no row to fit a tree on")
    with byte_bound_batches(df.sparkSession, BLOCK_BYTES):
        stored = [_blocks(rows, total, points, len(categories), place, trees, seed, bootstrap) for place in range(max(1, len(categories)))]
        start = _tree_totals(stored[0], len(numeric), kind, trees)
        forest, whole = [Tree() for _ in range(trees)], [{0: start[t]} for t in range(trees)]
        for t, tree in enumerate(forest):
            n, s = start[t]
            if not n:
                raise ValueError("no row to fit a tree on")
            tree.value[0], tree.rows[0] = s / n, n
        opened = [{0} for _ in forest]
        for _ in range(depth):
            shape = Shape(forest, len(numeric))  # of bins; the cut points come in at the end
            fresh: list[set[int]] = [set() for _ in forest]
            found = _best_cuts(stored, shape, kind, widths, opened, whole, least_rows)
            whole = [{} for _ in forest]
            for r in sorted(found, key=lambda r: (r["tree"], -r["all_n"], r["node"])):
                tree = forest[r["tree"]]
                if (len(tree.column) + 1) // 2 >= max_leaves:
                    continue
                parts = (r["n"], r["s"]), (r["all_n"] - r["n"], r["all_s"] - r["s"])
                made = tree.split(r["node"], r["column"], r["cut"], *parts)
                whole[r["tree"]] |= dict(zip(made, parts, strict=True))
                fresh[r["tree"]] |= {node for node in made if tree.rows[node] >= 2 * least_rows}
            opened = fresh
            if not any(opened):
                break
    for tree in forest:
        tree.cut = [points[c][k] if 0 <= c < len(points) else k for c, k in zip(tree.column, tree.cut, strict=True)]
    return forest, cuts


class ForestModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """A grown forest as a pipeline stage: adds ``prediction``, the mean of the trees' leaves.

    A NULL or NaN number goes right at every cut; an unseen category equals none.
    """

    forest = Param(Params._dummy(), "forest", "columns and trees as JSON", TypeConverters.toString)

    def __init__(self, trees: Sequence[Tree] | None = None, numeric: Sequence[str] = (), categories: Sequence[str] = ()):
        super().__init__()
        if trees is not None:
            held = [[t.column, t.cut, t.child, t.value, t.rows] for t in trees]
            self._set(forest=json.dumps({"numeric": list(numeric), "categories": list(categories), "trees": held}))

    def parts(self) -> tuple[list[Tree], list[str], list[str]]:
        held, trees = json.loads(self.getOrDefault(self.forest)), []
        for arrays in held["trees"]:
            tree = Tree()
            tree.column, tree.cut, tree.child, tree.value, tree.rows = arrays
            trees.append(tree)
        return trees, held["numeric"], held["categories"]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        trees, numeric, categories = self.parts()
        shape = dataset.sparkSession.sparkContext.broadcast(Shape(trees, len(numeric)))

        @F.pandas_udf("double")
        def predict(numbers, codes):
            import pandas as pd

            return pd.Series(shape.value.predict(_matrix(numbers, np.float64), _matrix(codes, np.int64)))

        numbers, codes = _inputs(numeric, categories)
        return dataset.withColumn("prediction", predict(numbers, codes))
