"""N-gram Jaccard join over parity sketches."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from .batches import bound
from .components import components
from .native import refuse_clashes
from .ngram_tasks import LONGS, Plan, distance, long_sketch, shared, shingle_sets, short_sketch

# Node ids (8 bytes each) that are broadcast; more are joined by a shuffle.
BROADCAST_NODES = 500_000
# A turn with new centers is followed by another if one in so many comparisons found a link.
PAYING = 8
# Centers that every key tries in a turn; a turn's jobs cost more than its pairs where keys are small.
CENTERS = 4
# Pairs up to which whole sets are compared at once, without long sketches first.
FEW_PAIRS = 20_000
# Texts that one partition remembers as already sketched; affects volume only.
REMEMBERED = 1_000_000
SKETCH = [f"_s{i}" for i in range(LONGS)]


def _nodes(docs: DataFrame, text: str) -> DataFrame:
    """Texts with two hashes: ``_h`` is what keys carry, ``_node`` tells texts apart."""
    filled = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.xxhash64(filled).alias("_h"), F.md5(filled.cast("binary")).alias("_node"), filled.alias("_text"))


def _infos(docs: DataFrame, keep: Sequence[str], text: str, size: int) -> DataFrame:
    filled = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(*keep, F.xxhash64(filled).alias("_h"), F.md5(filled.cast("binary")).alias("_node"), filled.alias("_text"))
    schema = rows.drop("_text").schema.add("n_shingles", "long")
    for name in SKETCH:
        schema = schema.add(name, "long")
    count = len(schema) - 1 - LONGS

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            made = [(len(s), *short_sketch(s)) for s in shingle_sets(batch.column(count).to_pylist(), size)]
            columns = [pa.array(c, pa.int64()) for c in zip(*made, strict=True)] or [pa.array([], pa.int64())] * (1 + LONGS)
            yield pa.RecordBatch.from_arrays([*batch.columns[:count], *columns], names=schema.names)

    return rows.mapInArrow(run, schema)


def _keys(docs: DataFrame, text: str, size: int, plan: Plan) -> DataFrame:
    """(key, h) of every text; a partition sketches equal texts once."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        seen: set = set()
        for batch in batches:
            hashes, texts = batch.column(0).to_pylist(), batch.column(1)
            new = []
            for i, h in enumerate(hashes):
                if h not in seen:
                    seen.add(h)
                    new.append(i)
            if len(seen) > REMEMBERED:
                seen = set()
            for at in range(0, len(new), 1000):
                part = new[at:at + 1000]
                found = [plan.keys(s) for s in shingle_sets(texts.take(pa.array(part)).to_pylist(), size)]
                own = np.repeat(np.array([hashes[i] for i in part], np.int64), [len(k) for k in found])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found)), pa.array(own)], names=["key", "h"])

    return _nodes(docs, text).select("_h", "_text").mapInArrow(run, "key long, h long")


def _shared_keys(keys: DataFrame) -> DataFrame:
    """Members of keys that two texts or more have, with the key's least member as ``center``.

    One exchange by key; the sorted stream of a partition is read once, so no
    group is held in memory.
    """
    def run(batches):
        import numpy as np
        import pyarrow as pa

        last_key, last_h, center, told = None, None, None, False
        for batch in batches:
            k, h = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if last_key is not None:
                k, h = np.r_[last_key, k], np.r_[last_h, h]
            if not len(k):
                continue
            first = np.r_[True, k[1:] != k[:-1]]
            starts = np.flatnonzero(first)
            group = np.cumsum(first) - 1
            centers = h[starts]
            if last_key is not None:
                centers[0] = center
            fresh = np.r_[True, ~((k[1:] == k[:-1]) & (h[1:] == h[:-1]))]
            others = fresh & (h != centers[group])
            if last_key is not None:
                others[0] = False  # was in the batch before
            # the center itself once, with its first other member
            crowded = np.unique(group[others])
            with_center = crowded[1:] if told and len(crowded) and crowded[0] == 0 else crowded
            yield pa.RecordBatch.from_arrays([
                pa.array(np.r_[k[starts[with_center]], k[others]]), pa.array(np.r_[centers[with_center], h[others]]),
                pa.array(np.r_[centers[with_center], centers[group[others]]])], names=["key", "h", "center"])
            same = len(starts) == 1 and last_key is not None
            told = bool(len(crowded) and crowded[-1] == group[-1]) or (same and told)
            last_key, last_h, center = k[-1], h[-1], centers[-1]

    return keys.repartition("key").sortWithinPartitions("key", "h").mapInArrow(run, "key long, h long, center long")


def _near(left: str, right: str, percent: int) -> Column:
    """Whether two sizes and short sketches allow a link: Hamming distance bounds the difference from below."""
    a, b = F.col(f"{left}.n_shingles"), F.col(f"{right}.n_shingles")
    limit = F.floor((a + b) * (100 - percent) / (100 + percent))
    distance = reduce(add, [F.bit_count(F.col(f"{left}.{s}").bitwiseXOR(F.col(f"{right}.{s}"))) for s in SKETCH])
    return (a * 100 >= b * percent) & (b * 100 >= a * percent) & (distance <= limit)


def _stored(pairs: DataFrame, node: str, docs: DataFrame, text: str, size: int, kind: str, make) -> DataFrame:
    """(_h, _node, _size, _made) of every text that ``pairs`` name in a or b by its ``node`` (``_h`` or ``_node``)."""
    wanted = materialize(pairs.select(F.col("a").alias(node)).union(pairs.select("b")).distinct(), "wanted")
    few = wanted.count() <= BROADCAST_NODES
    texts = _nodes(docs, text).join(F.broadcast(wanted) if few else wanted, node, "left_semi").select("_h", "_node", "_text")

    def run(batches):
        import pyarrow as pa

        seen: set = set()
        for batch in batches:
            nodes = batch.column(1).to_pylist()
            new = [i for i, n in enumerate(nodes) if n not in seen and not seen.add(n)]
            for at in range(0, len(new), 500):
                part = pa.array(new[at:at + 500], pa.int64())
                made = [(len(s), make(s)) for s in shingle_sets(batch.column(2).take(part).to_pylist(), size)]
                sizes, found = zip(*made, strict=True)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(part), batch.column(1).take(part), pa.array(sizes, pa.int64()),
                                                  pa.array(found, pa.binary())], names=["_h", "_node", "_size", "_made"])

    return materialize(texts.mapInArrow(run, "_h long, _node string, _size long, _made binary").dropDuplicates(["_node"]), kind)


def _verified(pairs: DataFrame, docs: DataFrame, text: str, size: int, percent: int) -> DataFrame:
    """Links (a, b) among ``pairs`` (of ``_h``) by the exact size of the intersection, as ``_node``.

    Long sketches, a tenth of the sets' bytes, meet the pairs first; whole
    sets are made only for pairs that these do not rule out. Up to
    ``FEW_PAIRS`` go to the sets directly.
    """
    limit = Plan(percent).pair_limit

    def kept(batch, good):
        import pyarrow as pa

        rows = pa.array([i for i, g in enumerate(good) if g], pa.int64())
        return pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows)], names=["a", "b"])

    def close(batches):
        for batch in batches:
            measures = zip(*(batch.column(i).to_pylist() for i in range(2, 6)), strict=True)
            yield kept(batch, [x is None or y is None or distance(x, y) <= limit(n, m) for n, m, x, y in measures])

    def verify(batches):
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                both = shared(x, y)
                good.append(100 * both >= percent * ((len(x) + len(y)) // 8 - both) > 0)
            yield kept(batch, good)

    def side(table: DataFrame, key: str, name: str) -> DataFrame:
        return table.select(F.col(key).alias(name), F.col("_node").alias(f"n{name}"), F.col("_size").alias(f"s{name}"), F.col("_made").alias(f"m{name}"))

    if pairs.count() <= FEW_PAIRS:
        sets = _stored(pairs, "_h", docs, text, size, "sets", bytes)
        met = pairs.join(side(sets, "_h", "a"), "a").join(side(sets, "_h", "b"), "b").select(F.col("na").alias("a"), F.col("nb").alias("b"), "ma", "mb")
    else:
        sketches = _stored(pairs, "_h", docs, text, size, "long-sketches", long_sketch)
        met = pairs.join(side(sketches, "_h", "a"), "a").join(side(sketches, "_h", "b"), "b")
        near = materialize(met.select("na", "nb", "sa", "sb", "ma", "mb").mapInArrow(close, "a string, b string"), "near")
        sets = _stored(near, "_node", docs, text, size, "sets", bytes)
        met = near.join(side(sets, "_node", "a"), "a").join(side(sets, "_node", "b"), "b")
    return materialize(met.select("a", "b", "ma", "mb").mapInArrow(verify, "a string, b string"), "links")


def _apart(members: DataFrame, infos: DataFrame, links: DataFrame) -> DataFrame:
    """Members, with sizes, sketches and components, of the keys whose members ``links`` leave in several components."""
    found = components(links).select(F.col("node").alias("_node"), F.col("component").alias("_comp"))
    labelled = infos.select(F.col("_h").alias("h"), "_node").join(found, "_node", "left").withColumn("_comp", F.coalesce("_comp", "_node"))
    placed = _several(materialize(members.select("key", "h").distinct().join(labelled, "h"), "placed"))
    return materialize(placed.join(infos.drop("_h"), "_node"), "apart")


def _several(placed: DataFrame) -> DataFrame:
    """The members of keys that have several components."""
    several = placed.groupBy("key").agg(F.min("_comp").alias("_least"), F.max("_comp").alias("_most")).where("_least <> _most")
    return placed.join(several.select("key"), "key", "left_semi")


def _still_apart(apart: DataFrame, more: DataFrame) -> DataFrame:
    """What :func:`_apart` would leave with the links ``more`` added; only the components that these join are found anew."""
    of = apart.select("_node", "_comp").distinct()
    end = lambda name: of.select(F.col("_node").alias(name), F.col("_comp").alias(f"_c{name}"))
    moved = components(more.join(end("a"), "a").join(end("b"), "b"), "_ca", "_cb").select(F.col("node").alias("_comp"), "component")
    joined = apart.join(moved, "_comp", "left").withColumn("_comp", F.coalesce("component", "_comp")).drop("component")
    return materialize(_several(materialize(joined, "placed")), "apart")


def join(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text", size: int = 5, percent: int = 80):
    """(rows, links): every row with its text's node and set size, and verified links of nodes.

    Two texts link when 100 * shared >= ``percent`` * united shingles of
    ``size`` words. ``links`` joins all texts that any chain of such links
    joins, though not by every pair: in a large group of near copies each is
    first compared with one member per key, then, while that keeps finding
    links, with others, and only texts that this left apart meet all the rest
    of their key. Equal texts are one node. Texts without words have no links.
    """
    plan = Plan(percent)
    bound(docs.sparkSession)
    rows = materialize(_infos(docs, keep, text, size), "sketches")
    members = materialize(_shared_keys(_keys(docs, text, size, plan)), "members")
    infos = rows.where("n_shingles > 0").select("_h", "_node", "n_shingles", *SKETCH).dropDuplicates(["_node"])

    side = lambda name: infos.select(F.col("_h").alias(name), "n_shingles", *SKETCH).alias(f"i{name}")
    pairs = members.where("h <> center").select(F.col("center").alias("a"), F.col("h").alias("b")).distinct()
    pairs = pairs.join(side("a"), "a").join(side("b"), "b").where(_near("ia", "ib", percent)).select("a", "b").distinct()
    links = _verified(materialize(pairs, "pairs"), docs, text, size, percent)

    # keys whose members are still apart: other centers in every turn, while that joins many
    apart, turn, pays = _apart(members, infos, links), 0, True
    crossing = F.col("x._comp") != F.col("y._comp")
    ends = F.least("x.h", "y.h").alias("a"), F.greatest("x.h", "y.h").alias("b")
    while pays and apart.limit(1).count():
        turn += 1
        member = F.struct("h", "_comp", "n_shingles", *SKETCH)
        chosen = F.array_distinct(F.array(*[F.min_by(member, F.xxhash64("h", F.lit(turn * CENTERS + i))) for i in range(CENTERS)])).alias("c")
        centers = apart.groupBy("key").agg(chosen).select("key", F.explode("c").alias("c")).select("key", "c.*")
        met = apart.alias("x").join(centers.alias("y"), (F.col("x.key") == F.col("y.key")) & crossing & _near("x", "y", percent))
        pairs = materialize(met.select(*ends).distinct(), "pairs")
        tried = pairs.count()
        if not tried:
            break
        more = _verified(pairs, docs, text, size, percent)
        found = more.count()
        pays = found * PAYING >= tried
        if found:
            links = links.unionByName(more)
            apart = _still_apart(apart, more)

    if not apart.limit(1).count():
        return rows, links
    # what is apart by now: members outside the component of the key's center meet all others
    center = apart.groupBy("key").agg(F.min_by("_comp", F.xxhash64("h")).alias("_own"))
    placed = materialize(apart.join(center, "key"), "placed")
    outside, inside = placed.where("_comp <> _own").alias("x"), placed.alias("y")
    once = (F.col("y._comp") == F.col("y._own")) | (F.col("x.h") < F.col("y.h"))
    met = outside.join(inside, (F.col("x.key") == F.col("y.key")) & crossing & once & _near("x", "y", percent))
    pairs = materialize(met.select(*ends).distinct(), "pairs")
    if pairs.limit(1).count():
        links = links.unionByName(_verified(pairs, docs, text, size, percent))
    return rows, links


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80,
                    keep: Sequence[str] = ()) -> DataFrame:
    """Set size and component of every row.

    Returns the id, ``keep``, ``n_shingles`` and ``component_id`` (the smallest
    id reachable by links, itself included). Equal texts share a component
    unless they have no words; those are alone with their own id. Rows with a
    NULL id belong to the component of their text, but name none. Repeated
    rows give repeated results, an empty table none. Kept names that start with
    ``_`` or are a result's are refused.
    """
    refuse_clashes([doc_id, *keep], ("n_shingles", "component_id"))
    rows, links = join(docs, [doc_id, *keep], text, size, percent)
    found = components(links).select(F.col("node").alias("_node"), F.col("component").alias("_comp"))
    rows = rows.join(found, "_node", "left").withColumn("_comp", F.coalesce("_comp", "_node"))
    least = rows.where("n_shingles > 0").groupBy("_comp").agg(F.min(doc_id).alias("_least"))
    rows = rows.withColumn("_comp", F.when(F.col("n_shingles") > 0, F.col("_comp")))
    return rows.join(least, "_comp", "left").select(
        doc_id, *keep, "n_shingles", F.coalesce("_least", F.col(doc_id)).alias("component_id"))


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """The same columns, with one row of every component of linked texts: that of the smallest id.

    Ties go to the least text hash; of repeated rows with one id and text one
    stays; a row with a NULL id stays only where the component has no other.
    Texts without words all stay.
    """
    rows, links = join(docs, [doc_id], text, size, percent)
    found = components(links).select(F.col("node").alias("_node"), F.col("component").alias("_comp"))
    own = rows.where("n_shingles > 0").groupBy(doc_id, "_node").agg(F.count(F.lit(1)).alias("_rows"))
    own = own.join(found, "_node", "left").withColumn("_comp", F.coalesce("_comp", "_node"))
    own = own.withColumn("_rank", F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), F.col("_node").alias("node")))
    own = materialize(own, "owners")
    first = own.groupBy("_comp").agg(F.min("_rank").alias("_first"))
    judged = own.join(first, "_comp").select(F.col(doc_id).alias("_id"), F.col("_node").alias("_n"), "_rows", (F.col("_rank") == F.col("_first")).alias("_stays"))
    judged = materialize(judged.where("not _stays or _rows > 1"), "judged")
    counts = {r["_stays"]: r["count"] for r in judged.groupBy("_stays").count().collect()}
    keyed = docs.withColumn("_n", F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))

    def against(frame, stays: bool, how: str):
        side = judged.where(F.col("_stays") == stays).select("_id", F.col("_n").alias("_m"))
        side = F.broadcast(side) if counts.get(stays, 0) <= BROADCAST_NODES else side
        return frame.join(side, F.col(doc_id).eqNullSafe(F.col("_id")) & (F.col("_n") == F.col("_m")), how)

    left = against(keyed, False, "left_anti")
    if counts.get(True):
        # repeated rows among those that stay
        left = against(left, True, "left_anti").unionByName(against(left, True, "left_semi").dropDuplicates([doc_id, "_n"]))
    return left.drop("_n")
