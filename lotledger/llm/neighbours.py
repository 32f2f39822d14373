"""Approximate nearest neighbours: a k-means tree, walked best bin first as far as calibration asks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..session import materialize
from . import kmeans_tree as trees
from .batches import bound

# Distinct vectors that the tree is fitted on, and the bytes they may take on the driver.
SAMPLE, SAMPLE_BYTES = 16_384, 64 << 20
# Rows that a leaf should hold, and sampled vectors it needs at least.
LEAF_ROWS, LEAF_SAMPLE = 64, 4
# Queries that calibrate the number of leaf visits, and the share of their neighbours to be met.
CALIBRATION, RECALL = 256, 0.97
# Vectors in one block (of one or more neighbouring leaves), queries that meet it together, queries that walk together.
BLOCK_ROWS, BLOCK_QUERIES, TOGETHER = 2048, 1024, 64
# Slices of the answers that rows of one query vector are joined with.
SLICES = 8
RESULTS = ("query_id", "rank", "vec_id", "score", "leaf_visits", "calibrated_recall")


def _matrix(column):
    """Arrow lists of one length as a matrix."""
    import numpy as np

    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _assign(nodes: DataFrame, tree) -> DataFrame:
    schema = StructType([*nodes.schema.fields, StructField("_leaf", LongType())])

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows:
                leaf = tree.value.leaf_of(trees.unit(_matrix(batch.column(1))))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], names=schema.names)

    return nodes.mapInArrow(run, schema)


def _true_leaves(nodes: DataFrame, queries: list, k: int) -> list[list[int]]:
    """Leaves of the ``k`` nearest rows of some queries, by exact products with all nodes.

    Every task keeps ``k`` nodes a query; merging those gives the answer.
    """
    import numpy as np

    names = [r["_node"] for r in queries]
    sent = nodes.sparkSession.sparkContext.broadcast(trees.unit(np.array([r["_vector"] for r in queries], np.float64)))

    def run(batches):
        import pyarrow as pa

        own = {name: i for i, name in enumerate(names)}
        for batch in batches:
            if not batch.num_rows:
                continue
            near = sent.value @ trees.unit(_matrix(batch.column(1))).T
            for j, name in enumerate(batch.column(0).to_pylist()):
                if name in own:
                    near[own[name], j] = -2.0
            best = np.argsort(-near, axis=1, kind="stable")[:, :k]
            q = np.repeat(np.arange(len(near)), best.shape[1])
            take = pa.array(best.ravel())
            yield pa.RecordBatch.from_arrays([
                pa.array(q), pa.array(near[q, best.ravel()]), batch.column(2).take(take), batch.column(3).take(take)], names=["q", "s", "size", "leaf"])

    found = nodes.select("_node", "_vector", F.size("_ids").cast("long"), "_leaf").mapInArrow(run, "q long, s double, size long, leaf long")
    found = found.withColumn("_r", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("s")))).where((F.col("_r") <= k) & (F.col("s") > -2))
    out: list[list[int]] = [[] for _ in names]
    for r in found.orderBy("q", "_r").collect():  # k rows per calibrating query
        leaves = out[r["q"]]
        leaves += [r["leaf"]] * min(r["size"], k - len(leaves))
    return out


def _grouped(nodes_of: dict[int, int], most: int) -> dict[int, int]:
    """Group of every leaf: neighbouring leaves share one while it holds at most ``most`` nodes."""
    out, group, held = {}, 0, 0
    for leaf in sorted(nodes_of):
        if held and held + nodes_of[leaf] > most:
            group, held = group + 1, 0
        out[leaf], held = group, held + nodes_of[leaf]
    return out


def _dealt(side: DataFrame, own: dict, opposite: dict, name: str, key: str, other: str) -> DataFrame:
    """``side`` cut into ``own`` blocks per group, repeated for every block that the opposite side has there."""
    groups = [(group, own[group], opposite[group]) for group in own.keys() & opposite.keys()]
    # no more groups than leaves, of which the bounded sample allows few
    blocks = F.broadcast(side.sparkSession.createDataFrame(groups, "_group long, _own long, _opposite long"))
    block = F.pmod(F.xxhash64(key), F.col("_own"))
    repeated = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_opposite") - 1))
    return side.join(blocks, "_group").withColumn(name, block).withColumn(other, repeated).drop("_own", "_opposite")


def _best(k: int):
    """The ``k`` nearest rows of a block for every query, among the leaves that it visits."""
    def run(key, rows, queries):
        import numpy as np
        import pandas as pd

        out = []
        if len(rows) and len(queries):
            rows = rows.sort_values("_leaf", kind="stable")
            leaves, starts = np.unique(rows["_leaf"].to_numpy(), return_index=True)
            places = dict(zip(leaves.tolist(), np.split(np.arange(len(rows)), starts[1:]), strict=True))
            vectors = np.array(rows["_vector"].tolist(), np.float64)
            units, ids, sizes = trees.unit(vectors), rows["_ids"].tolist(), rows["_ids"].map(len).to_numpy()
            for name, asked, visited in zip(queries["_query"], queries["_vector"], queries["_leaves"], strict=True):
                asked, chosen = np.array(asked, np.float64), [places[leaf] for leaf in visited if leaf in places]
                if not chosen:
                    continue
                chosen = np.concatenate(chosen)
                near = units[chosen] @ trees.unit(asked[None])[0]
                # products of normalized vectors tell who may be among the best; the measure itself ranks them
                place = min(k, len(near)) - 1
                found = chosen[near >= -np.partition(-near, place)[place] - 1e-9]
                scores = trees.cosines(asked, vectors[found])
                left, last = k, None
                for i in np.argsort(-scores, kind="stable"):
                    if left <= 0 and scores[i] < last:
                        break
                    left, last = left - sizes[found[i]], scores[i]
                    out += [(name, x["id"], x["rid"], scores[i]) for x in ids[found[i]]]
        return pd.DataFrame(out, columns=["_query", "id", "rid", "score"])
    return run


def _search(nodes: DataFrame, queries: DataFrame, rows: int, length: int, k: int, recall: float, leaf_rows: int, sample: int):
    """(_query, id, rid, score) of the best ``k + 1`` rows per query vector, with visits and recall."""
    import numpy as np

    spark = nodes.sparkSession
    drawn = nodes.select("_node", "_vector").orderBy(F.xxhash64("_node")).limit(max(1, min(sample, SAMPLE_BYTES // (8 * length))))
    points = trees.unit(np.array([r["_vector"] for r in drawn.collect()], np.float64))
    wanted = max(1, min(rows // leaf_rows, len(points) // LEAF_SAMPLE))
    tree = trees.Tree(points, max(LEAF_SAMPLE, -(-len(points) // wanted)))
    sent = spark.sparkContext.broadcast(tree)
    placed = materialize(_assign(nodes, sent), "leaves")

    held = np.zeros(tree.leaves, np.int64)
    counts = placed.groupBy("_leaf").agg(F.count(F.lit(1)).alias("nodes"), F.sum(F.size("_ids")).alias("rows")).collect()
    for r in counts:
        held[r["_leaf"]] = r["rows"]
    asked = queries.orderBy(F.xxhash64("_node", F.lit("calibration"))).limit(CALIBRATION).collect()
    truth = _true_leaves(placed, asked, k)
    units = trees.unit(np.array([r["_vector"] for r in asked], np.float64))
    least, met = trees.needed_visits(tree, units, truth, held, recall)

    of_rows: dict = {}
    group_of = _grouped({r["_leaf"]: r["nodes"] for r in counts}, BLOCK_ROWS)
    for r in counts:
        of_rows[group_of[r["_leaf"]]] = of_rows.get(group_of[r["_leaf"]], 0) + r["nodes"]
    of_rows = {group: -(-n // BLOCK_ROWS) for group, n in of_rows.items()}

    def visited(batches):
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                part, take, groups, leaves = batch.slice(at, TOGETHER), [], [], []
                for i, vector in enumerate(trees.unit(_matrix(part.column(1)))):
                    by_group: dict = {}
                    for leaf in trees.visits(sent.value, vector, held, least, k + 1):
                        by_group.setdefault(group_of[leaf], []).append(leaf)
                    take += [i] * len(by_group)
                    groups += by_group.keys()
                    leaves += by_group.values()
                take = pa.array(take, pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0).take(take), part.column(1).take(take), pa.array(groups, pa.int64()),
                                                  pa.array(leaves, pa.list_(pa.int64()))], names=["_query", "_vector", "_group", "_leaves"])

    visiting = materialize(queries.mapInArrow(visited, "_query string, _vector array<double>, _group long, _leaves array<long>"), "visits")
    of_queries = {r["_group"]: -(-r["count"] // BLOCK_QUERIES) for r in visiting.groupBy("_group").count().collect()}
    groups = F.broadcast(spark.createDataFrame(list(group_of.items()), "_leaf long, _group long"))
    rows_of = placed.join(groups, "_leaf").select("_group", "_leaf", "_node", "_vector", "_ids")
    left = _dealt(rows_of, of_rows, of_queries, "_b", "_node", "_c")
    right = _dealt(visiting, of_queries, of_rows, "_c", "_query", "_b")
    keys = ("_group", "_b", "_c")
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(_best(k + 1), "_query string, id long, rid long, score double")
    order = Window.partitionBy("_query").orderBy(F.desc("score"), "id", "rid")
    best = found.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k + 1)
    answers = best.groupBy("_query").agg(F.sort_array(F.collect_list(F.struct("_r", "id", "rid", "score"))).alias("_found"))
    return answers.withColumns({"leaf_visits": F.lit(least), "calibrated_recall": F.lit(met)})


def search(vectors: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding", keep: Sequence[str] = (),
           recall: float = RECALL, leaf_rows: int = LEAF_ROWS, sample: int = SAMPLE) -> DataFrame:
    """The ``k`` nearest other rows by cosine of every row that satisfies ``is_query``.

    A k-means tree is fitted on at most ``sample`` distinct vectors; every row
    is put into a leaf. A query takes bins from a priority queue, nearest center
    first, and visits leaves; how many is calibrated: up to 256 queries are
    answered exactly, and the fewest visits that meet ``recall`` of their
    neighbours are taken for all (more where the leaves hold too few rows).
    Leaves are compared in blocks of bounded size, however many rows or queries
    one has. Equal vectors are one node with its ``k + 1`` smallest ids.

    Returns ``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` (the cosine of the
    original vectors in double precision), ``leaf_visits``, ``calibrated_recall``
    and the query's columns ``keep``. Ties go to the smaller id. Only vectors of
    one length are compared, length by length. Vectors that are NULL, empty,
    zero or hold NULL or non-finite components, and rows without an id, take no
    part. Repeated rows are rows of their own: each is a candidate of the
    others. An empty table gives no rows. ``keep`` must not hold a result name
    or one that starts with ``_``.
    """
    if clash := set(RESULTS) & set(keep) | {c for c in keep if c.startswith("_")}:
        raise ValueError(f"kept columns clash with results: {sorted(clash)}")
    spark = vectors.sparkSession
    bound(spark)
    values = F.col(vector).cast("array<double>")
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= F.lit(1.7976931348623157e308)))
    valid = F.coalesce((F.size(values) > 0) & finite & F.exists(values, lambda x: x != 0), F.lit(False)) & F.col(vec_id).isNotNull()
    even = F.transform(values, lambda x: x + F.lit(0.0))  # zeros of either sign are one value
    node = F.concat_ws("-", F.hex(F.xxhash64(even)), F.hex(F.xxhash64(F.lit(1), even)))
    rows = vectors.where(valid).select(
        F.col(vec_id).cast("long").alias("id"), F.monotonically_increasing_id().alias("rid"), F.struct(F.lit(0), *keep).alias("_keep"),
        node.alias("_node"), F.size(values).alias("_length"), even.alias("_vector"), F.coalesce(is_query, F.lit(False)).alias("_asks"))
    rows = materialize(rows, "vectors")
    lengths = {r["_length"]: r["count"] for r in rows.groupBy("_length").count().collect()}
    first = F.row_number().over(Window.partitionBy("_node").orderBy("id", "rid"))
    # each task passes on k + 1 rows of a node at most, so a very common vector gathers nowhere
    few = rows.select("_length", "_node", "_vector", "id", "rid").withColumn("_r", first).where(F.col("_r") <= k + 1)
    nodes = few.groupBy("_length", "_node").agg(F.first("_vector").alias("_vector"), F.sort_array(F.collect_list(F.struct("id", "rid"))).alias("_ids"))
    nodes = materialize(nodes, "nodes")
    asking = rows.where("_asks")
    queries = materialize(asking.select("_length", "_node", "_vector").dropDuplicates(["_length", "_node"]), "queries")
    answers = None
    for length in sorted(r["_length"] for r in queries.select("_length").distinct().collect()):
        same = F.col("_length") == length
        found = _search(nodes.where(same).select("_node", "_vector", "_ids"), queries.where(same).select("_node", "_vector"),
                        lengths[length], length, k, recall, leaf_rows, sample)
        answers = found if answers is None else answers.unionByName(found)
    if answers is None:
        empty = "query_id long, rank int, vec_id long, score double, leaf_visits int, calibrated_recall double"
        return spark.createDataFrame([], empty).select(*RESULTS, *[F.lit(None).cast(vectors.schema[c].dataType).alias(c) for c in keep])
    answers = answers.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1))))
    asking = asking.select(F.col("id").alias("query_id"), F.col("rid").alias("_own"), "_keep", "_node", F.pmod(F.hash("rid"), F.lit(SLICES)).alias("_s"))
    met = asking.join(answers, (F.col("_node") == F.col("_query")) & (asking["_s"] == answers["_s"]), "inner").drop("_s")
    others = F.slice(F.filter("_found", lambda x: x["rid"] != F.col("_own")), 1, k)
    each = met.select("query_id", "_keep", "leaf_visits", "calibrated_recall", F.posexplode(others).alias("_p", "_x"))
    return each.select("query_id", (F.col("_p") + 1).cast("int").alias("rank"), F.col("_x.id").alias("vec_id"), F.col("_x.score").alias("score"),
                       "leaf_visits", "calibrated_recall", *[F.col(f"_keep.{c}").alias(c) for c in keep])
