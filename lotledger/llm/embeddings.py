"""Near-duplicate vectors through small-world graphs per shard."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..session import materialize
from .components import components
from .native import refuse_clashes

# Vectors of one label that share a graph.
SHARD_ROWS = 16_384
# Rows of an exact block of products.
BLOCK = 1024


def _build(pdf):
    """One shard's vectors and graph as one row."""
    import pickle

    import numpy as np
    import pandas as pd

    from .hnsw import Graph, normalized

    pdf = pdf.sort_values("_node")
    vectors = normalized(np.array(pdf["_vector"].tolist(), np.float64))
    graph = Graph(vectors)
    return pd.DataFrame([(pdf["_space"].iloc[0], int(pdf["_shard"].iloc[0]), pickle.dumps(
        (pdf["_node"].tolist(), pdf["_copies"].to_numpy(np.int64), vectors, graph), protocol=5))],
        columns=["_space", "_shard", "_graph"])


def _link(least: float):
    """Links between two shards (or within one): per node their number, and a star of its component."""
    def run(pdf):
        import pickle

        import numpy as np
        import pandas as pd

        from .hnsw import range_search

        out = []
        for one, two, same in zip(pdf["_one"], pdf["_two"], pdf["_same"], strict=True):
            nodes_a, copies_a, vectors_a, graph_a = pickle.loads(one)
            nodes_b, copies_b, vectors_b, graph_b = (nodes_a, copies_a, vectors_a, graph_a) if same else pickle.loads(two)
            offset = 0 if same else len(nodes_a)
            total = len(nodes_a) if same else len(nodes_a) + len(nodes_b)
            links, label = np.zeros(total, np.int64), np.arange(total)

            def join(u, found, label=label):
                group = np.append(label[found], label[u])
                least_label = group.min()
                if (group != least_label).any():
                    label[np.isin(label, group)] = least_label

            hits_a, exact_a = range_search(graph_b, vectors_b, vectors_a, least, same)
            hits_b, exact_b = (hits_a, exact_a) if same else range_search(graph_a, vectors_a, vectors_b, least)
            pairs = []
            for hits, exact, flip in ((hits_a, exact_a, False),) if same else ((hits_a, exact_a, False), (hits_b, exact_b, True)):
                other = exact_a if same or flip else exact_b
                for q in np.flatnonzero(~exact):
                    found = hits[q][~other[hits[q]]]  # links to exact ones are counted there
                    if same:
                        found = found[found != q]
                    if len(found):
                        first, second = (found, np.full(len(found), q)) if flip else (np.full(len(found), q), found)
                        if same:
                            first, second = np.minimum(first, second), np.maximum(first, second)
                        pairs.append(first.astype(np.int64) * len(nodes_b) + second)
            if pairs:
                codes = np.unique(np.concatenate(pairs))
                first, second = codes // len(nodes_b), codes % len(nodes_b)
                np.add.at(links, first, copies_b[second])
                np.add.at(links, second + offset, copies_a[first])
                starts = np.flatnonzero(np.r_[True, first[1:] != first[:-1]])
                for u, found in zip(first[starts], np.split(second, starts[1:]), strict=True):
                    join(u, found + offset)
            sides = [(exact_a, vectors_a, 0, copies_a, exact_b, vectors_b, offset, copies_b)]
            if not same:
                sides.append((exact_b, vectors_b, offset, copies_b, exact_a, vectors_a, 0, copies_a))
            for exact, vectors, own_at, own_copies, other_exact, others, other_at, other_copies in sides:
                rows = np.flatnonzero(exact)
                for at in range(0, len(rows), BLOCK):
                    part = rows[at:at + BLOCK]
                    near = vectors[part] @ others.T >= least
                    if same:
                        near[np.arange(len(part)), part] = False
                    links[part + own_at] += near @ other_copies
                    loose = np.flatnonzero(~other_exact)
                    links[loose + other_at] += near[:, loose].T @ own_copies[part]
                    for row, u in enumerate(part):
                        found = np.flatnonzero(near[row])
                        if len(found):
                            join(u + own_at, found + other_at)
            names = nodes_a if same else [*nodes_a, *nodes_b]
            out += [(names[i], names[label[i]], int(links[i])) for i in np.flatnonzero(links)]
        return pd.DataFrame(out, columns=["a", "b", "n"])
    return run


def link_vectors(vectors: DataFrame, least: float = 0.98, vec_id: str = "vec_id", vector: str = "embedding",
                 label: str = "label", keep: Sequence[str] = (), shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Links and component of every vector.

    Only vectors of one label (and one length) are compared. Equal vectors are
    one node with a count. Nodes are dealt to shards of about ``shard_rows`` by
    hash; every shard gets a graph, and the vectors of each shard query their
    own and every other shard of the label. Returns the id, ``keep``,
    ``n_links`` (other vectors with cosine >= ``least``), ``component_id``
    (smallest id reachable by links) and ``kept`` (id = component).

    NULL labels and ids, and vectors that are NULL, empty, zero or hold NULL or
    non-finite components, link with nothing. Repeated rows are vectors of
    their own; an empty table gives no rows. Equal cosines need no order, as all
    links count. Kept names that start with ``_`` or are a result's are refused.
    """
    refuse_clashes([vec_id, *keep], ("n_links", "component_id", "kept"))
    spark = vectors.sparkSession
    values = F.col(vector).cast("array<double>")
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= F.lit(1.7976931348623157e308)))
    valid = F.coalesce((F.size(values) > 0) & finite & F.exists(values, lambda x: x != 0), F.lit(False))
    valid &= F.col(label).isNotNull() & F.col(vec_id).isNotNull()
    space = F.concat_ws("/", F.col(label).cast("string"), F.size(values).cast("string"))
    # zeros of either sign are one value
    even = F.transform(values, lambda x: x + F.lit(0.0))
    node = F.concat_ws("-", F.hex(F.xxhash64(space, even)), F.hex(F.xxhash64(even, space)))
    rows = vectors.select(vec_id, *keep, F.when(valid, node).alias("_node"), F.when(valid, space).alias("_space"), even.alias("_vector"))
    counted = rows.where("_node is not null").groupBy("_space", "_node").agg(
        F.count(F.lit(1)).alias("_copies"), F.min(vec_id).alias("_least"), F.first("_vector").alias("_vector"))
    nodes = materialize(counted, "nodes")
    sizes = nodes.groupBy("_space").agg(F.ceil(F.count(F.lit(1)) / F.lit(shard_rows)).alias("_shards"))
    sharded = nodes.join(sizes, "_space").withColumn("_shard", F.pmod(F.xxhash64("_node"), F.col("_shards")))
    graphs = sharded.select("_space", "_shard", "_node", "_copies", "_vector").groupBy("_space", "_shard").applyInPandas(
        _build, "_space string, _shard long, _graph binary")
    graphs = materialize(graphs, "graphs")
    one = graphs.select("_space", F.col("_shard").alias("_i"), F.col("_graph").alias("_one"))
    two = graphs.select("_space", F.col("_shard").alias("_j"), F.col("_graph").alias("_two"))
    # the shards of a label by one another: a label's rows over shard_rows, squared, not its rows
    met = one.join(two, "_space").where("_i <= _j").select(
        "_space", "_i", "_j", "_one", F.when(F.col("_i") != F.col("_j"), F.col("_two")).alias("_two"), (F.col("_i") == F.col("_j")).alias("_same"))
    found = met.groupBy("_space", "_i", "_j").applyInPandas(_link(least), "a string, b string, n long")
    found = materialize(found, "links")
    linked = found.groupBy(F.col("a").alias("_node")).agg(F.sum("n").alias("_n"))
    parts = components(found.select("a", "b")).select(F.col("node").alias("_node"), F.col("component").alias("_comp"))
    placed = nodes.select("_node", "_copies", "_least").join(parts, "_node", "left").join(linked, "_node", "left")
    placed = materialize(placed.withColumn("_comp", F.coalesce("_comp", "_node")), "placed")
    least_id = placed.groupBy("_comp").agg(F.min("_least").alias("_id"))
    result = rows.drop("_vector", "_space").join(placed.join(least_id, "_comp"), "_node", "left")
    component = F.coalesce("_id", F.col(vec_id))
    n_links = F.coalesce(F.coalesce("_n", F.lit(0)) + F.col("_copies") - 1, F.lit(0)).cast("long")
    return result.select(vec_id, *keep, n_links.alias("n_links"), component.alias("component_id"),
                         (F.col(vec_id) == component).alias("kept"))
