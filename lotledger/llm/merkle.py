"""Merkle manifest of a dataset: aligned builders, postorder logs, proofs by position."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize
from . import merkle_tasks as tasks
from .batches import bound
from .native import UPPER

# The columns of a leaf, in order.
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
# Rows that one task orders.
RANGE_ROWS = 1_000_000
RESULTS = ("leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
_PATH = "array<struct<before:string,after:string>>"


def leaf_digest(columns: Sequence[Column]) -> Column:
    """SHA-256 over the columns, each ``-`` if NULL, else its UTF-8 bytes, ``:`` and the value."""
    parts = []
    for c in columns:
        value = c.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _numbered(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """Adds ``_i`` (place in the group, from 0) and ``_n`` (rows of the group).

    Rows are dealt to ranges of (group, order), so a group of any size is
    ordered by many tasks; a place is that in the range plus the rows of
    earlier ranges, from one row per range and group.
    """
    ranges = max(1, -(-rows.count() // RANGE_ROWS), rows.sparkSession.sparkContext.defaultParallelism)
    ordered = rows.repartitionByRange(ranges, group, *order).sortWithinPartitions(group, *order)
    placed = materialize(ordered.withColumn("_place", F.monotonically_increasing_id()), "ordered")
    placed = placed.withColumn("_range", F.shiftright("_place", 33))
    starts = placed.groupBy(group, "_range").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    own = Window.partitionBy(group)
    earlier = F.coalesce(F.sum("_rows").over(own.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = starts.select(F.col(group).alias("_g"), F.col("_range").alias("_r"), (earlier - F.col("_first")).alias("_add"), F.sum("_rows").over(own).alias("_n"))
    joined = placed.join(starts, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_range") == F.col("_r")))
    return joined.withColumn("_i", F.col("_place") + F.col("_add")).drop("_g", "_r", "_add", "_range", "_place")


def _logs(leaves: DataFrame, group: str, carry: Sequence[str], height: int) -> DataFrame:
    """One row per builder: its leaves' carried columns in order and its postorder log."""
    held_leaves = tasks.ARITY ** height

    @F.pandas_udf("array<string>")
    def log(found, alone):
        return found.combine(alone, lambda digests, one: tasks.build(list(digests), bool(one), height))

    dealt = leaves.withColumn("_b", F.floor(F.col("_i") / held_leaves).cast("long"))
    rows = F.array_sort(F.collect_list(F.struct("_i", "_digest", *carry)))  # at most held_leaves of them
    held = dealt.groupBy(group, "_b").agg(F.max("_n").alias("_n"), rows.alias("_rows"))
    held = held.withColumn("_log", log(F.col("_rows._digest"), F.col("_n") <= held_leaves))
    return materialize(held.withColumn("_top", F.element_at("_log", -1)), "postorder")


def _prove(leaves: DataFrame, group: str, carry: Sequence[str], height: int) -> DataFrame:
    """Adds to every leaf (``group``, ``_i``, ``_n``, ``_digest``) the group's root and the siblings on its path.

    Builders of ``16 ** height`` consecutive leaves write their logs; their roots are the
    leaves of the next round, until every group has one. The paths then come
    down: siblings inside a builder are read from its log, those above it are
    shared by all its leaves. Returns one row per builder: ``group``, ``_b``,
    ``_root``, ``_rows``, ``_log``, ``_n`` and ``_above``.
    """
    logs = _logs(leaves, group, carry, height)
    if not logs.where(F.col("_b") > 0).limit(1).count():
        return logs.withColumnRenamed("_top", "_root").withColumn("_above", F.array().cast(_PATH))
    upper = logs.select(group, F.col("_b").alias("_i"), F.ceil(F.col("_n") / tasks.ARITY ** height).alias("_n"), F.col("_top").alias("_digest"))
    above = _paths(_prove(upper, group, (), height), group, ("_i",), height)
    above = above.select(F.col(group).alias("_g"), F.col("_i").alias("_j"), "_root", F.col("_path").alias("_above"))
    return logs.drop("_top").join(above, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_b") == F.col("_j"))).drop("_g", "_j")


def _paths(proved: DataFrame, group: str, carry: Sequence[str], height: int) -> DataFrame:
    """One row per leaf with its whole path."""
    @F.pandas_udf(f"array<{_PATH}>")
    def inside(log, size, alone):
        import pandas as pd

        return pd.Series([[[{"before": a, "after": b} for a, b in path] for path in tasks.paths(list(x), int(n), bool(one), height)]
                          for x, n, one in zip(log, size, alone, strict=True)])

    within = inside("_log", F.size("_rows"), F.col("_n") <= tasks.ARITY ** height)
    each = proved.select(group, "_root", "_above", F.explode(F.arrays_zip("_rows", within.alias("_within"))).alias("_z"))
    return each.select(group, "_root", *[F.col(f"_z._rows.{c}") for c in carry], F.concat("_z._within", "_above").alias("_path"))


def _folds(proved: DataFrame, above: str, carry: Sequence[str], height: int) -> DataFrame:
    """Per leaf: digest of all siblings, and the root folded from ``_told`` (the tampered, else the own digest)."""
    @F.pandas_udf("array<struct<proof:string,fold:string>>")
    def fold(log, told, alone, above):
        import pandas as pd

        out = []
        for x, leaves, one, shared in zip(log, told, alone, above, strict=True):
            shared = [(p["before"], p["after"]) for p in shared]
            tail = "".join(a + b for a, b in shared)
            rows = []
            for path, leaf in zip(tasks.paths(list(x), len(leaves), bool(one), height), leaves, strict=True):
                rows.append({"proof": tasks.digest_of("".join(a + b for a, b in path) + tail), "fold": tasks.folded(leaf, path + shared)})
            out.append(rows)
        return pd.Series(out)

    folds = fold("_log", "_rows._told", F.col("_n") <= tasks.ARITY ** height, above)
    each = proved.withColumn("_z", F.explode(F.arrays_zip("_rows", folds.alias("_fold"))))
    return each.select(*[f"_z._rows.{c}" for c in carry], F.col("_z._rows._digest").alias("leaf"), F.col("_root").alias("subroot"), "root",
                       F.col("_z._fold.proof").alias("proof_sha256"), F.col("_z._fold.fold").alias("folded_root"))


def postorder_log(docs: DataFrame, keep: Sequence[str] = ("doc_id",), columns: Sequence[str] = LEAF_COLUMNS, group: str = "source", key: str = "doc_id",
                  height: int = tasks.HEIGHT) -> DataFrame:
    """The append log of the lowest builders: ``group``, ``builder``, ``position`` (from 0) and ``digest``."""
    logs = _logs(_leaves(docs, keep, columns, group, key, None), "_source", ("_row",), height)
    return logs.select(F.col("_source").alias(group), F.col("_b").alias("builder"), F.posexplode("_log").alias("position", "digest"))


def _leaves(docs, keep, columns, group, key, tampered) -> DataFrame:
    bound(docs.sparkSession)  # a builder's row holds its whole log
    own = leaf_digest([F.col(c) for c in columns])
    told = F.lit(None).cast("string")
    if tampered is not None:
        condition, changes = tampered
        told = F.when(condition, leaf_digest([changes.get(c, F.col(c)) for c in columns]))
    rows = docs.select(F.struct(*keep).alias("_row"), F.col(group).alias("_source"), F.col(key).alias("_key"), own.alias("_digest"), told.alias("_told"))
    rows = rows.withColumn("_told", F.coalesce("_told", "_digest"))
    # no text from here on
    return _numbered(materialize(rows, "leaves"), "_source", ("_key", "_digest"))


def manifest(docs: DataFrame, keep: Sequence[str] = ("doc_id",), columns: Sequence[str] = LEAF_COLUMNS, group: str = "source",
             key: str = "doc_id", tampered: tuple[Column, dict[str, Column]] | None = None, height: int = tasks.HEIGHT) -> DataFrame:
    """Every row's leaf, its group's root, the dataset's root and a checked proof.

    A row is the SHA-256 of ``columns``. Per ``group``, leaves in order of
    ``key`` are hashed 16 at a time until one node remains, the subroot; the
    subroots in order of the group (NULL first, by UTF-8 bytes) give the root
    likewise. ``tampered`` (condition, changed columns) says which rows are
    presented altered: ``folded_root`` is what the presented leaf and the
    original siblings give, ``verified`` whether that is the root.
    ``proof_sha256`` is the digest of all siblings, level by level.

    Returns ``keep`` and the six result columns. NULLs are ``-`` in a leaf; a NULL
    group is a group, a NULL key comes first; ties of the key are ordered by
    the leaf's digest, so repeated rows have places of their own and equal
    digests. An empty table gives no rows. Long texts are hashed where they
    are read. ``keep`` must not hold a result name or one starting with ``_``.
    """
    if clash := set(RESULTS) & set(keep) | {c for c in keep if c.startswith("_")}:
        raise ValueError(f"kept columns clash with results: {sorted(clash)}")
    carry = ("_row", "_told")
    proved = _prove(_leaves(docs, keep, columns, group, key, tampered), "_source", carry, height)
    subroots = materialize(proved.select("_source", F.col("_root").alias("_digest")).distinct().withColumn("_all", F.lit(0)), "subroots")
    ordered = _numbered(subroots, "_all", ("_source",))
    top = _paths(_prove(ordered, "_all", ("_source",), height), "_all", ("_source",), height)
    top = materialize(top.select(F.col("_source").alias("_g"), F.col("_root").alias("root"), F.col("_path").alias("_on_top")), "top")
    joined = proved.join(top, F.col("_source").eqNullSafe(F.col("_g"))).withColumn("_shared", F.concat("_above", "_on_top"))
    out = _folds(joined, "_shared", carry, height)
    return out.select("_row.*", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def lowered(text: Column) -> Column:
    """``text`` with A-Z in lower case; NULL stays."""
    return F.translate(text, UPPER, UPPER.lower())
