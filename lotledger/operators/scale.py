"""Building blocks that keep exact results without gathering a group in one task.

A single key may hold a third of all rows. ``percentile`` keeps every distinct
value of its group in one task, and an ordered window sorts its whole
partition there; both are used here only on groups whose size was checked.
Larger groups go through :func:`cumulative_sums`, which ranks distinct values
inside value ranges and adds the totals of the lower ranges.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize

# Largest group handed to `percentile` or to one ordered window.
HOT_GROUP_ROWS = 2_000_000
# Rows of a value range, which is what one task sorts, and ranges per group at least.
RANGE_ROWS, RANGES = 1_000_000, 16
# Cut points per step of the search for one key.
PROBES = 256
# Bytes (as JSON text) up to which a side is broadcast.
BROADCAST_BYTES = 32 << 20
# Copies of the small side (and slices of each key of the large side) beyond that.
JOIN_SLICES = 16


def sized_join(large: DataFrame, small: DataFrame, on: Sequence[str], how: str = "inner",
               broadcast_bytes: int = BROADCAST_BYTES, slices: int = JOIN_SLICES) -> DataFrame:
    """Join a fact side to a smaller side, hot keys included.

    ``small`` is written once so its size is known before the plan is fixed:
    up to ``broadcast_bytes`` it is broadcast; beyond that every key of the
    large side is cut into slices by a hash of the row, and the small side is
    repeated per slice. Rows of ``small`` multiply as in any join; NULL keys match.
    """
    small = materialize(small, "side")
    keys = list(on)
    renamed = small.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    match = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    held = small.agg(F.coalesce(F.sum(F.length(F.to_json(F.struct(*small.columns)))), F.lit(0))).first()[0]
    if held <= broadcast_bytes:
        return large.join(F.broadcast(renamed), match, how).drop(*[f"_r_{k}" for k in keys])
    sliced = large.withColumn("_slice", F.pmod(F.xxhash64(*large.columns), F.lit(slices)))
    repeated = renamed.withColumn("_r_slice", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))))
    match.append(F.col("_slice") == F.col("_r_slice"))
    return sliced.join(repeated, match, how).drop("_slice", "_r_slice", *[f"_r_{k}" for k in keys])


def row_hashes(df: DataFrame, columns: Sequence[str] | None = None) -> list[Column]:
    """Two 64-bit hashes that together identify a full row.

    Hashing skips NULLs, so the positions of NULLs are hashed as well.
    """
    cols = [F.col(f"`{c}`") for c in (columns or df.columns)]
    nulls = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in cols])
    return [F.xxhash64(*cols, nulls), F.xxhash64(F.lit("second"), nulls, *cols)]


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    """Rows of the largest group (one row reaches the driver)."""
    if not keys:
        return df.count()
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return sizes.agg(F.max("_n")).first()[0] or 0


def cumulative_sums(counts: DataFrame, keys: Sequence[str], order: str, sums: Sequence[str],
                    ranges: int | None = None) -> DataFrame:
    """Running totals per group in ``order``, plus the next larger value.

    ``counts`` holds one row per (keys, order). Adds ``cum_<c>`` (inclusive)
    and ``total_<c>`` for every column in ``sums``, and ``next_<order>``.
    Each group is cut into ``ranges`` value ranges at approximate quantiles (by
    default as many as keep a range of the largest possible group at
    ``RANGE_ROWS``): tasks sort one range, and the table of range totals (at
    most ``ranges`` rows per group) supplies the offset. The cut points affect
    balance only.
    """
    keys = list(keys)
    # Read three times below; what produces the counts runs once.
    counts = materialize(counts, "counts")
    if ranges is None:
        ranges = max(RANGES, -(-counts.count() // RANGE_ROWS))
    points = [i / ranges for i in range(1, ranges)]
    cuts = F.percentile_approx(order, points, 4 * ranges).alias("_cuts")
    if keys:
        splits = counts.groupBy(*keys).agg(cuts)
        ranged = sized_join(counts, splits, keys)
        cut_list = F.col("_cuts")
    else:
        found = counts.agg(cuts).first()[0] or []
        ranged = counts
        cut_list = F.array(*[F.lit(x) for x in found]) if found else F.array().cast("array<double>")
    value = F.col(order)
    ranged = ranged.withColumn("_range", F.size(F.filter(cut_list, lambda c: c < value))).drop("_cuts")

    totals = ranged.groupBy(*keys, "_range").agg(
        F.min(order).alias("_first"), *[F.sum(c).alias(f"_sum_{c}") for c in sums]
    )
    # At most `ranges` rows per group, so one window partition stays small.
    whole = Window.partitionBy(*[F.col(k) for k in keys]) if keys else Window.partitionBy(F.lit(0))
    by_range = whole.orderBy("_range")
    before = by_range.rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        *keys, "_range",
        F.lead("_first").over(by_range).alias("_next_first"),
        *[F.coalesce(F.sum(f"_sum_{c}").over(before), F.lit(0)).alias(f"_before_{c}") for c in sums],
        *[F.sum(f"_sum_{c}").over(whole).alias(f"total_{c}") for c in sums],
    )
    joined = sized_join(ranged, totals, [*keys, "_range"])

    inside = Window.partitionBy(*keys, "_range").orderBy(order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return joined.select(
        *counts.columns,
        *[(F.col(f"_before_{c}") + F.sum(c).over(upto)).alias(f"cum_{c}") for c in sums],
        *[f"total_{c}" for c in sums],
        F.coalesce(F.lead(order).over(inside), F.col("_next_first")).alias(f"next_{order}"),
    )


def _ranked_percentiles(df: DataFrame, keys: list[str], column: str,
                        wanted: Mapping[str, float]) -> DataFrame:
    """Exact linear percentiles of one column, by rank over distinct values."""
    counts = (
        df.where(F.col(column).isNotNull())
        .groupBy(*keys, F.col(column).cast("double").alias("_v"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ranked = cumulative_sums(counts, keys, "_v", ["n"])
    aggs = []
    for alias, p in wanted.items():
        position = (F.col("total_n") - 1) * F.lit(float(p))
        low, high = F.floor(position), F.ceil(position)

        def at(rank: Column) -> Column:
            return F.max(F.when((F.col("cum_n") > rank) & (F.col("cum_n") - F.col("n") <= rank), F.col("_v")))

        fraction = F.max(position - low)
        aggs.append((at(low) + (at(high) - at(low)) * fraction).alias(alias))
    return ranked.groupBy(*keys).agg(*aggs)


def group_stats(df: DataFrame, keys: Sequence[str], aggs: Sequence[Column] = (),
                percentiles: Mapping[str, tuple[str, float]] | None = None,
                hot_rows: int = HOT_GROUP_ROWS, largest: int | None = None) -> DataFrame:
    """Aggregates plus exact linear percentiles per group.

    ``percentiles`` maps an output name to (numeric column, probability). One
    aggregation does everything unless a group exceeds ``hot_rows``; the
    percentiles of such groups are then found by rank. ``largest`` passes the
    largest group's size where the caller knows it, saving the counting pass.
    """
    keys, percentiles = list(keys), dict(percentiles or {})
    by_column: dict[str, dict[str, float]] = {}
    for alias, (column, p) in percentiles.items():
        by_column.setdefault(column, {})[alias] = p
    # one map of values per column, however many percentiles it gives
    exact = [F.percentile(F.col(c).cast("double"), F.array(*[F.lit(float(p)) for p in wanted.values()])).alias(f"_p{i}")
             for i, (c, wanted) in enumerate(by_column.items())]
    place = {a: F.get(f"_p{i}", F.lit(j)).alias(a) for i, wanted in enumerate(by_column.values()) for j, a in enumerate(wanted)}
    picked = [place[a] for a in percentiles]
    if percentiles and largest is None:
        largest = largest_group(df, keys)
    if not percentiles or largest <= hot_rows:
        found = df.groupBy(*keys).agg(*aggs, *exact)
        hidden = {f"_p{i}" for i in range(len(by_column))}
        return found.select(*[c for c in found.columns if c not in hidden], *picked) if percentiles else found

    base = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), *aggs)
    if not keys:
        out = base.drop("_rows")
        for column, wanted in by_column.items():
            # one row on each side
            out = out.crossJoin(F.broadcast(_ranked_percentiles(df, [], column, wanted)))
        return out

    base = materialize(base, "groups")
    hot = base.where(F.col("_rows") > hot_rows).select(*keys, F.lit(True).alias("_hot"))
    marked = sized_join(df, hot, keys, "left")
    cold_side = marked.where(F.col("_hot").isNull()).groupBy(*keys).agg(*exact).select(*keys, *picked)
    hot_side = hot.select(*keys)  # a group without values of a column keeps its other percentiles
    for column, wanted in by_column.items():
        hot_side = _null_safe_join(hot_side, _ranked_percentiles(marked.where(F.col("_hot")), keys, column, wanted), keys)
    found = cold_side.unionByName(hot_side.select(*cold_side.columns))
    names = [c for c in base.columns if c != "_rows"]
    return _null_safe_join(base, found, keys).select(*names, *percentiles)


def _null_safe_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    right = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    match = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(right, match, "left").drop(*[f"_r_{k}" for k in keys])


def scalar_stats(df: DataFrame, aggs: Sequence[Column] = (),
                 percentiles: Mapping[str, tuple[str, float]] | None = None,
                 hot_rows: int = HOT_GROUP_ROWS) -> dict:
    """One-row statistics brought to the driver, to be used as literals."""
    return group_stats(df, [], aggs, percentiles, hot_rows).first().asDict()


def kth_key(df: DataFrame, key: str, k: int, hot_rows: int = HOT_GROUP_ROWS) -> object:
    """The ``k``-th smallest (1-based) value of a unique numeric key.

    Narrows the key range at approximate quantiles, one counting pass per
    step, until what is left is small enough to sort in one task.
    """
    rest, remaining = df.select(key), k
    size = rest.count()
    if not 1 <= k <= size:
        raise ValueError(f"k={k} outside 1..{size}")
    while size > hot_rows:
        points = [i / PROBES for i in range(1, PROBES)]
        cuts = sorted(set(rest.agg(F.percentile_approx(key, points, 4 * PROBES)).first()[0]))
        where = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c < F.col(key)))
        tally = dict(rest.groupBy(where.alias("r")).count().collect())  # at most PROBES rows
        chosen = 0
        for chosen in sorted(tally):
            if remaining <= tally[chosen]:
                break
            remaining -= tally[chosen]
        if tally[chosen] == size:
            raise ValueError(f"{key} is not unique enough to order by")
        if chosen > 0:
            rest = rest.where(F.col(key) > cuts[chosen - 1])
        if chosen < len(cuts):
            rest = rest.where(F.col(key) <= cuts[chosen])
        size = tally[chosen]
    rank = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(key))
    return rest.withColumn("_rank", rank).where(F.col("_rank") == remaining).first()[0]


def linear_edges(low: float, high: float, bins: int) -> list[float]:
    """``bins + 1`` equally spaced edges, the last one exact."""
    step = (high - low) / bins
    return [low + step * i for i in range(bins)] + [high]


def right_closed_bin(value: Column, edges: Sequence[float]) -> Column:
    """Index of the ``(edge[i], edge[i+1]]`` interval holding ``value``; the
    first interval takes anything at or below ``edge[1]``.

    The arithmetic guess is corrected against the edges themselves, so
    rounding in the division cannot move a value across an edge.
    """
    low, high, bins = edges[0], edges[-1], len(edges) - 1
    width = (high - low) / bins
    table = F.array(*[F.lit(float(e)) for e in edges])
    guess = F.least(F.greatest(F.ceil((value - F.lit(low)) / F.lit(width)).cast("int") - 1, F.lit(0)), F.lit(bins - 1))
    below = (guess > 0) & (value <= F.element_at(table, guess + 1))
    above = (guess < bins - 1) & (value > F.element_at(table, guess + 2))
    return F.when(below, guess - 1).when(above, guess + 1).otherwise(guess)


def whole_rows(n: int, share: float) -> int:
    """Rows in a share of a table: truncated, at least one."""
    return max(1, int(math.floor(n * share)))
