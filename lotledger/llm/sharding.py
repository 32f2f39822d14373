"""Histogram sort: equal shards by refining splitters over exact byte counts."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize

# Probes per interval and round, and counts of a round; one aggregated row each reaches the driver.
PROBES, ROUND_COUNTS = 2048, 32_768
# A splitter is settled when the bytes below it are this close to its target.
TOLERANCE = 1e-4
# Rows that one task numbers.
SLICE_ROWS = 2_000_000
LOW, HIGH = -(1 << 63), 1 << 63  # keys are signed 64-bit numbers


def sort_key(text: Column, *tie: Column) -> Column:
    """40 bits of the text's hash, then 24 bits of the tie columns' hash.

    Equal texts share one key range, so they lie together; a group of copies
    larger than a shard can still be cut inside its range.
    """
    high = F.shiftleft(F.shiftright(F.xxhash64(F.coalesce(text, F.lit(""))), 24), 24)
    return high.bitwiseOR(F.shiftrightunsigned(F.xxhash64(*tie), 40))


def _numbers(values: Sequence[int]) -> Column:
    """An array constant; as one text it stays one expression, however long."""
    return F.from_json(F.lit(json.dumps(list(values))), "array<bigint>")


def _lookup(key: Column, splitters: Sequence[int]) -> Column:
    """Number of splitters at or below ``key``, by binary search in one array."""
    if not splitters:
        return F.lit(0)
    table, ends = _numbers(splitters), (F.lit(0), F.lit(len(splitters)))
    bounds = lambda low, high: F.struct(low.cast("int").alias("low"), high.cast("int").alias("high"))

    def halve(at, _):
        middle = F.floor((at["low"] + at["high"]) / 2).cast("int")
        open_, right = at["low"] < at["high"], F.get(table, middle) <= key
        return bounds(F.when(open_ & right, middle + 1).otherwise(at["low"]), F.when(open_ & ~right, middle).otherwise(at["high"]))

    steps = F.array_repeat(F.lit(0), len(splitters).bit_length())
    return F.aggregate(steps, bounds(*ends), halve)["low"]


def _counts(table: DataFrame, intervals: list[tuple[int, int]], probes: int) -> dict:
    """Exact bytes per probe step inside each of some disjoint, ordered intervals."""
    if not intervals:
        return {}
    key, exact = F.col("_key"), lambda c: c.cast("decimal(20,0)")
    rows = table.select("size", "_key", (_lookup(key, [low for low, _ in intervals]) - 1).alias("i")).where("i >= 0")
    low, last, step = (_numbers(v) for v in zip(*[(low, high - 1, -(-(high - low) // probes)) for low, high in intervals], strict=True))
    rows = rows.where(key <= F.get(last, F.col("i")))
    # a distance may not fit in 64 signed bits
    place = F.floor((exact(key) - exact(F.get(low, F.col("i")))) / exact(F.get(step, F.col("i")))).cast("long")
    counted = rows.groupBy("i", place.alias("j")).agg(F.sum("size").alias("bytes")).collect()
    found: dict = {}
    for r in counted:
        found.setdefault(r["i"], {})[r["j"]] = r["bytes"]
    return found


def find_splitters(table: DataFrame, targets: Sequence[int], slack: int, probes: int = PROBES) -> list[int]:
    """Keys below which the bytes are nearest to each target.

    ``table`` has ``_key`` and ``size``. Every round counts exact bytes per
    probe step inside the open intervals (each round narrows one ``probes``
    times), until a step's edge is within ``slack`` bytes of the target or the
    interval is a single key, which cannot be cut. A round brings at most
    ``ROUND_COUNTS`` counts to the driver, however many targets are open.
    """
    # target index -> (low, high, bytes below low)
    open_ = {i: (LOW, HIGH, 0) for i in range(len(targets))}
    done: dict[int, int] = {}
    while open_:
        intervals = sorted({(low, high) for low, high, _ in open_.values()})
        steps = max(2, min(probes, ROUND_COUNTS // len(intervals)))
        counts = _counts(table, intervals, steps)
        number = {interval: i for i, interval in enumerate(intervals)}
        for i, (low, high, below) in list(open_.items()):
            step = -(-(high - low) // steps)
            held = counts.get(number[low, high], {})
            at = low
            for j in sorted(held):
                edge, after = min(low + (j + 1) * step, high), below + held[j]
                start = low + j * step
                if after >= targets[i]:
                    # the target falls inside step j
                    if abs(after - targets[i]) <= slack or abs(below - targets[i]) <= slack or step == 1:
                        done[i] = edge if abs(after - targets[i]) <= abs(below - targets[i]) else start
                    else:
                        open_[i] = (start, edge, below)
                    break
                below, at = after, edge
            else:
                done[i] = min(at, HIGH - 1)
            if i in done:
                del open_[i]
    return [min(done[i], HIGH - 1) for i in range(len(targets))]


def shard(docs: DataFrame, shards: int = 8, text: str = "text", carry: Sequence[str] = ("doc_id",),
          tolerance: float = TOLERANCE, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Every row with its shard (near-equal bytes) and its place in the shard.

    Returns ``carry`` plus ``size`` (UTF-8 bytes + 1), ``text_crc32``, ``shard``
    and ``slot``. Rows are in key order: equal texts lie side by side and part
    only where a shard ends. One table without the text is written; the rounds
    read that and find the splitters of the shards, ``shards - 1`` numbers. One
    exchange then deals rows to ranges of (shard, key) of about ``slice_rows``;
    a row's slot is its place in its range plus the rows of the shard's earlier
    ranges, from a table with one row per range and shard.

    NULL texts count as empty (size 1). Repeated rows are told apart by their
    position in the scan. An empty table gives no rows. Names starting with
    ``_`` and the result names must not be among ``carry``.
    """
    if clash := {"size", "text_crc32", "shard", "slot"} & set(carry):
        raise ValueError(f"carried columns clash with results: {sorted(clash)}")
    filled = F.coalesce(F.col(text), F.lit(""))
    rid = F.monotonically_increasing_id()
    table = docs.select(
        *carry, (F.octet_length(filled) + 1).cast("long").alias("size"), F.crc32(filled.cast("binary")).alias("text_crc32"),
        filled.alias("_text"), rid.alias("_rid"),
    )
    table = table.select(*carry, "size", "text_crc32", "_rid", sort_key(F.col("_text"), F.col("_rid")).alias("_key"))
    table = materialize(table, "shard-keys")
    total, rows = table.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    slack = max(1, int(tolerance * total / shards))
    splitters = find_splitters(table, [total * i // shards for i in range(1, shards)], slack) if rows else []
    dealt = table.withColumn("shard", _lookup(F.col("_key"), sorted(splitters)))
    ranges = max(docs.sparkSession.sparkContext.defaultParallelism, -(-rows // slice_rows))
    order = ("shard", "_key", "_rid")
    ordered = dealt.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id())
    ordered = materialize(ordered, "shard-rows").withColumn("_range", F.shiftright("_place", 33))
    starts = ordered.groupBy("shard", "_range").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy("shard").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select("shard", "_range", (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_add"))
    return ordered.join(starts, ["shard", "_range"]).select(
        *carry, "size", "text_crc32", F.col("shard").cast("int").alias("shard"), (F.col("_place") + F.col("_add")).alias("slot"))
