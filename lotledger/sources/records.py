"""Delimited records with line breaks inside quotes, read from any part of a file.

A line takes a reader that stands outside quotes, or inside them, to one of
the two states again. Such steps compose, so every block of a file is
summarized by where it leads from either state; a running composition over the
blocks of a file tells in which state each begins, and all blocks are then cut
into records side by side. Only the pieces of records that cross a block's end
meet in a shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import materialize

# Blocks that begin inside quotes whose hashes (8 bytes each) are broadcast; more are met by a shuffle.
BROADCAST_BLOCKS = 2_000_000
WHOLE, HEAD, MIDDLE, TAIL = "whole", "head", "middle", "tail"


def ends_inside(line: str, inside: bool, sep: str) -> bool:
    """Whether a cell in quotes is open after ``line``; ``inside`` says so of the place before it.

    Quotes are doubled inside quotes, and open a cell only at its beginning.
    """
    if '"' not in line:
        return inside
    at, opening = 0, sep + '"'
    while True:
        if not inside:
            if at or line[0] != '"':
                at = line.find(opening, max(at - len(sep), 0))
                if at < 0:
                    return False
                at += len(opening)
            else:
                at = 1
        close = line.find('"', at)
        while close >= 0 and line.startswith('"', close + 1):
            close = line.find('"', close + 2)
        if close < 0:
            return True
        # what stands between the closing quote and the separator belongs to the cell
        at, inside = line.find(sep, close + 1), False
        if at < 0:
            return False
        at += len(sep)


def _lines(spark: SparkSession, path: str, options: Mapping[str, str]) -> DataFrame:
    """(file, block, line) in the order of the scan; a block is what one task reads of a file."""
    texts = spark.read.options(**options).option("lineSep", "\n").text(path)
    return texts.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                        F.col("value").alias("line"))


def _of_files(spark: SparkSession, lines: DataFrame, path: str, options: Mapping[str, str], only: Column) -> DataFrame:
    """The lines, in their order, of files that meet ``only``, which is judged once per file."""
    listed = spark.read.format("binaryFile").options(**options).load(path).select(F.col("_metadata.file_path").alias("file"))
    chosen = materialize(listed.where(only).distinct(), "files")
    if chosen.count() > BROADCAST_BLOCKS:
        return lines.where(only)
    return lines.join(F.broadcast(chosen), "file", "left_semi")


def _rows(batch):
    """Rows of an Arrow batch without nulls, converted by column."""
    return zip(*(c.to_numpy(zero_copy_only=False).tolist() for c in batch.columns), strict=True)


def _steps(lines: DataFrame, sep: str) -> DataFrame:
    """One row per block: where it leads from ``outside`` and from ``inside``."""
    def run(batches):
        import pyarrow as pa

        def row(key, states):
            return pa.RecordBatch.from_arrays([pa.array([v]) for v in (*key, *states)], names=["file", "block", "outside", "inside"])

        last, states = None, (False, True)
        for batch in batches:
            for file, block, line in _rows(batch):
                if (file, block) != last:
                    if last:
                        yield row(last, states)
                    last, states = (file, block), (False, True)
                if '"' in line:
                    # where both states have met, they stay together
                    first = ends_inside(line, states[0], sep)
                    states = (first, first if states[0] == states[1] else ends_inside(line, states[1], sep))
        if last:
            yield row(last, states)

    return lines.mapInArrow(run, "file string, block long, outside boolean, inside boolean")


def _opened(steps: DataFrame) -> DataFrame:
    """Blocks that begin inside quotes, by the running composition of the steps before them.

    A step keeps the state, turns it, or forgets it; the state is what the last
    forgetting step left, turned as often as steps have turned it since.
    """
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    upto = before.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    forgets = F.col("outside") == F.col("inside")
    turns = (F.col("outside") & ~F.col("inside")).cast("int")
    counted = steps.withColumn("turned", F.sum(turns).over(upto))
    fixed = F.when(forgets, F.struct(F.col("outside").cast("int").alias("state"), "turned"))
    since = F.last(fixed, ignorenulls=True).over(before)
    turned = F.coalesce(F.lag("turned").over(Window.partitionBy("file").orderBy("block")), F.lit(0))
    state = F.coalesce(since["state"], F.lit(0)) + turned - F.coalesce(since["turned"], F.lit(0))
    return counted.withColumn("state", state % 2).where("state = 1").select("file", "block")


def _cut(lines: DataFrame, sep: str) -> DataFrame:
    """Records and pieces of records of every block; ``lines`` has a column ``open`` besides."""
    def run(batches):
        import pyarrow as pa

        schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("kind", pa.string()), ("first", pa.bool_()), ("record", pa.string())])
        last, inside, begun, held, first = None, False, False, [], False

        def table(made):
            columns = list(zip(*made, strict=True)) or [()] * len(schema)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)

        def rest():
            # what the block's end leaves open; nothing follows a file's last block
            return [(*last, TAIL if begun else MIDDLE, first, "\n".join(held))] if held else []

        for batch in batches:
            made = []
            for file, block, line, opened in _rows(batch):
                if (file, block) != last:
                    made += rest()
                    last, inside, begun, held, first = (file, block), opened, not opened, [], block == 0
                held.append(line)
                inside = ends_inside(line, inside, sep)
                if not inside:
                    made.append((file, block, WHOLE if begun else HEAD, first, "\n".join(held)))
                    begun, held, first = True, [], False
            yield table(made)
        yield table(rest())

    return lines.mapInArrow(run, "file string, block long, kind string, first boolean, record string")


def delimited_records(spark: SparkSession, path: str, sep: str = ";", options: Mapping[str, str] | None = None,
                      only: Column | None = None) -> DataFrame:
    """(file, first, record): every record of the files at ``path`` as text; ``first`` marks a file's first.

    ``only`` is a condition on ``file``, the path, that files must meet.

    Cells in quotes may hold line breaks and doubled quotes. A file is read by
    as many tasks as it has blocks. A quote that is never closed makes the rest
    of its file one record. Empty records are left out; a carriage return
    before the line break that ends a record is not part of it.
    """
    lines = _lines(spark, path, options or {})
    lines = lines if only is None else _of_files(spark, lines, path, options or {}, only)
    opened = materialize(_opened(_steps(lines, sep)), "opened")
    own = lines.withColumn("key", F.xxhash64("file", "block"))
    side = opened.select(F.xxhash64("file", "block").alias("key"), F.lit(True).alias("open"))
    if opened.count() <= BROADCAST_BLOCKS:
        marked = own.join(F.broadcast(side), "key", "left")  # keeps the order of the scan
    else:
        placed = own.withColumn("place", F.monotonically_increasing_id())
        marked = placed.join(side, "key", "left").repartition("file", "block").sortWithinPartitions("file", "block", "place")
    # read twice below, and by whoever reads the records twice
    cut = materialize(_cut(marked.select("file", "block", "line", F.coalesce("open", F.lit(False)).alias("open")), sep), "cut")

    whole = cut.where(F.col("kind") == WHOLE).select("file", "first", "record")
    # at most two pieces a block; a tail begins a record
    order = F.struct("block", (F.col("kind") == TAIL).alias("late"))
    number = F.sum((F.col("kind") == TAIL).cast("int")).over(Window.partitionBy("file").orderBy(order))
    pieces = cut.where(F.col("kind") != WHOLE).withColumn("number", number).withColumn("order", order)
    joined = pieces.groupBy("file", "number").agg(
        F.max("first").alias("first"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("order", "record"))), lambda p: p["record"]), "\n").alias("record"))
    records = whole.unionByName(joined.select("file", "first", "record"))
    return records.withColumn("record", F.regexp_replace("record", r"\r\z", "")).where(F.col("record") != "")


def cell_count(record: Column, sep: str = ";") -> Column:
    """Cells of a whole record; separators inside quotes don't count."""
    # without doubled quotes every cell in quotes ends at the next quote
    outside = F.regexp_replace(F.replace(record, F.lit('""'), F.lit("")), rf'(^|\Q{sep}\E)"[^"]*("|$)', "$1")
    return ((F.length(outside) - F.length(F.replace(outside, F.lit(sep), F.lit("")))) / len(sep)).cast("int") + 1


def parse_cells(records: DataFrame, names: Sequence[str], sep: str = ";") -> DataFrame:
    """The records of :func:`delimited_records` as string columns ``names``, with the file's path as ``_file``.

    Missing cells are NULL, cells beyond ``names`` are left out.
    """
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    cells = F.from_csv("record", schema, {"sep": sep, "quote": '"', "escape": '"', "multiLine": "true"})
    # a generator's row is made once, where a column would be parsed anew for every cell and condition
    return records.select(F.inline(F.array(cells)), F.col("file").alias("_file"))
