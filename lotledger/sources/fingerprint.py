"""Dataset versions, file digests and corpus signatures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def table_fingerprint(df: DataFrame, columns: Sequence[Column] | None = None, hasher: str = "xxhash64",
                      stem: str | None = None, digits: int = 12) -> DataFrame:
    """One row: row count, order-insensitive digest and version label.

    Row hashes are summed, so the result ignores row order and partitioning
    and combines map-side; duplicate rows count. ``md5`` is the portable variant.
    """
    cols = list(columns) if columns else [F.col(f"`{c}`") for c in df.columns]
    if hasher == "md5":
        text = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("\\N")) for c in cols])
        row_hash = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("decimal(38,0)")
    else:
        # Hashing skips NULLs, so their positions are hashed as well.
        nulls = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in cols])
        row_hash = F.xxhash64(*cols, nulls).cast("decimal(38,0)")
    total = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(row_hash), F.lit(0).cast("decimal(38,0)")).cast("string").alias("_sum"),
    )
    digest = F.sha2(F.concat_ws(":", F.col("rows").cast("string"), F.col("_sum")), 256)
    label = F.substring(digest, 1, digits)
    version = F.concat(F.lit(f"{stem}_"), label) if stem else label
    return total.select("rows", digest.alias("digest"), version.alias("version"))


def file_digests(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """SHA-256 of every file (files must fit a binary cell, i.e. below 2 GB)."""
    files = spark.read.format("binaryFile").options(recursiveFileLookup="true", pathGlobFilter=glob).load(path)
    return files.select("path", "length", F.sha2("content", 256).alias("sha256"))


def corpus_signature(spark: SparkSession, root: str, glob: str = "*.{md,txt}", groups: int = 4096) -> DataFrame:
    """One row: SHA-256 over (path, size, mtime) of the matching files, or ``missing``.

    Only file metadata is read. Files are digested in path order inside hash
    groups and the group digests in group order, so no task sees all paths.
    """
    files = (
        spark.read.format("binaryFile").options(recursiveFileLookup="true", pathGlobFilter=glob).load(root)
        .select("path", "length", "modificationTime")
    )
    relative = F.substring_index("path", root.rstrip("/") + "/", -1)
    entry = F.concat_ws(":", relative, F.col("length").cast("string"), F.unix_micros("modificationTime").cast("string"))
    grouped = files.groupBy(F.pmod(F.xxhash64(relative), F.lit(groups)).alias("g")).agg(
        F.sha2(F.array_join(F.array_sort(F.collect_list(entry)), "\n"), 256).alias("d"), F.count(F.lit(1)).alias("n")
    )
    labelled = F.concat_ws(":", F.lpad(F.col("g").cast("string"), 5, "0"), "d")
    digest = F.sha2(F.array_join(F.array_sort(F.collect_list(labelled)), "\n"), 256)
    return grouped.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("files"), digest.alias("_d")).select(
        "files", F.when(F.col("files") == 0, F.lit("missing")).otherwise(F.col("_d")).alias("signature")
    )
