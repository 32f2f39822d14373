"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, types as T

# Settings the operators are written for. Adaptive execution coalesces small
# shuffle partitions, turns a join whose measured side is small into a
# broadcast join, and splits skewed join partitions.
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(builder, **overrides: str):
    """Apply :data:`ENGINE_CONF` (and overrides) to a session builder."""
    for key, value in {**ENGINE_CONF, **overrides}.items():
        builder = builder.config(key, value)
    return builder


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``.

    In local mode a temporary folder is made where none is named; on a cluster
    a machine's own folder would be lost with it, so there it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[[^\]]*\])?$", spark.sparkContext.master):  # local-cluster is a cluster
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="lotledger-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; never reused, so retries and
    concurrent jobs cannot meet each other's files."""
    return f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex}"


# Rows and bytes per Arrow batch: texts are long, and a batch stands in memory several times.
BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20


def bound_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to what executors of a few GB hold with long texts.

    The settings are read when a job runs, so they stay; they bound memory and
    change no result. A session that has smaller batches keeps them.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


@contextmanager
def byte_bound_batches(spark: SparkSession, held: int) -> Iterator[None]:
    """Arrow batches of at most ``held`` bytes (and one row at least) in the jobs that run inside."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(held))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def local_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """The driver's few rows as a table of its plan.

    They go through Arrow: a list given to ``createDataFrame`` is turned into
    rows by Python workers, which then stand on the executors beside others.
    """
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    kinds = to_arrow_schema(schema)
    columns = [pa.array([row[i] for row in rows], kind.type) for i, kind in enumerate(kinds)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=kinds), schema)


def materialize(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage in a way that survives lost executors, and makes a result
    that two branches read identical for both. ``options`` are the writer's.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("errorifexists").options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
