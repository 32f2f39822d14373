"""Chunking, hashed bag-of-words vectors and top-k retrieval over a document table."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.text import strip
from ..session import bound_batches, materialize
from .retrieval_tasks import BUCKETS, CHUNK_OVERLAP, CHUNK_SIZE, chunker, scorer, tally
from .scale import sized_join

TOP_K = 3
# Fixed value: the marker of this vector scheme.
INDEX_MARKER = "embedding_backend=md5_hash_256"
# Queries and items that meet in one task; bounds its memory.
QUERY_BLOCK, ITEM_SLICE = 4096, 16_384


def chunk_documents(docs: DataFrame, order: str, content: str = "content", size: int = CHUNK_SIZE,
                    overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """Chunks with a ``chunk_index`` running over the whole corpus in ``order``.

    ``order`` is a unique numeric document key. Documents are dealt out once,
    by ranges of it; a task splits its documents in order and numbers its
    chunks, and the chunk counts of the tasks before it are added to that. A
    task holds one bounded batch of documents at a time.
    """
    bound_batches(docs.sparkSession)
    keep = [c for c in docs.columns if c != content]
    ordered = docs.repartitionByRange(F.col(order)).sortWithinPartitions(order).select(*keep, F.col(content).alias("content"))
    schema = docs.select(*keep).schema.add("_part", "integer").add("_local", "long").add("content", "string")
    chunks = materialize(ordered.mapInPandas(chunker(size, overlap), schema), "chunks")
    # one row per task
    ends = chunks.groupBy("_part").agg((F.max("_local") + 1).alias("n"))
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = ends.select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    numbered = chunks.join(F.broadcast(bases), "_part")
    return numbered.select(*keep, (F.col("_base") + F.col("_local")).alias("chunk_index"), "content")


def tokens(text: Column) -> Column:
    """Lower-case words of two or more word characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"(?U)\b\w\w+\b"), 0)


def token_bucket(token: Column, buckets: int = BUCKETS) -> Column:
    return (F.conv(F.substring(F.md5(token), 1, 8), 16, 10).cast("long") % buckets).cast("int")


VECTOR_TYPE = "struct<buckets:array<int>,counts:array<int>>"


def with_vector(df: DataFrame, text: str = "content") -> DataFrame:
    """Add ``vector``: the sparse word counts over hash buckets (never negative)."""
    bound_batches(df.sparkSession)
    hashed = F.transform(F.coalesce(tokens(F.col(text)), F.array().cast("array<string>")), lambda t: token_bucket(t))
    return df.withColumn("vector", F.pandas_udf(tally, VECTOR_TYPE)(hashed))


def dense_embedding(vector: Column, buckets: int = BUCKETS) -> Column:
    """Unit-length dense vector of a sparse one (all zeros for an empty text)."""
    norm = F.sqrt(F.aggregate(vector["counts"], F.lit(0).cast("long"), lambda s, c: s + c * c))
    weights = F.map_from_arrays(vector["buckets"], vector["counts"])
    return F.transform(
        F.sequence(F.lit(0), F.lit(buckets - 1)),
        lambda b: F.coalesce(F.try_divide(F.try_element_at(weights, b).cast("double"), norm), F.lit(0.0)),
    )


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity of two dense vectors; 0 when either has no length."""
    def dot(x: Column, y: Column) -> Column:
        products = F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double"))
        return F.aggregate(products, F.lit(0.0), lambda s, p: s + p)

    lengths = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(lengths == 0, F.lit(0.0)).otherwise(F.try_divide(dot(a, b), lengths))


def top_k(queries: DataFrame, items: DataFrame, k: int = TOP_K, query: str = "query_id", item: str = "chunk_index",
          block_rows: int = QUERY_BLOCK, slice_rows: int = ITEM_SLICE) -> DataFrame:
    """(query, item, score, rank): best ``k`` items per query by cosine.

    ``query`` and ``item`` are whole-number ids; both sides carry ``vector``.
    Queries are dealt into blocks and items into slices by hash, and every
    block meets every slice under a (block, slice) key: one plan, in which a
    task holds one block and one slice and hands on ``k`` items per query.
    Neither pairs nor a query's candidates are gathered, and no row passes
    through the driver. Equal scores rank by item id; items scoring zero
    remain eligible.
    """
    asked = materialize(queries.select(F.col(query).cast("long").alias("query_id"), "vector"), "queries")
    table = items.select(F.col(item).cast("long").alias(item), "vector")
    blocks, slices = (max(1, -(-side.count() // rows)) for side, rows in ((asked, block_rows), (table, slice_rows)))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    own = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("long")
    left = table.withColumn("_slice", own(item, slices)).withColumn("_block", every(blocks))
    right = asked.withColumn("_block", own("query_id", blocks)).withColumn("_slice", every(slices))
    met = left.groupBy("_block", "_slice").cogroup(right.groupBy("_block", "_slice"))
    found = met.applyInPandas(scorer(item, k), f"query_id long, {item} long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), item))
    ranked = found.withColumn("rank", rank).where(F.col("rank") <= k)
    return ranked.withColumnRenamed("query_id", query) if query != "query_id" else ranked


def build_index(chunks: DataFrame, path: str, signature: str) -> int:
    """Store a new version of the index; returns its chunk count (0 chunks is an error).

    Chunks go to a folder of their own and a pointer row (marker, source
    signature, folder) is appended last: a failed build leaves the index as it was.
    """
    spark = chunks.sparkSession
    version = f"{path}/version-{uuid.uuid4().hex}"
    with_vector(chunks.select("chunk_index", "source", "content")).write.mode("errorifexists").parquet(version)
    n = spark.read.parquet(version).count()
    if n == 0:
        raise ValueError("no document to index")
    row = [(time.time_ns(), INDEX_MARKER, signature, n, version)]
    spark.createDataFrame(row, "at long, marker string, signature string, chunks long, version string").coalesce(
        1).write.mode("append").parquet(f"{path}/pointers")
    return n


def _newest(spark: SparkSession, path: str):
    from pyspark.errors import AnalysisException

    try:
        return spark.read.parquet(f"{path}/pointers").orderBy(F.desc("at")).first()
    except AnalysisException:
        return None


def index_is_fresh(spark: SparkSession, path: str, signature: str) -> bool:
    """Whether the newest stored index was built by this scheme from these sources."""
    row = _newest(spark, path)
    return row is not None and row["marker"] == INDEX_MARKER and row["signature"] == signature


def load_index(spark: SparkSession, path: str) -> DataFrame:
    """The newest stored index; an error when there is none."""
    row = _newest(spark, path)
    if row is None:
        raise ValueError(f"no index under {path}")
    return spark.read.parquet(row["version"])


def ensure_index(spark: SparkSession, path: str, signature: str, chunks: DataFrame) -> DataFrame:
    """The stored index, rebuilt first when it is missing or stale."""
    if not index_is_fresh(spark, path, signature):
        build_index(chunks, path, signature)
    return load_index(spark, path)


def retrieve(questions: DataFrame, index: DataFrame, k: int = TOP_K, question: str = "question",
             query: str = "query_id") -> DataFrame:
    """Ranked chunks of every non-blank question."""
    asked = questions.select(query, strip(F.coalesce(F.col(question), F.lit(""))).alias("_q")).where(F.col("_q") != "")
    best = top_k(with_vector(asked, "_q"), index, k, query)
    return sized_join(index.select("chunk_index", "source", "content"), best, ["chunk_index"])


def context_pack(questions: DataFrame, index: DataFrame, k: int = TOP_K, max_chars: int = CHUNK_SIZE,
                 question: str = "question", query: str = "query_id") -> DataFrame:
    """Per question: status, packed context, prompt context, ordered sources, chunk count."""
    ranked = retrieve(questions, index, k, question, query)
    entry = F.struct("rank", F.coalesce("source", F.lit("unknown")).alias("source"),
                     F.substring("content", 1, max_chars).alias("content"))
    packed = ranked.groupBy(query).agg(F.array_sort(F.collect_list(entry)).alias("_c"))  # k entries per question
    c = F.col("_c")
    joined = questions.join(packed.withColumnRenamed(query, "_q"), F.col(query) == F.col("_q"), "left").drop("_q")
    blank = strip(F.coalesce(F.col(question), F.lit(""))) == ""
    status = F.when(blank, "empty_query").when(c.isNull(), "no_context").otherwise("success")
    quoted = F.transform(c, lambda x: F.concat(F.lit("Fonte: "), x["source"], F.lit("\nTrecho:\n"), x["content"]))
    return joined.select(
        *questions.columns, status.alias("status"),
        F.coalesce(F.array_join(F.transform(c, lambda x: x["content"]), "\n\n"), F.lit("")).alias("context"),
        F.coalesce(F.array_join(quoted, "\n\n"), F.lit("")).alias("prompt_context"),
        F.coalesce(F.array_distinct(F.transform(c, lambda x: x["source"])), F.array().cast("array<string>")).alias("sources"),
        F.coalesce(F.size(c), F.lit(0)).alias("chunks_retrieved"),
    )
