"""Chunking, vectors and retrieval over documents and benchmark questions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import retrieval
from ..session import scratch_path
from ..sources import fingerprint
from .registry import query, spread, table

_WORD = "[\\p{L}\\p{N}_]{2,}"


def _documents(spark, sf):
    return spread(table(spark, sf, "documents"), "doc_id").select("doc_id", "source", F.col("text").alias("content"))


def _as_index(spark, sf):
    """Whole documents as index entries, so that SQL can repeat the search."""
    rows = _documents(spark, sf).withColumnRenamed("doc_id", "chunk_index")
    return retrieval.with_vector(rows)


def _questions(spark, sf):
    return table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("question"))


# Neighbouring chunks whose words are counted in one row.
_RUN = 1024


def _distinct_words(chunks):
    """(doc_id, words): distinct words of every document.

    A document's chunks have neighbouring numbers, so nearly all documents lie in
    one run of numbers and are counted in a row of bounded length; the words of
    the others meet in a shuffle. No chunk is blank.
    """
    run = F.floor(F.col("chunk_index") / _RUN)
    split = lambda text: F.split(text, "[ \n]+")
    whole = chunks.groupBy("doc_id", run.alias("run")).agg(F.array_join(F.collect_list("content"), "\n").alias("text"))
    counts = whole.select("doc_id", "run", F.size(F.array_remove(F.array_distinct(split(F.col("text"))), "")).cast("long").alias("words"))
    runs = chunks.groupBy("doc_id").agg(F.min(run).alias("run"), F.max(run).alias("last"))
    within = counts.join(runs.where("run = last").drop("last"), ["doc_id", "run"]).select("doc_id", "words")
    across = chunks.join(runs.where("run < last"), "doc_id", "left_semi")
    words = across.select("doc_id", F.explode(split(F.col("content"))).alias("w")).where("w <> ''")
    return within.unionByName(words.groupBy("doc_id").agg(F.count_distinct("w").alias("words")))


@query("h1_chunk_documents", """
WITH w AS (SELECT doc_id, text, unnest(string_split_regex(text, '[ \\n]+')) AS w FROM documents)
SELECT doc_id, count(DISTINCT w) AS words, TRUE AS within_size, length(max(text)) <= 500 AS one_chunk FROM w WHERE w <> '' GROUP BY doc_id
""")
def _(spark, sf):
    # Invariants of the chunks: every word kept, size respected, short texts whole.
    chunks = retrieval.chunk_documents(_documents(spark, sf), "doc_id")
    return _distinct_words(chunks).join(chunks.groupBy("doc_id").agg(
        (F.max(F.length("content")) <= 500).alias("within_size"), (F.count(F.lit(1)) == 1).alias("one_chunk")), "doc_id")


@query("h1_chunk_numbering", "SELECT count(*) AS documents, TRUE AS contiguous, TRUE AS in_document_order FROM documents")
def _(spark, sf):
    chunks = retrieval.chunk_documents(_documents(spark, sf), "doc_id")
    spans = chunks.groupBy("doc_id").agg(
        F.min("chunk_index").alias("a"), F.max("chunk_index").alias("b"), F.count(F.lit(1)).alias("n"))
    return spans.agg(
        F.count(F.lit(1)).alias("documents"),
        ((F.max("b") + 1 == F.sum("n")) & F.bool_and(F.col("b") - F.col("a") + 1 == F.col("n"))).alias("contiguous"),
        (F.max_by("doc_id", "a") == F.max("doc_id")).alias("in_document_order"))


_VECTOR_SQL = f"""
WITH t AS (SELECT id, unnest(regexp_extract_all(lower(text), '{_WORD}')) AS w FROM (SELECT doc_id AS id, text FROM documents)),
b AS (SELECT id, CAST(('0x' || substr(md5(w), 1, 8)) AS BIGINT) % 256 AS bucket FROM t),
v AS (SELECT id, bucket, count(*) AS c FROM b GROUP BY id, bucket)
"""


@query("h2_hashed_vectors", _VECTOR_SQL + """
SELECT id AS doc_id, CAST(bucket AS INTEGER) AS bucket, c / sqrt(sum(c * c) OVER (PARTITION BY id)) AS weight FROM v
""")
def _(spark, sf):
    vectors = retrieval.with_vector(_documents(spark, sf))
    counts = F.col("vector.counts")
    norm = F.sqrt(F.aggregate(counts, F.lit(0).cast("long"), lambda s, c: s + c * c))
    return vectors.select(
        "doc_id", norm.alias("norm"), F.explode(F.arrays_zip(F.col("vector.buckets").alias("bucket"), counts.alias("c"))).alias("e")
    ).select("doc_id", F.col("e.bucket").alias("bucket"), (F.col("e.c") / F.col("norm")).alias("weight"))


@query("h2_dense_embedding", _VECTOR_SQL + """
SELECT id AS doc_id, CAST(count(*) AS INTEGER) AS filled, round(max(c) / sqrt(sum(c * c)), 9) AS largest FROM v GROUP BY id
""")
def _(spark, sf):
    dense = retrieval.dense_embedding(F.col("vector"))
    rows = retrieval.with_vector(_documents(spark, sf)).select("doc_id", dense.alias("e"))
    return rows.select("doc_id", F.size(F.filter("e", lambda x: x > 0)).alias("filled"), F.round(F.array_max("e"), 9).alias("largest"))


@query("h3_h4_stored_index", "SELECT count(*) AS indexed, FALSE AS fresh_before, TRUE AS fresh_after, FALSE AS fresh_if_changed FROM documents")
def _(spark, sf):
    path = scratch_path(spark, "index")
    docs = table(spark, sf, "documents")
    rows = _documents(spark, sf).withColumnRenamed("doc_id", "chunk_index")
    # the signature of what is indexed, and of the table with one row less
    now, changed = (fingerprint.table_fingerprint(t).first()["digest"] for t in (docs, docs.where("doc_id <> 0")))
    before = retrieval.index_is_fresh(spark, path, now)
    index = retrieval.ensure_index(spark, path, now, rows)
    return index.agg(F.count(F.lit(1)).alias("indexed")).withColumns({
        "fresh_before": F.lit(before), "fresh_after": F.lit(retrieval.index_is_fresh(spark, path, now)),
        "fresh_if_changed": F.lit(retrieval.index_is_fresh(spark, path, changed))})


@query("h5_dense_cosine", """
WITH a AS (SELECT label, CAST(arg_min(embedding, vec_id) AS DOUBLE[]) AS e FROM embeddings GROUP BY label)
SELECT vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), e), 7) AS similarity FROM embeddings JOIN a USING (label)
""")
def _(spark, sf):
    from ..operators.scale import sized_join

    vectors = table(spark, sf, "embeddings")
    first = vectors.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("_first"))
    pairs = sized_join(vectors, first, ["label"])
    return pairs.select("vec_id", F.round(retrieval.cosine(F.col("embedding"), F.col("_first")), 7).alias("similarity"))


@query("h6_dense_top_k", """
WITH q AS (SELECT label AS query_id, CAST(arg_min(embedding, vec_id) AS DOUBLE[]) AS e FROM embeddings GROUP BY label),
s AS (SELECT query_id, vec_id, list_cosine_similarity(CAST(embedding AS DOUBLE[]), e) AS score FROM embeddings, q)
SELECT query_id, vec_id, round(score, 7) AS score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
FROM s QUALIFY rank <= 5
""")
def _(spark, sf):
    vectors = table(spark, sf, "embeddings")
    queries = vectors.groupBy(F.col("label").alias("query_id")).agg(F.min_by("embedding", "vec_id").alias("vector"))
    items = vectors.select("vec_id", F.col("embedding").alias("vector"))
    best = retrieval.top_k(queries, items, 5, item="vec_id")
    return best.withColumn("score", F.round("score", 7)).withColumn("query_id", F.col("query_id").cast("int"))


_SEARCH_SQL = _VECTOR_SQL + f"""
, qt AS (SELECT id, unnest(regexp_extract_all(lower(text), '{_WORD}')) AS w FROM (SELECT item_id AS id, text FROM benchmark)),
qv AS (SELECT id, CAST(('0x' || substr(md5(w), 1, 8)) AS BIGINT) % 256 AS bucket, count(*) AS c FROM qt GROUP BY 1, 2),
dn AS (SELECT id, sum(c * c) AS n FROM v GROUP BY id), qn AS (SELECT id, sum(c * c) AS n FROM qv GROUP BY id),
dots AS (SELECT qv.id AS q, v.id AS d, sum(v.c * qv.c) AS dot FROM v JOIN qv USING (bucket) GROUP BY 1, 2),
s AS (SELECT item_id AS q, doc_id AS d, coalesce(dot / sqrt(qn.n::DOUBLE * dn.n), 0) AS score
      FROM benchmark CROSS JOIN documents LEFT JOIN dots ON dots.q = item_id AND dots.d = doc_id
      LEFT JOIN qn ON qn.id = item_id LEFT JOIN dn ON dn.id = doc_id),
r AS (SELECT q, d, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, d) AS rank FROM s)
"""


@query("h6_top_k", _SEARCH_SQL + """
SELECT q AS query_id, d AS chunk_index, round(score, 10) AS score, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 3
""")
def _(spark, sf):
    best = retrieval.top_k(retrieval.with_vector(_questions(spark, sf), "question"), _as_index(spark, sf))
    return best.withColumn("score", F.round("score", 10))


@query("h7_context_pack", _SEARCH_SQL + """
, p AS (SELECT q, string_agg('Fonte: ' || source || E'\\nTrecho:\\n' || substr(text, 1, 500), E'\\n\\n' ORDER BY rank) AS prompt_context,
         string_agg(substr(text, 1, 500), E'\\n\\n' ORDER BY rank) AS context, count(*) AS n
        FROM r JOIN documents ON doc_id = d WHERE rank <= 3 GROUP BY q)
SELECT item_id AS query_id, CASE WHEN blank THEN 'empty_query' ELSE 'success' END AS status, CASE WHEN blank THEN '' ELSE context END AS context,
       CASE WHEN blank THEN '' ELSE prompt_context END AS prompt_context, CAST(CASE WHEN blank THEN 0 ELSE n END AS INTEGER) AS chunks_retrieved
FROM (SELECT item_id, item_id % 10 = 9 AS blank FROM benchmark) JOIN p ON p.q = item_id
""")
def _(spark, sf):
    asked = _questions(spark, sf).withColumn("question", F.when(F.col("query_id") % 10 == 9, "  \n").otherwise(F.col("question")))
    packed = retrieval.context_pack(asked, _as_index(spark, sf))
    return packed.select("query_id", "status", "context", "prompt_context", "chunks_retrieved")


@query("h6_chunked_retrieval")
def _(spark, sf):
    chunks = retrieval.chunk_documents(_documents(spark, sf), "doc_id")
    index = retrieval.with_vector(chunks)
    return retrieval.retrieve(_questions(spark, sf), index).select("query_id", "chunk_index", "source", "rank", F.round("score", 9).alias("score"))
