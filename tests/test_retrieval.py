import tracemalloc

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lotledger.catalog import search
from lotledger.operators import retrieval
from lotledger.operators.retrieval_tasks import scorer, split_text
from lotledger.session import scratch_path


def test_split_text():
    text = "Localizacao influencia preco. " * 20
    chunks = split_text(text, 120, 20)
    assert len(chunks) > 1 and all(0 < len(c) <= 120 for c in chunks)
    assert set(" ".join(chunks).split()) == set(text.split())
    assert split_text("curto", 120, 20) == ["curto"]
    assert all(len(c) <= 10 for c in split_text("x" * 95, 10, 3))
    assert split_text("a\n\nb", 2, 0) == ["a", "b"] and split_text("  \n ", 10, 0) == []


def test_chunk_index_runs_over_the_corpus(spark):
    texts = ["palavra " * (40 * (i % 7)) for i in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, content string")
    rows = retrieval.chunk_documents(df, "doc_id", size=100, overlap=10).orderBy("chunk_index").collect()
    wanted = [(i, c) for i, t in enumerate(texts) for c in split_text(t, 100, 10)]
    assert [(r.doc_id, r.content) for r in rows] == wanted
    assert [r.chunk_index for r in rows] == list(range(len(wanted)))


def test_workers_get_bounded_batches(spark, monkeypatch):
    def sizes(size, overlap):
        def run(batches):
            for batch in batches:
                yield batch.assign(_part=np.int32(0), _local=range(len(batch)), content=str(len(batch)))
        return run

    def counted(rows: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"buckets": [[len(rows)]] * len(rows), "counts": [[1]] * len(rows)})

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    monkeypatch.setattr(retrieval, "chunker", sizes)
    monkeypatch.setattr(retrieval, "tally", counted)
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("preco do imovel").alias("content")).coalesce(1)
    spark.conf.set(name, "10000")
    assert retrieval.chunk_documents(docs, "doc_id").agg(F.max(F.col("content").cast("int"))).first()[0] <= 1000
    spark.conf.set(name, "10000")
    assert retrieval.with_vector(docs).agg(F.max(F.col("vector.buckets")[0])).first()[0] <= 1000


def test_scoring_holds_few_cells():
    rng = np.random.default_rng(5)
    items = pd.DataFrame({"chunk_index": range(3000), "vector": list(rng.random((3000, 8)))})
    asked = pd.DataFrame({"query_id": range(3000), "vector": list(rng.random((3000, 8)))})
    tracemalloc.start()
    found = scorer("chunk_index", 3)(None, items, asked)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == 9000 and peak < 100e6


@pytest.mark.parametrize("run", [3, 1024])
def test_distinct_words_of_long_and_repeated_documents(spark, monkeypatch, run):
    monkeypatch.setattr(search, "_RUN", run)
    rows = [(1, 0, "a b\n a"), (1, 1, "a c"), (2, 2, "x"), (3, 3, "u"), (3, 4, "u v"), (3, 5, "w"), (3, 6, "u z"), (None, 7, "q"), (4, 8, " e ")]
    got = search._distinct_words(spark.createDataFrame(rows, "doc_id long, chunk_index long, content string"))
    assert "collect_list" in got._jdf.queryExecution().optimizedPlan().toString()
    assert {(r.doc_id, r.words) for r in got.collect() if r.doc_id} == {(1, 3), (2, 1), (3, 4), (4, 1)}


def test_dense_top_k(spark):
    items = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 0.0])], "chunk_index long, vector array<double>")
    queries = spark.createDataFrame([(7, [1.0, 0.0])], "query_id long, vector array<double>")
    got = [(r.chunk_index, r.score, r["rank"]) for r in retrieval.top_k(queries, items, 3).orderBy("rank").collect()]
    assert got == [(0, 1.0, 1), (1, 0.0, 2), (2, 0.0, 3)]


def test_top_k_blocks_match_brute_force(spark):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(60)]
    docs = [" ".join(rng.choice(words, rng.integers(0, 30))) for _ in range(300)]
    asks = [" ".join(rng.choice(words, 5)) for _ in range(25)]
    items = retrieval.with_vector(spark.createDataFrame(list(enumerate(docs)), "chunk_index long, content string").repartition(5))
    queries = retrieval.with_vector(spark.createDataFrame(list(enumerate(asks)), "query_id long, q string"), "q")

    def dense(rows, key):
        out = np.zeros((rows.count(), 256))
        for r in rows.collect():
            out[r[key], r["vector"]["buckets"]] = r["vector"]["counts"]
        return out

    a, b = dense(queries, "query_id"), dense(items, "chunk_index")
    norms = np.sqrt((a * a).sum(1)[:, None] * (b * b).sum(1)[None, :])
    scores = np.divide(a @ b.T, norms, out=np.zeros_like(norms), where=norms > 0)
    wanted = {(q, int(i), n + 1) for q in range(25) for n, i in enumerate(np.lexsort((np.arange(300), -scores[q]))[:4])}
    for block, part in ((8192, 16_384), (6, 40)):
        best = retrieval.top_k(queries, items, 4, block_rows=block, slice_rows=part)
        got = best.collect()
        assert "Broadcast" not in best._jdf.queryExecution().executedPlan().toString()
        assert {(r["query_id"], r["chunk_index"], r["rank"]) for r in got} == wanted


def test_cosine(spark):
    df = spark.createDataFrame([([3.0, 4.0], [3.0, 4.0]), ([1.0, 0.0], [0.0, 0.0])], "a array<double>, b array<double>")
    assert [r[0] for r in df.select(retrieval.cosine(F.col("a"), F.col("b"))).collect()] == pytest.approx([1.0, 0.0])


def test_index_and_context(spark):
    chunks = spark.createDataFrame([(0, "a.md", "preco do imovel " * 60), (1, "b.md", "clima e chuva")], "chunk_index long, source string, content string")
    path = scratch_path(spark, "index")
    index = retrieval.ensure_index(spark, path, "s1", chunks)
    assert retrieval.index_is_fresh(spark, path, "s1") and not retrieval.index_is_fresh(spark, path, "s2")
    asked = spark.createDataFrame([(1, "Qual o preco do imovel?"), (2, "  ")], "query_id long, question string")
    got = {r.query_id: r for r in retrieval.context_pack(asked, index, 1).collect()}
    assert got[1].sources == ["a.md"] and got[1].status == "success" and len(got[1].context) == 500
    assert got[1].prompt_context.startswith("Fonte: a.md\nTrecho:\npreco")
    assert got[2].status == "empty_query" and got[2].chunks_retrieved == 0
    with pytest.raises(ValueError):
        retrieval.build_index(chunks.where("false"), path, "s3")
