"""Scores over logged question/answer runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.text import strip

# Retrieval depths compared by the benchmark.
BENCHMARK_CONFIGS = (("top_k_1", 1), ("top_k_3", 3), ("top_k_5", 5))


def question_grid(questions: DataFrame, configs: Sequence[tuple[str, int]] = BENCHMARK_CONFIGS) -> DataFrame:
    """Every question once per configuration (a fixed, short list)."""
    entries = F.array(*[F.struct(F.lit(n).alias("config_name"), F.lit(k).alias("rag_top_k")) for n, k in configs])
    return questions.withColumn("_c", F.explode(entries)).select(*questions.columns, "_c.*")


def score_runs(runs: DataFrame) -> DataFrame:
    """Add ``response_length``, ``success`` and the three-valued ``tool_match``."""
    answer = F.coalesce("answer", F.lit(""))
    expected = F.nullif(F.col("expected_tool"), F.lit(""))
    used = F.coalesce("tools_used", F.array().cast("array<string>"))
    return runs.withColumns({
        "answer": answer,
        "response_length": F.length(answer),
        "success": (answer != "") & (F.coalesce("error", F.lit("")) == ""),
        "tool_match": F.when(expected.isNotNull(), F.array_contains(used, expected)),
    })


def run_metrics(runs: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Rates and means per configuration; zeros when there is no run."""
    def rate(condition):
        return F.coalesce(F.avg(condition.cast("int")), F.lit(0.0))

    def mean(column):
        return F.coalesce(F.avg(column), F.lit(0.0))

    success = F.col("success")
    return runs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_questions"),
        rate(success).alias("success_rate"),
        rate(~success).alias("error_rate"),
        mean("latency_ms").alias("avg_latency_ms"),
        mean(F.size(F.coalesce("tools_used", F.array().cast("array<string>")))).alias("avg_tools_used"),
        mean("chunks_retrieved").alias("avg_chunks_retrieved"),
        mean("response_length").alias("avg_response_length"),
        rate(F.coalesce(F.size("sources") > 0, F.lit(False))).alias("source_presence_rate"),
        rate(F.col("tool_match")).alias("tool_match_rate"),
    )


def answer_heuristics(rows: DataFrame, answer: str = "answer") -> DataFrame:
    """Three yes/no criteria of an answer and their mean."""
    text = F.col(answer)
    checks = {
        "corretude": F.length(text) > 15,
        "utilidade": F.contains(text, F.lit("R$")),
        "seguranca": ~F.contains(F.lower(text), F.lit("erro")),
    }
    score = sum((c.cast("int") for c in checks.values()), F.lit(0)) / 3
    return rows.withColumns({**checks, "score": score})


def answer_scores(rows: DataFrame, question: str = "question", answer: str = "answer",
                  truth: str = "ground_truth") -> DataFrame:
    """Faithfulness, relevancy, precision, recall and their mean."""
    reply = F.col(answer)
    holds = F.contains(reply, F.col(truth)).cast("int")
    words = F.split(strip(F.lower(F.col(question))), r"(?U)\s+")
    relevant = F.exists(words, lambda w: (w != "") & F.contains(F.lower(reply), w))
    scores = {
        "faithfulness": holds,
        "answer_relevancy": F.when(relevant, 1.0).otherwise(0.5),
        "context_precision": F.least(F.length(reply) / 200, F.lit(1.0)),
        "context_recall": holds,
    }
    return rows.withColumns({**scores, "final_score": sum(scores.values(), F.lit(0.0)) / 4})
