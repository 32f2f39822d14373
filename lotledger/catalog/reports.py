"""Profiles, gates, region statistics, frequency tables, triage, reply scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cleaning, quality, regions, reviews
from ..session import materialize
from .registry import query, table
from .views import CLEAN_SQL, SALES_SQL, landed_sales, sales

_PROFILE_SQL = f"""
WITH c AS ({CLEAN_SQL})
SELECT count(*) AS "rows", count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM c)) AS duplicated_rows,
       count(*) - count(data_de_transacao) AS null_dates, count(*) - count(valor_venal_de_referencia) AS null_targets,
       round(1 - count(data_de_transacao) / count(*), 4) AS null_date_rate,
       strftime(min(data_de_transacao), '%Y-%m-%d') AS date_min, strftime(max(data_de_transacao), '%Y-%m-%d') AS date_max,
       count(*) FILTER (descricao_do_uso_iptu = 'TERRENO') AS terrain_rows,
       count(*) FILTER (valor_venal_de_referencia <= 0) AS non_positive_target_rows
FROM c
"""


def _clean(spark, sf):
    # The stage table: reports read what the cleaning stage wrote.
    return materialize(cleaning.clean(landed_sales(spark, sf)), "clean")


@query("d1_quality_profile", _PROFILE_SQL)
def _(spark, sf):
    profile = quality.quality_profile(_clean(spark, sf))
    return profile.select(
        "rows", "duplicated_rows", F.col("nulls")["data_de_transacao"].alias("null_dates"),
        F.col("nulls")["valor_venal_de_referencia"].alias("null_targets"),
        F.col("critical_null_rate")["data_de_transacao"].alias("null_date_rate"),
        F.date_format("date_min", "yyyy-MM-dd").alias("date_min"), F.date_format("date_max", "yyyy-MM-dd").alias("date_max"),
        "terrain_rows", "non_positive_target_rows",
    )


@query("d1_profile_columns", """
SELECT count(*) AS "rows", CAST(least(count(*), 5) AS INTEGER) AS sample_rows, CAST(0 AS BIGINT) AS strange,
       'bigint' AS key_type, 'double' AS price_type, 'data_de_transacao,bairro,descricao_do_uso_iptu,valor_venal_de_referencia' AS missing
FROM orders
""")
def _(spark, sf):
    rows = materialize(table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_totalprice").cast("double").alias("area_do_terreno_m2"), F.col("o_orderstatus").alias("cep")), "rows")
    profile = materialize(quality.quality_profile(rows), "profile")
    shown = profile.select(F.explode("sample").alias("s")).select("s.*")
    strange = shown.join(rows, rows.columns, "left_anti").agg(F.count(F.lit(1)).alias("strange"), F.lit(1).alias("one"))
    return profile.withColumn("one", F.lit(1)).join(strange, "one").select(
        "rows", F.size("sample").alias("sample_rows"), "strange", F.col("dtypes")["o_orderkey"].alias("key_type"),
        F.col("dtypes")["area_do_terreno_m2"].alias("price_type"), F.array_join("missing_required_cols", ",").alias("missing"))


@query("d2_quality_gate", f"""
WITH p AS ({_PROFILE_SQL})
SELECT concat_ws('; ',
   CASE WHEN "rows" < 100000000 THEN 'rows=' || CAST("rows" AS VARCHAR) || ' abaixo do minimo 100000000' END,
   CASE WHEN terrain_rows < 1 THEN 'terrain_rows=' || CAST(terrain_rows AS VARCHAR) || ' abaixo do minimo 1' END,
   CASE WHEN null_date_rate > 0.001 THEN 'taxa de nulos em data_de_transacao=' || CAST(null_date_rate AS VARCHAR) || ' acima de 0.001' END,
   CASE WHEN non_positive_target_rows > 0 THEN 'x' END) AS failures
FROM p
""")
def _(spark, sf):
    profile = quality.quality_profile(_clean(spark, sf))
    judged = quality.quality_failures(profile, min_rows=100_000_000, min_terrain_rows=1,
                                      max_null_rate={"data_de_transacao": 0.001})
    return judged.select(F.array_join("failures", "; ").alias("failures"))


_CONTRACT_SQL = f"""
SELECT count(*) AS "rows", count(DISTINCT cep) AS unique_ceps, count(DISTINCT ano * 100 + mes) AS unique_periods,
       min(area_do_terreno_m2) AS area_min, max(area_do_terreno_m2) AS area_max,
       min(valor_venal_de_referencia) AS target_min, round(quantile_cont(valor_venal_de_referencia, 0.5), 4) AS target_median,
       max(valor_venal_de_referencia) AS target_max
FROM ({SALES_SQL})
"""


def _contract(spark, sf, **kw):
    features = sales(spark, sf).select("cep", "area_do_terreno_m2", "valor_venal_de_referencia", "ano", "mes")
    return quality.feature_contract(features, **kw)


@query("d3_feature_contract", _CONTRACT_SQL)
def _(spark, sf):
    return _contract(spark, sf).select(
        "rows", "unique_ceps", "unique_periods", "area_min", "area_max", "target_min",
        F.round("target_median", 4).alias("target_median"), "target_max")


@query("d4_contract_gate", f"""
WITH p AS ({_CONTRACT_SQL})
SELECT concat_ws('; ',
    CASE WHEN unique_periods < 500 THEN 'unique_periods=' || CAST(unique_periods AS VARCHAR) || ' abaixo do minimo 500' END,
    'colunas proibidas presentes: ano', CASE WHEN area_max > 20 THEN 'area maxima acima de 20.0' END) AS failures,
    FALSE AS passed FROM p
""")
def _(spark, sf):
    return _contract(spark, sf, min_rows=1, min_ceps=1, min_periods=500, area_max=20, forbidden=("ano",)).select(
        F.array_join("failures", "; ").alias("failures"), "passed")


_SUMMARY_SQL = f"""
SELECT bairro, count(*) AS quantidade_vendas, round(avg(valor_m2_estimado), 4) AS valor_m2_medio,
       round(coalesce(var_samp(valor_m2_estimado), 0), 2) AS valor_m2_variancia
FROM ({SALES_SQL}) GROUP BY bairro HAVING count(*) >= 20
"""


def _valued(spark, sf):
    return cleaning.prepare_valued(sales(spark, sf), F.col("bairro"))


def _rounded(df):
    return df.withColumns({
        "valor_m2_medio": F.round("valor_m2_medio", 4), "valor_m2_variancia": F.round("valor_m2_variancia", 2)})


@query("d5_region_summary", _SUMMARY_SQL)
def _(spark, sf):
    return _rounded(regions.region_summary(_valued(spark, sf)))


@query("d6_overall_price", f"""
SELECT count(*) AS quantidade_vendas, round(avg(valor_m2_estimado), 4) AS valor_m2_medio_geral FROM ({SALES_SQL})
""")
def _(spark, sf):
    return regions.overall_price(_valued(spark, sf)).withColumn(
        "valor_m2_medio_geral", F.round("valor_m2_medio_geral", 4))


@query("d7_dearest_regions", f"SELECT * FROM ({_SUMMARY_SQL}) ORDER BY valor_m2_medio DESC, bairro LIMIT 10")
def _(spark, sf):
    return _rounded(regions.dearest(regions.region_summary(_valued(spark, sf))))


@query("d7_cheapest_regions", f"SELECT * FROM ({_SUMMARY_SQL}) ORDER BY valor_m2_medio, bairro DESC LIMIT 30")
def _(spark, sf):
    return _rounded(regions.cheapest(regions.region_summary(_valued(spark, sf))))


def _frequency_sql(column: str, bins: int) -> str:
    return f"""
WITH v AS (SELECT {column} AS x FROM ({SALES_SQL}) WHERE {column} IS NOT NULL),
t AS (SELECT x FROM v WHERE x <= (SELECT CASE WHEN count(*) >= 100 THEN quantile_cont(x, 0.99) ELSE max(x) END FROM v)),
r AS (SELECT min(x) AS lo, max(x) AS hi FROM t),
e AS (SELECT i AS bin,
        CASE WHEN i = 0 THEN lo - 0.001e0 * (hi - lo) ELSE lo + (hi - lo) / {bins}::DOUBLE * i END AS a,
        CASE WHEN i = {bins - 1} THEN hi ELSE lo + (hi - lo) / {bins}::DOUBLE * (i + 1) END AS b
      FROM r, range({bins}) g(i))
SELECT CAST(bin AS INTEGER) AS bin, a AS limite_inferior, b AS limite_superior,
       count(x) AS frequencia_vendas
FROM e LEFT JOIN t ON x > a AND x <= b GROUP BY bin, a, b
"""


def _frequency(spark, sf, column, bins=50):
    out = regions.frequency_table(_valued(spark, sf), column, bins)
    return out.select("bin", "limite_inferior", "limite_superior", "frequencia_vendas")


@query("d8_frequency_price_m2", _frequency_sql("valor_m2_estimado", 50))
def _(spark, sf):
    return _frequency(spark, sf, "valor_m2_estimado")


@query("d8_frequency_value", _frequency_sql("valor_venal_de_referencia", 50))
def _(spark, sf):
    return _frequency(spark, sf, "valor_venal_de_referencia")


@query("d9_compare_regions", f"""
WITH s AS (SELECT bairro, avg(valor_m2_referencia) AS am, quantile_cont(valor_m2_referencia, 0.5) AS dm, count(valor_m2_referencia) AS nm,
                  avg(valor_venal_de_referencia) AS av, quantile_cont(valor_venal_de_referencia, 0.5) AS dv, count(valor_venal_de_referencia) AS nv
           FROM (SELECT *, valor_m2_estimado AS valor_m2_referencia FROM ({SALES_SQL})) GROUP BY bairro),
p AS (SELECT c_custkey AS id, 'BAIRRO ' || CAST(c_custkey % 60 AS VARCHAR) AS region_a, 'BAIRRO ' || CAST(c_custkey % 130 AS VARCHAR) AS region_b,
             CASE WHEN c_mktsegment = 'MACHINERY' THEN 'valor_m2_referencia' ELSE 'valor_venal_de_referencia' END AS metric
      FROM customer)
SELECT id, region_a, region_b, metric,
       CASE WHEN a.bairro IS NULL OR b.bairro IS NULL THEN 'regions_not_found' ELSE 'success' END AS status,
       concat_ws(',', CASE WHEN a.bairro IS NULL THEN region_a END, CASE WHEN b.bairro IS NULL THEN region_b END) AS missing_regions,
       CASE WHEN b.bairro IS NOT NULL THEN round(CASE WHEN metric = 'valor_m2_referencia' THEN a.am ELSE a.av END, 3) END AS mean_a,
       CASE WHEN a.bairro IS NOT NULL THEN CASE WHEN metric = 'valor_m2_referencia' THEN b.dm ELSE b.dv END END AS median_b,
       CASE WHEN b.bairro IS NOT NULL THEN CASE WHEN metric = 'valor_m2_referencia' THEN a.nm ELSE a.nv END END AS n_a,
       CASE WHEN a.bairro IS NOT NULL AND b.bairro IS NOT NULL THEN
         CASE WHEN CASE WHEN metric = 'valor_m2_referencia' THEN a.am - b.am ELSE a.av - b.av END >= 0 THEN region_a ELSE region_b END END AS higher_region,
       round(abs(CASE WHEN metric = 'valor_m2_referencia' THEN a.am - b.am ELSE a.av - b.av END), 3) AS absolute_difference
FROM p LEFT JOIN s a ON a.bairro = region_a LEFT JOIN s b ON b.bairro = region_b
""")
def _(spark, sf):
    pairs = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"),
        F.concat(F.lit(" bairro "), (F.col("c_custkey") % 60).cast("string")).alias("region_a"),
        F.concat(F.lit("Bairro "), (F.col("c_custkey") % 130).cast("string")).alias("region_b"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "valor_m2").when(F.col("c_mktsegment") == "HOUSEHOLD", "desconhecida")
        .alias("metric"),
    )
    priced = _valued(spark, sf).withColumnRenamed("valor_m2_estimado", "valor_m2_referencia")
    out = regions.compare_regions(pairs, priced, ["valor_m2_referencia", "valor_venal_de_referencia"])
    return out.select(
        "id", "region_a", "region_b", "metric", "status", F.array_join("missing_regions", ",").alias("missing_regions"),
        F.round("stats_a.media", 3).alias("mean_a"), F.col("stats_b.mediana").alias("median_b"),
        F.col("stats_a.amostra").alias("n_a"), "higher_region", F.round("absolute_difference", 3).alias("absolute_difference"),
    )


@query("d10_region_cards", f"""
SELECT bairro, count(*) AS count, round(avg(valor_m2_estimado), 4) AS avg_price_m2, quantile_cont(valor_m2_estimado, 0.5) AS median_price_m2,
       round(avg(valor_venal_de_referencia), 3) AS avg_price, quantile_cont(valor_venal_de_referencia, 0.5) AS median_price,
       min(valor_venal_de_referencia) AS min_price, max(valor_venal_de_referencia) AS max_price
FROM ({SALES_SQL}) GROUP BY bairro
""")
def _(spark, sf):
    cards = regions.region_cards(_valued(spark, sf))
    return cards.withColumns({
        "avg_price_m2": F.round("avg_price_m2", 4), "avg_price": F.round("avg_price", 3)})


_TRIAGE_SQL = f"""
WITH s AS (SELECT * FROM ({SALES_SQL})),
m AS (SELECT bairro, avg(valor_m2_estimado) AS mm FROM s GROUP BY bairro),
d AS (SELECT s.bairro, valor_venal_de_referencia, valor_declarado,
             (valor_declarado - mm * area_do_terreno_m2) / (mm * area_do_terreno_m2) AS desvio FROM s JOIN m USING (bairro)),
c AS (SELECT *, quantile_cont(desvio, 0.5) OVER (PARTITION BY bairro) AS med FROM d),
w AS (SELECT *, quantile_cont(abs(desvio - med), 0.5) OVER (PARTITION BY bairro) AS mad FROM c),
j AS (SELECT bairro, valor_venal_de_referencia, valor_declarado, desvio, 0.6745e0 * (desvio - med) / mad AS z FROM w),
f AS (SELECT *, CASE WHEN abs(desvio) > 0.5 AND abs(z) > 1.5 THEN CASE WHEN desvio < 0 THEN 'muito_abaixo' ELSE 'muito_acima' END
                     ELSE 'normal' END AS sinal FROM j)
"""


def _triaged(spark, sf):
    return regions.deviation_triage(sales(spark, sf), "valor_declarado", z_limit=1.5)


@query("d24_deviation_triage", _TRIAGE_SQL + """
SELECT bairro, valor_venal_de_referencia, round(valor_declarado, 3) AS valor_declarado, round(desvio, 6) AS desvio,
       round(z, 5) AS z_robusto, sinal FROM f WHERE sinal <> 'normal'
""")
def _(spark, sf):
    flagged = _triaged(spark, sf).where(F.col("sinal") != "normal")
    return flagged.select(
        "bairro", "valor_venal_de_referencia", F.round("valor_declarado", 3).alias("valor_declarado"),
        F.round("desvio", 6).alias("desvio"), F.round("z_robusto", 5).alias("z_robusto"), "sinal")


@query("d24_region_deviation", _TRIAGE_SQL + """
SELECT bairro, count(*) AS n, round(avg(abs(desvio)), 6) AS desvio_medio_abs,
       round(avg(CASE WHEN sinal = 'normal' THEN 0 ELSE 1 END), 6) AS taxa_sinal FROM f GROUP BY bairro
""")
def _(spark, sf):
    out = regions.region_deviation(_triaged(spark, sf))
    return out.withColumns({"desvio_medio_abs": F.round("desvio_medio_abs", 6), "taxa_sinal": F.round("taxa_sinal", 6)})


# Runs derived from conversations: each assistant turn answers the turn before it.
_RUNS_SQL = """
SELECT CASE turn % 3 WHEN 0 THEN 'top_k_1' WHEN 1 THEN 'top_k_3' ELSE 'top_k_5' END AS config_name, conv_id, turn,
       CASE WHEN conv_id % 7 = 0 THEN '' ELSE text END AS answer, CASE WHEN conv_id % 11 = 0 THEN 'quota' END AS error,
       CASE WHEN turn % 2 = 0 THEN 2 ELSE 1 END AS n_tools, turn % 2 = 0 AS has_rag, role = 'user' AS no_expected,
       CAST(turn % 5 AS INTEGER) AS chunks_retrieved, length(text) * 3 AS latency_ms, conv_id % 4 <> 0 AS has_sources
FROM conversations
"""


def _runs(spark, sf):
    turn, conv = F.col("turn"), F.col("conv_id")
    logged = table(spark, sf, "conversations").select(
        F.when(turn % 3 == 0, "top_k_1").when(turn % 3 == 1, "top_k_3").otherwise("top_k_5").alias("config_name"),
        "conv_id", "turn",
        F.when(conv % 7 == 0, "").otherwise(F.col("text")).alias("answer"), F.when(conv % 11 == 0, "quota").alias("error"),
        F.when(turn % 2 == 0, F.array(F.lit("rag_search"), F.lit("price_estimator")))
        .otherwise(F.array(F.lit("price_estimator"))).alias("tools_used"),
        F.when(conv % 4 != 0, F.array(F.lit("a.md"))).otherwise(F.array().cast("array<string>")).alias("sources"),
        F.when(F.col("role") != "user", "rag_search").alias("expected_tool"),
        (turn % 5).cast("int").alias("chunks_retrieved"), (F.length("text") * 3).cast("long").alias("latency_ms"),
    )
    return reviews.score_runs(logged)


@query("d20_run_metrics", f"""
WITH r AS ({_RUNS_SQL}), s AS (SELECT *, answer <> '' AND error IS NULL AS success FROM r)
SELECT config_name, count(*) AS total_questions, round(avg(CAST(success AS INTEGER)), 6) AS success_rate,
       round(avg(CAST(NOT success AS INTEGER)), 6) AS error_rate, round(avg(latency_ms), 6) AS avg_latency_ms,
       round(avg(n_tools), 6) AS avg_tools_used, round(avg(chunks_retrieved), 6) AS avg_chunks_retrieved,
       round(avg(length(answer)), 6) AS avg_response_length, round(avg(CAST(has_sources AS INTEGER)), 6) AS source_presence_rate,
       round(coalesce(avg(CAST(has_rag AS INTEGER)) FILTER (NOT no_expected), 0), 6) AS tool_match_rate
FROM s GROUP BY config_name
""")
def _(spark, sf):
    out = reviews.run_metrics(_runs(spark, sf), ["config_name"])
    return out.select("config_name", "total_questions",
                      *[F.round(c, 6).alias(c) for c in out.columns if c not in ("config_name", "total_questions")])


@query("d21_run_records", f"""
SELECT config_name, conv_id, turn, CAST(length(answer) AS INTEGER) AS response_length, answer <> '' AND error IS NULL AS success,
       CASE WHEN no_expected THEN NULL ELSE has_rag END AS tool_match FROM ({_RUNS_SQL})
""")
def _(spark, sf):
    return _runs(spark, sf).select("config_name", "conv_id", "turn", "response_length", "success", "tool_match")


@query("d21_question_grid", """
SELECT item_id AS id, config_name, rag_top_k FROM benchmark,
 (VALUES ('top_k_1', 1), ('top_k_3', 3), ('top_k_5', 5)) v(config_name, rag_top_k)
""")
def _(spark, sf):
    return reviews.question_grid(table(spark, sf, "benchmark").select(F.col("item_id").alias("id")))


@query("d22_answer_heuristics", """
SELECT conv_id, turn, length(text) > 15 AS corretude, contains(text, 'R$') AS utilidade,
       NOT contains(lower(text), 'erro') AS seguranca,
       round((CAST(length(text) > 15 AS INTEGER) + CAST(contains(text, 'R$') AS INTEGER)
             + CAST(NOT contains(lower(text), 'erro') AS INTEGER)) / 3.0, 6) AS score
FROM (SELECT conv_id, turn, text || CASE WHEN turn % 2 = 0 THEN ' R$ 450000' ELSE '' END AS text FROM conversations)
""")
def _(spark, sf):
    answer = F.concat("text", F.when(F.col("turn") % 2 == 0, " R$ 450000").otherwise(""))
    judged = reviews.answer_heuristics(table(spark, sf, "conversations").withColumn("answer", answer))
    return judged.select("conv_id", "turn", "corretude", "utilidade", "seguranca", F.round("score", 6).alias("score"))


@query("d23_answer_scores", """
WITH q AS (SELECT conv_id, turn, text AS answer, 'E ' || text[1:12] || ' xqz' AS question, text[5:25] || CASE WHEN turn % 2 = 0 THEN '' ELSE '~' END AS truth
           FROM conversations),
s AS (SELECT conv_id, turn, CAST(contains(answer, truth) AS INTEGER) AS faithfulness,
      CASE WHEN len(list_filter(string_split_regex(trim(lower(question)), '\\s+'), lambda w: contains(lower(answer), w))) > 0 THEN 1.0 ELSE 0.5 END AS answer_relevancy,
      least(length(answer) / 200.0, 1.0) AS context_precision FROM q)
SELECT conv_id, turn, faithfulness, CAST(answer_relevancy AS DOUBLE) AS answer_relevancy,
       round(CAST(context_precision AS DOUBLE), 6) AS context_precision, faithfulness AS context_recall,
       round((faithfulness * 2 + answer_relevancy + context_precision) / 4.0, 6) AS final_score FROM s
""")
def _(spark, sf):
    rows = table(spark, sf, "conversations").select(
        "conv_id", "turn", F.col("text").alias("answer"),
        F.concat(F.lit("E "), F.substring("text", 1, 12), F.lit(" xqz")).alias("question"),
        F.concat(F.substring("text", 5, 21), F.when(F.col("turn") % 2 == 0, "").otherwise("~")).alias("ground_truth"))
    out = reviews.answer_scores(rows)
    return out.select("conv_id", "turn", "faithfulness", "answer_relevancy", F.round("context_precision", 6).alias("context_precision"),
                      "context_recall", F.round("final_score", 6).alias("final_score"))


