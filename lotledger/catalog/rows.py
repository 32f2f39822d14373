"""Row-quality filters and the cleaning stage."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import snake_columns
from ..operators import cleaning
from ..operators.features import build_features
from ..session import materialize
from .registry import query, table
from .views import CLEAN_SQL, RAW_SQL, SALES_SQL, landed_sales, sales


@query("c1_drop_header_rows", f"""
SELECT * FROM ({RAW_SQL})
WHERE NOT contains(n_do_cadastro, '° do Cadastro') AND data_de_transacao <> 'Data de Transação'
""")
def _(spark, sf):
    return cleaning.drop_header_rows(landed_sales(spark, sf))


_REMOVED_SQL = f"""
WITH raw AS ({RAW_SQL}),
kept AS (SELECT * REPLACE (replace(bairro, 'SÃ£o JoÃ£o', 'São João') AS bairro) FROM raw
         WHERE NOT contains(n_do_cadastro, '° do Cadastro') AND data_de_transacao <> 'Data de Transação'),
uniq AS (SELECT DISTINCT * FROM kept)
SELECT (SELECT count(*) FROM raw) - (SELECT count(*) FROM kept) AS header_rows,
       (SELECT count(*) FROM kept) - (SELECT count(*) FROM uniq) AS duplicate_rows,
       (SELECT count(*) FROM uniq WHERE valor_venal_de_referencia IN ('0,00', '-10')) AS non_positive_target_rows
"""


@query("c1_c2_c3_removal_counters", _REMOVED_SQL)
def _(spark, sf):
    return cleaning.removal_counters(landed_sales(spark, sf))


@query("c1_c2_c3_counted_while_cleaning", _REMOVED_SQL)
def _(spark, sf):
    # The counters of the cleaning pass itself, which reads the table once.
    raw = landed_sales(spark, sf)
    cleaned, counters = cleaning.clean_counted(raw)
    stored = materialize(cleaned, "clean")
    found = counters(raw.count(), stored.count())
    return spark.createDataFrame([tuple(found.values())], ", ".join(f"{name} long" for name in found))


@query("c2_full_row_dedup", """
SELECT DISTINCT l_partkey % 50 AS grupo, l_linenumber, l_returnflag,
       CASE WHEN l_linestatus = 'F' THEN l_quantity END AS area_do_terreno_m2 FROM lineitem
""")
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        (F.col("l_partkey") % 50).alias("grupo"), "l_linenumber", "l_returnflag",
        F.when(F.col("l_linestatus") == "F", F.col("l_quantity")).alias("area_do_terreno_m2"))
    return rows.dropDuplicates()


@query("c3_positive_target", """
SELECT l_orderkey, CASE WHEN l_linenumber = 1 THEN NULL ELSE l_quantity - 10 END AS valor_venal_de_referencia
FROM lineitem WHERE l_linenumber = 1 OR l_quantity > 10
""")
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", F.when(F.col("l_linenumber") != 1, F.col("l_quantity") - 10).alias(cleaning.TARGET))
    return cleaning.drop_non_positive_target(rows)


@query("c4_c5_land_in_range", f"""
SELECT cep, area_do_terreno_m2, valor_venal_de_referencia FROM ({SALES_SQL})
WHERE descricao_do_uso_iptu = 'TERRENO' AND area_do_terreno_m2 BETWEEN 2 AND 40 AND valor_venal_de_referencia > 0
""")
def _(spark, sf):
    rows = sales(spark, sf).where((F.col("descricao_do_uso_iptu") == "TERRENO") & cleaning.in_range(area_min=2, area_max=40))
    return rows.select("cep", "area_do_terreno_m2", "valor_venal_de_referencia")


@query("c6_complete_rows", """
SELECT l_orderkey, CASE WHEN l_linenumber > 1 THEN l_quantity END AS area, CASE WHEN l_tax > 0 THEN l_tax END AS testada
FROM lineitem WHERE l_linenumber > 1 AND l_tax > 0
""")
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", F.when(F.col("l_linenumber") > 1, F.col("l_quantity")).alias("area"),
        F.when(F.col("l_tax") > 0, F.col("l_tax")).alias("testada"))
    return cleaning.drop_incomplete(rows, ["area", "testada"])


@query("c7_domain_checked", f"SELECT cep, ano, mes FROM ({SALES_SQL})")
def _(spark, sf):
    return cleaning.assert_domain(sales(spark, sf).select("cep", "ano", "mes"), ["cep", "ano", "mes"])


@query("c8_prepare_valued", """
SELECT 'B' || CAST(l_suppkey AS VARCHAR) AS bairro, CAST(l_quantity AS DOUBLE) AS area_do_terreno_m2,
       l_extendedprice AS valor_venal_de_referencia, l_extendedprice / l_quantity AS valor_m2_estimado
FROM lineitem WHERE l_linenumber NOT IN (1, 2, 3)
""")
def _(spark, sf):
    line = F.col("l_linenumber")
    cells = table(spark, sf, "lineitem").select(
        F.when(line != 1, F.concat(F.lit(" b"), F.col("l_suppkey").cast("string"))).alias("regiao"),
        F.when(line == 2, "abc").otherwise(F.col("l_quantity").cast("string")).alias("area_do_terreno_m2"),
        F.when(line == 3, F.lit(0.0)).otherwise(F.col("l_extendedprice")).alias("valor_venal_de_referencia"))
    return cleaning.prepare_valued(cells, F.upper(F.trim("regiao"))).select(
        "bairro", "area_do_terreno_m2", "valor_venal_de_referencia", "valor_m2_estimado")


@query("c9_c10_columns", "SELECT o_orderkey AS cep, o_custkey AS bairro, o_totalprice AS valor FROM orders")
def _(spark, sf):
    repeated = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus").toDF(
        "CEP", "Bairro", "Valor", "Cep ")
    return cleaning.require_columns(snake_columns(repeated, drop_repeats=True), ["cep", "bairro", "valor"])


@query("c_clean_table", f"""
SELECT n_do_cadastro, bairro, cep, strftime(data_de_transacao, '%Y-%m-%d') AS data_de_transacao,
       valor_venal_de_referencia, area_do_terreno_m2, descricao_do_uso_iptu FROM ({CLEAN_SQL})
""")
def _(spark, sf):
    return cleaning.clean(landed_sales(spark, sf)).withColumn(
        "data_de_transacao", F.date_format("data_de_transacao", "yyyy-MM-dd"))


@query("c_feature_table", f"""
SELECT replace(cep, '-', '') AS cep, area_do_terreno_m2, valor_venal_de_referencia,
       CAST(year(data_de_transacao) AS INTEGER) AS ano, CAST(month(data_de_transacao) AS INTEGER) AS mes
FROM ({CLEAN_SQL})
WHERE descricao_do_uso_iptu = 'TERRENO' AND area_do_terreno_m2 BETWEEN 1 AND 50000 AND valor_venal_de_referencia > 0
  AND data_de_transacao IS NOT NULL
""")
def _(spark, sf):
    return build_features(materialize(cleaning.clean(landed_sales(spark, sf)), "clean"))


