"""Views of the given tables shaped like the property data, in Spark and in SQL.

``sales``: line items as land sales (region/CEP = supplier, area = quantity,
value = extended price, date = ship date, use = return flag).
``raw_sales``: the same written as messy text cells.
``deals``: orders with their total area; ``o_orderkey`` is a unique key.
``scored``: orders with a truth and two deterministic predictions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import materialize
from .registry import spread, table

USE = "CASE l_returnflag WHEN 'A' THEN 'TERRENO' WHEN 'N' THEN 'RESIDENCIA' ELSE 'COMERCIO' END"

SALES_SQL = f"""
SELECT lpad(CAST(l_suppkey AS VARCHAR), 8, '0') AS cep,
       'BAIRRO ' || CAST(l_suppkey AS VARCHAR) AS bairro,
       l_quantity AS area_do_terreno_m2,
       l_extendedprice AS valor_venal_de_referencia,
       l_extendedprice * (CAST(1 AS DOUBLE) - l_discount * CAST(8 AS DOUBLE)) AS valor_declarado,
       CAST(year(l_shipdate) AS INTEGER) AS ano, CAST(month(l_shipdate) AS INTEGER) AS mes,
       {USE} AS descricao_do_uso_iptu,
       l_shipdate AS data_de_transacao,
       l_extendedprice / l_quantity AS valor_m2_estimado
FROM lineitem
"""


def sales(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    use = (
        F.when(F.col("l_returnflag") == "A", "TERRENO").when(F.col("l_returnflag") == "N", "RESIDENCIA")
        .otherwise("COMERCIO")
    )
    key = F.col("l_suppkey").cast("string")
    return li.select(
        F.lpad(key, 8, "0").alias("cep"),
        F.concat(F.lit("BAIRRO "), key).alias("bairro"),
        F.col("l_quantity").alias("area_do_terreno_m2"),
        F.col("l_extendedprice").alias("valor_venal_de_referencia"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount") * 8)).alias("valor_declarado"),
        F.year("l_shipdate").alias("ano"), F.month("l_shipdate").alias("mes"),
        use.alias("descricao_do_uso_iptu"),
        F.col("l_shipdate").alias("data_de_transacao"),
        F.try_divide("l_extendedprice", "l_quantity").alias("valor_m2_estimado"),
    )


# Text cells with mojibake, embedded header rows, repeated rows, three date
# orders, Brazilian numbers, missing numbers and non-positive targets.
RAW_SQL = """
SELECT CASE WHEN l_linenumber = 7 AND l_quantity = 50 THEN 'N° do Cadastro (SQL)'
            ELSE lpad(CAST(l_partkey AS VARCHAR), 10, '0') END AS n_do_cadastro,
       CASE WHEN l_partkey % 3 = 0 THEN 'SÃ£o JoÃ£o ' WHEN l_partkey % 3 = 1 THEN ' São João '
            ELSE 'Jardim América nº ' END || CAST(l_suppkey AS VARCHAR) AS bairro,
       substr(lpad(CAST(l_suppkey AS VARCHAR), 8, '0'), 1, 5) || '-'
         || substr(lpad(CAST(l_suppkey AS VARCHAR), 8, '0'), 6, 3) AS cep,
       CASE WHEN l_linenumber = 4 AND l_quantity < 5 THEN 'sem data'
            WHEN l_linenumber = 6 AND l_quantity = 49 THEN 'Data de Transação'
            WHEN l_linenumber = 2 THEN strftime(l_shipdate, '%Y-%m-%d')
            WHEN l_linenumber = 3 AND day(l_shipdate) > 12 THEN strftime(l_shipdate, '%m/%d/%Y')
            ELSE strftime(l_shipdate, '%d/%m/%Y') END AS data_de_transacao,
       CASE WHEN l_linenumber = 6 AND l_quantity = 2 THEN 'n/d'
            WHEN l_linenumber = 5 AND l_quantity = 1 THEN '0,00'
            WHEN l_linenumber = 6 AND l_quantity = 1 THEN '-10'
            ELSE 'R$ ' || translate(format('{:,.2f}', l_extendedprice), ',.', '.,') END AS valor_venal_de_referencia,
       translate(format('{:,.2f}', l_quantity * 37), ',.', '.,') AS area_do_terreno_m2,
       CASE l_returnflag WHEN 'A' THEN 'Terreno' WHEN 'N' THEN 'residência' ELSE ' comércio ' END AS descricao_do_uso_iptu
FROM lineitem
"""


def raw_sales(spark: SparkSession, sf: str) -> DataFrame:
    li = spread(table(spark, sf, "lineitem"), "l_orderkey", "l_linenumber")
    line, qty, part, ship = (F.col(c) for c in ("l_linenumber", "l_quantity", "l_partkey", "l_shipdate"))
    supp = F.col("l_suppkey").cast("string")
    padded = F.lpad(supp, 8, "0")

    def br(col):
        return F.translate(F.format_string("%,.2f", col), ",.", ".,")

    return li.select(
        F.when((line == 7) & (qty == 50), "N° do Cadastro (SQL)")
        .otherwise(F.lpad(part.cast("string"), 10, "0")).alias("n_do_cadastro"),
        F.concat(
            F.when(part % 3 == 0, "SÃ£o JoÃ£o ").when(part % 3 == 1, " São João ").otherwise("Jardim América nº "), supp
        ).alias("bairro"),
        F.concat(F.substring(padded, 1, 5), F.lit("-"), F.substring(padded, 6, 3)).alias("cep"),
        F.when((line == 4) & (qty < 5), "sem data")
        .when((line == 6) & (qty == 49), "Data de Transação")
        .when(line == 2, F.date_format(ship, "yyyy-MM-dd"))
        .when((line == 3) & (F.dayofmonth(ship) > 12), F.date_format(ship, "MM/dd/yyyy"))
        .otherwise(F.date_format(ship, "dd/MM/yyyy")).alias("data_de_transacao"),
        F.when((line == 6) & (qty == 2), "n/d").when((line == 5) & (qty == 1), "0,00")
        .when((line == 6) & (qty == 1), "-10")
        .otherwise(F.concat(F.lit("R$ "), br(F.col("l_extendedprice")))).alias("valor_venal_de_referencia"),
        br(qty * 37).alias("area_do_terreno_m2"),
        F.when(F.col("l_returnflag") == "A", "Terreno").when(F.col("l_returnflag") == "N", "residência")
        .otherwise(" comércio ").alias("descricao_do_uso_iptu"),
    )


def landed_sales(spark: SparkSession, sf: str) -> DataFrame:
    """``raw_sales`` as a stored table, which is what a cleaning stage reads."""
    return materialize(raw_sales(spark, sf), "landed")


# The cleaning stage in SQL, over RAW_SQL.
CLEAN_SQL = f"""
WITH raw AS ({RAW_SQL}),
repaired AS (
  SELECT * REPLACE (replace(bairro, 'SÃ£o JoÃ£o', 'São João') AS bairro) FROM raw
),
kept AS (
  SELECT DISTINCT * FROM repaired
  WHERE NOT contains(n_do_cadastro, '° do Cadastro') AND data_de_transacao <> 'Data de Transação'
),
typed AS (
  SELECT n_do_cadastro,
    trim(upper(regexp_replace(strip_accents(replace(bairro, 'º', 'o')), '[^\\x00-\\x7F]', '', 'g'))) AS bairro,
    cep,
    coalesce(try_strptime(data_de_transacao, '%Y-%m-%d'), try_strptime(data_de_transacao, '%d/%m/%Y'),
             try_strptime(data_de_transacao, '%m/%d/%Y')) AS data_de_transacao,
    TRY_CAST(nullif(regexp_extract(replace(replace(valor_venal_de_referencia, '.', ''), ',', '.'),
             '([-+]?[0-9]*\\.?[0-9]+)', 1), '') AS DOUBLE) AS valor_venal_de_referencia,
    TRY_CAST(nullif(regexp_extract(replace(replace(area_do_terreno_m2, '.', ''), ',', '.'),
             '([-+]?[0-9]*\\.?[0-9]+)', 1), '') AS DOUBLE) AS area_do_terreno_m2,
    trim(upper(strip_accents(descricao_do_uso_iptu))) AS descricao_do_uso_iptu
  FROM kept
)
SELECT * FROM typed WHERE NOT coalesce(valor_venal_de_referencia <= 0, FALSE)
"""

DEALS_SQL = """
SELECT o_orderkey AS id, lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS cep, area_do_terreno_m2,
       o_totalprice AS valor_venal_de_referencia,
       CAST(year(o_orderdate) AS INTEGER) AS ano, CAST(month(o_orderdate) AS INTEGER) AS mes
FROM orders JOIN (SELECT l_orderkey, sum(l_quantity) AS area_do_terreno_m2 FROM lineitem GROUP BY l_orderkey)
  ON o_orderkey = l_orderkey
"""


def deals(spark: SparkSession, sf: str) -> DataFrame:
    area = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(
        F.sum("l_quantity").alias("area_do_terreno_m2")
    )
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.lpad(F.col("o_custkey").cast("string"), 8, "0").alias("cep"),
        F.col("o_totalprice").alias("valor_venal_de_referencia"),
        F.year("o_orderdate").alias("ano"), F.month("o_orderdate").alias("mes"),
    )
    return orders.join(area, "id").select(
        "id", "cep", "area_do_terreno_m2", "valor_venal_de_referencia", "ano", "mes"
    )


SCORED_SQL = """
SELECT o_orderkey AS id, o_orderpriority AS priority,
       CASE WHEN o_custkey % 97 = 0 THEN NULL ELSE 'C' || CAST(o_custkey % 500 AS VARCHAR) END AS cep,
       CAST(year(o_orderdate) AS INTEGER) AS ano, CAST(month(o_orderdate) AS INTEGER) AS mes,
       o_totalprice AS y_true,
       o_totalprice * (0.8e0 + (o_custkey % 40) / 97.0e0) AS y_pred,
       o_totalprice * (0.9e0 + (o_orderkey % 30) / 131.0e0) AS y_pred_b
FROM orders
"""


def scored(spark: SparkSession, sf: str) -> DataFrame:
    cust, price = F.col("o_custkey"), F.col("o_totalprice")
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("priority"),
        F.when(cust % 97 == 0, F.lit(None)).otherwise(F.concat(F.lit("C"), (cust % 500).cast("string"))).alias("cep"),
        F.year("o_orderdate").alias("ano"), F.month("o_orderdate").alias("mes"),
        price.alias("y_true"),
        (price * (F.lit(0.8) + (cust % 40) / F.lit(97.0))).alias("y_pred"),
        (price * (F.lit(0.9) + (F.col("o_orderkey") % 30) / F.lit(131.0))).alias("y_pred_b"),
    )
