"""Scalar functions over text, numbers, dates and payloads."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import payload, text, values
from .registry import query, spread, table
from .views import RAW_SQL, SALES_SQL, raw_sales, sales


@query("b1_snake_columns", """
SELECT o_orderkey AS n_do_cadastro_sql, o_custkey AS codigo_iptu, o_totalprice AS valor_da_transacao_r,
       o_orderstatus AS no_imovel FROM orders
""")
def _(spark, sf):
    named = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus").toDF(
        "N° do Cadastro (SQL)", "Código IPTU", "Valor da TransaÃ§Ã£o (R$)", "Nº  Imóvel")
    return text.snake_columns(named)


@query("b2_repair_mojibake", "SELECT doc_id, text AS repaired FROM documents")
def _(spark, sf):
    broken = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    return spread(table(spark, sf, "documents"), "doc_id").select("doc_id", text.repair_mojibake(broken).alias("repaired"))


@query("b3_repair_all", "SELECT conv_id, role, text FROM conversations")
def _(spark, sf):
    broken = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    return text.repair_all(table(spark, sf, "conversations").select("conv_id", "role", broken.alias("text")))


@query("b4_normalize_text", """
SELECT doc_id, trim(upper(regexp_replace(strip_accents(text), '[^\\x00-\\x7F]', '', 'g')), E' \\t\\n\\r') AS label FROM documents
""")
def _(spark, sf):
    return spread(table(spark, sf, "documents"), "doc_id").select("doc_id", text.normalize_text(F.col("text")).alias("label"))


_NUMBER_SQL = f"""
SELECT valor_venal_de_referencia AS celula, count(*) AS n,
       min(TRY_CAST(nullif(regexp_extract(replace(replace(valor_venal_de_referencia, '.', ''), ',', '.'),
           '([-+]?[0-9]*\\.?[0-9]+)', 1), '') AS DOUBLE)) AS valor
FROM ({RAW_SQL}) GROUP BY valor_venal_de_referencia
"""


@query("b5_parse_br_number", _NUMBER_SQL)
def _(spark, sf):
    cell = F.col("valor_venal_de_referencia")
    return raw_sales(spark, sf).groupBy(cell.alias("celula")).agg(
        F.count(F.lit(1)).alias("n"), F.min(values.parse_br_number(cell)).alias("valor"))


@query("b5_parse_number_auto", """
SELECT CAST(l_extendedprice AS VARCHAR) AS celula, l_extendedprice AS valor, format('{:,.2f}', l_extendedprice) AS outra,
       l_extendedprice AS outro_valor
FROM (SELECT DISTINCT l_extendedprice FROM lineitem)
""")
def _(spark, sf):
    price = F.col("l_extendedprice")
    rows = table(spark, sf, "lineitem").select(price).distinct()
    brazilian = F.translate(F.format_string("%,.2f", price), ",.", ".,")
    return rows.select(
        price.cast("string").alias("celula"), values.parse_br_number(price, "auto").alias("valor"),
        F.format_string("%,.2f", price).alias("outra"), values.parse_br_number(brazilian, "auto").alias("outro_valor"),
    )


@query("b6_parse_date", f"""
SELECT data_de_transacao AS celula, count(*) AS n,
       min(strftime(coalesce(try_strptime(data_de_transacao, '%Y-%m-%d'), try_strptime(data_de_transacao, '%d/%m/%Y'),
                    try_strptime(data_de_transacao, '%m/%d/%Y')), '%Y-%m-%d')) AS dia,
       min(strftime(coalesce(try_strptime(data_de_transacao, '%Y-%m-%d'), try_strptime(data_de_transacao, '%m/%d/%Y'),
                    try_strptime(data_de_transacao, '%d/%m/%Y')), '%Y-%m-%d')) AS dia_mes_primeiro
FROM ({RAW_SQL}) GROUP BY data_de_transacao
""")
def _(spark, sf):
    cell = F.col("data_de_transacao")
    cells = raw_sales(spark, sf).groupBy(cell.alias("celula")).agg(F.count(F.lit(1)).alias("n"))
    return cells.select(
        "celula", "n", F.date_format(values.parse_date(F.col("celula")), "yyyy-MM-dd").alias("dia"),
        F.date_format(values.parse_date(F.col("celula"), "monthfirst"), "yyyy-MM-dd").alias("dia_mes_primeiro"),
    )


@query("b7_cep_digits", f"""
SELECT nullif(regexp_replace(cep, '[^0-9]', '', 'g'), '') AS cep, count(*) AS n FROM ({RAW_SQL}) GROUP BY 1
""")
def _(spark, sf):
    return raw_sales(spark, sf).groupBy(values.digits_only(F.col("cep")).alias("cep")).agg(F.count(F.lit(1)).alias("n"))


@query("b8_period_parts", """
SELECT ano, mes, ano * 100 + mes AS ano_mes, ano AS ano_de_volta, mes AS mes_de_volta, count(*) AS n FROM (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS ano, CAST(month(o_orderdate) AS INTEGER) AS mes FROM orders) GROUP BY ano, mes
""")
def _(spark, sf):
    dated = values.with_period(table(spark, sf, "orders"), "o_orderdate")
    back_year, back_month = values.split_period(F.col("ano_mes"))
    return dated.groupBy("ano", "mes", "ano_mes", back_year.alias("ano_de_volta"), back_month.alias("mes_de_volta")).agg(
        F.count(F.lit(1)).alias("n"))


@query("b9_price_per_m2", """
SELECT l_orderkey, l_extendedprice / nullif(l_quantity - 1, 0) AS valor_m2 FROM lineitem
""")
def _(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", values.price_per_m2(F.col("l_extendedprice"), F.col("l_quantity") - 1).alias("valor_m2"))


@query("b10_region_key", """
SELECT upper(trim(text_name)) AS regiao, upper(trim(CAST(s_suppkey AS VARCHAR))) AS regiao_sem_bairro
FROM (SELECT s_suppkey, '  ' || s_name || ' ' AS text_name FROM supplier)
""")
def _(spark, sf):
    rows = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("cep"), F.concat(F.lit("  "), F.col("s_name"), F.lit(" ")).alias("bairro"))
    with_region = values.region_key(rows)
    without = values.region_key(rows.drop("bairro"))
    return rows.select(with_region.alias("regiao"), without.alias("regiao_sem_bairro"))


@query("b11_period_label", f"""
SELECT CAST(ano AS VARCHAR) || '-' || lpad(CAST(mes AS VARCHAR), 2, '0') AS periodo, count(*) AS n FROM ({SALES_SQL}) GROUP BY 1
""")
def _(spark, sf):
    label = values.period_label(F.col("ano"), F.col("mes"))
    return sales(spark, sf).groupBy(label.alias("periodo")).agg(F.count(F.lit(1)).alias("n"))


@query("b12_lenient_numbers", """
SELECT celula, TRY_CAST(replace(celula, ',', '.') AS DOUBLE) AS real,
       CAST(trunc(TRY_CAST(replace(celula, ',', '.') AS DOUBLE)) AS INTEGER) AS inteiro
FROM (SELECT DISTINCT CASE WHEN l_linenumber = 1 THEN 'abc' WHEN l_linenumber = 2 THEN '-' ELSE '' END
        || replace(CAST(l_quantity * 1.25e0 AS VARCHAR), '.', ',') AS celula FROM lineitem)
""")
def _(spark, sf):
    line = F.col("l_linenumber")
    cell = F.concat(F.when(line == 1, "abc").when(line == 2, "-").otherwise(""),
                    F.replace((F.col("l_quantity") * 1.25).cast("string"), F.lit("."), F.lit(",")))
    rows = table(spark, sf, "lineitem").select(cell.alias("celula")).distinct()
    return rows.select("celula", values.lenient_double(F.col("celula")).alias("real"),
                       values.lenient_int(F.col("celula")).alias("inteiro"))


@query("b13_sanitize", """
SELECT conv_id, turn, trim(text, E' \\t\\n\\r') AS limpo FROM conversations
""")
def _(spark, sf):
    dirty = F.concat(F.lit("  \t\u0007"), F.regexp_replace("text", " ", "\u0001 "), F.lit("\u0003\n　"))
    return table(spark, sf, "conversations").select("conv_id", "turn", text.sanitize(dirty).alias("limpo"))


@query("b14_truncate", """
SELECT conv_id, turn, CASE WHEN length(text) > 160 THEN substr(text, 1, 160) || '...' ELSE text END AS curto FROM conversations
""")
def _(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", text.truncate(F.col("text")).alias("curto"))


@query("b15_token_estimate", """
SELECT doc_id, CAST(greatest(1, length(text) // 4) AS INTEGER) AS tokens FROM documents
""")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.estimate_tokens(F.col("text")).alias("tokens"))


@query("b16_property_from_text", """
SELECT l_orderkey, l_linenumber, CAST(l_quantity AS VARCHAR) AS area_do_terreno_m2, lpad(CAST(l_suppkey AS VARCHAR), 8, '0') AS cep,
       CASE WHEN l_returnflag = 'A' THEN CAST(year(l_shipdate) AS VARCHAR) END AS ano,
       CASE WHEN l_returnflag = 'A' THEN CAST(month(l_shipdate) AS VARCHAR) END AS mes,
       CASE WHEN l_returnflag <> 'A' THEN strftime(l_shipdate, '%Y%m') END AS ano_mes
FROM lineitem
""")
def _(spark, sf):
    supp = F.lpad(F.col("l_suppkey").cast("string"), 8, "0")
    period = F.when(
        F.col("l_returnflag") == "A",
        F.concat(F.lit("ano "), F.year("l_shipdate"), F.lit(" e MES "), F.month("l_shipdate")),
    ).otherwise(F.concat(F.lit("ano_mes "), F.date_format("l_shipdate", "yyyyMM")))
    sentence = F.concat(
        F.lit("Quanto vale um terreno com CEP "), F.substring(supp, 1, 5), F.lit("-"), F.substring(supp, 6, 3),
        F.lit(", Area "), F.replace(F.col("l_quantity").cast("string"), F.lit("."), F.lit(",")), F.lit(" e "), period, F.lit("?"),
    )
    return spread(table(spark, sf, "lineitem"), "l_orderkey").select(
        "l_orderkey", "l_linenumber", payload.property_from_text(sentence).alias("p")
    ).select("l_orderkey", "l_linenumber", "p.*")


@query("b17_payload_aliases", """
SELECT o_orderkey, lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS cep, CAST(o_totalprice AS DOUBLE) AS area_do_terreno_m2,
       CASE WHEN o_orderstatus = 'F' THEN CAST(year(o_orderdate) AS INTEGER) ELSE 2020 END AS ano,
       CASE WHEN o_orderstatus = 'F' THEN CAST(month(o_orderdate) AS INTEGER) ELSE 7 END AS mes
FROM orders
""")
def _(spark, sf):
    status, no_text = F.col("o_orderstatus"), F.lit(None).cast("string")
    cep = F.lpad(F.col("o_custkey").cast("string"), 8, "0")
    no_number = F.lit(None).cast("double")
    fields = payload.resolve_aliases(
        cep=F.when(status == "F", cep).otherwise(no_text), cep_prefixo=F.when(status != "F", cep).otherwise(no_text),
        area_do_terreno_m2=F.when(status == "O", F.col("o_totalprice")).otherwise(no_number), area=F.col("o_totalprice"),
        # year known, month missing: both come from the period
        ano=F.when(status != "P", F.year("o_orderdate").cast("string")).otherwise(no_text),
        mes=F.when(status == "F", F.month("o_orderdate").cast("string")).otherwise(no_text),
        ano_mes=F.lit("202007"),
    )
    return table(spark, sf, "orders").select("o_orderkey", fields.alias("p")).select("o_orderkey", "p.*")


@query("b18_regions_from_text", """
SELECT o_orderkey, 'Bairro ' || o_orderstatus AS region_a, 'Vila Jequitiba' AS region_b,
       CASE WHEN o_orderstatus = 'F' THEN 'valor_m2' END AS metric FROM orders
""")
def _(spark, sf):
    tail = F.when(F.col("o_orderstatus") == "F", " usando valor_m2").when(F.col("o_orderstatus") == "O", ".").otherwise("")
    sentence = F.concat(F.lit("Por favor COMPARE Bairro "), F.col("o_orderstatus"), F.lit(" e Vila Jequitiba"), tail)
    return table(spark, sf, "orders").select("o_orderkey", payload.regions_from_text(sentence).alias("p")).select(
        "o_orderkey", "p.*")


@query("b19_reply_payload", """
SELECT conv_id, turn, CASE WHEN turn % 3 = 2 THEN 'fallback' ELSE 'ok' END AS thought,
       CASE WHEN turn % 3 = 2 THEN 'final' ELSE role END AS action,
       CASE WHEN turn % 3 = 2 THEN '' ELSE '{"query":"q"}' END AS action_input,
       CASE WHEN turn % 3 = 2 THEN trim(text, E' \\t\\n\\r') ELSE text END AS final_answer
FROM conversations
""")
def _(spark, sf):
    body = F.to_json(F.struct(
        F.lit("ok").alias("thought"), F.col("role").alias("action"), F.struct(F.lit("q").alias("query")).alias("action_input"),
        F.col("text").alias("final_answer"),
    ))
    reply = (
        F.when(F.col("turn") % 3 == 0, body)
        .when(F.col("turn") % 3 == 1, F.concat(F.lit("Claro! ```json\n"), body, F.lit("\n```")))
        .otherwise(F.concat(F.col("text"), F.lit(" \n")))
    )
    return table(spark, sf, "conversations").select("conv_id", "turn", payload.reply_payload(reply).alias("p")).select(
        "conv_id", "turn", "p.*")


@query("b21_distinct_sources", """
SELECT doc_id, source || '|' || lang || CASE WHEN doc_id % 2 = 0 THEN '|extra' ELSE '' END AS sources FROM documents
""")
def _(spark, sf):
    entry = F.struct(F.array("source", "lang").alias("sources"))
    steps = F.array(F.struct(F.array("lang").alias("sources")),
                    F.struct(F.when(F.col("doc_id") % 2 == 0, F.array(F.lit("extra"))).otherwise(F.array("source")).alias("sources")))
    return table(spark, sf, "documents").select(
        "doc_id", F.array_join(payload.distinct_sources(F.array(entry), steps), "|").alias("sources"))
