"""Sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.payload import model_version
from ..session import scratch_path
from ..sources import fingerprint, links, raw, registry, sinks
from .registry import query, table
from .views import RAW_SQL, SALES_SQL, raw_sales, sales

_PART_COLUMNS = ("n_do_cadastro", "bairro", "cep", "data_de_transacao", "valor_venal_de_referencia",
                 "area_do_terreno_m2", "descricao_do_uso_iptu")


@query("a1_union_monthly_parts", """
SELECT lpad(CAST(l_partkey AS VARCHAR), 6, '0') AS n_do_cadastro, 'B' || CAST(l_suppkey AS VARCHAR) AS bairro,
       CAST(l_orderkey AS VARCHAR) AS cep, strftime(l_shipdate, '%d/%m/%Y') AS data_de_transacao,
       format('{:.2f}', l_extendedprice) AS valor_venal_de_referencia,
       CASE WHEN l_returnflag = 'R' THEN l_linestatus END AS coluna_extra_28,
       'itbi_' || l_returnflag || '.xlsx' AS arquivo, 'JAN-2024' AS aba
FROM lineitem WHERE l_quantity < 50
""")
def _(spark, sf):
    # Three parts, one of them with an extra column; rows with quantity 50 are empty.
    li = table(spark, sf, "lineitem")
    cells = {
        0: F.lpad(F.col("l_partkey").cast("string"), 6, "0"),
        4: F.concat(F.lit("B"), F.col("l_suppkey").cast("string")),
        6: F.col("l_orderkey").cast("string"),
        9: F.date_format("l_shipdate", "dd/MM/yyyy"),
        10: F.format_string("%.2f", "l_extendedprice"),
        28: F.col("l_linestatus"),
    }

    def part(flag: str, width: int):
        empty = F.lit(None).cast("string")
        columns = [F.when(F.col("l_quantity") < 50, cells.get(i, empty)).alias(f"_c{i}") for i in range(width)]
        return raw.name_part(li.where(F.col("l_returnflag") == flag).select(*columns),
                             F.lit(f"itbi_{flag}.xlsx"), F.lit("JAN-2024"))

    out = raw.union_parts([part("A", 28), part("N", 28), part("R", 29)])
    return out.select("n_do_cadastro", "bairro", "cep", "data_de_transacao", "valor_venal_de_referencia",
                      "coluna_extra_28", "arquivo", "aba")


@query("a1_landed_parts", """
SELECT lpad(CAST(l_partkey AS VARCHAR), 6, '0') AS n_do_cadastro,
       'B' || CAST(l_suppkey AS VARCHAR) || chr(10) || 'rua; "' || CAST(l_linenumber AS VARCHAR) || '"' AS bairro,
       strftime(l_shipdate, '%d/%m/%Y') AS data_de_transacao, CASE WHEN l_returnflag = 'R' THEN l_linestatus END AS coluna_extra_28,
       'itbi_' || l_returnflag || '.xlsx' AS arquivo, CASE WHEN l_linestatus = 'F' THEN 'JAN-2024' ELSE 'fev-2024' END AS aba
FROM lineitem WHERE l_quantity < 50
""")
def _(spark, sf):
    # Parts of two widths with line breaks, separators and quotes inside cells; the sheet without a month is passed over.
    li = table(spark, sf, "lineitem")
    root = scratch_path(spark, "landed")
    text = F.concat(F.lit("B"), F.col("l_suppkey").cast("string"), F.lit('\nrua; "'), F.col("l_linenumber").cast("string"), F.lit('"'))
    cells = {0: F.lpad(F.col("l_partkey").cast("string"), 6, "0"), 4: text, 9: F.date_format("l_shipdate", "dd/MM/yyyy"), 28: F.col("l_linestatus")}
    for flag, width in (("A", 28), ("N", 28), ("R", 29)):
        columns = [F.when(F.col("l_quantity") < 50, cells.get(i, F.lit(None).cast("string"))).alias(f"_c{i}") for i in range(width)]
        for status, aba in (("F", "JAN-2024"), ("O", "fev-2024"), ("O", "Resumo")):
            part = li.where((F.col("l_returnflag") == flag) & (F.col("l_linestatus") == status))
            if not part.isEmpty():
                sinks.write_part(part.select(*columns), root, f"itbi_{flag}.xlsx", aba)
    return raw.read_monthly_parts(spark, root).select(
        "n_do_cadastro", "bairro", "data_de_transacao", "coluna_extra_28", "arquivo", "aba")


_SHEETS = "array('JAN','FEV','MAR','ABR','MAI','JUN','JUL','AGO','SET','OUT','NOV','DEZ')"


@query("a2_month_sheets", """
WITH named AS (
  SELECT CASE o_orderpriority WHEN '1-URGENT' THEN ' ' || m || '-' || y WHEN '2-HIGH' THEN lower(m) || '-' || y
              WHEN '3-MEDIUM' THEN 'Resumo ' || m || '-' || y ELSE m || '-' || y END AS aba
  FROM (SELECT o_orderpriority, CAST(year(o_orderdate) AS VARCHAR) AS y,
               ['JAN','FEV','MAR','ABR','MAI','JUN','JUL','AGO','SET','OUT','NOV','DEZ'][month(o_orderdate)] AS m
        FROM orders))
SELECT aba, count(*) AS n FROM named
WHERE regexp_matches(upper(trim(aba)), '^(JAN|FEV|MAR|ABR|MAI|JUN|JUL|AGO|SET|OUT|NOV|DEZ)-20[0-9][0-9]$')
GROUP BY aba
""")
def _(spark, sf):
    code = F.expr(f"element_at({_SHEETS}, month(o_orderdate))")
    name = F.concat(code, F.lit("-"), F.year("o_orderdate").cast("string"))
    priority = F.col("o_orderpriority")
    sheet = (
        F.when(priority == "1-URGENT", F.concat(F.lit(" "), name)).when(priority == "2-HIGH", F.lower(name))
        .when(priority == "3-MEDIUM", F.concat(F.lit("Resumo "), name)).otherwise(name)
    )
    named = table(spark, sf, "orders").select(sheet.alias("aba"))
    return named.where(raw.is_month_sheet(F.col("aba"))).groupBy("aba").agg(F.count(F.lit(1)).alias("n"))


def _through_csv(spark, df, label):
    path = scratch_path(spark, label)
    sinks.write_delimited(df, path)
    return raw.read_delimited(spark, path, df.columns)


@query("a3_semicolon_scan", RAW_SQL)
def _(spark, sf):
    return _through_csv(spark, raw_sales(spark, sf).select(
        "n_do_cadastro", "bairro", "cep", "data_de_transacao", "valor_venal_de_referencia",
        "area_do_terreno_m2", "descricao_do_uso_iptu"), "scan")


@query("a4_feature_scan", """
SELECT lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS cep, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS valor,
       CAST(year(o_orderdate) AS INTEGER) AS ano FROM orders WHERE o_orderstatus <> 'P'
""")
def _(spark, sf):
    rows = table(spark, sf, "orders").select(
        F.lpad(F.col("o_custkey").cast("string"), 8, "0").alias("cep"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("valor"),
        F.year("o_orderdate").alias("ano"),
    )
    return raw.load_feature_table(rows, ["cep", "valor", "ano"])


_LINKS_SQL = """
WITH anchors AS (
  SELECT page_id, url, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href,
         unnest(regexp_extract_all(html, '<a href="[^"]*">([^<]*)</a>', 1)) AS context,
         generate_subscripts(regexp_extract_all(html, '<a href="([^"]*)"', 1), 1) - 1 AS pos
  FROM pages)
"""


@query("a5_page_links", _LINKS_SQL + """
SELECT page_id, CAST(pos AS INTEGER) AS pos, href, context FROM anchors
""")
def _(spark, sf):
    return links.page_links(table(spark, sf, "pages")).select("page_id", "pos", "href", "context")


_KEYED_SQL = _LINKS_SQL + """
, keyed AS (
  SELECT page_id, pos, coalesce(nullif(regexp_extract(context, '([a-z]{2})', 1), ''),
                                nullif(regexp_extract(href, '([a-z]{2})', 1), '')) AS key,
         regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || href AS link
  FROM anchors WHERE contains(lower(href), '/') AND contains(lower(href), 'e'))
SELECT page_id, key, max_by(link, pos) AS link FROM keyed WHERE key IS NOT NULL GROUP BY page_id, key
"""


def _keyed(spark, sf):
    return links.keyed_links(table(spark, sf, "pages"), suffix="/", keyword="e", key_pattern="([a-z]{2})")


@query("a5_keyed_links", _KEYED_SQL)
def _(spark, sf):
    return _keyed(spark, sf)


@query("a5_year_links", _LINKS_SQL.replace("FROM pages)", """FROM (
  SELECT page_id, url, '<p><strong>Ano 20' || lpad(CAST(page_id % 30 AS VARCHAR), 2, '0')
    || '</strong></p><ul><li><a href="/d/ITBI_' || CAST(page_id AS VARCHAR) || '.XLSX">x</a></li></ul>' || html AS html
  FROM pages))""") + """
SELECT page_id, CAST(2000 + page_id % 30 AS INTEGER) AS year, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || href AS link
FROM anchors WHERE contains(lower(href), '.xlsx') AND contains(lower(href), 'itbi') AND page_id % 30 BETWEEN 10 AND 25
""")
def _(spark, sf):
    key = F.col("page_id")
    lead = F.concat(
        F.lit("<p><strong>Ano 20"), F.lpad((key % 30).cast("string"), 2, "0"),
        F.lit('</strong></p><ul><li><a href="/d/ITBI_'), key.cast("string"), F.lit('.XLSX">x</a></li></ul>'), F.col("html"),
    )
    return links.year_links(table(spark, sf, "pages").withColumn("html", lead), 2010, 2025)


@query("a6_source_manifest", _KEYED_SQL.replace("SELECT page_id, key, max_by", ", best AS (SELECT page_id, key, max_by") + """)
SELECT page_id, string_agg(key || '=' || link, ' ' ORDER BY key) AS manifest FROM best GROUP BY page_id
""")
def _(spark, sf):
    manifest = links.source_manifest(_keyed(spark, sf), key="key")
    path = scratch_path(spark, "manifest")
    sinks.write_json_report(manifest, path)
    back = spark.read.schema(manifest.schema).json(path)
    text = F.array_join(F.transform("years", lambda e: F.concat(e["year"], F.lit("="), e["url"])), " ")
    return back.select("page_id", text.alias("manifest"))


@query("a7_file_name_period", """
SELECT arquivo, regexp_extract(arquivo, '([0-9]{4}).*?([0-9]{2})', 1) AS ano,
       regexp_extract(arquivo, '([0-9]{4}).*?([0-9]{2})', 2) AS mes,
       CAST(o_orderkey AS INTEGER) AS numero
FROM (SELECT o_orderkey, 'itbi-' || strftime(o_orderdate, '%Y-%m') || '_' || CAST(o_orderkey AS VARCHAR) || '.xlsx' AS arquivo
      FROM orders)
""")
def _(spark, sf):
    name = F.concat(F.lit("itbi-"), F.date_format("o_orderdate", "yyyy-MM"), F.lit("_"),
                    F.col("o_orderkey").cast("string"), F.lit(".xlsx"))
    files = table(spark, sf, "orders").select(name.alias("arquivo"))
    ano, mes = raw.period_from_file_name(F.col("arquivo"))
    return files.select("arquivo", ano.alias("ano"), mes.alias("mes"),
                        raw.year_from_file_name(F.col("arquivo")).alias("numero"))


@query("a8_text_documents", """
SELECT CAST(item_id AS VARCHAR) AS item, text || E'\\n' AS content FROM benchmark
""")
def _(spark, sf):
    # One file per benchmark item, as documents land.
    path = scratch_path(spark, "documents")
    items = table(spark, sf, "benchmark").select("item_id", "text")
    items.write.partitionBy("item_id").text(path)
    docs = raw.read_text_documents(spark, path)
    return docs.select(F.regexp_extract("source", "item_id=([0-9]+)", 1).alias("item"), "content")


@query("a9_golden_set", """
SELECT 'q' || lpad(CAST(item_id AS VARCHAR), 6, '0') AS id, text AS question, 'rag_search' AS expected_tool,
       'Resposta: ' || text AS reference_answer, 'rag' AS category
FROM benchmark ORDER BY item_id LIMIT 20
""")
def _(spark, sf):
    golden = table(spark, sf, "benchmark").select(
        F.concat(F.lit("q"), F.lpad(F.col("item_id").cast("string"), 6, "0")).alias("id"),
        F.col("text").alias("question"), F.lit("rag_search").alias("expected_tool"),
        F.concat(F.lit("Resposta: "), "text").alias("reference_answer"), F.lit("rag").alias("category"),
    )
    path = scratch_path(spark, "golden")
    sinks.write_json_report(golden, path)
    return raw.read_golden_set(spark, path)


@query("a10_row_sample", """
SELECT o_custkey, o_totalprice, o_orderpriority FROM orders
ORDER BY md5(CAST(o_orderkey AS VARCHAR) || '|42'), o_orderkey LIMIT 5000
""")
def _(spark, sf):
    return raw.sample_rows(table(spark, sf, "orders"), ["o_custkey", "o_totalprice", "o_orderpriority"],
                           ["o_orderkey"], n=5000, hasher="md5")


@query("a11_delimited_sink", f"SELECT cep, bairro, CAST(ano AS VARCHAR) AS ano, CAST(mes AS VARCHAR) AS mes FROM ({SALES_SQL})")
def _(spark, sf):
    return _through_csv(spark, sales(spark, sf).select("cep", "bairro", "ano", "mes"), "features")


@query("a12_json_report", f"""
SELECT bairro, count(*) AS n, max(valor_venal_de_referencia) AS maior, NULL::VARCHAR AS observacao
FROM ({SALES_SQL}) GROUP BY bairro
""")
def _(spark, sf):
    report = sales(spark, sf).groupBy("bairro").agg(
        F.count(F.lit(1)).alias("n"), F.max("valor_venal_de_referencia").alias("maior"),
        F.lit(None).cast("string").alias("observacao"),
    )
    path = scratch_path(spark, "report")
    sinks.write_json_report(report, path)
    return spark.read.schema(report.schema).json(path)


@query("a13_run_export", """
WITH c AS (SELECT conv_id, count(*) AS n, string_agg(role, '|' ORDER BY turn) AS roles, arg_min(text, turn) AS q,
                  arg_max(text, turn) AS a, sum(length(text)) AS size FROM conversations GROUP BY conv_id)
SELECT 'top_k_' || CAST(conv_id % 3 AS VARCHAR) AS config_name, CAST(conv_id % 3 AS VARCHAR) AS rag_top_k, CAST(conv_id AS VARCHAR) AS id,
       'rag' AS category, 'rag_search' AS expected_tool, roles AS tools_used, CAST(n AS VARCHAR) AS chunks_retrieved,
       CAST(size AS VARCHAR) AS latency_ms, CAST(length(a) AS VARCHAR) AS response_length,
       CASE WHEN conv_id % 5 = 0 THEN 'false' ELSE 'true' END AS success, CASE WHEN conv_id % 5 = 0 THEN 'timeout; "late"' END AS error,
       roles AS sources, q AS question, a || chr(10) || '"' || q || '", fim' AS answer
FROM c
""")
def _(spark, sf):
    turns = F.array_sort(F.collect_list(F.struct("turn", "role")))
    talks = table(spark, sf, "conversations").groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n"), F.transform(turns, lambda x: x["role"]).alias("roles"), F.min_by("text", "turn").alias("q"),
        F.max_by("text", "turn").alias("a"), F.sum(F.length("text")).alias("size"))
    late = F.col("conv_id") % 5 == 0
    runs = talks.select(
        F.concat(F.lit("top_k_"), F.col("conv_id") % 3).alias("config_name"), (F.col("conv_id") % 3).alias("rag_top_k"),
        F.col("conv_id").alias("id"), F.lit("rag").alias("category"), F.lit("rag_search").alias("expected_tool"),
        F.col("roles").alias("tools_used"), F.col("n").alias("chunks_retrieved"), F.col("size").alias("latency_ms"),
        F.length("a").alias("response_length"), (~late).alias("success"), F.when(late, 'timeout; "late"').alias("error"),
        F.col("roles").alias("sources"), F.col("q").alias("question"),
        F.concat("a", F.lit('\n"'), "q", F.lit('", fim')).alias("answer"))
    path = scratch_path(spark, "runs")
    sinks.write_runs(runs, f"{path}/json", f"{path}/csv")
    return raw.read_delimited(spark, f"{path}/csv", sinks.RUN_COLUMNS, sep=",")


@query("a14_table_fingerprint", """
WITH h AS (
  SELECT count(*) AS n, sum(CAST(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || '|' || CAST(o_custkey AS VARCHAR) || '|'
         || o_orderstatus || '|' || format('{:.2f}', o_totalprice) || '|' || strftime(o_orderdate, '%Y-%m-%d') || '|'
         || o_orderpriority), 1, 15)) AS BIGINT)::HUGEINT) AS s
  FROM orders)
SELECT n AS "rows", sha256(CAST(n AS VARCHAR) || ':' || CAST(s AS VARCHAR)) AS digest,
       'orders_' || substr(sha256(CAST(n AS VARCHAR) || ':' || CAST(s AS VARCHAR)), 1, 12) AS version
FROM h
""")
def _(spark, sf):
    columns = [
        F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus"), F.format_string("%.2f", "o_totalprice"),
        F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderpriority"),
    ]
    return fingerprint.table_fingerprint(table(spark, sf, "orders"), columns, hasher="md5", stem="orders")


@query("a16_newest_model", """
WITH r AS (
  SELECT CASE o_orderstatus WHEN 'F' THEN 'prod' WHEN 'O' THEN 'dev' ELSE 'test' END AS env,
         'model_' || strftime(o_orderdate, '%Y.%m.%d') || '.' || lpad(CAST(o_orderkey % 2400 AS VARCHAR), 4, '0') AS name
  FROM orders)
SELECT env, 'models/' || env || '/' || max(name) AS path, substr(max(name), 7) AS version FROM r GROUP BY env
""")
def _(spark, sf):
    env = F.when(F.col("o_orderstatus") == "F", "prod").when(F.col("o_orderstatus") == "O", "dev").otherwise("test")
    name = F.concat(F.lit("model_"), F.date_format("o_orderdate", "yyyy.MM.dd"), F.lit("."),
                    F.lpad((F.col("o_orderkey") % 2400).cast("string"), 4, "0"))
    rows = table(spark, sf, "orders").select(env.alias("env"), F.concat_ws("/", F.lit("models"), env, name).alias("path"))
    return registry.newest_models(rows)


_REGISTRY_SQL = """
WITH r AS (
  SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'prod' WHEN '2-HIGH' THEN 'dev' ELSE 'test' END AS env,
         strftime(o_orderdate, '%Y.%m.%d') || '.' || lpad(CAST(o_orderkey % 2400 AS VARCHAR), 4, '0') AS version FROM orders)
"""


@query("a16_resolve_model", _REGISTRY_SQL + """
SELECT 'any' AS asked, 'prod' AS env, max(version) AS version FROM r WHERE env = 'prod'
UNION ALL SELECT 'newest of dev', 'dev', (SELECT max(version) FROM r WHERE env = 'dev' AND version NOT IN (SELECT version FROM r WHERE env = 'prod'))
UNION ALL SELECT 'not prod', 'dev', max(version) FROM r WHERE env = 'dev'
""")
def _(spark, sf):
    # Production first; a version that only dev has is found there; without production the newest of dev.
    env = F.when(F.col("o_orderpriority") == "1-URGENT", "prod").when(F.col("o_orderpriority") == "2-HIGH", "dev").otherwise("test")
    version = F.concat(F.date_format("o_orderdate", "yyyy.MM.dd"), F.lit("."), F.lpad((F.col("o_orderkey") % 2400).cast("string"), 4, "0"))
    rows = table(spark, sf, "orders").select(env.alias("env"), F.concat(F.lit("models/"), env, F.lit("/model_"), version).alias("path"))
    made = rows.withColumn("version", model_version(F.col("path")))
    alone = made.where("env = 'dev'").join(made.where("env = 'prod'").select("version").distinct(), "version", "left_anti")
    asked = alone.agg(F.max("version")).first()[0]
    found = [("any", registry.resolve_model(rows)), ("newest of dev", registry.resolve_model(rows, version=asked)),
             ("not prod", registry.resolve_model(rows.where("env <> 'prod'")))]
    parts = [one.select(F.lit(name).alias("asked"), "env", "version") for name, one in found]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("b20_model_version", """
SELECT path, CASE WHEN o_orderstatus = 'P' THEN 'unknown' ELSE strftime(o_orderdate, '%Y.%m.%d') || '.1200' END AS version
FROM (SELECT o_orderstatus, o_orderdate,
             CASE WHEN o_orderstatus = 'P' THEN 'models/tmp/' || strftime(o_orderdate, '%Y.%m.%d')
                  ELSE 'models/prod/model_' || strftime(o_orderdate, '%Y.%m.%d') || '.1200' END AS path FROM orders)
""")
def _(spark, sf):
    day = F.date_format("o_orderdate", "yyyy.MM.dd")
    path = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("models/tmp/"), day)).otherwise(
        F.concat(F.lit("models/prod/model_"), day, F.lit(".1200")))
    return table(spark, sf, "orders").select(path.alias("path"), model_version(path).alias("version"))
