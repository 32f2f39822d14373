"""The operators as registered queries over whole tables, with SQL checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query("op6_histogram_sort")
def op6(spark, sf):
    from .sharding import shard

    return shard(table(spark, sf, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op8_license_diagonals")
def op8(spark, sf):
    from .licenses import scan_licenses

    return scan_licenses(table(spark, sf, "documents"))


@query("op9_url_logistic")
def op9(spark, sf):
    from .urls import judge

    return judge(table(spark, sf, "pages")).select("page_id", "host", "path", "rule", "verdict", "score")


OP5_SQL = r"""
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM documents),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws
  FROM benchmark),
wins AS (
  SELECT DISTINCT item, least(len(ws), 10) AS n, ws[i : i + least(len(ws), 10) - 1] AS win
  FROM (SELECT item, ws, unnest(generate_series(1, greatest(len(ws) - 9, 1))) AS i FROM items WHERE len(ws) > 0)),
grams AS (
  SELECT doc_id, i, n, ws[i : i + n - 1] AS win
  FROM (SELECT doc_id, ws, n, unnest(generate_series(1, len(ws) - n + 1)) AS i FROM w, (SELECT DISTINCT n FROM wins) WHERE len(ws) >= n)),
occ AS (SELECT doc_id, i, n, item FROM grams JOIN wins USING (n, win)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM occ) GROUP BY doc_id),
named AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS s FROM occ GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@query("op5_prefix_windows", OP5_SQL)
def op5(spark, sf):
    from .decontaminate import scan

    return scan(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query("op2_segment_tree_bpe")
def op2(spark, sf):
    from .bpe import digest

    return digest(table(spark, sf, "documents"))


def remainder(divisor: int):
    """crc32 of doc_id as text, modulo ``divisor``."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(divisor))


@query("op7_bidirectional_gru")
def op7(spark, sf):
    from .language import fit, identify

    docs = table(spark, sf, "documents")
    network = fit(docs.where(remainder(3) != 1))
    return identify(docs, network).select(
        "doc_id", F.coalesce(remainder(3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")


OP4_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
sets AS (
  SELECT DISTINCT doc_id, ws[i : i + least(len(ws), 4) - 1] AS g
  FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(len(ws) - 3, 1))) AS i FROM w WHERE len(ws) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
coded AS (SELECT doc_id, hash(g) AS h FROM sets),
pair AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM coded a JOIN coded b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pair JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least_of AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM w LEFT JOIN sizes USING (doc_id) JOIN least_of ON least_of.doc_id = w.doc_id
"""


@query("op4_parity_sketch_join", OP4_SQL)
def op4(spark, sf):
    from .ngram_join import near_duplicates

    return near_duplicates(table(spark, sf, "documents"), size=4, percent=85)


OP10_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least_of AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
counted AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n, 0) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e LEFT JOIN counted USING (vec_id) JOIN least_of USING (vec_id)
"""


@query("op10_small_world_graphs", OP10_SQL)
def op10(spark, sf):
    from .embeddings import link_vectors

    return link_vectors(table(spark, sf, "embeddings"))


@query("op1_latent_neighbours")
def op1(spark, sf):
    from .quality import fit, score

    docs = table(spark, sf, "documents")
    voters = fit(docs, table(spark, sf, "labels"), remainder(5) != 0)
    held = docs.withColumn("held_out", F.coalesce(remainder(5) == 0, F.lit(False)))
    return score(held, voters, ["doc_id", "held_out"])


@query("op3_boosted_spans")
def op3(spark, sf):
    from .pii import detect

    return detect(table(spark, sf, "documents"))


OP13_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, doc_id, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM pieces),
total AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
places AS (SELECT lang, ws, unnest(generate_series(1, len(ws))) AS i FROM w WHERE len(ws) > 0),
grams AS (SELECT lang, k, array_to_string(ws[i : i + k - 1], ' ') AS phrase FROM places, (VALUES (1), (2), (3)) s(k) WHERE i + k - 1 <= len(ws)),
f AS (SELECT lang, k, phrase, count(*) AS n FROM grams GROUP BY ALL HAVING count(*) >= 10),
c AS (SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS ws FROM f WHERE k >= 2),
cuts AS (SELECT lang, phrase, a, ws, j, array_to_string(ws[1:j], ' ') AS p, array_to_string(ws[j + 1:], ' ') AS q
  FROM c, (VALUES (1), (2)) t(j) WHERE j < k),
scored AS (SELECT cuts.lang, cuts.phrase, a, ws, j, x.n AS l, y.n AS r, CAST((1000000::HUGEINT * a * a) // (x.n::HUGEINT * y.n) AS BIGINT) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = p JOIN f y ON y.lang = cuts.lang AND y.phrase = q),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
parts AS (SELECT lang, a, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS phrase FROM c WHERE k = 3),
longer AS (SELECT lang, phrase, max(a) AS m FROM parts GROUP BY lang, phrase)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM weakest JOIN total USING (lang) LEFT JOIN longer USING (lang, phrase)
WHERE m IS NULL OR 100 * m < 50 * a
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000
"""


@query("op13_son_phrases", OP13_SQL)
def op13(spark, sf):
    from .phrases import collocations

    return collocations(table(spark, sf, "documents"))


OP12_SQL = """
WITH RECURSIVE d AS (
  SELECT *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents),
base AS (
  SELECT doc_id, source, coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || CAST(doc_id AS VARCHAR), '-')
    || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
    || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || CAST(n_chars AS VARCHAR), '-') AS head,
    coalesce(strlen(text) || ':' || text, '-') AS tail, coalesce(strlen(low) || ':' || low, '-') AS low_tail FROM d),
crc_byte AS (
  SELECT 0 AS step, v AS b, v AS c FROM range(256) r(v)
  UNION ALL SELECT step + 1, b, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END FROM crc_byte WHERE step < 8),
crc_table AS (SELECT list(c ORDER BY b) AS t FROM crc_byte WHERE step = 8),
crc AS (
  SELECT doc_id, CAST(doc_id AS VARCHAR) AS s, CAST(1 AS BIGINT) AS pos, CAST(4294967295 AS BIGINT) AS c FROM documents WHERE doc_id IS NOT NULL
  UNION ALL SELECT doc_id, s, pos + 1, xor(c // 256, t[CAST(xor(c % 256, ascii(s[pos])) AS INTEGER) + 1]) FROM crc, crc_table WHERE pos <= length(s)),
changed AS (SELECT DISTINCT doc_id FROM crc WHERE pos = length(s) + 1 AND xor(c, 4294967295) % 5 = 0),
leaf AS (
  SELECT doc_id, source, sha256(head || tail) AS leaf, sha256(head || CASE WHEN doc_id IN (SELECT doc_id FROM changed) THEN low_tail ELSE tail END) AS told
  FROM base),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM leaf),
lev AS (
  SELECT source, 0 AS l, i, leaf AS h, n AS c FROM placed
  UNION ALL SELECT source, l + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)), any_value((c + 15) // 16) FROM lev WHERE c > 1 GROUP BY source, l, i // 16),
sub AS (SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM lev WHERE c = 1),
top AS (
  SELECT 0 AS l, i, subroot AS h, n AS c FROM sub
  UNION ALL SELECT l + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)), any_value((c + 15) // 16) FROM top WHERE c > 1 GROUP BY l, i // 16),
path AS (
  SELECT p.source, p.i AS leaf_i, v.l, coalesce(string_agg(v.h, '' ORDER BY v.i) FILTER (v.i < p.i // CAST(16 ** v.l AS BIGINT)), '') AS before,
    coalesce(string_agg(v.h, '' ORDER BY v.i) FILTER (v.i > p.i // CAST(16 ** v.l AS BIGINT)), '') AS after
  FROM placed p JOIN lev v ON v.source IS NOT DISTINCT FROM p.source AND v.c > 1 AND v.i // 16 = p.i // CAST(16 ** v.l AS BIGINT) // 16
  GROUP BY p.source, p.i, v.l),
above AS (
  SELECT s.source, v.l, coalesce(string_agg(v.h, '' ORDER BY v.i) FILTER (v.i < s.i // CAST(16 ** v.l AS BIGINT)), '') AS before,
    coalesce(string_agg(v.h, '' ORDER BY v.i) FILTER (v.i > s.i // CAST(16 ** v.l AS BIGINT)), '') AS after
  FROM sub s JOIN top v ON v.c > 1 AND v.i // 16 = s.i // CAST(16 ** v.l AS BIGINT) // 16 GROUP BY s.source, v.l),
whole AS (
  SELECT source, leaf_i, l AS pos, before, after FROM path
  UNION ALL SELECT p.source, p.i, a.l + 1000, a.before, a.after FROM placed p JOIN above a ON a.source IS NOT DISTINCT FROM p.source),
steps AS (SELECT source, leaf_i, before, after, row_number() OVER (PARTITION BY source, leaf_i ORDER BY pos) AS k FROM whole),
proof AS (SELECT source, leaf_i, sha256(string_agg(before || after, '' ORDER BY k)) AS proof_sha256, max(k) AS steps FROM steps GROUP BY source, leaf_i),
fold AS (
  SELECT source, i, 0 AS k, told AS h FROM placed
  UNION ALL SELECT f.source, f.i, f.k + 1, sha256(s.before || f.h || s.after)
    FROM fold f JOIN steps s ON s.source IS NOT DISTINCT FROM f.source AND s.leaf_i = f.i AND s.k = f.k + 1),
ends AS (SELECT source, i, arg_max(h, k) AS folded_root FROM fold GROUP BY source, i)
SELECT p.doc_id, p.leaf, s.subroot, (SELECT h FROM top WHERE c = 1) AS root, coalesce(r.proof_sha256, sha256('')) AS proof_sha256, e.folded_root,
  e.folded_root = (SELECT h FROM top WHERE c = 1) AS verified
FROM placed p JOIN sub s ON s.source IS NOT DISTINCT FROM p.source JOIN ends e ON e.source IS NOT DISTINCT FROM p.source AND e.i = p.i
LEFT JOIN proof r ON r.source IS NOT DISTINCT FROM p.source AND r.leaf_i = p.i
"""


@query("op12_postorder_manifest", OP12_SQL)
def op12(spark, sf):
    from .merkle import lowered, manifest

    return manifest(table(spark, sf, "documents"), tampered=(remainder(5) == 0, {"text": lowered(F.col("text"))}))


@query("op11_kmeans_tree_search")
def op11(spark, sf):
    from .neighbours import search

    return search(table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0)
