"""Drift and column summaries over the event stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import drift, splits
from .registry import query, table

_CUT = "2024-01-16 00:00:00"
_SIDES = f"""
WITH e AS (SELECT ts < TIMESTAMP '{_CUT}' AS ref, value AS price, CAST(user_id AS DOUBLE) AS usuario,
                  CAST(hour(ts) AS DOUBLE) + CASE WHEN ts < TIMESTAMP '{_CUT}' THEN 0 ELSE 3 END AS hora,
                  event_type AS tipo, CASE WHEN ts < TIMESTAMP '{_CUT}' AND user_id > 20 THEN 'a' ELSE 'b' END AS grupo FROM events)
"""


def _sides(spark, sf):
    cut = F.lit(_CUT).cast("timestamp_ntz")
    before = F.col("ts") < cut
    rows = table(spark, sf, "events").select(
        "ts", F.col("value").alias("price"), F.col("user_id").cast("double").alias("usuario"),
        (F.hour("ts").cast("double") + F.when(before, 0).otherwise(3)).alias("hora"), F.col("event_type").alias("tipo"),
        F.when(before & (F.col("user_id") > 20), "a").otherwise("b").alias("grupo"))
    return splits.temporal_reference_current(rows, "ts", cut)


def _numeric_sql(column: str) -> str:
    return f"""
SELECT '{column}' AS "column", max(tr) AS n_ref, max(tc) AS n_cur, round(max(g), 8) AS ks, round(sum(g * w) / max(s), 6) AS wasserstein
FROM (SELECT abs(cr / tr - cc / tc) AS g, coalesce(lead(v) OVER (ORDER BY v) - v, 0) AS w, tr, tc, s FROM (
  SELECT v, sum(r) OVER (ORDER BY v) AS cr, sum(c) OVER (ORDER BY v) AS cc, sum(r) OVER () AS tr, sum(c) OVER () AS tc,
         (SELECT greatest(stddev_pop({column}), 0.001) FROM e WHERE ref) AS s
  FROM (SELECT {column} AS v, CAST(count(*) FILTER (ref) AS BIGINT) AS r, CAST(count(*) FILTER (NOT ref) AS BIGINT) AS c FROM e GROUP BY 1)))
"""


_NUMERIC = _SIDES + ", n AS (" + " UNION ALL ".join(_numeric_sql(c) for c in ("price", "usuario", "hora")) + ")"
_NUMERIC_ROWS = """SELECT "column", CAST(n_ref AS BIGINT) AS n_ref, CAST(n_cur AS BIGINT) AS n_cur, ks, wasserstein, wasserstein >= 0.1 AS drifted FROM n"""


@query("g1_numeric_drift", _NUMERIC + _NUMERIC_ROWS)
def _(spark, sf):
    out = drift.numeric_drift(_sides(spark, sf), ["price", "usuario", "hora"])
    return out.select("column", "n_ref", "n_cur", F.round("ks", 8).alias("ks"), F.round("wasserstein", 6).alias("wasserstein"), "drifted")


def _categorical_sql(column: str) -> str:
    return f"""
SELECT '{column}' AS "column", round(sqrt(greatest(sum(CASE WHEN p > 0 THEN p * ln(p / m) ELSE 0 END + CASE WHEN q > 0 THEN q * ln(q / m) ELSE 0 END) / 2, 0)), 7) AS jensen_shannon,
       round(sum((greatest(q, 0.0001) - greatest(p, 0.0001)) * ln(greatest(q, 0.0001) / greatest(p, 0.0001))), 7) AS psi
FROM (SELECT p, q, (p + q) / 2 AS m FROM (
  SELECT count(*) FILTER (ref) / (SELECT count(*) FROM e WHERE ref)::DOUBLE AS p, count(*) FILTER (NOT ref) / (SELECT count(*) FROM e WHERE NOT ref)::DOUBLE AS q
  FROM e GROUP BY {column}))
"""


_CATEGORICAL = "c AS (" + " UNION ALL ".join(_categorical_sql(c) for c in ("tipo", "grupo")) + ")"


@query("g1_categorical_drift", _SIDES + "," + _CATEGORICAL + "SELECT *, jensen_shannon >= 0.1 AS drifted FROM c")
def _(spark, sf):
    out = drift.categorical_drift(_sides(spark, sf), ["tipo", "grupo"])
    return out.select("column", F.round("jensen_shannon", 7).alias("jensen_shannon"), F.round("psi", 7).alias("psi"), "drifted")


@query("g2_dataset_drift", _NUMERIC + "," + _CATEGORICAL + """
, f AS (SELECT wasserstein >= 0.1 AS d FROM n UNION ALL SELECT jensen_shannon >= 0.1 FROM c)
SELECT count(*) AS columns, count(*) FILTER (d) AS drifted_columns, round(avg(CAST(d AS INTEGER)), 6) AS drift_share,
       avg(CAST(d AS INTEGER)) >= 0.3 AS dataset_drift FROM f
""")
def _(spark, sf):
    report = drift.drift_report(_sides(spark, sf), ["price", "usuario", "hora"], ["tipo", "grupo"])
    return drift.dataset_drift(report).withColumn("drift_share", F.round("drift_share", 6))


@query("g3_target_drift", _NUMERIC + _NUMERIC_ROWS + """ WHERE "column" = 'price'""")
def _(spark, sf):
    out = drift.numeric_drift(_sides(spark, sf).select("sample", "price"), ["price"])
    return out.select("column", "n_ref", "n_cur", F.round("ks", 8).alias("ks"), F.round("wasserstein", 6).alias("wasserstein"), "drifted")


def _summary_sql(column: str) -> str:
    return f"""
SELECT '{column}' AS "column", count({column}) AS count, count(*) - count({column}) AS nulls, count(DISTINCT {column}) AS "distinct",
       min({column})::DOUBLE AS min, max({column})::DOUBLE AS max, round(avg({column}), 6) AS mean, round(stddev_samp({column}), 6) AS std,
       round(quantile_cont({column}::DOUBLE, 0.25), 5) AS p25, round(quantile_cont({column}::DOUBLE, 0.5), 5) AS p50,
       round(quantile_cont({column}::DOUBLE, 0.75), 5) AS p75,
       (SELECT {column}::DOUBLE FROM t WHERE {column} IS NOT NULL GROUP BY {column} ORDER BY count(*) DESC, {column} LIMIT 1) AS mode FROM t
"""


@query("g4_column_summary", """
WITH t AS (SELECT value, user_id, CASE WHEN event_type = 'error' THEN NULL ELSE hour(ts) END AS hora FROM events)
""" + " UNION ALL ".join(_summary_sql(c) for c in ("value", "user_id", "hora")))
def _(spark, sf):
    rows = table(spark, sf, "events").select(
        "value", "user_id", F.when(F.col("event_type") != "error", F.hour("ts")).alias("hora"))
    out = drift.column_summary(rows, ["value", "user_id", "hora"])
    digits = {"mean": 6, "std": 6, "p25": 5, "p50": 5, "p75": 5}
    return out.withColumns({c: F.round(c, d) for c, d in digits.items()})
