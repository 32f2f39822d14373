"""Splits over time."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import splits
from .registry import query, table
from .views import DEALS_SQL, SCORED_SQL, deals, scored


@query("e1_temporal_holdout", f"""
WITH s AS ({SCORED_SQL}), n AS (SELECT count(*) AS n FROM s)
SELECT id, CASE WHEN row_number() OVER (ORDER BY ano, mes, id) <= n - greatest(1, CAST(floor(n * 0.2e0) AS BIGINT))
                THEN 'train' ELSE 'test' END AS split FROM s, n
""")
def _(spark, sf):
    return splits.temporal_holdout(scored(spark, sf), "id").select("id", "split")


@query("e2_period_range", f"""
WITH s AS ({SCORED_SQL})
SELECT priority, strftime(make_date(min(ano * 100 + mes) // 100, min(ano * 100 + mes) % 100, 1), '%Y-%m') AS period_start,
       strftime(make_date(max(ano * 100 + mes) // 100, max(ano * 100 + mes) % 100, 1), '%Y-%m') AS period_end FROM s GROUP BY priority
""")
def _(spark, sf):
    return splits.period_range(scored(spark, sf), ("priority",))


@query("e3_backtest_folds", f"""
WITH s AS (SELECT id, ano * 100 + mes AS p FROM ({DEALS_SQL})),
f AS (SELECT p AS fold FROM (SELECT DISTINCT p FROM s ORDER BY p OFFSET 3) ORDER BY p DESC LIMIT 3)
SELECT id, CAST(fold // 100 AS VARCHAR) || '-' || lpad(CAST(fold % 100 AS VARCHAR), 2, '0') AS fold,
       CASE WHEN p = fold THEN 'test' ELSE 'train' END AS role FROM s JOIN f ON p <= fold
""")
def _(spark, sf):
    return splits.backtest_folds(deals(spark, sf)).select("id", "fold", "role")


@query("e4_reference_current", """
SELECT o_orderkey, CASE WHEN CAST(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || '|42'), 1, 8)) AS BIGINT) % 1000 < 700
       THEN 'reference' ELSE 'current' END AS sample FROM orders
""")
def _(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return splits.reference_current(rows, ["o_orderkey"], hasher="md5").select("o_orderkey", "sample")


@query("e4_temporal_reference", """
SELECT event_id, CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 'reference' ELSE 'current' END AS sample FROM events
""")
def _(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "ts", "value")
    cut = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    return splits.temporal_reference_current(rows, "ts", cut).select("event_id", "sample")
