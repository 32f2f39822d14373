"""Regression errors, segments and model comparisons."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics
from .registry import query
from .views import SCORED_SQL, scored

_METRICS = """count(*) AS n, round(avg(abs(y_true - y_pred)), 4) AS mae,
       round(quantile_cont(abs(y_true - y_pred), 0.5), 5) AS median_absolute_error"""


def _round(df, **digits):
    return df.withColumns({c: F.round(c, d) for c, d in digits.items()})


@query("d11_regression_metrics", f"""
SELECT {_METRICS}, round(quantile_cont(abs(y_true - y_pred), 0.95), 5) AS p95_absolute_error, round(avg(y_pred - y_true), 4) AS bias,
       round(1 - sum((y_true - y_pred) ** 2) / (var_pop(y_true) * count(*)), 8) AS r2 FROM ({SCORED_SQL})
""")
def _(spark, sf):
    return _round(metrics.regression_metrics(scored(spark, sf)), mae=4, median_absolute_error=5,
                  p95_absolute_error=5, bias=4, r2=8)


@query("d12_group_metrics", f"""
SELECT coalesce(cep, 'nan') AS value, {_METRICS}, round(avg(y_pred - y_true), 4) AS bias
FROM ({SCORED_SQL}) GROUP BY cep HAVING count(*) >= 30
""")
def _(spark, sf):
    return _round(metrics.group_metrics(scored(spark, sf), "cep"), mae=4, median_absolute_error=5, bias=4)


_BANDED_SQL = f"""
WITH s AS ({SCORED_SQL}),
q AS (SELECT quantile_cont(y_true, 0.25) AS q1, quantile_cont(y_true, 0.5) AS q2, quantile_cont(y_true, 0.75) AS q3 FROM s),
b AS (SELECT s.*, CASE WHEN y_true <= q1 THEN 'baixo' WHEN y_true <= q2 THEN 'medio_baixo' WHEN y_true <= q3 THEN 'medio_alto'
                       ELSE 'alto' END AS target_band FROM s, q)
"""
_SEGMENTS_SQL = _BANDED_SQL + f"""
, g AS (SELECT 'period' AS dimension, CAST(ano AS VARCHAR) || '-' || lpad(CAST(mes AS VARCHAR), 2, '0') AS value, y_true, y_pred FROM b
        UNION ALL SELECT 'target_band', target_band, y_true, y_pred FROM b
        UNION ALL SELECT 'cep', coalesce(cep, 'nan'), y_true, y_pred FROM b),
r AS (SELECT dimension, value, {_METRICS}, round(avg(y_pred - y_true), 4) AS bias FROM g GROUP BY dimension, value HAVING count(*) >= 20)
"""


def _segments(spark, sf):
    return metrics.standard_segments(scored(spark, sf), min_group_size=20)


@query("d13_segment_report", _SEGMENTS_SQL + "SELECT * FROM r")
def _(spark, sf):
    return _round(_segments(spark, sf), mae=4, median_absolute_error=5, bias=4)


@query("d14_quartile_band", _BANDED_SQL + "SELECT id, target_band FROM b")
def _(spark, sf):
    return metrics.with_quartile_band(scored(spark, sf), "y_true").select("id", "target_band")


@query("d15_worst_segments", _SEGMENTS_SQL + "SELECT * FROM r WHERE dimension = 'cep' ORDER BY mae DESC, value LIMIT 10")
def _(spark, sf):
    return _round(metrics.worst_segments(_segments(spark, sf)), mae=4, median_absolute_error=5, bias=4)


@query("d16_prediction_range", f"""
SELECT round(min(y_pred), 5) AS min, round(max(y_pred), 5) AS max, round(quantile_cont(y_pred, 0.05), 5) AS p05,
       round(quantile_cont(y_pred, 0.5), 5) AS median, round(quantile_cont(y_pred, 0.95), 5) AS p95 FROM ({SCORED_SQL})
""")
def _(spark, sf):
    return _round(metrics.prediction_range(scored(spark, sf)), min=5, max=5, p05=5, median=5, p95=5)


@query("d17_backtest_summary", f"""
WITH w AS (SELECT ano * 100 + mes AS period, avg(abs(y_true - y_pred)) AS mae FROM ({SCORED_SQL}) GROUP BY 1)
SELECT count(*) AS windows, round(avg(mae), 4) AS mean_mae, round(max(mae), 4) AS max_mae, round(min(mae), 4) AS min_mae,
       round(stddev_pop(mae), 4) AS std_mae FROM w
""")
def _(spark, sf):
    rows = scored(spark, sf).withColumn("period", F.col("ano") * 100 + F.col("mes"))
    windows = metrics.regression_metrics(rows, keys=["period"])
    return _round(metrics.backtest_summary(windows), mean_mae=4, max_mae=4, min_mae=4, std_mae=4)


@query("d18_mean_baseline_mae", f"""
SELECT round(avg(abs(y_true - (SELECT avg(y_true) FROM ({SCORED_SQL})))), 4) AS baseline_mae FROM ({SCORED_SQL})
""")
def _(spark, sf):
    return _round(metrics.mean_baseline_mae(scored(spark, sf), "y_true"), baseline_mae=4)


@query("d19_compare_models", f"""
WITH m AS (SELECT avg(abs(y_true - y_pred)) AS mae_a, avg(abs(y_true - y_pred_b)) AS mae_b,
   1 - sum((y_true - y_pred) ** 2) / (var_pop(y_true) * count(*)) AS r2_a, 1 - sum((y_true - y_pred_b) ** 2) / (var_pop(y_true) * count(*)) AS r2_b,
   avg(y_pred_b - y_pred) AS mean_diff, avg(abs(y_pred_b - y_pred)) AS mean_abs_diff FROM ({SCORED_SQL}))
SELECT round(mae_a, 4) AS mae_a, round(mae_b, 4) AS mae_b, round(r2_a, 8) AS r2_a, round(r2_b, 8) AS r2_b, round(mean_diff, 4) AS mean_diff,
       round(mean_abs_diff, 4) AS mean_abs_diff, mae_b < mae_a AS b_better_mae, r2_b > r2_a AS b_better_r2 FROM m
""")
def _(spark, sf):
    out = metrics.compare_models(scored(spark, sf), pred_a="y_pred", pred_b="y_pred_b")
    return _round(out, mae_a=4, mae_b=4, r2_a=8, r2_b=8, mean_diff=4, mean_abs_diff=4)


@query("d19_difference_histogram", f"""
WITH d AS (SELECT y_pred_b - y_pred AS d FROM ({SCORED_SQL})), r AS (SELECT min(d) AS lo, (max(d) - min(d)) / 50::DOUBLE AS w FROM d),
c AS (SELECT CAST(least(floor((d - lo) / w), 49) AS INTEGER) AS bin, count(*) AS n FROM d, r GROUP BY 1)
SELECT CAST(i AS INTEGER) AS bin, round(lo + i * w, 4) AS bin_start, round(lo + (i + 1) * w, 4) AS bin_end, coalesce(n, 0) AS n
FROM r, range(50) g(i) LEFT JOIN c ON c.bin = i
""")
def _(spark, sf):
    out = metrics.difference_histogram(scored(spark, sf), "y_pred", "y_pred_b")
    return _round(out, bin_start=4, bin_end=4)
