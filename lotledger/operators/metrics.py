"""Regression error, segment reports and model comparisons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.values import period_label
from .regions import frequency_table
from .scale import HOT_GROUP_ROWS, group_stats, scalar_stats

# Names of the four target bands, lowest first.
BAND_LABELS = ("baixo", "medio_baixo", "medio_alto", "alto")


def with_residual_ratio(df: DataFrame, declared: str, estimate: str = "estimativa") -> DataFrame:
    """Add ``desvio`` = (declared - estimate) / estimate."""
    return df.withColumn("desvio", F.try_divide(F.col(declared) - F.col(estimate), F.col(estimate)))


def regression_metrics(df: DataFrame, truth: str = "y_true", pred: str = "y_pred", keys: Sequence[str] = (),
                       hot_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """n, MAE, median and 95th-percentile absolute error, bias and R² (0 for a constant truth)."""
    y, p = F.col(truth).cast("double"), F.col(pred).cast("double")
    rows = df.withColumns({"_y": y, "_e": p - y, "_ae": F.abs(y - p)})
    spread = F.var_pop("_y") * F.count("_y")
    aggs = [
        F.count(F.lit(1)).alias("n"),
        F.avg("_ae").alias("mae"),
        F.avg("_e").alias("bias"),
        F.when(spread == 0, F.lit(0.0)).otherwise(
            1 - F.try_divide(F.sum(F.col("_e") * F.col("_e")), spread)
        ).alias("r2"),
    ]
    tails = {"median_absolute_error": ("_ae", 0.5), "p95_absolute_error": ("_ae", 0.95)}
    out = group_stats(rows, keys, aggs, tails, hot_rows)
    return out.select(*keys, "n", "mae", "median_absolute_error", "p95_absolute_error", "bias", "r2")


def band_edges(df: DataFrame, column: str, hot_rows: int = HOT_GROUP_ROWS) -> list[float]:
    """Inner quartile edges with repeats removed."""
    found = scalar_stats(
        df, [F.min(column).alias("low")], {"q1": (column, 0.25), "q2": (column, 0.5), "q3": (column, 0.75)}, hot_rows
    )
    if found["q1"] is None:
        return []
    return sorted({found[q] for q in ("q1", "q2", "q3")})


def quartile_band(column: Column, edges: Sequence[float]) -> Column:
    """Right-closed quartile band of a value, by value edges (not by row rank).

    With tied edges fewer bands exist; the highest labels go unused.
    """
    band = F.lit(None).cast("string")
    labels = BAND_LABELS[: len(edges) + 1]
    band = F.when(column.isNull(), band)
    for edge, label in zip(edges, labels):
        band = band.when(column <= F.lit(edge), label)
    return band.otherwise(labels[-1])


def with_quartile_band(df: DataFrame, column: str, hot_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """Add ``target_band``; three edges reach the driver, labelling is row by row."""
    return df.withColumn("target_band", quartile_band(F.col(column), band_edges(df, column, hot_rows)))


def segment_report(df: DataFrame, dimensions: Sequence[str], truth: str = "y_true", pred: str = "y_pred",
                   min_group_size: int = 30, hot_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """Error per value of each dimension (``dimension``, ``value``), worst first.

    All dimensions share one aggregation. NULL values form the group ``nan``.
    """
    pairs = F.explode(F.array(*[
        F.struct(F.lit(d).alias("dimension"), F.coalesce(F.col(d).cast("string"), F.lit("nan")).alias("value"))
        for d in dimensions
    ]))
    y, p = F.col(truth).cast("double"), F.col(pred).cast("double")
    rows = df.select(pairs.alias("_d"), (p - y).alias("_e"), F.abs(p - y).alias("_ae")).select("_d.*", "_e", "_ae")
    aggs = [F.count(F.lit(1)).alias("n"), F.avg("_ae").alias("mae"), F.avg("_e").alias("bias")]
    stats = group_stats(
        rows, ["dimension", "value"], aggs, {"median_absolute_error": ("_ae", 0.5)}, hot_rows
    )
    return (
        stats.where(F.col("n") >= min_group_size)
        .select("dimension", "value", "n", "mae", "median_absolute_error", "bias")
        .orderBy("dimension", F.desc("mae"), "value")
    )


def group_metrics(df: DataFrame, key: str, truth: str = "y_true", pred: str = "y_pred",
                  min_group_size: int = 30, hot_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """:func:`segment_report` of a single column."""
    return segment_report(df, [key], truth, pred, min_group_size, hot_rows).drop("dimension")


def standard_segments(df: DataFrame, truth: str = "y_true", pred: str = "y_pred", min_group_size: int = 30,
                      hot_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """Errors by period, by target band and by postal code."""
    rows = with_quartile_band(df.withColumn("period", period_label(F.col("ano"), F.col("mes"))), truth, hot_rows)
    dimensions = ["period", "target_band"] + (["cep"] if "cep" in df.columns else [])
    return segment_report(rows, dimensions, truth, pred, min_group_size, hot_rows)


def worst_segments(report: DataFrame, dimension: str = "cep", k: int = 10) -> DataFrame:
    return report.where(F.col("dimension") == dimension).orderBy(F.desc("mae"), "value").limit(k)


def prediction_range(df: DataFrame, pred: str = "y_pred", hot_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """Minimum, 5 %, median, 95 % and maximum prediction."""
    return group_stats(
        df, [], [F.min(pred).alias("min"), F.max(pred).alias("max")],
        {"p05": (pred, 0.05), "median": (pred, 0.5), "p95": (pred, 0.95)}, hot_rows,
    )


def backtest_summary(windows: DataFrame) -> DataFrame:
    """Number of windows and mean/max/min/population deviation of their MAE."""
    return windows.agg(
        F.count(F.lit(1)).alias("windows"),
        F.avg("mae").alias("mean_mae"),
        F.max("mae").alias("max_mae"),
        F.min("mae").alias("min_mae"),
        F.stddev_pop("mae").alias("std_mae"),
    )


def mean_baseline_mae(df: DataFrame, target: str) -> DataFrame:
    """Mean absolute error of always predicting the mean."""
    mean = df.agg(F.avg(target)).first()[0]
    return df.agg(F.avg(F.abs(F.col(target) - F.lit(mean))).alias("baseline_mae"))


def compare_models(df: DataFrame, truth: str = "y_true", pred_a: str = "pred_a", pred_b: str = "pred_b") -> DataFrame:
    """MAE and R² of two prediction columns and which one wins each."""
    y, a, b = (F.col(c).cast("double") for c in (truth, pred_a, pred_b))
    spread = F.var_pop(y) * F.count(y)

    def r2(p: Column) -> Column:
        return F.when(spread == 0, F.lit(0.0)).otherwise(1 - F.try_divide(F.sum((y - p) * (y - p)), spread))

    facts = df.agg(
        F.avg(F.abs(y - a)).alias("mae_a"), F.avg(F.abs(y - b)).alias("mae_b"),
        r2(a).alias("r2_a"), r2(b).alias("r2_b"),
        F.avg(b - a).alias("mean_diff"), F.avg(F.abs(b - a)).alias("mean_abs_diff"),
    )
    return facts.withColumns({
        "b_better_mae": F.col("mae_b") < F.col("mae_a"),
        "b_better_r2": F.col("r2_b") > F.col("r2_a"),
    })


def difference_histogram(df: DataFrame, pred_a: str = "pred_a", pred_b: str = "pred_b", bins: int = 50) -> DataFrame:
    """Equal-width, left-closed histogram of ``pred_b - pred_a`` over its whole range."""
    gap = (F.col(pred_b) - F.col(pred_a)).cast("double")
    rows = df.select(gap.alias("d")).where(F.col("d").isNotNull())
    span = rows.agg(F.min("d").alias("low"), F.max("d").alias("high")).first()
    if span["low"] is None:
        raise ValueError("no prediction pair to compare")
    low, high = span["low"], span["high"]
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    slot = F.least(F.floor((F.col("d") - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counts = rows.groupBy(slot.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    frame = df.sparkSession.range(bins).select(
        F.col("id").cast("int").alias("bin"),
        (F.lit(low) + F.col("id") * F.lit(width)).alias("bin_start"),
        (F.lit(low) + (F.col("id") + 1) * F.lit(width)).alias("bin_end"),
    )
    return frame.join(counts, "bin", "left").withColumn("n", F.coalesce("n", F.lit(0)).cast("long")).orderBy("bin")


__all__ = [
    "backtest_summary", "band_edges", "compare_models", "difference_histogram", "frequency_table", "group_metrics",
    "mean_baseline_mae", "prediction_range", "quartile_band", "regression_metrics", "segment_report",
    "standard_segments", "with_quartile_band", "with_residual_ratio", "worst_segments",
]
