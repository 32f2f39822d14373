"""Distribution drift between a reference and a current sample, and column summaries.

Everything starts from counts per (column, value): map-side combined, spread
by value, and small wherever values repeat.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from .scale import HOT_GROUP_ROWS, cumulative_sums, group_stats, sized_join

DRIFT_THRESHOLD = 0.1
DRIFT_SHARE = 0.3
# Share standing in for an empty category in the stability index.
EMPTY_SHARE = 1e-4


def _long(df: DataFrame, columns: Sequence[str], kind: str, *keep: str) -> DataFrame:
    """One row per (row, column) as ``column``, ``value``."""
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast(kind).alias("value")) for c in columns]))
    return df.select(*keep, cells.alias("_c")).select(*keep, "_c.*")


def _sample_counts(df: DataFrame, columns: Sequence[str], kind: str, sample: str) -> DataFrame:
    rows = _long(df, columns, kind, sample).where(F.col("value").isNotNull())
    reference = F.col(sample) == "reference"
    return rows.groupBy("column", "value").agg(
        F.count_if(reference).alias("ref"), F.count_if(~reference).alias("cur")
    )


def _size(column: str) -> Column:
    return F.coalesce(column, F.lit(0).cast("long")).alias(column)


def _drifted(score: str, threshold: float) -> Column:
    """At or above the threshold; a column without values in either sample has drifted as well."""
    empty = (F.coalesce("n_ref", F.lit(0)) == 0) | (F.coalesce("n_cur", F.lit(0)) == 0)
    return empty | F.coalesce(F.col(score) >= threshold, F.lit(True))


def numeric_drift(df: DataFrame, columns: Sequence[str], sample: str = "sample",
                  threshold: float = DRIFT_THRESHOLD) -> DataFrame:
    """Kolmogorov-Smirnov and normalized Wasserstein distance per numeric column.

    Both come from the two running shares over the distinct values. The
    Wasserstein distance is divided by the reference's deviation.
    """
    counts = _sample_counts(df, columns, "double", sample)
    running = cumulative_sums(counts, ["column"], "value", ["ref", "cur"])
    gap = F.abs(F.try_divide("cum_ref", "total_ref") - F.try_divide("cum_cur", "total_cur"))
    width = F.coalesce(F.col("next_value") - F.col("value"), F.lit(0.0))
    distances = running.groupBy("column").agg(
        F.max(gap).alias("ks"), F.sum(gap * width).alias("_w"),
        F.max("total_ref").alias("n_ref"), F.max("total_cur").alias("n_cur"),
    )
    reference = df.where(F.col(sample) == "reference")
    # One aggregate per column in a single row, then one row per column.
    spreads = reference.agg(*[F.stddev_pop(F.col(c).cast("double")).alias(c) for c in columns])
    spread = spreads.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.greatest(F.col(c), F.lit(0.001)).alias("_std")) for c in columns
    ])).alias("_s")).select("_s.*")
    out = spread.join(distances, "column", "left").withColumn("wasserstein", F.try_divide("_w", "_std"))
    return out.select(
        "column", F.lit("numeric").alias("kind"), _size("n_ref"), _size("n_cur"), "ks", "wasserstein",
        F.col("wasserstein").alias("score"), _drifted("wasserstein", threshold).alias("drifted"),
    )


def categorical_drift(df: DataFrame, columns: Sequence[str], sample: str = "sample",
                      threshold: float = DRIFT_THRESHOLD) -> DataFrame:
    """Jensen-Shannon distance and population stability index per categorical column."""
    counts = materialize(_sample_counts(df, columns, "string", sample), "shares")
    totals = counts.groupBy("column").agg(
        F.sum("ref").alias("n_ref"), F.sum("cur").alias("n_cur")
    )
    shares = sized_join(counts, totals, ["column"])
    p, q = F.try_divide("ref", "n_ref"), F.try_divide("cur", "n_cur")
    middle = (p + q) / 2

    def part(x: Column) -> Column:
        return F.when(x > 0, x * F.log(x / middle)).otherwise(F.lit(0.0))

    p_floor, q_floor = F.greatest(p, F.lit(EMPTY_SHARE)), F.greatest(q, F.lit(EMPTY_SHARE))
    found = shares.groupBy("column").agg(
        F.max("n_ref").alias("n_ref"), F.max("n_cur").alias("n_cur"),
        F.sqrt(F.greatest((F.sum(part(p)) + F.sum(part(q))) / 2, F.lit(0.0))).alias("jensen_shannon"),
        F.sum((q_floor - p_floor) * F.log(q_floor / p_floor)).alias("psi"),
    )
    asked = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in columns])).alias("column"))
    return asked.join(found, "column", "left").select(
        "column", F.lit("categorical").alias("kind"), _size("n_ref"), _size("n_cur"), "jensen_shannon", "psi",
        F.col("jensen_shannon").alias("score"), _drifted("jensen_shannon", threshold).alias("drifted"),
    )


def drift_report(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (), sample: str = "sample",
                 threshold: float = DRIFT_THRESHOLD) -> DataFrame:
    """All columns in one table (measures a kind lacks are NULL)."""
    parts = []
    if numeric:
        parts.append(numeric_drift(df, numeric, sample, threshold))
    if categorical:
        parts.append(categorical_drift(df, categorical, sample, threshold))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def dataset_drift(report: DataFrame, drift_share: float = DRIFT_SHARE) -> DataFrame:
    """One row: share of drifted columns and whether that is an alert."""
    share = F.avg(F.col("drifted").cast("int"))
    return report.agg(
        F.count(F.lit(1)).alias("columns"), F.count_if("drifted").alias("drifted_columns"), share.alias("drift_share"),
        F.coalesce(share >= drift_share, F.lit(True)).alias("dataset_drift"),  # nothing compared is an alert
    )


def column_summary(df: DataFrame, columns: Sequence[str], hot_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """Count, nulls, distinct, range, mean, deviation, quartiles and mode per numeric column."""
    cells = _long(df, columns, "double")
    stats = group_stats(
        cells, ["column"],
        [
            F.count("value").alias("count"), F.count_if(F.col("value").isNull()).alias("nulls"),
            F.min("value").alias("min"), F.max("value").alias("max"), F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("std"),
        ],
        {"p25": ("value", 0.25), "p50": ("value", 0.5), "p75": ("value", 0.75)}, hot_rows,
    )
    counts = cells.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    shape = counts.groupBy("column").agg(
        F.count(F.lit(1)).alias("distinct"),
        # most frequent value, the smallest among equals
        F.max(F.struct("n", (-F.col("value")).alias("v"))).alias("_mode"),
    )
    return stats.join(shape, "column", "left").withColumn("mode", -F.col("_mode.v")).drop("_mode").withColumn(
        "distinct", F.coalesce("distinct", F.lit(0)))
