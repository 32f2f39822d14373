"""Splits over time: holdout by row count, expanding backtest, drift samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.values import period_key, period_label
from .scale import HOT_GROUP_ROWS, kth_key, whole_rows


def temporal_holdout(df: DataFrame, key: str, test_size: float = 0.2,
                     hot_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """Add ``split`` (``train``/``test``): the last rows by (ano, mes, key) are the test.

    The cut is by row count and so falls inside a month. Only the counts per
    period reach the driver; inside the boundary period the cut is the exact
    k-th smallest ``key`` (unique, numeric), so labelling rows needs no sort.
    """
    period = period_key(F.col("ano"), F.col("mes"))
    counted = df.groupBy(period.alias("p")).count().collect()
    if any(r[0] is None for r in counted):
        raise ValueError("temporal split needs a year and a month in every row")
    sizes = sorted((r[0], r[1]) for r in counted)
    total = sum(n for _, n in sizes)
    train_rows = total - whole_rows(total, test_size) if total else 0
    if train_rows <= 0:
        raise ValueError("temporal split left the train or the test side empty")
    seen = 0
    for boundary, n in sizes:
        if seen + n >= train_rows:
            break
        seen += n
    last = kth_key(df.where(period == boundary), key, train_rows - seen, hot_rows)
    is_train = (period < boundary) | ((period == boundary) & (F.col(key) <= F.lit(last)))
    return df.withColumn("split", F.when(is_train, "train").otherwise("test"))


def period_range(df: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """First and last period as ``YYYY-MM`` (per group when keys are given)."""
    period = period_key(F.col("ano"), F.col("mes"))
    spans = df.groupBy(*keys).agg(F.min(period).alias("a"), F.max(period).alias("b"))

    def label(c: str):
        return period_label(F.floor(F.col(c) / 100), F.col(c) % 100)

    return spans.select(*keys, label("a").alias("period_start"), label("b").alias("period_end"))


def backtest_periods(df: DataFrame, windows: int = 3, min_train_periods: int = 3) -> list[int]:
    """The ``yyyymm`` periods that serve as test folds (periods are few)."""
    period = period_key(F.col("ano"), F.col("mes")).alias("p")
    periods = sorted(r[0] for r in df.select(period).distinct().where("p is not null").collect())
    return periods[min_train_periods:][-windows:]


def backtest_folds(df: DataFrame, windows: int = 3, min_train_periods: int = 3) -> DataFrame:
    """One row per (row, fold it belongs to) with ``fold`` and ``role``.

    A row of period p trains every fold later than p and tests fold p.
    """
    folds = backtest_periods(df, windows, min_train_periods)
    if not folds:
        raise ValueError("not enough periods for a backtest")
    period = period_key(F.col("ano"), F.col("mes"))
    fitting = F.filter(F.array(*[F.lit(f) for f in folds]), lambda f: f >= period)
    out = df.withColumn("_fold", F.explode(fitting))
    return out.withColumns({
        "fold": period_label(F.floor(F.col("_fold") / 100), F.col("_fold") % 100),
        "role": F.when(period == F.col("_fold"), "test").otherwise("train"),
    }).drop("_fold")


def reference_current(df: DataFrame, key: list[str], seed: int = 42, reference_share: float = 0.7,
                      hasher: str = "xxhash64") -> DataFrame:
    """Add ``sample`` (``reference``/``current``) by a hash of the key.

    Unlike ``randomSplit`` the result does not depend on partitioning. Rows
    holding a NULL are dropped first. ``hasher="md5"`` is the portable variant.
    """
    rows = df.na.drop()
    if hasher == "md5":
        text = F.concat_ws("|", *[F.col(k).cast("string") for k in key], F.lit(str(seed)))
        bucket = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % 1000
    else:
        bucket = F.pmod(F.xxhash64(*key, F.lit(seed)), F.lit(1000))
    threshold = round(reference_share * 1000)
    return rows.withColumn("sample", F.when(bucket < threshold, "reference").otherwise("current"))


def temporal_reference_current(df: DataFrame, moment: str, cut) -> DataFrame:
    """Add ``sample`` by time: before ``cut`` is the reference."""
    return df.na.drop().withColumn("sample", F.when(F.col(moment) < F.lit(cut), "reference").otherwise("current"))
