"""Price per square metre by region, frequency tables and comparisons."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import strip
from ..session import materialize
from .cleaning import AREA, TARGET
from .scale import (
    HOT_GROUP_ROWS, group_stats, largest_group, linear_edges, right_closed_bin, scalar_stats, sized_join,
)

# Fixed values of the frequency tables.
TRIM_FROM_ROWS = 100
TRIM_QUANTILE = 0.99


def region_summary(df: DataFrame, min_samples: int = 20, region: str = "bairro",
                   value: str = "valor_m2_estimado") -> DataFrame:
    """Count, mean and sample variance (0 for a single sale) per region, dearest first."""
    summary = df.groupBy(region).agg(
        F.count(F.lit(1)).alias("quantidade_vendas"),
        F.avg(value).alias("valor_m2_medio"),
        F.coalesce(F.var_samp(value), F.lit(0.0)).alias("valor_m2_variancia"),
    )
    return summary.where(F.col("quantidade_vendas") >= min_samples).orderBy(F.desc("valor_m2_medio"), region)


def overall_price(df: DataFrame, value: str = "valor_m2_estimado") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("quantidade_vendas"), F.avg(value).alias("valor_m2_medio_geral")
    )


def dearest(summary: DataFrame, k: int = 10, region: str = "bairro") -> DataFrame:
    return summary.orderBy(F.desc("valor_m2_medio"), region).limit(k)


def cheapest(summary: DataFrame, k: int = 30, region: str = "bairro") -> DataFrame:
    return summary.orderBy("valor_m2_medio", F.desc(region)).limit(k)


def bin_edges(low: float, high: float, bins: int) -> list[float]:
    """Equal-width edges, the first widened by 0.1 % of the range.

    A constant column is widened by 0.1 % of its value on both sides instead.
    """
    if low == high:
        pad = 0.001 * abs(low) if low else 0.001
        return linear_edges(low - pad, high + pad, bins)
    edges = linear_edges(low, high, bins)
    edges[0] -= 0.001 * (high - low)
    return edges


def label_edges(edges: Sequence[float], precision: int = 3) -> list[float]:
    """Edges rounded for display, with more digits when rounding would merge two."""
    def shown(x: float, digits: int) -> float:
        if not math.isfinite(x) or x == 0:
            return x
        fraction, whole = math.modf(x)
        if whole == 0:
            digits = -math.floor(math.log10(abs(fraction))) - 1 + digits
        return round(x, digits)

    for digits in range(precision, 20):
        rounded = [shown(e, digits) for e in edges]
        if len(set(rounded)) == len(set(edges)):
            return rounded
    return list(edges)


def frequency_table(df: DataFrame, column: str, bins: int = 50, hot_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """Counts in equal-width, right-closed intervals; empty intervals are kept.

    From 100 rows on, values above the 99th percentile are left out. Only the
    trim point and the range reach the driver; counting is a bounded group-by.
    """
    value = F.col(column).cast("double")
    values = df.where(value.isNotNull()).select(value.alias("v"))
    first = scalar_stats(values, [F.count(F.lit(1)).alias("n")], {"p": ("v", TRIM_QUANTILE)}, hot_rows)
    if first["n"] == 0:
        raise ValueError(f"no value in {column}")
    if first["n"] >= TRIM_FROM_ROWS:
        values = values.where(F.col("v") <= F.lit(first["p"]))
    span = values.agg(F.min("v").alias("low"), F.max("v").alias("high")).first()
    edges = bin_edges(span["low"], span["high"], bins)
    shown = label_edges(edges)
    # The guess uses the unwidened range; the edges decide.
    counts = values.groupBy(right_closed_bin(F.col("v"), edges).alias("bin")).agg(
        F.count(F.lit(1)).alias("frequencia_vendas")
    )
    spark = df.sparkSession
    table = [(i, shown[i], shown[i + 1], edges[i], edges[i + 1]) for i in range(bins)]
    frame = spark.createDataFrame(
        table, "bin int, faixa_inicio double, faixa_fim double, limite_inferior double, limite_superior double"
    )
    return (
        frame.join(counts, "bin", "left")
        .withColumn("frequencia_vendas", F.coalesce("frequencia_vendas", F.lit(0)).cast("long"))
        .orderBy("bin")
    )


def region_cards(df: DataFrame, region: str = "bairro", price_m2: str = "valor_m2_estimado",
                 price: str = TARGET, hot_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """Count, mean/median price per m² and mean/median/min/max price of every region."""
    aggs = [
        F.count(F.lit(1)).alias("count"),
        F.avg(price_m2).alias("avg_price_m2"),
        F.avg(price).alias("avg_price"),
        F.min(price).alias("min_price"),
        F.max(price).alias("max_price"),
    ]
    medians = {"median_price_m2": (price_m2, 0.5), "median_price": (price, 0.5)}
    return group_stats(df, [region], aggs, medians, hot_rows)


def resolve_metric(metric: Column, available: Sequence[str], default: str = TARGET) -> Column:
    """Metric name a comparison uses: price per m² by its derived name, else the default."""
    derived = "valor_m2_referencia"
    known = metric.isin(*available)
    if derived in available and "valor_m2" not in available:
        return F.when(known, metric).when(metric == "valor_m2", F.lit(derived)).otherwise(F.lit(default))
    return F.when(known, metric).otherwise(F.lit(default))


def compare_regions(pairs: DataFrame, sales: DataFrame, metrics: Sequence[str], region: str = "bairro",
                    hot_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """Answer a table of comparison requests (``region_a``, ``region_b``, ``metric``).

    All metrics of all regions come from one aggregation; requests then look
    up two rows each.
    """
    wanted = [*metrics]
    aggs = [F.avg(m).alias(f"mean_{m}") for m in wanted] + [F.count(m).alias(f"n_{m}") for m in wanted]
    stats = group_stats(sales, [region], aggs, {f"median_{m}": (m, 0.5) for m in wanted}, hot_rows)

    def side(letter: str) -> DataFrame:
        entries = [
            x for m in wanted for x in (
                F.lit(m),
                F.struct(
                    F.col(f"mean_{m}").alias("media"), F.col(f"median_{m}").alias("mediana"),
                    F.col(f"n_{m}").alias("amostra"),
                ),
            )
        ]
        return stats.select(F.col(region).alias(f"region_{letter}"), F.create_map(*entries).alias(f"_{letter}"))

    asked = pairs.withColumns({
        "region_a": F.upper(strip(F.col("region_a"))),
        "region_b": F.upper(strip(F.col("region_b"))),
        "metric": resolve_metric(F.coalesce(F.col("metric"), F.lit(TARGET)), wanted),
    })
    found = sized_join(sized_join(asked, side("a"), ["region_a"], "left"), side("b"), ["region_b"], "left")
    blank = (F.coalesce("region_a", F.lit("")) == "") | (F.coalesce("region_b", F.lit("")) == "")
    missing = F.array_compact(F.array(
        F.when(F.col("_a").isNull(), F.col("region_a")), F.when(F.col("_b").isNull(), F.col("region_b"))
    ))
    a, b = F.try_element_at("_a", F.col("metric")), F.try_element_at("_b", F.col("metric"))
    status = F.when(blank, "missing_fields").when(F.size(missing) > 0, "regions_not_found").otherwise("success")
    ok = status == "success"
    gap = a["media"] - b["media"]
    return found.select(
        *[c for c in asked.columns],
        status.alias("status"),
        F.when(blank, F.array().cast("array<string>")).otherwise(missing).alias("missing_regions"),
        F.when(ok, a).alias("stats_a"),
        F.when(ok, b).alias("stats_b"),
        F.when(ok, F.when(gap >= 0, F.col("region_a")).otherwise(F.col("region_b"))).alias("higher_region"),
        F.when(ok, F.abs(gap)).alias("absolute_difference"),
    )


def deviation_triage(sales: DataFrame, declared: str, region: str = "bairro", area: str = AREA,
                     price: str = TARGET, ratio_limit: float = 0.5, z_limit: float = 3.5,
                     hot_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """Flag declared values far from the expected one, for human review.

    Expected value is the region's mean price per m² times the area. A row is
    flagged when it deviates by more than ``ratio_limit`` of the estimate and
    its robust z-score within the region (median/MAD) exceeds ``z_limit``.
    """
    from .metrics import with_residual_ratio

    # Within a region the deviation is (declared / area) / mean - 1, so its median and spread are those of
    # declared / area, scaled: mean and median come from one pass, the spread from a second, one join each.
    per_area = F.try_divide(F.col(declared), F.col(area))
    largest = largest_group(sales, [region])
    centre = group_stats(sales.withColumn("_ratio", per_area), [region], [F.avg(F.try_divide(price, area)).alias("_mean_m2")],
                         {"_centre": ("_ratio", 0.5)}, hot_rows, largest)
    centre = materialize(centre, "centre")
    off = F.abs(per_area - F.col("_centre"))
    spread = group_stats(sized_join(sales, centre, [region]).select(region, off.alias("_off")), [region], [], {"_spread": ("_off", 0.5)}, hot_rows, largest)
    facts = centre.withColumnRenamed(region, "_r").join(spread, F.col("_r").eqNullSafe(F.col(region))).select(
        region, "_mean_m2", (F.try_divide("_centre", "_mean_m2") - 1).alias("_median"),
        F.abs(F.try_divide("_spread", "_mean_m2")).alias("_mad"))
    estimated = sized_join(sales, facts, [region]).withColumn("estimativa", F.col("_mean_m2") * F.col(area))
    judged = with_residual_ratio(estimated, declared)
    z = F.try_divide(F.lit(0.6745) * (F.col("desvio") - F.col("_median")), F.col("_mad"))
    judged = judged.withColumn("z_robusto", z)
    far = (F.abs("desvio") > ratio_limit) & (F.abs("z_robusto") > z_limit)
    flag = F.when(far & (F.col("desvio") < 0), "muito_abaixo").when(far, "muito_acima").otherwise("normal")
    return judged.withColumn("sinal", flag).drop("_mean_m2", "_median", "_mad")


def region_deviation(triaged: DataFrame, region: str = "bairro") -> DataFrame:
    """Mean deviation and flag rate per region, largest deviation first."""
    return triaged.groupBy(region).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs("desvio")).alias("desvio_medio_abs"),
        F.avg((F.col("sinal") != "normal").cast("int")).alias("taxa_sinal"),
    ).orderBy(F.desc("desvio_medio_abs"), region)
