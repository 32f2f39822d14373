"""Quality profile, feature contract and the gates over them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .cleaning import AREA, DATE_COLUMN, TARGET
from .scale import HOT_GROUP_ROWS, group_stats, row_hashes

# Columns the clean table must have, and the thresholds.
REQUIRED_COLUMNS = (
    "data_de_transacao",
    "bairro",
    "cep",
    "descricao_do_uso_iptu",
    "area_do_terreno_m2",
    "valor_venal_de_referencia",
)
NEVER_ALL_NULL = (
    "bairro",
    "descricao_do_uso_iptu",
    "area_do_terreno_m2",
    "valor_venal_de_referencia",
)
MAX_NULL_RATE = {
    "data_de_transacao": 0.01,
    "cep": 0.01,
    "descricao_do_uso_iptu": 0.0,
    "area_do_terreno_m2": 0.01,
    "valor_venal_de_referencia": 0.01,
}
MIN_ROWS = 100_000
MIN_TERRAIN_ROWS = 1_000
FEATURE_MIN_ROWS = 1_000
FEATURE_MIN_CEPS = 20
FEATURE_MIN_PERIODS = 6
FORBIDDEN_FEATURES = ("valor_m2", "media_valor_cep")


def _names(names: Sequence[str]) -> Column:
    return F.array(*[F.lit(n) for n in names]).cast("array<string>")


def quality_profile(df: DataFrame, header_rows: int = 0, duplicate_rows: int = 0,
                    non_positive_rows: int = 0, category: str = "TERRENO") -> DataFrame:
    """One row describing the clean table, with a ``sample`` of its rows.

    The counts are one aggregation that combines map-side. Duplicates are
    found by grouping two row hashes, so 16 bytes per row are shuffled and
    not the rows.
    """
    present = [c for c in REQUIRED_COLUMNS if c in df.columns]
    has = set(df.columns)
    nulls = {c: F.count_if(F.col(f"`{c}`").isNull()) for c in df.columns}
    rows = F.count(F.lit(1))
    nothing = F.lit(None).cast("date")
    counted = df.agg(
        rows.alias("rows"),
        F.create_map(*[x for c, n in nulls.items() for x in (F.lit(c), n)]).alias("nulls"),
        F.create_map(*[x for c in present for x in (F.lit(c), F.round(F.try_divide(nulls[c], rows), 4))])
        .cast("map<string,double>").alias("critical_null_rate"),
        (F.min(DATE_COLUMN).cast("date") if DATE_COLUMN in has else nothing).alias("date_min"),
        (F.max(DATE_COLUMN).cast("date") if DATE_COLUMN in has else nothing).alias("date_max"),
        (F.count_if(F.col("descricao_do_uso_iptu") == category) if "descricao_do_uso_iptu" in has else F.lit(0))
        .cast("long").alias("terrain_rows"),
        (F.count_if(F.col(TARGET) <= 0) if TARGET in has else F.lit(0)).cast("long").alias("non_positive_target_rows"),
        F.lit(1).alias("_one"),
    )
    first, second = row_hashes(df)
    copies = df.groupBy(first.alias("_a"), second.alias("_b")).agg(F.count(F.lit(1)).alias("_copies"))
    repeated = copies.agg(
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicated_rows"), F.lit(1).alias("_one")
    )
    sample = profile_sample(df).agg(F.collect_list(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("sample"), F.lit(1).alias("_one"))
    facts = counted.join(repeated, "_one").join(sample, "_one").drop("_one")  # one row each
    return facts.withColumns({
        "columns": _names(df.columns),
        "dtypes": F.create_map(*[F.lit(x) for pair in df.dtypes for x in pair]),
        "missing_required_cols": _names([c for c in REQUIRED_COLUMNS if c not in has]),
        "embedded_header_rows_removed": F.lit(header_rows).cast("long"),
        "duplicate_rows_removed": F.lit(duplicate_rows).cast("long"),
        "non_positive_target_rows_removed": F.lit(non_positive_rows).cast("long"),
    })


def profile_sample(df: DataFrame, n: int = 5) -> DataFrame:
    """The sample rows shown beside a profile."""
    return df.limit(n)


def _failures(*checks: tuple[Column, Column]) -> Column:
    return F.array_compact(F.array(*[F.when(bad, message) for bad, message in checks]))


def _message(*parts) -> Column:
    return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts])


def quality_failures(profile: DataFrame, min_rows: int = MIN_ROWS, min_terrain_rows: int = MIN_TERRAIN_ROWS,
                     max_null_rate: Mapping[str, float] = MAX_NULL_RATE, max_non_positive: int = 0) -> DataFrame:
    """Add ``failures``: every broken rule of the quality gate."""
    rows, nulls = F.col("rows"), F.col("nulls")
    all_null = [
        (rows > 0) & (F.try_element_at(nulls, F.lit(c)) == rows) for c in NEVER_ALL_NULL
    ]
    checks = [
        (F.size("missing_required_cols") > 0,
         _message("colunas obrigatorias ausentes: ", F.array_join("missing_required_cols", ","))),
        *[(bad, _message("coluna totalmente nula: ", c)) for bad, c in zip(all_null, NEVER_ALL_NULL)],
        (rows < min_rows, _message("rows=", rows, " abaixo do minimo ", min_rows)),
        (F.col("terrain_rows") < min_terrain_rows,
         _message("terrain_rows=", F.col("terrain_rows"), " abaixo do minimo ", min_terrain_rows)),
        *[
            (F.try_element_at("critical_null_rate", F.lit(c)) > float(limit),
             _message(f"taxa de nulos em {c}=", F.try_element_at("critical_null_rate", F.lit(c)),
                      " acima de ", limit))
            for c, limit in max_null_rate.items()
        ],
        (F.col("non_positive_target_rows") > max_non_positive,
         _message("non_positive_target_rows=", F.col("non_positive_target_rows"), " acima de ", max_non_positive)),
    ]
    return profile.withColumn("failures", _failures(*checks))


def feature_contract(df: DataFrame, target: str = TARGET, min_rows: int = FEATURE_MIN_ROWS,
                     min_ceps: int = FEATURE_MIN_CEPS, min_periods: int = FEATURE_MIN_PERIODS,
                     area_min: float = 1, area_max: float = 50_000,
                     forbidden: Sequence[str] = FORBIDDEN_FEATURES,
                     hot_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """One row describing the feature table, with ``failures`` and ``passed``."""
    required = ("cep", AREA, target, "ano", "mes")
    has = set(df.columns)

    def when_present(column: str, agg: Column, kind: str) -> Column:
        return (agg if column in has else F.lit(None)).cast(kind)

    aggs = [
        F.count(F.lit(1)).alias("rows"),
        F.create_map(*[x for c in df.columns for x in (F.lit(c), F.count_if(F.col(f"`{c}`").isNull()))]).alias("nulls"),
        when_present(AREA, F.min(AREA) if AREA in has else None, "double").alias("area_min"),
        when_present(AREA, F.max(AREA) if AREA in has else None, "double").alias("area_max"),
        when_present(target, F.min(target) if target in has else None, "double").alias("target_min"),
        when_present(target, F.max(target) if target in has else None, "double").alias("target_max"),
    ]
    medians = {"target_median": (target, 0.5)} if target in has else {}
    facts = group_stats(df, [], aggs, medians, hot_rows)
    if not medians:
        facts = facts.withColumn("target_median", F.lit(None).cast("double"))
    # distinct counts from one table of combinations, which combines map-side, rather than three copies of every row
    keys = [c for c in ("cep", "ano", "mes") if c in has]
    combined = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")) if keys else None

    def distinct(columns: Sequence[str], counted: Column, name: str) -> DataFrame:
        if not set(columns) <= has:
            return df.sparkSession.range(1).select(F.lit(0).cast("long").alias(name))
        return combined.groupBy(*columns).agg(F.lit(1)).agg(counted.cast("long").alias(name))

    # a (NULL, NULL) period counts as one, as asked; a NULL code does not
    ceps = distinct(("cep",), F.count("cep"), "unique_ceps")
    periods = distinct(("ano", "mes"), F.count(F.lit(1)), "unique_periods")
    for part in (ceps, periods):  # one row each
        facts = facts.withColumn("_one", F.lit(1)).join(part.withColumn("_one", F.lit(1)), "_one").drop("_one")
    facts = facts.withColumns({
        "missing_required_columns": _names([c for c in required if c not in has]),
        "forbidden_columns_present": _names(sorted(set(forbidden) & has)),
    })
    checks = [
        (F.col("rows") < min_rows, _message("rows=", F.col("rows"), " abaixo do minimo ", min_rows)),
        (F.col("unique_ceps") < min_ceps,
         _message("unique_ceps=", F.col("unique_ceps"), " abaixo do minimo ", min_ceps)),
        (F.col("unique_periods") < min_periods,
         _message("unique_periods=", F.col("unique_periods"), " abaixo do minimo ", min_periods)),
        (F.size("missing_required_columns") > 0,
         _message("colunas obrigatorias ausentes: ", F.array_join("missing_required_columns", ","))),
        (F.size("forbidden_columns_present") > 0,
         _message("colunas proibidas presentes: ", F.array_join("forbidden_columns_present", ","))),
        (F.col("area_min") < area_min, _message("area minima abaixo de ", float(area_min))),
        (F.col("area_max") > area_max, _message("area maxima acima de ", float(area_max))),
    ]
    return facts.withColumn("failures", _failures(*checks)).withColumn("passed", F.size("failures") == 0)


def assert_passed(report: DataFrame, what: str) -> DataFrame:
    """Raise with every failure when a one-row report did not pass."""
    failures = report.select("failures").first()[0]
    if failures:
        raise ValueError(f"{what}: " + "; ".join(failures))
    return report
