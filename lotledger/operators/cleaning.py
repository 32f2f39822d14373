"""Row quality: header rows, duplicates, targets, required fields."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F

from ..functions.text import normalize_text, repair_all, repair_mojibake, snake_columns
from ..functions.values import parse_br_number, parse_date
from .scale import row_hashes

TARGET = "valor_venal_de_referencia"
AREA = "area_do_terreno_m2"

# Columns of the raw table that hold numbers and labels.
NUMERIC_COLUMNS = (
    "valor_de_transacao_declarado_pelo_contribuinte",
    "valor_venal_de_referencia",
    "proporcao_transmitida",
    "valor_venal_de_referencia_proporcional",
    "base_de_calculo_adotada",
    "valor_financiado",
    "area_do_terreno_m2",
    "testada_m",
    "fracao_ideal",
    "area_construida_m2",
)
LABEL_COLUMNS = (
    "descricao_do_padrao_iptu",
    "nome_do_logradouro",
    "bairro",
    "natureza_de_transacao",
    "tipo_de_financiamento",
    "descricao_do_uso_iptu",
    "padrao_iptu",
    "uso_iptu",
)
DATE_COLUMN = "data_de_transacao"


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Fail at plan time when a required column is absent."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def is_header_row(columns: Sequence[str]) -> Column:
    """True for a header line repeated among the data."""
    def says(column: str, test) -> Column:
        cell = F.col(column).cast("string")
        # Data cells are digits and punctuation; only wordy cells are normalized.
        wordy = cell.rlike(r"[A-Za-z]|[^\x00-\x7f]")
        return F.coalesce(F.when(wordy, test(normalize_text(cell))), F.lit(False))

    found = F.lit(False)
    if "n_do_cadastro" in columns:
        found = found | says("n_do_cadastro", lambda t: t.contains("N DO CADASTRO"))
    if DATE_COLUMN in columns:
        found = found | says(DATE_COLUMN, lambda t: t == "DATA DE TRANSACAO")
    return found


def drop_header_rows(df: DataFrame) -> DataFrame:
    return df.where(~is_header_row(df.columns))


def is_non_positive(target: str = TARGET) -> Column:
    """Target at or below zero; a NULL target is not."""
    return F.coalesce(F.col(target) <= 0, F.lit(False))


def drop_non_positive_target(df: DataFrame, target: str = TARGET) -> DataFrame:
    return df.where(~is_non_positive(target)) if target in df.columns else df


def clean(df: DataFrame) -> DataFrame:
    """The cleaning stage: names, mojibake, headers, duplicates, types, labels, target."""
    return _clean(df, lambda rows, *aggs: rows)


def clean_counted(df: DataFrame) -> tuple[DataFrame, Callable[[int, int], dict | None]]:
    """:func:`clean`, and what to ask for its removal counters once it has been written.

    The counters are gathered while the table is cleaned, so it is read once.
    Spark may count rows of a stage again that it repeats after losing an
    executor; so the answer is checked against the rows before and after
    (both plain counts of stored tables) and is None where it does not add up.
    """
    read, typed = Observation("read"), Observation("typed")
    watches = iter((read, typed))
    out = _clean(df, lambda rows, *aggs: rows.observe(next(watches), *aggs))

    def counters(rows_before: int, rows_after: int) -> dict | None:
        seen, left = read.get, typed.get
        if seen["rows"] != rows_before or left["rows"] - left["low"] != rows_after:
            return None
        return {"header_rows": seen["headers"], "duplicate_rows": seen["rows"] - seen["headers"] - left["rows"], "non_positive_target_rows": left["low"]}

    return out, counters


def _clean(df: DataFrame, watched) -> DataFrame:
    repaired = repair_all(snake_columns(df))
    rows = F.count(F.lit(1)).alias("rows")
    seen = watched(repaired, rows, F.count_if(is_header_row(repaired.columns)).alias("headers"))
    out = drop_header_rows(seen).dropDuplicates()
    labels = [c for c in LABEL_COLUMNS if c in out.columns]
    # Labels are repaired once more in a projection of their own: the next one
    # refers to each several times, and Catalyst then evaluates them once.
    out = out.withColumns({c: repair_mojibake(F.col(c)) for c in labels})
    typed = {c: parse_br_number(F.col(c)) for c in NUMERIC_COLUMNS if c in out.columns}
    typed |= {c: normalize_text(F.col(c), repair=False) for c in labels}
    if DATE_COLUMN in out.columns:
        typed[DATE_COLUMN] = parse_date(F.col(DATE_COLUMN))
    out = out.withColumns(typed)
    low = is_non_positive() if TARGET in out.columns else F.lit(False)
    return drop_non_positive_target(watched(out, rows, F.count_if(low).alias("low")))


def removal_counters(df: DataFrame) -> DataFrame:
    """One row: how many rows each cleaning step removes.

    Copies of a row are grouped by two row hashes, so rows themselves are not
    shuffled; header and target flags are the same for all copies.
    """
    renamed = repair_all(snake_columns(df))
    target = parse_br_number(F.col(TARGET)) if TARGET in renamed.columns else F.lit(None).cast("double")
    first, second = row_hashes(renamed)
    grouped = renamed.groupBy(first.alias("_a"), second.alias("_b")).agg(
        F.count(F.lit(1)).alias("_copies"),
        F.bool_or(is_header_row(renamed.columns)).alias("_header"),
        F.bool_or(F.coalesce(target <= 0, F.lit(False))).alias("_low"),
    )
    kept = ~F.col("_header")
    return grouped.agg(
        F.coalesce(F.sum(F.when(F.col("_header"), F.col("_copies"))), F.lit(0)).alias("header_rows"),
        F.coalesce(F.sum(F.when(kept, F.col("_copies") - 1)), F.lit(0)).alias("duplicate_rows"),
        F.count_if(kept & F.col("_low")).alias("non_positive_target_rows"),
    )


def drop_incomplete(df: DataFrame, required: Sequence[str], at_least: int = 0) -> DataFrame:
    """Rows with every required field; fails when fewer than ``at_least`` remain."""
    out = require_columns(df, required).na.drop(subset=list(required))
    if at_least and out.limit(at_least).count() < at_least:
        raise ValueError(f"fewer than {at_least} rows left after the required-field filter")
    return out


def in_range(area: str = AREA, target: str = TARGET, area_min: float = 1, area_max: float = 50_000) -> Column:
    """Area within bounds (inclusive) and a known, positive target."""
    return F.col(area).between(area_min, area_max) & F.col(target).isNotNull() & (F.col(target) > 0)


def assert_domain(df: DataFrame, required: Sequence[str], month: str = "mes") -> DataFrame:
    """Fail when the table is empty, holds a NULL, or a month outside 1..12."""
    facts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.greatest(*[F.col(c).isNull().cast("int") for c in required]) == 1).alias("nulls"),
        F.count_if(~F.col(month).between(1, 12)).alias("months"),
    ).first()
    if facts["rows"] == 0:
        raise ValueError("no valid row left after the quality filters")
    if facts["nulls"]:
        raise ValueError(f"{facts['nulls']} rows hold a NULL in a required column")
    if facts["months"]:
        raise ValueError(f"{facts['months']} rows have a month outside 1..12")
    return df


def prepare_valued(df: DataFrame, region: Column, area: str = AREA, target: str = TARGET) -> DataFrame:
    """Rows usable for price per square metre, with ``bairro`` and ``valor_m2_estimado``."""
    typed = df.withColumns({
        "bairro": region,
        area: F.col(area).try_cast("double"),
        target: F.col(target).try_cast("double"),
    }).na.drop(subset=["bairro", area, target])
    kept = typed.where((F.col(area) > 0) & (F.col(target) > 0))
    return kept.withColumn("valor_m2_estimado", F.try_divide(target, area))
