"""From the clean table to the five model columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.values import digits_only, with_period
from .cleaning import AREA, DATE_COLUMN, TARGET, in_range, require_columns

FEATURE_COLUMNS = ("cep", "area_do_terreno_m2", "valor_venal_de_referencia", "ano", "mes")


def build_features(clean: DataFrame, category: str = "TERRENO", area_min: float = 1,
                   area_max: float = 50_000) -> DataFrame:
    """Land sales with a usable area and target: filters first, then the contract's columns."""
    required = ("descricao_do_uso_iptu", "cep", AREA, TARGET, DATE_COLUMN)
    rows = require_columns(clean, required).where(
        (F.col("descricao_do_uso_iptu") == category) & in_range(area_min=area_min, area_max=area_max)
    )
    dated = with_period(rows.withColumn("cep", digits_only(F.col("cep"))))
    return dated.select(*FEATURE_COLUMNS).na.drop(subset=list(FEATURE_COLUMNS))
