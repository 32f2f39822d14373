"""Model registry: which stored model an environment uses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from ..functions.payload import model_version


def newest_models(registry: DataFrame, path: str = "path", env: str = "env") -> DataFrame:
    """Newest model per environment: the greatest folder name."""
    name = F.element_at(F.split(F.col(path), "/"), -1)
    best = registry.where(name.startswith("model_")).groupBy(env).agg(F.max_by(path, name).alias("path"))
    return best.withColumn("version", model_version(F.col("path")))


def resolve_model(registry: DataFrame, envs: Sequence[str] = ("prod", "dev"), version: str | None = None) -> DataFrame:
    """One row: the newest (or the named) model of the first environment that has one."""
    rows = registry.where(F.col("env").isin(*envs))
    if version:
        rows = rows.where(model_version(F.col("path")) == version)
    rank = F.array_position(F.array(*[F.lit(e) for e in envs]), F.col("env"))
    return newest_models(rows).orderBy(rank).limit(1)


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
