"""Batch scoring of requests and the promotion decision."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from ..functions.payload import resolve_aliases
from ..functions.values import digits_only, lenient_double
from ..operators.policy import request_violations
from ..operators.scale import sized_join

REQUEST_FIELDS = ("cep", "cep_prefixo", "area_do_terreno_m2", "area", "ano", "mes", "ano_mes")
MODEL_FIELDS = ("cep", "area_do_terreno_m2", "ano", "mes")


def with_model_input(requests: DataFrame) -> DataFrame:
    """Add ``input`` (normalized fields) and ``missing_fields``; absent columns count as NULL."""
    given = {
        f: F.nullif(F.col(f).cast("string"), F.lit("")) if f in requests.columns else F.lit(None).cast("string")
        for f in REQUEST_FIELDS
    }
    resolved = requests.withColumn("_p", resolve_aliases(**given))
    p = F.col("_p")
    missing = F.array_compact(F.array(*[F.when(p[f].isNull(), F.lit(f)) for f in MODEL_FIELDS]))
    model_input = F.struct(
        digits_only(p["cep"]).alias("cep"), lenient_double(p["area_do_terreno_m2"]).alias("area_do_terreno_m2"),
        p["ano"].alias("ano"), p["mes"].alias("mes"),
    )
    return resolved.withColumns({"missing_fields": missing, "input": model_input}).drop("_p")


def score_requests(requests: DataFrame, model: PipelineModel) -> DataFrame:
    """Price every request: ``status``, ``error``, ``missing_fields``, ``valor_estimado``.

    Works on batch and streaming tables alike. Invalid rows pass through the
    model with neutral values so one scan serves both kinds; their estimate
    is then dropped.
    """
    checked = with_model_input(requests).withColumn("_violations", request_violations(
        F.col("input.cep"), F.col("input.area_do_terreno_m2"), F.col("input.ano"), F.col("input.mes")))
    ready = checked.withColumns({
        "_cep": F.coalesce("input.cep", F.lit("")),
        "_area": F.coalesce("input.area_do_terreno_m2", F.lit(0.0)),
        "_ano": F.coalesce("input.ano", F.lit(0)),
        "_mes": F.coalesce("input.mes", F.lit(0)),
    })
    names = {"_cep": "cep", "_area": "area_do_terreno_m2", "_ano": "ano", "_mes": "mes"}
    kept = [c for c in requests.columns if c not in names.values()]
    model_view = ready.select(
        *kept, "missing_fields", "input", "_violations", *[F.col(a).alias(b) for a, b in names.items()]
    )
    scored = model.transform(model_view)
    error = (
        F.when(F.size("missing_fields") > 0, "missing_fields")
        .when(F.size("_violations") > 0, F.element_at("_violations", 1))
        .when(F.coalesce(F.col("prediction") < 0, F.lit(True)), "invalid_model_output")
    )
    return scored.select(
        *kept, "input", "missing_fields", error.alias("error"),
        F.when(error.isNull(), "success").otherwise("error").alias("status"),
        F.when(error.isNull(), F.col("prediction")).alias("valor_estimado"),
    )


def promotion_decisions(candidates: DataFrame, active: DataFrame, max_mae: float | None = None,
                        improvement_pct: float = 0.0) -> DataFrame:
    """Decide which candidates may enter ``to_env``.

    ``candidates``: model, to_env, validation_mae, train_mae. ``active``: one
    row per env with validation_mae, train_mae. The validation figure wins.
    A candidate above ``max_mae`` is blocked; where a model is active and an
    improvement is asked for, it must be better by that percentage.
    """
    current = active.select(
        F.col("env").alias("to_env"), F.lit(True).alias("_active"),
        F.coalesce("validation_mae", "train_mae").alias("active_mae"),
    )
    judged = sized_join(
        candidates.withColumn("candidate_mae", F.coalesce("validation_mae", "train_mae")), current, ["to_env"], "left"
    )
    mae, active_mae = F.col("candidate_mae"), F.col("active_mae")
    needed = active_mae * (1 - improvement_pct / 100)
    above_limit = F.lit(False) if max_mae is None else mae > max_mae
    reason = (
        F.when(mae.isNull(), "candidate_without_metric")
        .when(above_limit, "above_max_mae")
        .when(F.col("_active").isNull(), "no_active_model")
        .when(F.lit(improvement_pct <= 0), "comparison_skipped")
        .when(active_mae.isNull(), "active_without_metric")
        .when(mae > needed, "not_enough_improvement")
        .otherwise("improved")
    )
    approved = reason.isin("no_active_model", "comparison_skipped", "improved")
    return judged.withColumns({
        "required_mae": F.when(F.lit(improvement_pct > 0), needed), "reason": reason, "approved": approved,
    }).drop("_active")
