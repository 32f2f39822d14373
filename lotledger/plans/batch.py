"""The batch stages end to end: clean, features, exploration, training, validation.

A published table is a folder of versions and a table of pointers, of which the
newest counts. A stage writes a new version, judges what it wrote, and appends a
pointer only when the gate passes: nothing is copied or overwritten, and a
failed gate or a crash leaves readers on the version they had.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.values import region_key
from ..models import training
from ..operators import cleaning, features, quality, regions
from ..session import materialize
from ..sources import fingerprint, registry, sinks


# Column that tells rows of the feature table apart.
ROW_ID = "id"


def _write_version(df: DataFrame, path: str) -> tuple[str, DataFrame]:
    version = f"{path}/version-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(version)
    return version, df.sparkSession.read.schema(df.schema).parquet(version)


def _point_to(spark: SparkSession, path: str, version: str) -> None:
    row = spark.createDataFrame([(time.time_ns(), version)], "at long, version string")
    row.coalesce(1).write.mode("append").parquet(f"{path}/pointers")


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a published table."""
    return spark.read.parquet(spark.read.parquet(f"{path}/pointers").agg(F.max_by("version", "at")).first()[0])


def publish_clean(raw: DataFrame, path: str, report_path: str | None = None, **limits) -> DataFrame:
    """Clean the raw table, gate its quality, publish it as Parquet.

    One pass over the raw rows cleans and counts; only where a repeated stage
    spoilt the counts is a pass made for them alone.
    """
    cleaned, counters = cleaning.clean_counted(raw)
    version, staged = _write_version(cleaned, path)
    removed = counters(raw.count(), staged.count()) or cleaning.removal_counters(raw).first()
    profile = quality.quality_profile(
        staged, removed["header_rows"], removed["duplicate_rows"], removed["non_positive_target_rows"]
    )
    judged = materialize(quality.quality_failures(profile, **limits), "profile")
    if report_path:
        sinks.write_json_report(judged, report_path)
    quality.assert_passed(judged, "quality criteria")
    _point_to(raw.sparkSession, path, version)
    return staged


def publish_features(clean: DataFrame, path: str, report_path: str | None = None, **limits) -> DataFrame:
    """Build the feature table, gate its contract, publish it as Parquet.

    Every row gets its ``id`` here, once, and is stored with it: training and
    validation cut the table by that column, so both see one holdout.
    """
    built = features.build_features(clean).withColumn(ROW_ID, F.monotonically_increasing_id())
    version, staged = _write_version(built, path)
    cleaning.assert_domain(staged, features.FEATURE_COLUMNS)
    contract = materialize(quality.feature_contract(staged, **limits), "contract")
    if report_path:
        sinks.write_json_report(contract, report_path)
    quality.assert_passed(contract, "feature contract")
    _point_to(clean.sparkSession, path, version)
    return staged


def explore(df: DataFrame, path: str, bins: int = 50, min_samples: int = 20) -> dict[str, DataFrame]:
    """Region and frequency tables, each written below ``path``."""
    valued = materialize(cleaning.prepare_valued(df, region_key(df)), "valued")
    if valued.isEmpty():
        raise ValueError("no valid row to compute price per square metre")
    summary = materialize(regions.region_summary(valued, min_samples), "summary")
    tables = {
        "summary": summary,
        "overall": regions.overall_price(valued),
        "dearest": regions.dearest(summary),
        "cheapest": regions.cheapest(summary),
        "frequency_price_m2": regions.frequency_table(valued, "valor_m2_estimado", bins),
        "frequency_value": regions.frequency_table(valued, cleaning.TARGET, bins),
    }
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{path}/{name}")
    return {name: df.sparkSession.read.parquet(f"{path}/{name}") for name in tables}


@dataclass(frozen=True)
class StoredModel:
    """A trained model on disk and its one-row summary."""

    path: str
    summary: DataFrame


def train(feature_table: DataFrame, root: str, version: str,
          candidates: Sequence[training.Candidate] | None = None) -> StoredModel:
    """Fit the candidates, store the best as ``<root>/dev/model_<version>`` and log every run.

    The holdout is cut by the stored ``id``.
    """
    candidates = list(candidates or training.default_candidates())
    rows = cleaning.require_columns(feature_table, (ROW_ID,))
    data_version = fingerprint.table_fingerprint(rows.drop(ROW_ID)).first()["digest"]
    trained = training.train_candidates(rows, ROW_ID, candidates)
    best = next(c for c in candidates if c.name == trained.best)
    summary = materialize(training.train_summary(rows, trained, best, version, data_version), "train-summary")
    path = registry.save_model(trained.models[trained.best], f"{root}/dev/model_{version}")
    sinks.write_json_report(summary, f"{root}/metrics/train_{version}")
    training.log_runs(
        training.run_records(feature_table.sparkSession, trained, candidates, version, data_version), f"{root}/runs"
    )
    return StoredModel(path, summary)


def validate(feature_table: DataFrame, model_path: str, env: str, report_path: str) -> DataFrame:
    """Validation report of a stored model on the holdout of ``feature_table``."""
    rows = cleaning.require_columns(feature_table, (ROW_ID,))
    report = training.validation_report(registry.load_model(model_path), rows, ROW_ID, env, model_path)
    report = materialize(report, "validation")
    sinks.write_json_report(report, report_path)
    return report
