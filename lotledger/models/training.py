"""Price models on Spark ML: fit, compare, backtest, validate, log."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.payload import model_version
from ..functions.values import period_label
from ..operators.metrics import (
    backtest_summary, prediction_range, regression_metrics, standard_segments, worst_segments,
)
from ..operators.splits import backtest_periods, period_range, temporal_holdout
from ..session import materialize
from .forest import ForestModel, grow
from .linear import backtest_codes, fit_codes
from .vectors import CodeAssembler, CodeIndexer, CodeOneHot, fit_wide, width

# The model's columns.
CATEGORICAL = ("cep",)
NUMERIC = ("area_do_terreno_m2", "ano", "mes")
FEATURES = ("cep", "area_do_terreno_m2", "ano", "mes")
TARGET = "valor_venal_de_referencia"
METRICS = ("mae", "median_absolute_error", "p95_absolute_error", "bias", "r2")
# Steps in which a linear fit must converge.
MAX_STEPS = 500
# Columns up to which the coefficients of a linear fit are the driver's.
HELD_COLUMNS = 100_000


def feature_stages(categorical: Sequence[str] = CATEGORICAL, numeric: Sequence[str] = NUMERIC) -> list:
    """One-hot categories plus numerics as they are.

    The indexer's extra slot for unseen categories is the one the encoder
    drops, so an unseen category is the zero vector. Labels are a table.
    """
    index = CodeIndexer(list(categorical), [f"{c}_index" for c in categorical])
    onehot = CodeOneHot([f"{c}_index" for c in categorical], [f"{c}_onehot" for c in categorical])
    return [index, onehot, CodeAssembler([f"{c}_onehot" for c in categorical] + list(numeric), "features")]


def unseen_rate(model: PipelineModel, df: DataFrame, column: str = "cep") -> DataFrame:
    """Share of rows whose category the model never saw."""
    indexer = model.stages[0]
    known = indexer.sizes()[indexer.getInputCols().index(column)]
    indexed = indexer.transform(df)
    return indexed.agg(F.avg((F.col(f"{column}_index") >= known).cast("int")).alias("unseen_rate"))


def mean_model(train: DataFrame, target: str = TARGET) -> PipelineModel:
    """Always predicts the training mean; stored and loaded like any other model."""
    mean = train.agg(F.avg(target)).first()[0]
    return PipelineModel([SQLTransformer(statement=f"SELECT *, CAST({mean!r} AS DOUBLE) AS prediction FROM __THIS__")])


def fit_linear(df: DataFrame, features: str, target: str, reg_param: float = 0.0):
    """Least squares with an L2 penalty on unscaled coefficients.

    Beyond ``HELD_COLUMNS`` columns the solver's vectors are tables
    (:func:`.vectors.fit_wide`); the solution is the same. One-hot columns add up to the intercept. The iteration starts at zero and
    never leaves the span of the centred features, so of all least-squares
    solutions it finds the one of least norm (of standardized coefficients);
    an unseen category is then priced near the mean of the seen ones.

    Rows of one design enter as one, with their mean and their number as its
    weight: the sums of squares differ by a constant, and a step of the
    iteration passes over the designs instead of all rows.
    """
    # a missing target in any row stays missing, so the fit refuses it
    mean = F.when(F.count(target) == F.count(F.lit(1)), F.avg(target))
    designs = df.groupBy(features).agg(mean.alias("_mean"), F.count(F.lit(1)).cast("double").alias("_rows"))
    if (width(df, features) or 0) > HELD_COLUMNS:
        whole = df.agg(F.stddev_samp(target).alias("s"), F.count(F.lit(1)).alias("n")).first() if reg_param else None
        return fit_wide(designs, features, reg_param * whole["n"] / whole["s"] if whole and whole["s"] else 0.0, MAX_STEPS)
    if reg_param:
        # the penalty scales with the label's deviation, which means have less of
        designs = materialize(designs, "designs")
        label = array_to_vector(F.array(F.coalesce("_mean", F.lit(0.0))))
        kept = designs.agg(Summarizer.std(label, F.col("_rows")).alias("s")).first()["s"]
        whole = df.agg(F.stddev_samp(target)).first()[0]
        reg_param *= kept[0] / whole if kept is not None and kept[0] and whole else 1.0
    model = LinearRegression(
        featuresCol=features, labelCol="_mean", weightCol="_rows", regParam=reg_param, elasticNetParam=0.0, standardization=False,
        solver="l-bfgs", maxIter=MAX_STEPS, tol=1e-9,
    ).fit(designs)
    if model.summary.totalIterations >= MAX_STEPS:
        raise ValueError(f"linear fit did not converge in {MAX_STEPS} steps")
    return model


def ridge_reg_param(df: DataFrame, target: str, alpha: float) -> float:
    """Spark's penalty equal to ``alpha * |w|^2`` beside a sum of squares.

    Spark divides the loss by n and scales the label by its deviation.
    """
    row = df.agg(F.stddev_samp(target).alias("s"), F.count(F.lit(1)).alias("n")).first()
    return alpha * row["s"] / row["n"]


def ols_model(train: DataFrame, target: str = TARGET) -> PipelineModel:
    """Exact least squares on one-hot codes and numbers; an unseen code is priced at the mean of the codes."""
    return PipelineModel([fit_codes(train, target, CATEGORICAL[0], NUMERIC)])


def ridge_model(train: DataFrame, target: str = TARGET, alpha: float = 1.0) -> PipelineModel:
    """Exact ridge on the same design; the intercept is free."""
    return PipelineModel([fit_codes(train, target, CATEGORICAL[0], NUMERIC, alpha)])


# The code as a number lets trees cut ranges of neighbouring codes besides single ones.
CODE_NUMBER = "_cep_number"


def forest_model(train: DataFrame, target: str = TARGET, trees: int = 200, depth: int = 30, seed: int = 42, **options) -> PipelineModel:
    """A forest over the numbers, the code as a number and the code as a category."""
    numbered = SQLTransformer(statement=f"SELECT *, try_cast(cep AS DOUBLE) AS {CODE_NUMBER} FROM __THIS__")
    numeric = (*NUMERIC, CODE_NUMBER)
    grown, _ = grow(numbered.transform(train), target, numeric, CATEGORICAL, trees, depth, seed, **options)
    return PipelineModel([numbered, ForestModel(grown, numeric, CATEGORICAL)])


@dataclass(frozen=True)
class Candidate:
    """A named way to fit a model, the parameters to log for it, and the penalty of a line that one pass can backtest."""

    name: str
    fit: Callable[[DataFrame, str], PipelineModel]
    params: dict = field(default_factory=dict)
    line_penalty: float | None = None


def default_candidates(trees: int = 200, depth: int = 30, seed: int = 42, alpha: float = 1.0) -> list[Candidate]:
    return [
        Candidate("baseline_media", mean_model),
        Candidate("regressao_linear", ols_model, line_penalty=0.0),
        Candidate("ridge", lambda df, t: ridge_model(df, t, alpha), {"alpha": alpha}, line_penalty=alpha),
        Candidate("random_forest", lambda df, t: forest_model(df, t, trees, depth, seed),
                  {"n_estimators": trees, "max_depth": depth, "random_state": seed}),
    ]


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Rows plus ``prediction``, without the intermediate vectors."""
    return model.transform(df).select(*df.columns, "prediction")


@dataclass
class Training:
    """Outcome of :func:`train_candidates`."""

    best: str
    models: dict
    leaderboard: DataFrame
    split: DataFrame


def train_candidates(df: DataFrame, key: str, candidates: Sequence[Candidate], target: str = TARGET,
                     test_size: float = 0.2) -> Training:
    """Fit every candidate on the temporal train side, rank by MAE on the test side.

    Features and labelled split are written once; each fit reads the split.
    """
    rows = materialize(df.select(key, *FEATURES, target), "features")
    split = materialize(temporal_holdout(rows, key, test_size), "split")
    train, test = split.where("split = 'train'"), split.where("split = 'test'")
    models, rows = {}, None
    for candidate in candidates:
        model = candidate.fit(train, target)
        models[candidate.name] = model
        row = regression_metrics(predict(model, test), target, "prediction").withColumn("model_name", F.lit(candidate.name))
        rows = row if rows is None else rows.unionByName(row)
    board = materialize(rows.select("model_name", "n", *METRICS), "leaderboard")
    best = board.agg(F.min_by("model_name", "mae")).first()[0]
    return Training(best, models, board.orderBy("mae", "model_name"), split)


def temporal_backtest(df: DataFrame, candidate: Candidate, target: str = TARGET, windows: int = 3,
                      min_train_periods: int = 3) -> DataFrame:
    """Metrics per test period, refitting on everything strictly earlier.

    Lines come from one pass over the table for all periods; other models are
    fitted once per period.
    """
    needed = [*FEATURES, target]
    folds = backtest_periods(df, windows, min_train_periods)
    if not folds:
        raise ValueError("not enough periods for a backtest")
    if candidate.line_penalty is not None:
        scored = materialize(backtest_codes(df.select(*needed), target, CATEGORICAL[0], NUMERIC, folds, candidate.line_penalty), "backtest-scores")
        by_fold = regression_metrics(scored, target, "prediction", ["fold"])
        period = period_label(F.floor(F.col("fold") / 100), F.col("fold") % 100)
        return by_fold.withColumn("period", period).select("period", "n", *METRICS)
    rows = materialize(df.select(*needed), "backtest-rows")
    month = F.col("ano") * 100 + F.col("mes")
    out = None
    for fold in folds:  # at most `windows`
        period = f"{fold // 100}-{fold % 100:02d}"
        model = candidate.fit(rows.where(month < fold), target)
        scored = predict(model, rows.where(month == fold))
        row = regression_metrics(scored, target, "prediction").withColumn("period", F.lit(period))
        out = row if out is None else out.unionByName(row)
    return out.select("period", "n", *METRICS)


def _segment_lists(segments: DataFrame) -> list:
    """The three segment lists of a report, worst first (few rows: groups of at least 30)."""
    return [
        ("by_period", segments.where("dimension = 'period'")),
        ("by_target_band", segments.where("dimension = 'target_band'")),
        ("worst_ceps_by_mae", worst_segments(segments, "cep")),
    ]


def segment_columns(scored: DataFrame, target: str = TARGET, min_group_size: int = 30) -> DataFrame:
    """One row with the segment lists as arrays of structs."""
    fields = ["value", "n", "mae", "median_absolute_error", "bias"]
    segments = materialize(
        standard_segments(scored, target, "prediction", min_group_size), "segments"
    )
    out = None
    for name, part in _segment_lists(segments):
        ordered = F.array_sort(F.collect_list(F.struct((-F.col("mae")).alias("_order"), F.struct(*fields).alias("s"))))
        row = part.agg(F.transform(ordered, lambda x: x["s"]).alias(name)).withColumn("_one", F.lit(1))
        out = row if out is None else out.join(row, "_one")
    return out.drop("_one")


def validation_report(model: PipelineModel, df: DataFrame, key: str, env: str, path: str, target: str = TARGET,
                      test_size: float = 0.2, min_group_size: int = 30) -> DataFrame:
    """One nested row: holdout metrics, prediction range and segments of a stored model."""
    holdout = temporal_holdout(df, key, test_size).where("split = 'test'").drop("split")
    scored = materialize(predict(model, holdout), "scored")
    facts = regression_metrics(scored, target, "prediction").withColumnRenamed("n", "n_holdout")
    spread = prediction_range(scored, "prediction").select(F.struct("min", "p05", "median", "p95", "max").alias("prediction_range"))
    span = period_range(scored).select(
        F.col("period_start").alias("holdout_period_start"), F.col("period_end").alias("holdout_period_end")
    )
    segments = segment_columns(scored, target, min_group_size).select(F.struct("*").alias("segment_metrics"))
    one = F.lit(1)
    report = facts.withColumn("_one", one)
    for part in (spread, span, segments):  # one row each
        report = report.join(part.withColumn("_one", one), "_one")
    return report.drop("_one").withColumns({
        "env": F.lit(env), "version": model_version(F.lit(path)), "model_path": F.lit(path),
        "split_strategy": F.lit("temporal_holdout"), "features": F.array(*[F.lit(f) for f in FEATURES]), "target": F.lit(target),
    })


def train_summary(df: DataFrame, trained: Training, candidate: Candidate, version: str, data_version: str,
                  target: str = TARGET) -> DataFrame:
    """One nested row: best model, split ranges, segments, backtest and all candidates."""
    test = trained.split.where("split = 'test'").drop("split")
    scored = materialize(predict(trained.models[trained.best], test), "scored")
    windows = materialize(temporal_backtest(df, candidate, target), "backtest")
    ranges = period_range(trained.split, ("split",)).groupBy().pivot("split", ["train", "test"]).agg(
        F.first("period_start").alias("period_start"), F.first("period_end").alias("period_end")
    )
    counts = trained.split.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("split") == "train").alias("n_train"),
        F.count_if(F.col("split") == "test").alias("n_test"),
    )
    board = trained.leaderboard.agg(
        F.array_sort(F.collect_list(F.struct("mae", "model_name", "r2", "bias", "n"))).alias("candidates")
    )
    backtest = windows.agg(F.array_sort(F.collect_list(F.struct("period", "n", *METRICS))).alias("backtest_windows"))
    parts = [
        counts, ranges, board, backtest,
        backtest_summary(windows).select(F.struct("*").alias("backtest_summary")),
        segment_columns(scored, target).select(F.struct("*").alias("segment_metrics")),
    ]
    out = None
    for part in parts:  # one row each
        part = part.withColumn("_one", F.lit(1))
        out = part if out is None else out.join(part, "_one")
    return out.drop("_one").withColumns({
        "version": F.lit(version), "best_model": F.lit(trained.best), "training_data_version": F.lit(data_version),
        "split_strategy": F.lit("temporal_holdout"), "target": F.lit(target),
    })


def run_records(spark: SparkSession, trained: Training, candidates: Sequence[Candidate], version: str,
                data_version: str, target: str = TARGET) -> DataFrame:
    """One log row per candidate: tags, parameters and the five metrics."""
    info = [
        (c.name, {k: str(v) for k, v in {"target": target, "features": ",".join(FEATURES), **c.params}.items()})
        for c in candidates
    ]
    params = spark.createDataFrame(info, "model_name string, params map<string,string>")
    metric_map = F.create_map(*[x for m in METRICS for x in (F.lit(m), F.col(m))])
    tags = F.create_map(
        F.lit("model_version"), F.lit(version), F.lit("training_data_version"), F.lit(data_version),
        F.lit("leakage_removed"), F.lit("valor_m2,media_valor_cep"), F.lit("stage"), F.lit("dev"),
        F.lit("split_strategy"), F.lit("temporal_holdout"),
    )
    rows = trained.leaderboard.join(params, "model_name")
    run_id = F.substring(F.sha2(F.concat_ws("|", "model_name", F.lit(version), F.lit(data_version)), 256), 1, 32)
    return rows.select(run_id.alias("run_id"), "model_name", tags.alias("tags"), "params", metric_map.alias("metrics"))


def log_runs(records: DataFrame, path: str) -> None:
    """Append run rows to the runs table."""
    records.write.mode("append").parquet(path)
