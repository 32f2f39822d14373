"""Least squares on one-hot codes and a few numbers, solved exactly by eliminating the codes.

The design has one column per code, so its normal equations fall into a block
per code and a small dense block. Per-code sums from one aggregation eliminate
the former; what is left is a system of as many unknowns as there are numbers,
plus the intercept. With sums per code and period, every fold of an expanding
backtest comes from the same pass.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce
from operator import add

import numpy as np
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.values import period_key
from ..session import materialize
from .stored import StoredModel

# Codes whose effects are held in the model itself; more are a table beside it.
HELD_CODES = 100_000


def _pairs(k: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(k) for j in range(i, k)]


def _centred(df: DataFrame, numeric: Sequence[str], target: str, centre: Sequence[float]) -> DataFrame:
    """Columns ``y`` and ``x0``, ``x1``, ... less their centre, which keeps sums of squares small."""
    named = [*[(f"x{i}", c) for i, c in enumerate(numeric)], ("y", target)]
    return df.withColumns({name: F.col(c).cast("double") - F.lit(at) for (name, c), at in zip(named, centre, strict=True)})


def find_centre(df: DataFrame, numeric: Sequence[str], target: str) -> list[float]:
    row = df.agg(*[F.avg(c) for c in (*numeric, target)]).first()
    if row[-1] is None or any(v is None for v in row):
        raise ValueError("no row to fit a line on")
    return [float(v) for v in row]


def _sums(k: int) -> list[Column]:
    """Rows, sums and products that a fit needs; all of them add up over parts of a group."""
    return [
        F.count(F.lit(1)).cast("double").alias("n"), F.sum("y").alias("sy"), *[F.sum(f"x{i}").alias(f"s{i}") for i in range(k)],
        *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"p{i}{j}") for i, j in _pairs(k)],
        *[F.sum(F.col(f"x{i}") * F.col("y")).alias(f"q{i}") for i in range(k)],
    ]


def _sum_names(k: int) -> list[str]:
    return ["n", "sy", *[f"s{i}" for i in range(k)], *[f"p{i}{j}" for i, j in _pairs(k)], *[f"q{i}" for i in range(k)]]


def _reduced(k: int, alpha: float) -> list[Column]:
    """The small system, summed over codes whose own column is eliminated, and plain moments of the codes' means."""
    n, sy, held = F.col("n"), F.col("sy"), F.col("n") + F.lit(alpha)
    s = [F.col(f"s{i}") for i in range(k)]
    return [
        F.sum(n - n * n / held).alias("b"), F.sum(sy - n * sy / held).alias("gb"), *[F.sum(s[i] - n * s[i] / held).alias(f"u{i}") for i in range(k)],
        *[F.sum(F.col(f"p{i}{j}") - s[i] * s[j] / held).alias(f"w{i}{j}") for i, j in _pairs(k)],
        *[F.sum(F.col(f"q{i}") - s[i] * sy / held).alias(f"g{i}") for i in range(k)], F.count(F.lit(1)).alias("codes"),
        F.sum(sy / n).alias("my"), *[F.sum(s[i] / n).alias(f"m{i}") for i in range(k)],
        *[F.sum(s[i] * s[j] / (n * n)).alias(f"mm{i}{j}") for i, j in _pairs(k)], *[F.sum(s[i] * sy / (n * n)).alias(f"my{i}") for i in range(k)],
    ]


def solve(row, k: int, alpha: float) -> tuple[float, np.ndarray]:
    """(intercept, slopes) for centred columns from one row of reduced sums.

    With a penalty the solution is unique. Without one, slopes that no code's
    own rows determine, and the split between codes and intercept, are those of
    least norm, as a solver on the centred one-hot design would give.
    """
    def square(name):
        out = np.zeros((k, k))
        for i, j in _pairs(k):
            out[i, j] = out[j, i] = row[f"{name}{i}{j}"]
        return out

    def line(name):
        return np.array([row[f"{name}{i}"] for i in range(k)], float)

    within, g = square("w"), line("g")
    if alpha:
        u, beta = line("u"), row["b"]
        slopes = np.linalg.solve(within + alpha * np.eye(k) - np.outer(u, u) / beta, g - u * row["gb"] / beta) if k else np.zeros(0)
        return float((row["gb"] - u @ slopes) / beta), slopes
    scale = np.sqrt(np.maximum(np.diag(square("mm")) + np.diag(within), 1e-300)) if k else np.ones(0)
    values, vectors = np.linalg.eigh(within / np.outer(scale, scale)) if k else (np.zeros(0), np.zeros((0, 0)))
    sure = values > 1e-10 * max(values.max(initial=0.0), 1e-10)
    slopes = (vectors[:, sure] / values[sure]) @ (vectors[:, sure].T @ (g / scale)) / scale
    loose = vectors[:, ~sure] / scale[:, None]
    means, cross, codes = line("m"), square("mm"), row["codes"]
    left, right = np.zeros((loose.shape[1] + 1,) * 2), np.zeros(loose.shape[1] + 1)
    # least squares of the codes' effects and the slopes over intercept and undetermined directions
    left[0, 0], left[0, 1:], left[1:, 0] = codes, means @ loose, means @ loose
    left[1:, 1:] = loose.T @ (cross + np.eye(k)) @ loose
    right[0] = row["my"] - means @ slopes
    right[1:] = loose.T @ (line("my") - cross @ slopes - slopes)
    found = np.linalg.lstsq(left, right, rcond=None)[0]
    return float(found[0]), slopes + loose @ found[1:]


class CodeLinearModel(StoredModel):
    """Intercept, slopes and one effect per code as a pipeline stage; an unseen or NULL code adds nothing."""

    fitted = Param(Params._dummy(), "fitted", "columns, slopes and held effects as JSON", TypeConverters.toString)

    def __init__(self, code: str = "", numeric: Sequence[str] = (), intercept: float = 0.0, slopes: Sequence[float] = (), effects: dict | DataFrame | None = None):
        super().__init__(effects if isinstance(effects, DataFrame) else None, "effects")
        if effects is not None:
            held = {} if isinstance(effects, DataFrame) else {"effects": effects}
            self._set(fitted=json.dumps({"code": code, "numeric": list(numeric), "intercept": intercept, "slopes": list(map(float, slopes)), **held}))

    def parts(self) -> dict:
        """Columns, slopes, intercept and, where the model holds them itself, ``effects``."""
        return json.loads(self.getOrDefault(self.fitted))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        held, spark = self.parts(), dataset.sparkSession
        if "effects" in held:
            effects = F.broadcast(spark.createDataFrame(list(held["effects"].items()), "_code string, _effect double"))
        else:
            effects = self.stored(spark).select(F.col("code").alias("_code"), F.col("effect").alias("_effect"))
        joined = dataset.join(effects, F.col(held["code"]).cast("string") == F.col("_code"), "left")
        terms = [F.lit(held["intercept"]), F.coalesce("_effect", F.lit(0.0)), *[F.col(c).cast("double") * F.lit(w) for c, w in zip(held["numeric"], held["slopes"], strict=True)]]
        return joined.withColumn("prediction", reduce(add, terms)).drop("_code", "_effect")


def _effect(k: int, alpha: float, intercept: Column, slopes: Sequence[Column]) -> Column:
    fitted = reduce(add, [F.col("n") * intercept, *[F.col(f"s{i}") * slopes[i] for i in range(k)]])
    return (F.col("sy") - fitted) / (F.col("n") + F.lit(alpha))


def fit_codes(train: DataFrame, target: str, code: str, numeric: Sequence[str], alpha: float = 0.0) -> CodeLinearModel:
    """Least squares (``alpha`` = 0) or ridge on one-hot ``code`` plus ``numeric``, with a free intercept.

    Two passes: centres, then sums per code. Effects of up to ``HELD_CODES``
    codes come to the driver with the model; more are a table beside it. Rows
    with a NULL number or target are left out.
    """
    k = len(numeric)
    rows = train.select(F.coalesce(F.col(code).cast("string"), F.lit("\0null")).alias("code"), *numeric, target).na.drop(subset=[*numeric, target])
    centre = find_centre(rows, numeric, target)
    sums = materialize(_centred(rows, numeric, target, centre).groupBy("code").agg(*_sums(k)), "code-sums")
    reduced = sums.agg(*_reduced(k, alpha)).first()
    intercept, slopes = solve(reduced, k, alpha)
    effect = _effect(k, alpha, F.lit(intercept), [F.lit(float(w)) for w in slopes])
    effects = sums.select("code", effect.alias("effect"))
    if reduced["codes"] <= HELD_CODES:
        effects = {r["code"]: r["effect"] for r in effects.collect()}
    whole = intercept + centre[-1] - float(np.dot(slopes, centre[:-1]))
    return CodeLinearModel(code, numeric, whole, slopes, effects)


def backtest_codes(df: DataFrame, target: str, code: str, numeric: Sequence[str], folds: Sequence[int], alpha: float = 0.0) -> DataFrame:
    """Rows of every fold's period with ``fold`` (yyyymm) and the ``prediction`` of a fit on all earlier periods.

    One aggregation per (code, period) holds all that any fold needs: a fold's
    sums are those of the periods before it. The systems of the folds, a row
    each, are solved on the driver; effects are joined to the fold's own rows.
    """
    k, spark = len(numeric), df.sparkSession
    rows = df.withColumn("_code", F.coalesce(F.col(code).cast("string"), F.lit("\0null"))).withColumn("_p", period_key(F.col("ano"), F.col("mes")))
    known = rows.na.drop(subset=[*numeric, target])
    centre = find_centre(known, numeric, target)
    by_period = _centred(known, numeric, target, centre).groupBy("_code", "_p").agg(*_sums(k))
    later = F.filter(F.array(*[F.lit(f) for f in folds]), lambda f: f > F.col("_p"))
    names = _sum_names(k)
    by_fold = by_period.withColumn("fold", F.explode(later)).groupBy("fold", "_code").agg(*[F.sum(c).alias(c) for c in names])
    by_fold = materialize(by_fold, "fold-sums")
    lines = []
    for row in by_fold.groupBy("fold").agg(*_reduced(k, alpha)).collect():  # one row per fold
        intercept, slopes = solve(row, k, alpha)
        lines.append((row["fold"], intercept, *map(float, slopes)))
    fitted = _lines(spark, lines, k)
    effects = by_fold.join(F.broadcast(fitted), "fold").select("fold", "_code", _effect(k, alpha, F.col("_b"), [F.col(f"_c{i}") for i in range(k)]).alias("_effect"))
    tested = rows.where(F.col("_p").isin(*folds)).withColumn("fold", F.col("_p")).drop("_p")
    scored = tested.join(F.broadcast(fitted), "fold").join(effects, ["fold", "_code"], "left")
    shifted = [(F.col(c).cast("double") - F.lit(at)) * F.col(f"_c{i}") for i, (c, at) in enumerate(zip(numeric, centre[:-1], strict=True))]
    prediction = reduce(add, [F.col("_b") + F.lit(centre[-1]), F.coalesce("_effect", F.lit(0.0)), *shifted])
    return scored.withColumn("prediction", prediction).drop("_code", "_effect", "_b", *[f"_c{i}" for i in range(k)])


def _lines(spark: SparkSession, lines: list, k: int) -> DataFrame:
    return spark.createDataFrame(lines, ", ".join(["fold int", "_b double", *[f"_c{i} double" for i in range(k)]]))
