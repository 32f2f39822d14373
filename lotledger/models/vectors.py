"""Categories as sparse vectors, and lines on them, where neither labels nor coefficients fit a driver.

Labels and coefficients are tables, and columns of vectors name their size only:
the attributes that Spark's own stages attach hold a name per category.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.ml import Estimator, Transformer
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCol, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..session import materialize
from .stored import StoredModel

_STRUCT = "v struct<type: tinyint, size: int, indices: array<int>, values: array<double>>"
_VECTOR = T.StructType([T.StructField("v", VectorUDT())])
# A linear fit has converged where its residual has shrunk by this factor.
SHRUNK = 1e-10


def sparse(size: int, indices: Column, values: Column) -> Column:
    """A vector from its parts; SQL has no cast to one."""
    parts = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"), indices.cast("array<int>").alias("indices"), values.alias("values"))
    return F.from_json(F.to_json(F.struct(parts.alias("v"))), _VECTOR)["v"]


def entries(vector: str) -> Column:
    """A vector as an array of (``index``, ``value``)."""
    v = F.from_json(F.to_json(F.struct(F.col(vector).alias("v"))), _STRUCT)["v"]
    indices = F.when(v["indices"].isNotNull(), v["indices"]).when(F.size(v["values"]) > 0, F.sequence(F.lit(0), F.size(v["values"]) - 1))
    return F.zip_with(indices, v["values"], lambda i, x: F.struct(i.alias("index"), x.alias("value")))


def _sized(column: Column, name: str, **attributes) -> Column:
    return column.alias(name, metadata={"ml_attr": attributes})


def width(df: DataFrame, vector: str) -> int | None:
    """Columns of a vector: what its attributes say, or else its first row; None without rows."""
    found = df.schema[vector].metadata.get("ml_attr", {}).get("num_attrs")
    if found is None:
        row = df.select(vector).first()
        found = row[0].size if row is not None and row[0] is not None else None
    return found


def _with(df: DataFrame, name: str, column: Column) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in df.columns], column)


class CodeIndexer(Estimator, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Numbers labels from the most frequent on, ties by label; a NULL or unseen one gets the slot after the last."""

    def __init__(self, inputCols: Sequence[str] = (), outputCols: Sequence[str] = ()):
        super().__init__()
        self._set(inputCols=list(inputCols), outputCols=list(outputCols))

    def _fit(self, dataset: DataFrame) -> CodeIndexModel:
        sizes, labels = [], None
        for k, c in enumerate(self.getInputCols()):
            label = F.col(c).cast("string")
            counted = dataset.where(label.isNotNull()).groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("n"))
            # sorted by ranges: a label's place is that in its range behind the labels of the ranges before
            placed = materialize(counted.orderBy(F.desc("n"), "label").select("label", F.monotonically_increasing_id().alias("at")), "labels")
            part = F.shiftright("at", 33)
            held = sorted(tuple(r) for r in placed.groupBy(part.alias("p")).count().collect())  # a row per task
            before = dict(zip([p for p, _ in held], accumulate([n for _, n in held], initial=0)))
            start = F.create_map(*[F.lit(x) for p, n in before.items() for x in (p, n)])[part] if held else F.lit(0)
            one = placed.select(F.lit(k).alias("column"), "label", (start + F.col("at").bitwiseAND(2 ** 33 - 1)).cast("double").alias("index"))
            labels = one if labels is None else labels.unionByName(one)
            sizes.append(sum(n for _, n in held))
        return CodeIndexModel(self.getInputCols(), self.getOutputCols(), sizes, labels)


class CodeIndexModel(StoredModel, HasInputCols, HasOutputCols):
    labelCounts = Param(Params._dummy(), "labelCounts", "labels of every column", TypeConverters.toListInt)

    def __init__(self, inputCols: Sequence[str] = (), outputCols: Sequence[str] = (), sizes: Sequence[int] = (), labels: DataFrame | None = None):
        super().__init__(labels, "index")
        if labels is not None:
            self._set(inputCols=list(inputCols), outputCols=list(outputCols), labelCounts=list(sizes))

    def sizes(self) -> list[int]:
        return self.getOrDefault(self.labelCounts)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        labels = self.stored(dataset.sparkSession)
        for k, (c, out, size) in enumerate(zip(self.getInputCols(), self.getOutputCols(), self.sizes(), strict=True)):
            found = labels.where(F.col("column") == k).select(F.col("label").alias("_label"), F.col("index").alias("_index"))
            joined = dataset.join(found, F.col(c).cast("string") == F.col("_label"), "left")
            index = _sized(F.coalesce("_index", F.lit(float(size))), out, type="nominal", num_vals=size + 1)
            dataset = joined.select(*[F.col(f"`{x}`") for x in dataset.columns], index)
        return dataset


class CodeOneHot(Transformer, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """A unit vector per index; the last slot, that of unseen labels, is the zero vector."""

    def __init__(self, inputCols: Sequence[str] = (), outputCols: Sequence[str] = ()):
        super().__init__()
        self._set(inputCols=list(inputCols), outputCols=list(outputCols))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        for c, out in zip(self.getInputCols(), self.getOutputCols(), strict=True):
            size = dataset.schema[c].metadata["ml_attr"]["num_vals"] - 1
            known = F.filter(F.array(F.col(c)), lambda i: i < size)
            dataset = _with(dataset, out, _sized(sparse(size, known, F.transform(known, lambda i: F.lit(1.0))), out, num_attrs=size))
        return dataset


class CodeAssembler(Transformer, HasInputCols, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Vectors and numbers one behind the other; a missing number is an error."""

    def __init__(self, inputCols: Sequence[str] = (), outputCol: str = "features"):
        super().__init__()
        self._set(inputCols=list(inputCols), outputCol=outputCol)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        parts, size, names, out = [], 0, self.getInputCols(), self.getOutputCol()
        vectors = [c for c in names if isinstance(dataset.schema[c].dataType, VectorUDT)]
        if names == vectors and len(names) == 1:
            return _with(dataset, out, _sized(F.col(names[0]), out, num_attrs=width(dataset, names[0]) or 0))
        for c in names:
            if c in vectors:
                behind = F.lit(size)
                parts.append(F.transform(entries(c), lambda e: F.struct((e["index"] + behind).alias("index"), e["value"].alias("value"))))  # noqa: B023
                size += width(dataset, c) or 0
            else:
                number = F.col(c).cast("double")
                number = F.when(number.isNull() | F.isnan(number), F.raise_error(F.lit(f"null or NaN in {c}")).cast("double")).otherwise(number)
                parts.append(F.array(F.struct(F.lit(size).alias("index"), number.alias("value"))))
                size += 1
        held = F.filter(F.concat(*parts), lambda e: e["value"] != 0)
        return _with(dataset, out, _sized(sparse(size, held["index"], held["value"]), out, num_attrs=size))


class WideLinearModel(StoredModel):
    """An intercept and a table of (``index``, ``coefficient``): adds ``prediction``."""

    featuresCol = Param(Params._dummy(), "featuresCol", "column of vectors", TypeConverters.toString)
    fittedIntercept = Param(Params._dummy(), "fittedIntercept", "intercept", TypeConverters.toFloat)

    def __init__(self, features: str = "features", intercept: float = 0.0, coefficients: DataFrame | None = None):
        super().__init__(coefficients, "coefficients")
        if coefficients is not None:
            self._set(featuresCol=features, fittedIntercept=float(intercept))

    @property
    def intercept(self) -> float:
        return self.getOrDefault(self.fittedIntercept)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        kept = F.struct(*[F.col(f"`{c}`") for c in dataset.columns]).alias("_kept")
        rows = dataset.select(kept, F.monotonically_increasing_id().alias("_row"), entries(self.getOrDefault(self.featuresCol)).alias("_es"))
        rows = rows.select("_kept", "_row", F.explode_outer("_es").alias("_e"))  # after the rows have their numbers
        joined = rows.join(self.stored(dataset.sparkSession), F.col("_e.index") == F.col("index"), "left")
        summed = joined.groupBy("_row").agg(F.first("_kept").alias("_kept"), F.sum(F.col("_e.value") * F.col("coefficient")).alias("_sum"))
        return summed.select("_kept.*", (F.coalesce("_sum", F.lit(0.0)) + F.lit(self.intercept)).alias("prediction"))


def fit_wide(designs: DataFrame, features: str, penalty: float, steps: int) -> WideLinearModel:
    """Least squares of ``_mean`` with weights ``_rows`` on ``features``, with ``penalty`` on the squares of unscaled coefficients.

    Conjugate gradients on centred columns of unit deviation, from zero: of all
    least-squares solutions the one of least norm. Coefficients and residuals
    are tables of a row per column; a step joins them to the designs' entries
    twice and brings four sums to the driver. One-hot columns need few steps.
    """
    rows = materialize(designs.select(F.monotonically_increasing_id().alias("d"), F.col("_mean").alias("y"), F.col("_rows").alias("m"), entries(features).alias("e"), F.col(features).isNull().alias("no")), "designs")
    y, m = F.col("y"), F.col("m")
    whole = rows.agg(F.sum(m).alias("n"), F.sum(m * y).alias("sy"), F.count_if(y.isNull() | F.col("no")).alias("missing")).first()
    if whole["missing"]:
        raise ValueError("null target or features")
    n, mean = whole["n"], whole["sy"] / whole["n"]
    cells = materialize(rows.select("d", "m", (m * (y - F.lit(mean))).alias("my"), F.explode("e").alias("e")).select("d", "m", "my", F.col("e.index").alias("j"), F.col("e.value").alias("v")), "cells")
    # columns, their mean and deviation, and the gradient at zero
    columns = cells.groupBy("j").agg((F.sum(F.col("m") * F.col("v")) / n).alias("mu"), (F.sum(F.col("m") * F.col("v") * F.col("v")) / n).alias("vv"), F.sum(F.col("my") * F.col("v")).alias("b"))
    variance = F.col("vv") - F.col("mu") * F.col("mu")
    columns = columns.where(variance > 1e-14 * F.col("vv")).select("j", "mu", F.sqrt(variance).alias("sd"), "b")
    b = F.col("b") / F.col("sd")
    state = materialize(columns.select("j", "mu", "sd", F.lit(0.0).alias("x"), b.alias("r"), b.alias("p")), "step")
    r, p, u, sd = F.col("r"), F.col("p"), F.col("u"), F.col("sd")
    first = state.agg(F.sum(r * r).alias("rr"), F.sum(F.col("mu") * p / sd).alias("c")).first()
    rr = least = first["rr"] or 0.0
    c = first["c"] or 0.0
    for step in range(steps + 1):
        if rr <= SHRUNK ** 2 * least:
            break
        if step == steps:
            raise ValueError(f"linear fit did not converge in {steps} steps")
        priced = cells.join(state.select("j", (p / sd).alias("w")), "j").groupBy("d").agg(F.sum(F.col("v") * F.col("w")).alias("z"))
        back = cells.join(priced, "d", "left").groupBy("j").agg(F.sum(F.col("m") * F.col("v") * (F.coalesce("z", F.lit(0.0)) - F.lit(c))).alias("g"))
        pushed = F.coalesce("g", F.lit(0.0)) / sd + F.lit(penalty) * p / (sd * sd)
        state = materialize(state.join(back, "j", "left").select("j", "mu", "sd", "x", "r", "p", pushed.alias("u")), "step")
        curve = state.agg(F.sum(p * u)).first()[0]
        if curve <= 0:
            break
        length = rr / curve
        x, left = F.col("x") + F.lit(length) * p, r - F.lit(length) * u
        sums = state.agg(F.sum(left * left).alias("rr"), F.sum(F.col("mu") * left / sd).alias("cr"), F.sum(F.col("mu") * p / sd).alias("cp")).first()
        turn = sums["rr"] / rr
        rr, c = sums["rr"], sums["cr"] + turn * sums["cp"]
        state = state.select("j", "mu", "sd", x.alias("x"), left.alias("r"), (left + F.lit(turn) * p).alias("p"))
    fitted = state.select(F.col("j").alias("index"), (F.col("x") / sd).alias("coefficient"), "mu")
    shift = fitted.agg(F.sum(F.col("mu") * F.col("coefficient"))).first()[0] or 0.0
    return WideLinearModel(features, mean - shift, fitted.select("index", "coefficient"))
