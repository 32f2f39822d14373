"""Vectors of categories and wide lines against Spark's own stages and dense solutions."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import functions as F

from lotledger.models import training, vectors
from lotledger.session import scratch_path
from lotledger.sources import registry


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(300).selectExpr(
        "id", "if(id % 50 = 7, null, concat('c', id * id % 23)) cep", "concat('d', id % 4) other", "cast(id % 31 as double) a", "cast(id % 3 as int) b",
        "cast(100 * (id * id % 23) + 7 * (id % 31) + id % 5 as double) y").repartition(4)


def test_stages_equal_sparks_own(spark, rows):
    names, numeric = ["cep", "other"], ["a", "b"]
    index = StringIndexer(inputCols=names, outputCols=[f"{c}_index" for c in names], handleInvalid="keep")
    onehot = OneHotEncoder(inputCols=[f"{c}_index" for c in names], outputCols=[f"{c}_onehot" for c in names], dropLast=True)
    spark_stages = [index, onehot, VectorAssembler(inputCols=[f"{c}_onehot" for c in names] + numeric, outputCol="features")]
    odd = rows.unionByName(rows.limit(1).withColumns({"id": F.lit(-1).cast("long"), "cep": F.lit("unseen")}))
    model = Pipeline(stages=training.feature_stages(names, numeric)).fit(rows)
    path = registry.save_model(model, scratch_path(spark, "stages") + "/model_2026.01.01.0000")
    wanted, *got = (sorted(((r["id"], r["cep_index"], r["other_index"], *[tuple(r[c].toArray()) for c in ("cep_onehot", "other_onehot", "features")])
                            for r in m.transform(odd).collect())) for m in (Pipeline(stages=spark_stages).fit(rows), model, registry.load_model(path)))
    assert got == [wanted, wanted] and model.stages[0].sizes() == [len(set(r[1] for r in wanted)) - 1, 4]
    with pytest.raises(Exception, match="null or NaN in a"):
        model.transform(rows.withColumn("a", F.lit(None).cast("double"))).select("features").collect()


def test_wide_columns_name_no_category(spark, rows):
    # a name per category in the schema is what a driver could not hold
    out = Pipeline(stages=training.feature_stages(["cep"], ["a"])).fit(rows).transform(rows)
    assert [out.schema[c].metadata for c in ("cep_onehot", "features")] == [{"ml_attr": {"num_attrs": n}} for n in (out.select("cep").distinct().count() - 1, out.select("cep").distinct().count())]


@pytest.mark.parametrize("alpha", [0.0, 40.0])
@pytest.mark.parametrize("numeric", [(), ("a", "b", "one")])
def test_wide_fit_equals_the_dense_solution(spark, rows, monkeypatch, alpha, numeric):
    df = rows.withColumn("one", F.lit(5.0))  # a column without a deviation
    prepared = Pipeline(stages=training.feature_stages(["cep", "other"], numeric)).fit(df).transform(df)
    held = prepared.select("features", "y").collect()
    x, y = np.array([r[0].toArray() for r in held]), np.array([r[1] for r in held])
    centred = x - x.mean(0)
    sd = np.where(centred.std(0) > 1e-12, centred.std(0), np.inf)
    scaled = centred / sd
    w = np.linalg.lstsq(scaled, y - y.mean(), rcond=1e-10)[0] / sd if not alpha else np.linalg.solve(centred.T @ centred + alpha * np.eye(x.shape[1]), centred.T @ (y - y.mean()))
    monkeypatch.setattr(training, "HELD_COLUMNS", 3)
    monkeypatch.setattr("pyspark.ml.regression.LinearRegression.fit", lambda *_: pytest.fail("the driver holds the coefficients"))
    model = training.fit_linear(prepared, "features", "y", training.ridge_reg_param(df, "y", alpha) if alpha else 0.0)
    assert model.intercept == pytest.approx(y.mean() - x.mean(0) @ w, rel=1e-7)
    path = registry.save_model(training.PipelineModel([model]), scratch_path(spark, "wide") + "/model_2026.01.01.0000")
    got = registry.load_model(path).transform(prepared)
    assert got.columns == [*prepared.columns, "prediction"] and got.count() == 300
    found = {r["id"]: r["prediction"] for r in got.collect()}
    want = {r["id"]: model.intercept + r["features"].toArray() @ w for r in prepared.select("id", "features").collect()}
    assert found.keys() == want.keys() and all(found[i] == pytest.approx(want[i], rel=1e-7) for i in want)
    with pytest.raises(ValueError, match="null"):
        training.fit_linear(prepared.withColumn("y", F.when(F.col("id") != 9, F.col("y"))), "features", "y")
