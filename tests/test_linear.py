"""Lines on codes and numbers against dense least squares."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotledger.models import linear, training
from lotledger.session import scratch_path
from lotledger.sources import registry


def dense(codes, x, y, alpha):
    """Predictions and coefficients on the centred one-hot design: ridge, or least squares of least norm."""
    names = sorted(set(codes))
    design = np.c_[np.array([[c == n for n in names] for c in codes], float), x]
    centre, mean = design.mean(0), y.mean()
    a, b = design - centre, y - mean
    if alpha:
        w = np.linalg.solve(a.T @ a + alpha * np.eye(a.shape[1]), a.T @ b)
    else:
        w = np.linalg.lstsq(a, b, rcond=1e-11)[0]
    return dict(zip(names, w)), w[len(names):], mean - centre @ w


def table(spark, codes, x, y):
    rows = [(i, c, *map(float, r), float(t), 2020 + i % 3, 1 + i % 12) for i, (c, r, t) in enumerate(zip(codes, x, y))]
    return spark.createDataFrame(rows, "id long, cep string, a double, b double, c double, y double, ano int, mes int").repartition(4)


@pytest.mark.parametrize("alpha", [0.0, 1.0, 250.0])
@pytest.mark.parametrize("case", ["many rows", "a row a code", "a column fixed by the code"])
def test_fit_equals_the_dense_solution(spark, alpha, case):
    rng = np.random.default_rng(2)
    n = 40 if case == "a row a code" else 300
    codes = [f"{i:03d}" if case == "a row a code" else f"{i % 17:03d}" for i in range(n)]
    x = rng.normal(size=(n, 3)) * [100, 5, 1] + [4000, 2020, 6]
    if case == "a column fixed by the code":
        x[:, 1] = [int(c) * 3 for c in codes]
    y = x @ [30.0, -200.0, 10.0] + rng.normal(size=n) * 50 + np.array([int(c) * 7 for c in codes])
    model = linear.fit_codes(table(spark, codes, x, y), "y", "cep", ["a", "b", "c"], alpha)
    effects, slopes, intercept = dense(codes, x, y, alpha)
    held = model.parts()
    assert held["slopes"] == pytest.approx(slopes, rel=1e-6, abs=1e-7)
    assert held["intercept"] == pytest.approx(intercept, rel=1e-6, abs=1e-3)
    assert [held["effects"][c] for c in effects] == pytest.approx(list(effects.values()), rel=1e-5, abs=1e-3)
    odd = spark.createDataFrame([("none", 1.0, 2.0, 3.0), (None, 1.0, 2.0, 3.0)], "cep string, a double, b double, c double")
    assert [r["prediction"] for r in model.transform(odd).collect()] == pytest.approx([intercept + slopes @ [1, 2, 3]] * 2, rel=1e-6)


@pytest.mark.parametrize("alpha", [0.0, 2.0])
def test_one_pass_backtest_equals_a_fit_per_fold(spark, alpha):
    rng = np.random.default_rng(7)
    n = 500
    codes = [f"{i % 23:03d}" for i in range(n)]
    x = rng.normal(size=(n, 3)) * [50, 2, 1] + [300, 5, 1]
    df = table(spark, codes, x, x @ [3.0, 40.0, -5.0] + rng.normal(size=n)).withColumn("cep", F.when(F.col("id") % 50 != 0, F.col("cep")))
    folds = [202203, 202206, 202209]
    got = {r["id"]: (r["fold"], r["prediction"]) for r in linear.backtest_codes(df, "y", "cep", ["a", "b", "c"], folds, alpha).collect()}
    period = F.col("ano") * 100 + F.col("mes")
    want = {}
    for fold in folds:
        model = linear.fit_codes(df.where(period < fold), "y", "cep", ["a", "b", "c"], alpha)
        want |= {r["id"]: (fold, r["prediction"]) for r in model.transform(df.where(period == fold).na.fill({"cep": "\0null"})).collect()}
    assert got.keys() == want.keys() and len(got) > 20
    assert all(got[i][0] == want[i][0] and got[i][1] == pytest.approx(want[i][1], rel=1e-9, abs=1e-6) for i in got)


def test_candidates_use_one_pass_where_they_can(spark):
    df = spark.range(400).selectExpr("id", "concat('c', id % 7) cep", "cast(id % 31 as double) area_do_terreno_m2", "cast(2020 + id div 150 as int) ano",
                                     "cast(1 + id % 12 as int) mes", "cast(100 * (id % 7) + 3 * (id % 31) as double) valor_venal_de_referencia")
    line, ridge = training.default_candidates()[1:3]
    for candidate in (line, ridge):
        looped = training.Candidate("loop", candidate.fit)
        one, many = (sorted(map(tuple, training.temporal_backtest(df, c).collect())) for c in (candidate, looped))
        assert [r[:2] for r in one] == [r[:2] for r in many] and np.allclose([r[2:] for r in one], [r[2:] for r in many], rtol=1e-6, atol=1e-6)


@pytest.mark.parametrize("alpha", [0.0, 5.0])
def test_effects_beyond_the_held_codes_are_a_table_of_the_stored_model(spark, monkeypatch, alpha):
    rng = np.random.default_rng(4)
    codes = [f"{i % 40:03d}" for i in range(400)]
    x = rng.normal(size=(400, 3)) * [50, 2, 1] + [300, 5, 1]
    df = table(spark, codes, x, x @ [3.0, 40.0, -5.0] + rng.normal(size=400))
    held = training.PipelineModel([linear.fit_codes(df, "y", "cep", ["a", "b", "c"], alpha)])
    monkeypatch.setattr(linear, "HELD_CODES", 39)
    model = linear.fit_codes(df, "y", "cep", ["a", "b", "c"], alpha)
    assert "effects" not in model.parts()
    path = registry.save_model(training.PipelineModel([model]), scratch_path(spark, "lines") + "/model_2026.01.01.0000")
    loaded = registry.load_model(path)
    assert loaded.stages[0].stored_at().startswith(path)
    odd = df.unionByName(df.limit(1).withColumns({"id": F.lit(-1).cast("long"), "cep": F.lit(None).cast("string")}))
    one, two = ({r["id"]: r["prediction"] for r in m.transform(odd).collect()} for m in (held, loaded))
    assert one.keys() == two.keys() and len(one) == 401 and all(one[i] == pytest.approx(two[i], rel=1e-12) for i in one)
    with pytest.raises(ValueError, match="cannot replace"):
        registry.save_model(loaded, path)
