import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from lotledger.models import serving, training
from lotledger.session import scratch_path
from lotledger.sources import registry


@pytest.fixture(scope="module")
def deals(spark):
    return spark.range(400).selectExpr(
        "id", "lpad(cast(id % 5 as string), 8, '0') cep", "cast(50 + id % 37 as double) area_do_terreno_m2",
        "cast(2023 + id div 150 as int) ano", "cast(1 + id % 12 as int) mes",
        "cast(1000 * (id % 5) + 10 * (50 + id % 37) + id % 3 as double) valor_venal_de_referencia")


def test_every_candidate_predicts_each_row(spark, deals):
    trained = training.train_candidates(deals, "id", training.default_candidates(trees=5, depth=5))
    board = {r.model_name: r for r in trained.leaderboard.collect()}
    assert set(board) == {"baseline_media", "regressao_linear", "ridge", "random_forest"}
    assert all(r.n == 80 for r in board.values())
    assert board["regressao_linear"].mae < 5 < board["baseline_media"].mae
    assert trained.best == min(board, key=lambda m: board[m].mae)
    summary = training.train_summary(deals, trained, training.default_candidates()[0], "v", "d").first()
    assert (summary["n_train"], summary["n_test"], summary["backtest_summary"]["windows"]) == (320, 80, 3)
    assert [c["mae"] for c in summary["candidates"]] == sorted(c["mae"] for c in summary["candidates"])


def test_unseen_category_is_the_zero_vector(spark, deals):
    from pyspark.ml import Pipeline

    prepared = Pipeline(stages=training.feature_stages()).fit(deals)
    row = deals.limit(1).withColumn("cep", F.lit("99999999"))
    vector = prepared.transform(row).select("cep_onehot").first()[0]
    assert vector.numNonzeros() == 0 and vector.size == 5
    assert training.unseen_rate(prepared, row).first()[0] == 1.0


def test_ridge_matches_closed_form(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 2)) * [3, 10]
    y = x @ [2.0, -1.0] + rng.normal(size=200) + 5
    df = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(x, y)], "a double, b double, y double")
    vectors = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    model = training.fit_linear(vectors, "features", "y", training.ridge_reg_param(vectors, "y", 50.0))
    centred = x - x.mean(0)
    exact = np.linalg.solve(centred.T @ centred + 50.0 * np.eye(2), centred.T @ (y - y.mean()))
    assert model.coefficients.toArray() == pytest.approx(exact, rel=1e-6)


def test_saved_model_scores_requests(spark, deals):
    path = registry.save_model(training.ols_model(deals), scratch_path(spark, "m") + "/model_2026.01.01.0000")
    rows = [(1, "00000001", "60,0", "2024", "3", None), (2, None, "60", "2024", "3", None), (3, "00000001", "60", None, None, "202403"),
            (4, "00000001", "-1", "2024", "3", None)]
    asked = spark.createDataFrame(rows, "id int, cep string, area string, ano string, mes string, ano_mes string")
    got = {r.id: r for r in serving.score_requests(asked, registry.load_model(path)).collect()}
    assert got[1].valor_estimado == pytest.approx(1601, abs=5) and got[3].valor_estimado == pytest.approx(got[1].valor_estimado)
    assert got[2].missing_fields == ["cep"] and got[2].error == "missing_fields"
    assert (got[4].status, got[4].error, got[4].valor_estimado) == ("error", "area_invalida", None)


@pytest.mark.parametrize("mae,max_mae,active,pct,approved,reason", [
    (60000.0, 50000.0, None, 5.0, False, "above_max_mae"), (40000.0, 50000.0, None, 5.0, True, "no_active_model"),
    (97000.0, None, 100000.0, 5.0, False, "not_enough_improvement"), (94000.0, None, 100000.0, 5.0, True, "improved"),
    (94000.0, None, "unknown", 0.0, True, "comparison_skipped"),
])
def test_promotion(spark, mae, max_mae, active, pct, approved, reason):
    candidates = spark.createDataFrame([("m", "prod", None, mae)], "model string, to_env string, validation_mae double, train_mae double")
    rows = [] if active is None else [("prod", None if active == "unknown" else active, None)]
    current = spark.createDataFrame(rows, "env string, validation_mae double, train_mae double")
    row = serving.promotion_decisions(candidates, current, max_mae, pct).first()
    assert (row["approved"], row["reason"]) == (approved, reason)


def test_linear_fit_passes_over_designs_and_not_over_rows(spark, monkeypatch):
    from pyspark.ml.regression import LinearRegression

    fitted, plain = [], LinearRegression.fit
    monkeypatch.setattr(LinearRegression, "fit", lambda self, df: fitted.append(df.count()) or plain(self, df))
    rows = [(float(i % 5), 3.0 * (i % 5) + 7 + (i // 5) % 2) for i in range(200)]
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(spark.createDataFrame(rows, "x double, y double"))
    model = training.fit_linear(df, "features", "y")
    assert fitted == [5] and abs(model.coefficients[0] - 3) < 1e-6 and abs(model.intercept - 7.5) < 1e-6
    alpha = 100.0  # beside sums of squares: 400 in x and 1200 in x and y
    ridge = training.fit_linear(df, "features", "y", training.ridge_reg_param(df, "y", alpha))
    assert abs(ridge.coefficients[0] - 1200 / (400 + alpha)) < 1e-6
    with pytest.raises(Exception, match="(?i)null"):
        training.fit_linear(df.unionByName(df.limit(1).withColumn("y", F.lit(None).cast("double"))), "features", "y")
