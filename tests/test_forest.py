"""Forests against trees grown by plain numpy, and on planted signals."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotledger.models import forest, training
from lotledger.session import scratch_path
from lotledger.sources import registry


def plain_tree(x, codes, y, cuts, depth, least=1):
    """Predictions of a tree grown by trying every cut of every node."""
    out = np.full(len(y), y.mean())

    def go(rows, level):
        out[rows] = y[rows].mean()
        if level == depth or len(rows) < 2 * least:
            return
        whole = y[rows].sum() ** 2 / len(rows)
        best = None
        for column in range(x.shape[1] + 1):
            options = [(b, x[rows, column] <= c) for b, c in enumerate(cuts[column])] if column < x.shape[1] else [(c, codes[rows] == c) for c in np.unique(codes[rows])]
            for cut, left in options:
                n = left.sum()
                if min(n, len(rows) - n) < least:
                    continue
                gain = y[rows][left].sum() ** 2 / n + y[rows][~left].sum() ** 2 / (len(rows) - n) - whole
                if gain > 1e-9 * (1 + whole) and (best is None or (gain, -column, -cut) > best[0]):
                    best = ((gain, -column, -cut), left)
        if best:
            go(rows[best[1]], level + 1)
            go(rows[~best[1]], level + 1)

    go(np.arange(len(y)), 0)
    return out


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    x = np.c_[rng.integers(0, 9, 600), rng.integers(0, 30, 600)].astype(float)
    code = rng.integers(0, 25, 600)
    y = (100 * (x[:, 0] > 4) + 7 * x[:, 1] + 300 * (code == 3) - 200 * (code == 8) + rng.integers(0, 20, 600)).astype(float)
    df = spark.createDataFrame([(i, *map(float, r), f"c{c}", float(t)) for i, (r, c, t) in enumerate(zip(x, code, y))], "id long, a double, b double, cep string, y double")
    return df.repartition(3), x, code, y


@pytest.mark.parametrize("depth,least", [(1, 1), (3, 1), (5, 10)])
def test_one_tree_equals_plain_search(spark, rows, depth, least):
    df, x, code, y = rows
    trees, cuts = forest.grow(df, "y", ["a", "b"], ["cep"], trees=1, depth=depth, bootstrap=False, least_rows=least)
    assert cuts == {"a": sorted(set(x[:, 0]))[:-1], "b": sorted(set(x[:, 1]))[:-1]}
    model = forest.ForestModel(trees, ["a", "b"], ["cep"])
    got = {r["id"]: r["prediction"] for r in model.transform(df).collect()}
    codes = {r["id"]: r["c"] for r in df.select("id", F.xxhash64("cep").alias("c")).collect()}
    want = plain_tree(x, np.array([codes[i] for i in range(600)]), y, [cuts["a"], cuts["b"]], depth, least)
    assert np.allclose([got[i] for i in range(600)], want)


def test_forest_finds_the_signal_and_survives_storing(spark, rows):
    df, _, _, y = rows
    deals = df.selectExpr("id", "cep", "a area_do_terreno_m2", "cast(b as int) ano", "1 mes", "y valor_venal_de_referencia")
    model = training.forest_model(deals, trees=10, depth=8)
    odd = spark.createDataFrame([(-1, None, None, None, None, 0.0), (-2, "unseen", 1.0, 2, 1, 0.0)], deals.schema.simpleString()[7:-1])
    path = registry.save_model(model, scratch_path(spark, "forest") + "/model_2026.01.01.0000")
    loaded = registry.load_model(path)
    got = {r["id"]: r["prediction"] for r in training.predict(loaded, deals.union(odd)).collect()}
    assert got == {r["id"]: r["prediction"] for r in training.predict(model, deals.union(odd)).collect()}
    errors = np.array([got[i] for i in range(600)]) - y
    assert np.abs(errors).mean() < 0.25 * np.abs(y - y.mean()).mean()
    assert np.isfinite([got[-1], got[-2]]).all()
    # trees differ by their draws, and a tree keeps within its bound of leaves
    values = {round(t.value[0], 6) for t in loaded.stages[-1].parts()[0]}
    assert len(values) > 5
    small, _ = forest.grow(deals, "valor_venal_de_referencia", ["ano"], ["cep"], trees=2, depth=30, max_leaves=9)
    assert all((len(t.column) + 1) // 2 == 9 for t in small)


def test_many_values_are_cut_at_quantiles(spark):
    df = spark.range(5000).selectExpr("cast(id as double) a", "cast(null as double) b", "cast(id div 1000 as double) y")
    cuts = forest.find_cuts(df, ["a", "b"], bins=10)
    assert len(cuts["a"]) == 9 and cuts["b"] == []
    trees, _ = forest.grow(df, "y", ["a", "b"], trees=1, depth=6, bootstrap=False, bins=10)
    got = forest.ForestModel(trees, ["a", "b"]).transform(df).where("abs(prediction - y) > 0.51").count()
    assert got < 50  # quantiles are approximate
    with pytest.raises(ValueError):
        forest.grow(df.limit(0), "y", ["a"], trees=1)


def test_weights_are_drawn_as_spark_hashes(spark):
    for seed in (42, -7, 2 ** 40):
        u = (F.xxhash64("id", F.col("t").cast("int"), F.lit(seed)) / F.lit(2.0 ** 64)) + 0.5
        drawn = F.size(F.filter(F.lit(forest._POISSON), lambda p: p < u))
        df = spark.range(-3, 60).unionByName(spark.range(2 ** 33, 2 ** 33 + 5)).crossJoin(spark.range(1, 4).withColumnRenamed("id", "t"))
        rows = sorted(map(tuple, df.select("t", "id", drawn).collect()))
        ids = np.array([i for t, i, _ in rows if t == 1])
        assert forest.draw_weights(ids, 3, seed).ravel().tolist() == [w for _, _, w in rows]


@pytest.mark.parametrize("dense", [0, 10 ** 6])
def test_blocks_spread_codes_and_two_categories_give_the_plain_tree(spark, rows, monkeypatch, dense):
    df, x, code, y = rows
    monkeypatch.setattr(forest, "BLOCK_ROWS", 30)
    monkeypatch.setattr(forest, "SPREAD", 20)  # a code of more than 30 rows is spread
    monkeypatch.setattr(forest, "DENSE_CELLS", dense)
    two = df.withColumn("other", F.lit("same"))
    want = forest.grow(df, "y", ["a", "b"], ["cep"], trees=1, depth=3, bootstrap=False)[0][0]
    got = forest.grow(two, "y", ["a", "b"], ["cep", "other"], trees=1, depth=3, bootstrap=False)[0][0]
    assert (got.column, got.cut, got.child, got.rows) == (want.column, want.cut, want.child, want.rows)
    model = forest.ForestModel([got], ["a", "b"], ["cep", "other"])
    found = {r["id"]: r["prediction"] for r in model.transform(two).collect()}
    codes = {r["id"]: r["c"] for r in df.select("id", F.xxhash64("cep").alias("c")).collect()}
    cuts = [sorted(set(x[:, c]))[:-1] for c in range(2)]
    assert np.allclose([found[i] for i in range(600)], plain_tree(x, np.array([codes[i] for i in range(600)]), y, cuts, 3))


def test_a_level_hands_on_no_sum_per_category(spark, monkeypatch):
    sums, stored = [], forest.materialize

    def kept(df, label, **options):
        out = stored(df, label, **options)
        sums.extend([out.count()] if label == "sums" else [])
        return out

    monkeypatch.setattr(forest, "materialize", kept)
    df = spark.range(2000).selectExpr("cast(id % 3 as double) a", "concat('c', id % 1000) cep", "cast(id % 3 * 10 + id % 1000 % 2 as double) y")
    forest.grow(df.coalesce(1), "y", ["a"], ["cep"], trees=1, depth=2, bootstrap=False)
    assert max(sums) < 100
