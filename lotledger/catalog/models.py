"""Model jobs on the deals view."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from ..models import serving, training
from ..operators.splits import temporal_holdout
from ..session import materialize, scratch_path
from ..sources import registry
from .registry import query, table
from .views import DEALS_SQL, deals

TARGET = training.TARGET
_HOLDOUT_SQL = f"""
WITH d AS ({DEALS_SQL}), n AS (SELECT count(*) AS n FROM d),
h AS (SELECT d.*, row_number() OVER (ORDER BY ano, mes, id) <= n - greatest(1, CAST(floor(n * 0.2e0) AS BIGINT)) AS train FROM d, n)
"""


def _sides(spark, sf):
    rows = materialize(deals(spark, sf), "deals")  # read by every pass of the split
    split = materialize(temporal_holdout(rows, "id"), "split")
    return split.where("split = 'train'"), split.where("split = 'test'")


@query("f1_unseen_categories", _HOLDOUT_SQL + """
SELECT id, cep IN (SELECT cep FROM h WHERE train) AS known FROM h WHERE NOT train
""")
def _(spark, sf):
    from pyspark.ml import Pipeline

    train, test = _sides(spark, sf)
    prepared = Pipeline(stages=training.feature_stages()).fit(train)
    labels = prepared.stages[0].sizes()[0]
    return prepared.stages[0].transform(test).select("id", (F.col("cep_index") < labels).alias("known"))


@query("f1_unseen_rate", _HOLDOUT_SQL + """
SELECT round(avg(CASE WHEN cep IN (SELECT cep FROM h WHERE train) THEN 0 ELSE 1 END), 8) AS unseen_rate FROM h WHERE NOT train
""")
def _(spark, sf):
    from pyspark.ml import Pipeline

    train, test = _sides(spark, sf)
    prepared = Pipeline(stages=training.feature_stages()).fit(train)
    return training.unseen_rate(prepared, test).select(F.round("unseen_rate", 8).alias("unseen_rate"))


@query("f2_mean_baseline", _HOLDOUT_SQL + f"""
SELECT id, round((SELECT avg({TARGET}) FROM h WHERE train), 3) AS prediction FROM h WHERE NOT train
""")
def _(spark, sf):
    train, test = _sides(spark, sf)
    model = training.mean_model(train)
    return training.predict(model, test).select("id", F.round("prediction", 3).alias("prediction"))


def _one_feature(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice")
    return VectorAssembler(inputCols=["l_quantity"], outputCol="features").transform(rows)


def _line(spark, model):
    return spark.createDataFrame(
        [(float(model.coefficients[0]), float(model.intercept))], "slope double, intercept double"
    ).select(F.round("slope", 3).alias("slope"), F.round("intercept", 2).alias("intercept"))


@query("f3_least_squares", """
SELECT round(regr_slope(l_extendedprice, l_quantity), 3) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 2) AS intercept
FROM lineitem
""")
def _(spark, sf):
    return _line(spark, training.fit_linear(_one_feature(spark, sf), "features", "l_extendedprice"))


@query("f4_ridge", """
WITH s AS (SELECT regr_sxy(l_extendedprice, l_quantity) / (regr_sxx(l_extendedprice, l_quantity) + 1000000) AS b,
                  avg(l_extendedprice) AS my, avg(l_quantity) AS mx FROM lineitem)
SELECT round(b, 3) AS slope, round(my - b * mx, 2) AS intercept FROM s
""")
def _(spark, sf):
    rows = _one_feature(spark, sf)
    penalty = training.ridge_reg_param(rows, "l_extendedprice", 1_000_000.0)
    return _line(spark, training.fit_linear(rows, "features", "l_extendedprice", penalty))


@query("f3_category_means", _HOLDOUT_SQL + f"""
SELECT cep, count(*) AS n, TRUE AS fitted_is_mean, TRUE AS unseen_is_between FROM h WHERE train GROUP BY cep
""")
def _(spark, sf):
    # On a one-hot design alone the least-squares fit of a category is its mean; an unseen one lies between the means.
    from pyspark.ml import Pipeline

    train, _ = _sides(spark, sf)
    prepared = Pipeline(stages=training.feature_stages(numeric=())).fit(train)
    model = training.fit_linear(prepared.transform(train), "features", TARGET)
    means = materialize(train.groupBy("cep").agg(F.avg(TARGET).alias("mean"), F.count(F.lit(1)).alias("n")), "means")
    fitted = model.transform(prepared.transform(means)).withColumnRenamed("prediction", "fitted")
    low, high = means.agg(F.min("mean"), F.max("mean")).first()
    unseen = float(model.intercept)
    return fitted.select("cep", "n", (F.abs(F.col("fitted") - F.col("mean")) < 1).alias("fitted_is_mean"),
                         F.lit(low < unseen < high).alias("unseen_is_between"))


def _line_sql(rows: str, alpha: str, penalized: bool) -> str:
    """Codes eliminated, then Cramer's rule on three slopes: ``b``, ``c0``..``c2`` per ``fold`` and ``e`` per (fold, cep).

    ``rows`` yields fold, cep, y, x0, x1, x2, all less fixed centres.
    """
    pairs = [(0, 0), (0, 1), (0, 2), (1, 1), (1, 2), (2, 2)]
    at = lambda i, j: f"w{min(i, j)}{max(i, j)}"

    def det(m):
        return (f"({m[0][0]}*({m[1][1]}*{m[2][2]}-{m[1][2]}*{m[2][1]})-{m[0][1]}*({m[1][0]}*{m[2][2]}-{m[1][2]}*{m[2][0]})"
                f"+{m[0][2]}*({m[1][0]}*{m[2][1]}-{m[1][1]}*{m[2][0]}))")

    whole = [[at(i, j) for j in range(3)] for i in range(3)]
    swapped = [[[f"g{i}" if j == k else at(i, j) for j in range(3)] for i in range(3)] for k in range(3)]
    slopes = ", ".join(f"{det(m)} / {det(whole)} AS c{k}" for k, m in enumerate(swapped))
    free = "(gb - u0 * c0 - u1 * c1 - u2 * c2) / beta" if penalized else "my - m0 * c0 - m1 * c1 - m2 * c2"
    drop = lambda i, j: f" - u{i} * u{j} / beta" + (f" + {alpha}" if i == j else "") if penalized else ""
    lose = lambda i: f" - u{i} * gb / beta" if penalized else ""
    return f"""
by_code AS (SELECT fold, cep, CAST(count(*) AS DOUBLE) AS n, sum(y) AS sy, {", ".join(f"sum(x{i}) AS s{i}" for i in range(3))},
  {", ".join(f"sum(x{i} * x{j}) AS p{i}{j}" for i, j in pairs)}, {", ".join(f"sum(x{i} * y) AS q{i}" for i in range(3))} FROM ({rows}) GROUP BY fold, cep),
less AS (SELECT fold, sum(n - n * n / (n + {alpha})) AS beta, sum(sy - n * sy / (n + {alpha})) AS gb, avg(sy / n) AS my,
  {", ".join(f"sum(s{i} - n * s{i} / (n + {alpha})) AS u{i}, avg(s{i} / n) AS m{i}, sum(q{i} - s{i} * sy / (n + {alpha})) AS h{i}" for i in range(3))},
  {", ".join(f"sum(p{i}{j} - s{i} * s{j} / (n + {alpha})) AS v{i}{j}" for i, j in pairs)} FROM by_code GROUP BY fold),
dense AS (SELECT *, {", ".join(f"v{i}{j}{drop(i, j)} AS w{i}{j}" for i, j in pairs)}, {", ".join(f"h{i}{lose(i)} AS g{i}" for i in range(3))} FROM less),
sloped AS (SELECT *, {slopes} FROM dense),
line AS (SELECT fold, c0, c1, c2, {free} AS b FROM sloped),
effects AS (SELECT fold, cep, (sy - n * b - s0 * c0 - s1 * c1 - s2 * c2) / (n + {alpha}) AS e FROM by_code JOIN line USING (fold))"""


_SHIFTED = f"cep, {TARGET} - 150000e0 AS y, area_do_terreno_m2 - 100e0 AS x0, ano - 1995e0 AS x1, mes - 6e0 AS x2"


def _holdout_line_sql(alpha: str, penalized: bool) -> str:
    return _HOLDOUT_SQL + ", " + _line_sql(f"SELECT 0 AS fold, {_SHIFTED} FROM h WHERE train", alpha, penalized).strip() + f"""
SELECT id, e IS NOT NULL AS seen, round(b + coalesce(e, 0) + x0 * c0 + x1 * c1 + x2 * c2 + 150000, 2) AS prediction,
  round(c0, 6) AS per_area, round(c1, 6) AS per_year, round(c2, 6) AS per_month
FROM (SELECT id, {_SHIFTED} FROM h WHERE NOT train) t CROSS JOIN line LEFT JOIN effects USING (cep)
"""


def _holdout_line(spark, sf, fit):
    train, test = _sides(spark, sf)
    model = fit(train)
    held = model.stages[-1].parts()
    slopes = [F.lit(round(w, 6)).alias(n) for w, n in zip(held["slopes"], ("per_area", "per_year", "per_month"), strict=True)]
    seen = F.broadcast(train.select(F.col("cep").alias("_seen")).distinct())
    return training.predict(model, test).join(seen, F.col("cep") == F.col("_seen"), "left").select(
        "id", F.col("_seen").isNotNull().alias("seen"), F.round("prediction", 2).alias("prediction"), *slopes)


@query("f3_one_hot_least_squares", _holdout_line_sql("0e0", False))
def _(spark, sf):
    # Codes and three numbers: slopes, and predictions of seen and unseen codes.
    return _holdout_line(spark, sf, training.ols_model)


@query("f4_one_hot_ridge", _holdout_line_sql("1e0", True))
def _(spark, sf):
    return _holdout_line(spark, sf, training.ridge_model)


_FOLDS_SQL = f"""
WITH d AS (SELECT *, ano * 100 + mes AS p FROM ({DEALS_SQL})),
f AS (SELECT p AS fold FROM (SELECT DISTINCT p FROM d ORDER BY p OFFSET 3) ORDER BY p DESC LIMIT 3)
"""


def _backtest_sql(alpha: str, penalized: bool) -> str:
    return _FOLDS_SQL + ", " + _line_sql(f"SELECT fold, {_SHIFTED} FROM d JOIN f ON p < fold", alpha, penalized).strip() + f"""
, scored AS (SELECT fold, y, b + coalesce(e, 0) + x0 * c0 + x1 * c1 + x2 * c2 AS z
  FROM (SELECT p AS fold, {_SHIFTED} FROM d) JOIN line USING (fold) LEFT JOIN effects USING (fold, cep))
SELECT CAST(fold // 100 AS VARCHAR) || '-' || lpad(CAST(fold % 100 AS VARCHAR), 2, '0') AS period, count(*) AS n, round(avg(abs(z - y)), 2) AS mae,
  round(quantile_cont(abs(z - y), 0.5), 2) AS median_absolute_error, round(quantile_cont(abs(z - y), 0.95), 2) AS p95_absolute_error,
  round(avg(z - y), 2) AS bias, round(CASE WHEN var_pop(y) = 0 THEN 0 ELSE 1 - sum((z - y) ** 2) / (var_pop(y) * count(*)) END, 6) AS r2
FROM scored GROUP BY fold
"""


def _backtest(spark, sf, at):
    out = training.temporal_backtest(deals(spark, sf), training.default_candidates()[at])
    return out.select("period", "n", *[F.round(c, 6 if c == "r2" else 2).alias(c) for c in training.METRICS])


@query("f7_least_squares_backtest", _backtest_sql("0e0", False))
def _(spark, sf):
    return _backtest(spark, sf, 1)


@query("f7_ridge_backtest", _backtest_sql("1e0", True))
def _(spark, sf):
    return _backtest(spark, sf, 2)


# Prices that follow the features: two steps in area, one in time, one in the codes, and a spread that no feature explains.
_SIGNAL_SQL = f"""
SELECT id, cep, area_do_terreno_m2, ano, mes, CAST(50000 + CASE WHEN area_do_terreno_m2 > 150 THEN 100000 ELSE 0 END
  + CASE WHEN area_do_terreno_m2 <= 40 THEN -20000 ELSE 0 END + CASE WHEN ano >= 1995 THEN 60000 ELSE 0 END
  + CASE WHEN CAST(cep AS BIGINT) <= 500 THEN 80000 ELSE 0 END + (id * 7919) % 10007 AS DOUBLE) AS {TARGET}
FROM ({DEALS_SQL})
"""


def _signal(spark, sf):
    step = lambda condition, value: F.when(condition, value).otherwise(0)
    area, code = F.col("area_do_terreno_m2"), F.col("cep").cast("long")
    price = (F.lit(50000) + step(area > 150, 100000) + step(area <= 40, -20000) + step(F.col("ano") >= 1995, 60000) + step(code <= 500, 80000)
             + (F.col("id") * 7919) % 10007)
    return materialize(deals(spark, sf).withColumn(TARGET, price.cast("double")), "signal")


def _tree_sql(depth: int) -> str:
    """A tree of ``depth`` cuts by trying every cut of every node: area at given points, years, months and single codes."""
    sql = f"""WITH s0 AS (SELECT id, cep, 0 AS node, {TARGET} AS y, least(greatest(ceil(area_do_terreno_m2 / 50) - 1, 0), 6) AS v0, ano - 1992 AS v1, mes - 1 AS v2 FROM ({_SIGNAL_SQL}))"""
    for level in range(depth):
        sql += f""",
whole{level} AS (SELECT node, CAST(count(*) AS DOUBLE) AS an, sum(y) AS sa FROM s{level} GROUP BY node),
cells{level} AS (SELECT node, f, v, CAST(count(*) AS DOUBLE) AS n, sum(y) AS s FROM (SELECT node, y, unnest([0, 1, 2]) AS f, unnest([v0, v1, v2]) AS v FROM s{level}) GROUP BY ALL),
options{level} AS (
  SELECT node, f, CAST(v AS VARCHAR) AS cut, v, sum(n) OVER w AS n, sum(s) OVER w AS s FROM cells{level} WINDOW w AS (PARTITION BY node, f ORDER BY v)
  UNION ALL SELECT node, 3, cep, 0, CAST(count(*) AS DOUBLE), sum(y) FROM s{level} GROUP BY node, cep),
best{level} AS (SELECT node, f, cut, v FROM options{level} JOIN whole{level} USING (node) WHERE n < an
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY s * s / n + (sa - s) * (sa - s) / (an - n) - sa * sa / an DESC, f, v, cut) = 1),
s{level + 1} AS (SELECT id, cep, CASE WHEN f IS NULL THEN node * 2 + 1
    WHEN CASE f WHEN 0 THEN v0 <= v WHEN 1 THEN v1 <= v WHEN 2 THEN v2 <= v ELSE cep = cut END THEN node * 2 + 1 ELSE node * 2 + 2 END AS node, y, v0, v1, v2
  FROM s{level} LEFT JOIN best{level} USING (node))"""
    return sql + f"""
SELECT id, round(avg(y) OVER (PARTITION BY node), 4) AS prediction FROM s{depth}"""


@query("f5_single_tree", _tree_sql(4))
def _(spark, sf):
    from ..models import forest

    rows, numeric = _signal(spark, sf), ("area_do_terreno_m2", "ano", "mes")
    low, high = rows.agg(F.coalesce(F.min("ano"), F.lit(1992)), F.coalesce(F.max("ano"), F.lit(1999))).first()  # every year is a cut
    cuts = {"area_do_terreno_m2": [50.0 * i for i in range(1, 7)], "ano": [float(y) for y in range(min(low, 1992), max(high, 1999))], "mes": [float(m) for m in range(1, 13)]}
    trees, _cuts = forest.grow(rows, TARGET, numeric, ["cep"], trees=1, depth=4, bootstrap=False, cuts=cuts)
    return forest.ForestModel(trees, numeric, ["cep"]).transform(rows).select("id", F.round("prediction", 4).alias("prediction"))


# Trees that a query grows; more only smooth a signal of this kind.
_TREES, _DEPTH = 20, 8
# A forest must come this near to the fit that knows where the steps are, and be this much better than the mean.
_NEAR, _BETTER = 1.15, 0.25
_PLAIN_SQL = f"""
WITH d AS ({_SIGNAL_SQL}), n AS (SELECT count(*) AS n FROM d),
h AS (SELECT d.*, row_number() OVER (ORDER BY ano, mes, id) <= n - greatest(1, CAST(floor(n * 0.2e0) AS BIGINT)) AS train,
  area_do_terreno_m2 > 150 AS k0, area_do_terreno_m2 <= 40 AS k1, ano >= 1995 AS k2, CAST(cep AS BIGINT) <= 500 AS k3 FROM d, n),
cells AS (SELECT k0, k1, k2, k3, avg({TARGET}) AS m FROM h WHERE train GROUP BY ALL),
plain AS (SELECT count(*) AS n, avg(abs({TARGET} - m)) AS plain_mae, avg(abs({TARGET} - (SELECT avg({TARGET}) FROM h WHERE train))) AS mean_mae
  FROM h JOIN cells USING (k0, k1, k2, k3) WHERE NOT train)
"""


def _plain_errors(train, test):
    """MAE of cell means where the steps are known, and of the overall mean."""
    cell = [F.col("area_do_terreno_m2") > 150, F.col("area_do_terreno_m2") <= 40, F.col("ano") >= 1995, F.col("cep").cast("long") <= 500]
    keys = [f"k{i}" for i in range(4)]
    marked = [df.withColumns(dict(zip(keys, cell, strict=True))) for df in (train, test)]
    means, mean = marked[0].groupBy(*keys).agg(F.avg(TARGET).alias("m")), train.agg(F.avg(TARGET)).first()[0]
    return marked[1].join(F.broadcast(means), keys).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs(F.col(TARGET) - F.col("m"))).alias("plain_mae"), F.avg(F.abs(F.col(TARGET) - F.lit(mean))).alias("mean_mae")).first()


@query("f5_random_forest", _PLAIN_SQL + "SELECT n, round(plain_mae, 3) AS plain_mae, round(mean_mae, 3) AS mean_mae, TRUE AS near_plain_fit, TRUE AS far_from_mean FROM plain")
def _(spark, sf):
    from ..operators.metrics import regression_metrics

    split = materialize(temporal_holdout(_signal(spark, sf), "id"), "split")
    train, test = split.where("split = 'train'"), split.where("split = 'test'")
    plain = _plain_errors(train, test)
    model = training.forest_model(train, trees=_TREES, depth=_DEPTH)
    found = regression_metrics(training.predict(model, test), TARGET, "prediction")
    return found.select(
        "n", F.lit(round(plain["plain_mae"], 3)).alias("plain_mae"), F.lit(round(plain["mean_mae"], 3)).alias("mean_mae"),
        F.col("mae").between(plain["plain_mae"] / _NEAR, plain["plain_mae"] * _NEAR).alias("near_plain_fit"),
        (F.col("mae") < _BETTER * plain["mean_mae"]).alias("far_from_mean"))


@query("f6_leaderboard", _PLAIN_SQL + """
SELECT model_name, n, place, model_name = 'baseline_media' AND TRUE AS is_mean, model_name = 'random_forest' AS is_near_plain_fit
FROM plain, (VALUES ('baseline_media', 4), ('regressao_linear', NULL), ('ridge', NULL), ('random_forest', 1)) m(model_name, place)
""")
def _(spark, sf):
    # The steps are in reach of trees only: the forest leads, the lines stand between it and the mean.
    rows = _signal(spark, sf)
    trained = training.train_candidates(rows, "id", training.default_candidates(trees=_TREES, depth=_DEPTH))
    plain = _plain_errors(trained.split.where("split = 'train'"), trained.split.where("split = 'test'"))
    places = [r["model_name"] for r in trained.leaderboard.collect()]
    if places[0] != trained.best:
        raise ValueError("the best candidate is not the one of least error")
    place = F.array_position(F.array(*[F.lit(p) for p in places]), F.col("model_name")).cast("int")
    return trained.leaderboard.select(
        "model_name", "n", F.when(F.col("model_name").isin("random_forest", "baseline_media"), place).alias("place"),
        (F.abs(F.col("mae") / plain["mean_mae"] - 1) < 1e-9).alias("is_mean"), (F.col("mae") < _NEAR * plain["plain_mae"]).alias("is_near_plain_fit"))


@query("f7_fitted_backtest", f"""
WITH d AS (SELECT *, ano * 100 + mes AS p FROM ({DEALS_SQL})),
f AS (SELECT p AS fold FROM (SELECT DISTINCT p FROM d ORDER BY p OFFSET 3) ORDER BY p DESC LIMIT 3)
SELECT count(DISTINCT fold) AS periods, count(*) AS n, TRUE AS near_mean_model FROM d JOIN f ON p = fold
""")
def _(spark, sf):
    # Ridge on the whole design, fitted anew for every period.
    rows = materialize(deals(spark, sf), "deals")
    mean, ridge = (materialize(training.temporal_backtest(rows, training.default_candidates()[i]), "windows") for i in (0, 2))
    total = mean.agg(F.sum(F.col("mae") * F.col("n"))).first()[0]
    return ridge.agg(F.count(F.lit(1)).alias("periods"), F.sum("n").alias("n"),
                     (F.sum(F.col("mae") * F.col("n")) < 1.5 * total).alias("near_mean_model"))


@query("f6_mean_leaderboard", _HOLDOUT_SQL + f"""
SELECT 'baseline_media' AS model_name, count(*) AS n, round(avg(abs({TARGET} - m)), 3) AS mae, round(avg(m - {TARGET}), 3) AS bias,
       round(1 - sum(({TARGET} - m) ** 2) / (var_pop({TARGET}) * count(*)), 8) AS r2
FROM h, (SELECT avg({TARGET}) AS m FROM h WHERE train) WHERE NOT train
""")
def _(spark, sf):
    board = training.train_candidates(deals(spark, sf), "id", training.default_candidates()[:1]).leaderboard
    return board.select("model_name", "n", F.round("mae", 3).alias("mae"), F.round("bias", 3).alias("bias"), F.round("r2", 8).alias("r2"))


@query("f7_temporal_backtest", f"""
WITH d AS (SELECT *, ano * 100 + mes AS p FROM ({DEALS_SQL})),
f AS (SELECT p AS fold FROM (SELECT DISTINCT p FROM d ORDER BY p OFFSET 3) ORDER BY p DESC LIMIT 3),
m AS (SELECT fold, avg({TARGET}) AS m FROM d JOIN f ON p < fold GROUP BY fold)
SELECT CAST(fold // 100 AS VARCHAR) || '-' || lpad(CAST(fold % 100 AS VARCHAR), 2, '0') AS period, count(*) AS n,
       round(avg(abs({TARGET} - m)), 3) AS mae, round(avg(m - {TARGET}), 3) AS bias
FROM d JOIN m ON p = fold GROUP BY fold
""")
def _(spark, sf):
    out = training.temporal_backtest(deals(spark, sf), training.default_candidates()[0])
    return out.select("period", "n", F.round("mae", 3).alias("mae"), F.round("bias", 3).alias("bias"))


@query("f8_run_log", _HOLDOUT_SQL + f"""
SELECT 'baseline_media' AS model_name, 'v1' AS version, '{TARGET}' AS target, round(avg(abs({TARGET} - m)), 3) AS mae
FROM h, (SELECT avg({TARGET}) AS m FROM h WHERE train) WHERE NOT train
""")
def _(spark, sf):
    candidates = training.default_candidates()[:1]
    trained = training.train_candidates(deals(spark, sf), "id", candidates)
    path = scratch_path(spark, "runs")
    training.log_runs(training.run_records(spark, trained, candidates, "v1", "d1"), path)
    return spark.read.parquet(path).select(
        "model_name", F.col("tags")["model_version"].alias("version"), F.col("params")["target"].alias("target"),
        F.round(F.col("metrics")["mae"], 3).alias("mae"))


@query("f8_train_summary", _HOLDOUT_SQL + f"""
, p AS (SELECT *, strftime(make_date(ano, mes, 1), '%Y-%m') AS period FROM h)
SELECT 'baseline_media' AS best_model, 'v1' AS version, count(*) AS n_rows, count(*) FILTER (train) AS n_train, count(*) FILTER (NOT train) AS n_test,
       min(period) FILTER (train) AS train_start, max(period) FILTER (train) AS train_end,
       min(period) FILTER (NOT train) AS test_start, max(period) FILTER (NOT train) AS test_end, CAST(3 AS INTEGER) AS windows,
       round(avg(abs({TARGET} - (SELECT avg({TARGET}) FROM h WHERE train))) FILTER (NOT train), 3) AS mae
FROM p
""")
def _(spark, sf):
    rows, candidates = materialize(deals(spark, sf), "deals"), training.default_candidates()[:1]
    trained = training.train_candidates(rows, "id", candidates)
    summary = training.train_summary(rows, trained, candidates[0], "v1", "d1")
    return summary.select(
        "best_model", "version", "n_rows", "n_train", "n_test", F.col("train_period_start").alias("train_start"),
        F.col("train_period_end").alias("train_end"), F.col("test_period_start").alias("test_start"),
        F.col("test_period_end").alias("test_end"), F.size("backtest_windows").alias("windows"),
        F.round(F.col("candidates")[0]["mae"], 3).alias("mae"))


@query("f9_validation_report", _HOLDOUT_SQL + f"""
, t AS (SELECT h.*, m FROM h, (SELECT avg({TARGET}) AS m FROM h WHERE train) WHERE NOT train),
seg AS (SELECT cep FROM t GROUP BY cep HAVING count(*) >= 5),
per AS (SELECT ano, mes FROM t GROUP BY ano, mes HAVING count(*) >= 5)
SELECT 'test' AS env, '2026.05.02.1934' AS version, count(*) AS n_holdout, round(avg(abs({TARGET} - m)), 3) AS mae,
       strftime(make_date(min(ano * 100 + mes) // 100, min(ano * 100 + mes) % 100, 1), '%Y-%m') AS holdout_period_start,
       strftime(make_date(max(ano * 100 + mes) // 100, max(ano * 100 + mes) % 100, 1), '%Y-%m') AS holdout_period_end,
       round(max(m), 3) AS highest, CAST(4 AS INTEGER) AS bands, CAST((SELECT count(*) FROM per) AS INTEGER) AS periods,
       CAST(least((SELECT count(*) FROM seg), 10) AS INTEGER) AS worst_ceps
FROM t
""")
def _(spark, sf):
    rows = materialize(deals(spark, sf), "deals")
    train = temporal_holdout(rows, "id").where("split = 'train'")
    path = registry.save_model(training.mean_model(train), scratch_path(spark, "model") + "/model_2026.05.02.1934")
    report = training.validation_report(registry.load_model(path), rows, "id", "test", path, min_group_size=5)
    return report.select(
        "env", "version", "n_holdout", F.round("mae", 3).alias("mae"), "holdout_period_start", "holdout_period_end",
        F.round("prediction_range.max", 3).alias("highest"), F.size("segment_metrics.by_target_band").alias("bands"),
        F.size("segment_metrics.by_period").alias("periods"), F.size("segment_metrics.worst_ceps_by_mae").alias("worst_ceps"))


@query("f10_score_requests", """
WITH t AS (SELECT avg(o_totalprice) AS m FROM orders),
r AS (SELECT o_orderkey AS id, o_orderkey % 9 AS k FROM orders)
SELECT id, CASE k WHEN 0 THEN 'missing_fields' WHEN 1 THEN 'area_invalida' WHEN 2 THEN 'mes_invalido' WHEN 3 THEN 'ano_invalido'
                WHEN 4 THEN 'cep_invalido' END AS error,
       CASE WHEN k <= 4 THEN 'error' ELSE 'success' END AS status, CASE WHEN k = 0 THEN 'cep' ELSE '' END AS missing_fields,
       CASE WHEN k > 4 THEN round(m, 3) END AS valor_estimado
FROM r, t
""")
def _(spark, sf):
    orders = table(spark, sf, "orders")
    model = training.mean_model(orders, "o_totalprice")
    k = F.col("o_orderkey") % 9
    requests = orders.select(
        F.col("o_orderkey").alias("id"),
        F.when(k == 0, F.lit(None)).when(k == 4, "--").when(k == 5, F.lit(None)).otherwise("01001-000").alias("cep"),
        F.when(k == 5, "01001-000").alias("cep_prefixo"),
        F.when(k == 1, "0").when(k != 6, "120,5").alias("area_do_terreno_m2"), F.when(k == 6, "80").alias("area"),
        F.when(k == 3, 1899).when(k != 7, F.year("o_orderdate")).alias("ano"),
        F.when(k == 2, 13).when(k != 7, F.month("o_orderdate")).alias("mes"), F.lit("202403").alias("ano_mes"),
    )
    return serving.score_requests(requests, model).select(
        "id", "error", "status", F.array_join("missing_fields", ",").alias("missing_fields"),
        F.round("valor_estimado", 3).alias("valor_estimado"))


@query("f10_fitted_requests", """
WITH c AS (SELECT DISTINCT o_custkey % 40 AS code FROM orders)
SELECT o_orderkey AS id, round(20000 + 300 * (o_orderkey % 300 + 0.5e0) + 100 * (year(o_orderdate) - 1990) + 40 * month(o_orderdate)
       + CASE WHEN o_custkey % 50 IN (SELECT code FROM c) THEN 500e0 * (o_custkey % 50) ELSE (SELECT avg(500e0 * code) FROM c) END, 2) AS valor_estimado
FROM orders
""")
def _(spark, sf):
    # Prices without noise, so least squares must price every request as its fields say; a fifth of the codes is unseen.
    orders = table(spark, sf, "orders").withColumns({"ano": F.year("o_orderdate"), "mes": F.month("o_orderdate")})
    priced = lambda area, code: 20000 + 300 * area + 100 * (F.col("ano") - 1990) + 40 * F.col("mes") + 500 * code
    code = lambda of: F.lpad(of.cast("string"), 8, "0")
    known, area = F.col("o_custkey") % 40, (F.col("o_orderkey") % 200 + 50).cast("double")
    train = orders.select(code(known).alias("cep"), area.alias("area_do_terreno_m2"), "ano", "mes", priced(area, known).cast("double").alias(TARGET))
    asked = code(F.col("o_custkey") % 50)
    requests = orders.select(
        F.col("o_orderkey").alias("id"), F.concat(F.substring(asked, 1, 5), F.lit("-"), F.substring(asked, 6, 3)).alias("cep"),
        F.concat((F.col("o_orderkey") % 300).cast("string"), F.lit(",5")).alias("area_do_terreno_m2"), "ano", "mes")
    scored = serving.score_requests(requests, training.ols_model(materialize(train, "train")))
    return scored.select("id", F.round("valor_estimado", 2).alias("valor_estimado"))


@query("f11_promotion", """
WITH c AS (SELECT o_custkey AS model, CASE o_custkey % 3 WHEN 0 THEN 'dev' WHEN 1 THEN 'test' ELSE 'prod' END AS to_env,
                  CASE WHEN o_custkey % 5 <> 0 THEN min(o_totalprice) * 2 END AS v, CASE WHEN o_custkey % 10 <> 0 THEN max(o_totalprice) END AS t
           FROM orders GROUP BY o_custkey),
a AS (SELECT CASE o_orderstatus WHEN 'F' THEN 'test' ELSE 'prod' END AS env, avg(o_totalprice) AS mae FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1),
j AS (SELECT model, to_env, coalesce(v, t) AS mae, a.env, a.mae AS active FROM c LEFT JOIN a ON a.env = to_env)
SELECT model, to_env, mae AS candidate_mae,
       CASE WHEN mae IS NULL THEN 'candidate_without_metric' WHEN mae > 300000 THEN 'above_max_mae' WHEN env IS NULL THEN 'no_active_model'
            WHEN mae > active * (1 - 5 / 100e0) THEN 'not_enough_improvement' ELSE 'improved' END AS reason,
       mae IS NOT NULL AND mae <= 300000 AND (env IS NULL OR mae <= active * (1 - 5 / 100e0)) AS approved
FROM j
""")
def _(spark, sf):
    orders, cust = table(spark, sf, "orders"), F.col("o_custkey")
    candidates = orders.groupBy(cust.alias("model")).agg(
        (F.min("o_totalprice") * 2).alias("v"), F.max("o_totalprice").alias("t")
    ).select(
        "model", F.when(F.col("model") % 3 == 0, "dev").when(F.col("model") % 3 == 1, "test").otherwise("prod").alias("to_env"),
        F.when(F.col("model") % 5 != 0, F.col("v")).alias("validation_mae"),
        F.when(F.col("model") % 10 != 0, F.col("t")).alias("train_mae"))
    active = orders.where("o_orderstatus <> 'P'").groupBy(
        F.when(F.col("o_orderstatus") == "F", "test").otherwise("prod").alias("env")
    ).agg(F.avg("o_totalprice").alias("validation_mae"), F.lit(None).cast("double").alias("train_mae"))
    return serving.promotion_decisions(candidates, active, max_mae=300_000, improvement_pct=5.0).select(
        "model", "to_env", "candidate_mae", "reason", "approved")
