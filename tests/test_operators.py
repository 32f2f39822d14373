import random
import statistics

import pytest
from pyspark.sql import functions as F

from lotledger.functions.text import snake_columns
from lotledger.operators import cleaning, drift, features, metrics, quality, regions, splits
from lotledger.operators.scale import cumulative_sums, group_stats, kth_key, row_hashes, sized_join


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds most rows; one key is NULL."""
    rng = random.Random(7)
    rows = [("hot" if i % 3 else rng.choice(["a", "b", None]), rng.choice([1.5, 2.0, rng.random() * 100]), i) for i in range(3000)]
    return spark.createDataFrame(rows, "k string, v double, id long"), rows


def test_hot_groups_give_the_same_percentiles(spark, skewed):
    df, rows = skewed
    wanted = {"m": ("v", 0.5), "p": ("v", 0.95), "low": ("v", 0.0), "high": ("v", 1.0)}
    size = F.count(F.lit(1)).alias("n")
    plain = {r.k: r.asDict() for r in group_stats(df, ["k"], [size], wanted).collect()}
    split = {r.k: r.asDict() for r in group_stats(df, ["k"], [size], wanted, hot_rows=100).collect()}
    assert plain.keys() == split.keys()
    for key, row in plain.items():
        assert row == pytest.approx(split[key]) if key else row["n"] == split[key]["n"]
        values = sorted(v for k, v, _ in rows if k == key)
        assert split[key]["m"] == pytest.approx(statistics.median(values))
        assert (split[key]["low"], split[key]["high"]) == (values[0], values[-1])


def test_global_percentiles_by_rank(spark, skewed):
    df, rows = skewed
    row = group_stats(df, [], [F.count(F.lit(1)).alias("n")], {"m": ("v", 0.5)}, hot_rows=10).first()
    assert (row["n"], row["m"]) == (3000, pytest.approx(statistics.median(v for _, v, _ in rows)))


def test_cumulative_sums(spark):
    rows = [(v, v % 5 + 1) for v in range(1000)]
    out = cumulative_sums(spark.createDataFrame(rows, "v long, n long"), [], "v", ["n"], ranges=8).orderBy("v").collect()
    total = 0
    for i, r in enumerate(out):
        total += rows[i][1]
        assert r["cum_n"] == total and r["next_v"] == (i + 1 if i < 999 else None)
    assert out[0]["total_n"] == total


def test_kth_key(spark):
    df = spark.createDataFrame([(i * 3,) for i in range(5000)], "id long")
    for k in (1, 2, 777, 4999, 5000):
        assert kth_key(df, "id", k, hot_rows=50) == (k - 1) * 3
    with pytest.raises(ValueError):
        kth_key(spark.createDataFrame([(1,)] * 100, "id long"), "id", 5, hot_rows=10)


def test_sized_join_slices_when_not_broadcast(spark, skewed):
    df, _ = skewed
    side = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    small, large = sized_join(df, side, ["k"]), sized_join(df, side, ["k"], broadcast_bytes=1, slices=4)
    assert small.count() == large.count() == 3000
    assert small.select(*large.columns).exceptAll(large).isEmpty()


def test_row_hashes_see_null_positions(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a", None)], "x string, y string")
    assert df.select(*row_hashes(df)).distinct().count() == 2


def test_header_rows(spark):
    df = spark.createDataFrame(
        [("N° do Cadastro (SQL)", "DATA DE TRANSAÇÃO"), ("123", "2024-01-10"), (None, None)],
        "n_do_cadastro string, data_de_transacao string")
    assert [r[0] for r in cleaning.drop_header_rows(df).collect()] == ["123", None]


def test_non_positive_target_keeps_null(spark):
    df = spark.createDataFrame([(100000.0, "A"), (0.0, "B"), (-10.0, "C"), (None, "D")], "valor_venal_de_referencia double, bairro string")
    assert {r.bairro for r in cleaning.drop_non_positive_target(df).collect()} == {"A", "D"}


def test_quality_profile_and_gate(spark):
    df = spark.sql("""SELECT timestamp'2024-01-01' data_de_transacao, 'A' bairro, '12345' cep, 'TERRENO' descricao_do_uso_iptu,
                      100D area_do_terreno_m2, 100000D valor_venal_de_referencia""")
    profile = quality.quality_profile(df, 1, 2, 3)
    row = profile.first()
    assert (row["rows"], row["embedded_header_rows_removed"], row["duplicate_rows_removed"],
            row["non_positive_target_rows_removed"], row["duplicated_rows"]) == (1, 1, 2, 3, 0)
    assert quality.quality_failures(profile, min_rows=1, min_terrain_rows=1).first()["failures"] == []
    with pytest.raises(ValueError, match="rows=1"):
        quality.assert_passed(quality.quality_failures(profile), "qualidade")
    empty = quality.quality_failures(quality.quality_profile(df.where("false").drop("bairro")))
    assert "colunas obrigatorias ausentes: bairro" in empty.first()["failures"]


def feature_rows(spark):
    return spark.range(1000).selectExpr(
        "cast(12345000 + id % 25 as string) cep", "100D area_do_terreno_m2", "cast(100000 + id as double) valor_venal_de_referencia",
        "array(2023,2023,2024,2024,2025,2025,2026,2026)[id % 8] ano", "array(1,2)[id % 2] mes")


def test_feature_contract(spark):
    good = quality.feature_contract(feature_rows(spark)).first()
    assert good["passed"] and good["unique_ceps"] == 25 and good["target_median"] == 100499.5
    bad = quality.feature_contract(feature_rows(spark).withColumn("valor_m2", F.lit(1.0))).first()
    assert any("colunas proibidas" in f for f in bad["failures"])


def test_build_features(spark):
    rows = [("TERRENO", "01001-000", 100.0, 5.0, "2024-02-01"), ("TERRENO", None, 100.0, 5.0, "2024-02-01"),
            ("CASA", "1", 1.0, 1.0, "2024-02-01"), ("TERRENO", "1", 60000.0, 1.0, "2024-02-01"), ("TERRENO", "1", 1.0, None, "2024-02-01")]
    df = spark.createDataFrame(rows, "descricao_do_uso_iptu string, cep string, area_do_terreno_m2 double, "
                                     "valor_venal_de_referencia double, d string").withColumn("data_de_transacao", F.to_timestamp("d"))
    assert [tuple(r) for r in features.build_features(df).collect()] == [("01001000", 100.0, 5.0, 2024, 2)]


def test_region_summary(spark):
    df = spark.createDataFrame([("a ", 100.0, 100000.0), ("B", 100.0, 200000.0)], "r string, area_do_terreno_m2 double, valor_venal_de_referencia double")
    valued = cleaning.prepare_valued(df, F.upper(F.trim("r")))
    top = regions.region_summary(valued, min_samples=1).collect()
    assert (top[0]["bairro"], top[0]["valor_m2_medio"], top[0]["valor_m2_variancia"]) == ("B", 2000.0, 0.0)
    assert tuple(regions.overall_price(valued).first()) == (2, 1500.0)


def test_frequency_table(spark):
    df = spark.createDataFrame([(float(x),) for x in (100, 200, 300, 400)], "v double")
    got = [(r.faixa_inicio, r.faixa_fim, r.frequencia_vendas) for r in regions.frequency_table(df, "v", 2).collect()]
    assert got == [(99.7, 250.0, 2), (250.0, 400.0, 2)]
    constant = regions.frequency_table(spark.createDataFrame([(5.0,)] * 3, "v double"), "v", 4).collect()
    assert sum(r.frequencia_vendas for r in constant) == 3 and len(constant) == 4


def test_compare_regions(spark):
    sales = spark.createDataFrame([("MOEMA", 12000.0, 1e6), ("MOEMA", 10000.0, 9e5), ("PINHEIROS", 14000.0, 1.2e6), ("PINHEIROS", 13000.0, 1.1e6)],
                                  "bairro string, valor_m2 double, valor_venal_de_referencia double")
    pairs = spark.createDataFrame([(1, "moema", " Pinheiros ", "valor_m2"), (2, "Moema", "Lapa", None), (3, "", "Moema", None)],
                                  "id int, region_a string, region_b string, metric string")
    got = {r["id"]: r for r in regions.compare_regions(pairs, sales, ["valor_m2", "valor_venal_de_referencia"]).collect()}
    assert got[1]["stats_b"]["media"] == 13500.0 and got[1]["stats_a"]["amostra"] == 2 and got[1]["higher_region"] == "PINHEIROS"
    assert got[2]["status"] == "regions_not_found" and got[2]["missing_regions"] == ["LAPA"]
    assert got[3]["status"] == "missing_fields"


def test_triage_flags_the_odd_one(spark):
    rows = [("A", 100.0, 1000.0, 1000.0 + i) for i in range(50)] + [("A", 100.0, 1000.0, 100.0)]
    df = spark.createDataFrame(rows, "bairro string, area_do_terreno_m2 double, valor_venal_de_referencia double, declarado double")
    flagged = regions.deviation_triage(df, "declarado").where("sinal <> 'normal'").collect()
    assert [(r.declarado, r.sinal) for r in flagged] == [(100.0, "muito_abaixo")]


def test_regression_metrics(spark):
    df = spark.createDataFrame([(100.0, 110.0), (200.0, 190.0), (300.0, 330.0)], "y_true double, y_pred double")
    row = metrics.regression_metrics(df).first().asDict()
    assert row == pytest.approx({"n": 3, "mae": 50 / 3, "median_absolute_error": 10.0, "p95_absolute_error": 28.0, "bias": 10.0, "r2": 0.945})
    constant = spark.createDataFrame([(5.0, 1.0), (5.0, 9.0)], "y_true double, y_pred double")
    assert metrics.regression_metrics(constant).first()["r2"] == 0.0


def test_segments_and_bands(spark):
    rows = [("01001000", 2024, 1, 100.0, 100.0), ("01001000", 2024, 1, 200.0, 210.0), ("03110000", 2025, 2, 300.0, 330.0), (None, 2025, 2, 400.0, 380.0)]
    df = spark.createDataFrame(rows, "cep string, ano int, mes int, y_true double, y_pred double")
    got = {(r.dimension, r.value): r.n for r in metrics.standard_segments(df, min_group_size=1).collect()}
    assert got[("period", "2024-01")] == 2 and got[("cep", "nan")] == 1 and got[("target_band", "baixo")] == 1
    tied = spark.createDataFrame([(1.0,)] * 5 + [(9.0,)], "v double")
    assert {r.target_band for r in metrics.with_quartile_band(tied, "v").collect()} == {"baixo", "medio_baixo"}


def periods(spark, pairs):
    return spark.createDataFrame([(i, a, m) for i, (a, m) in enumerate(pairs)], "id long, ano int, mes int")


def test_temporal_holdout(spark):
    df = periods(spark, [(2025, 1), (2023, 1), (2023, 2), (2024, 1), (2024, 2)])
    out = {(r.ano, r.mes): r.split for r in splits.temporal_holdout(df, "id").collect()}
    assert out.pop((2025, 1)) == "test" and set(out.values()) == {"train"}
    with pytest.raises(ValueError):
        splits.temporal_holdout(df.limit(1), "id")


def test_backtest(spark):
    df = periods(spark, [(2023, 1), (2023, 2), (2024, 1), (2024, 2), (2025, 1), (2025, 2)])
    rows = splits.backtest_folds(df, windows=2, min_train_periods=2).collect()
    assert {r.fold for r in rows} == {"2025-01", "2025-02"}
    for r in rows:
        assert (f"{r.ano}-{r.mes:02d}" < r.fold) == (r.role == "train")


def test_same_sample_has_no_drift(spark):
    df = spark.range(1000).selectExpr("id", "cast(id % 10 as double) v", "cast(id % 3 as string) c", "if(id < 500, 'reference', 'current') sample")
    report = drift.drift_report(df, ["v"], ["c"])
    assert not drift.dataset_drift(report).first()["dataset_drift"]
    moved = df.withColumn("v", F.when(F.col("sample") == "current", F.col("v") + 100).otherwise(F.col("v")))
    row = drift.numeric_drift(moved, ["v"]).first()
    assert row["drifted"] and row["ks"] == pytest.approx(1.0)


def test_clean_end_to_end(spark):
    df = spark.createDataFrame(
        [("N° do Cadastro", "Data de Transação", "x", "x"), ("1", "03/04/2024", "1.000,50", "SÃ£o JoÃ£o"), ("1", "03/04/2024", "1.000,50", "São João"),
         ("2", "03/04/2024", "0", "b"), ("3", "nada", "abc", "c")],
        "`N do Cadastro` string, `Data de Transação` string, `Valor Venal de Referência` string, Bairro string")
    got = {r.n_do_cadastro: (str(r.data_de_transacao)[:10], r.valor_venal_de_referencia, r.bairro) for r in cleaning.clean(df).collect()}
    assert got == {"1": ("2024-04-03", 1000.5, "SAO JOAO"), "3": ("None", None, "C")}
    counters = cleaning.removal_counters(snake_columns(df)).first()
    assert tuple(counters) == (1, 1, 1)


def test_hot_group_with_an_empty_column_keeps_the_others(spark):
    df = spark.range(400).selectExpr("if(id < 300, 'hot', 'cold') k", "cast(null as double) a", "cast(id as double) b", "cast(id % 7 as double) c")
    wanted = {"ma": ("a", 0.5), "mb": ("b", 0.5), "pb": ("b", 0.9), "mc": ("c", 0.25)}
    plain = {r.k: r for r in group_stats(df, ["k"], [], wanted).collect()}
    split = {r.k: r for r in group_stats(df, ["k"], [], wanted, hot_rows=50).collect()}
    assert plain == split and plain["hot"].mb == 149.5 and plain["hot"].ma is None


def test_temporal_holdout_refuses_null_periods(spark):
    df = spark.range(10).selectExpr("id", "if(id = 3, null, 2024) ano", "cast(1 + id % 5 as int) mes")
    with pytest.raises(ValueError, match="year and a month"):
        splits.temporal_holdout(df, "id")


def test_drift_without_a_current_sample_is_an_alert(spark):
    from lotledger.operators import drift

    df = spark.range(50).selectExpr("cast(id as double) x", "cast(null as double) z", "cast(id % 3 as string) c", "'reference' sample")
    report = drift.drift_report(df, ["x", "z"], ["c"])
    assert {r["column"]: r["drifted"] for r in report.collect()} == {"x": True, "z": True, "c": True}
    assert drift.dataset_drift(report).first()["dataset_drift"] is True
