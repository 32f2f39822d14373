import pytest

from lotledger.models import training
from lotledger.plans import batch


@pytest.fixture(scope="module")
def raw(spark):
    return spark.range(600).selectExpr(
        "lpad(cast(id as string), 6, '0') `Nº do Cadastro`", "concat('SÃ£o ', id % 3) Bairro",
        "concat(lpad(cast(id % 30 as string), 5, '0'), '-000') CEP", "if(id % 5 = 0, 'Residência', 'terreno') `Descrição do Uso (IPTU)`",
        "format_string('%02d/%02d/%d', 1 + id % 28, 1 + id % 12, 2022 + id div 150) `Data de Transação`",
        "concat(cast(50 + id % 40 as string), ',50') `Área do Terreno (m²)`", "concat('R$ ', cast(100 + id % 70 as string), '.000,00') `Valor Venal de Referência`",
    ).toDF("n_do_cadastro", "bairro", "cep", "descricao_do_uso_iptu", "data_de_transacao", "area_do_terreno_m2", "valor_venal_de_referencia")


def test_stages_end_to_end(spark, raw, tmp_path):
    root = str(tmp_path)
    clean = batch.publish_clean(raw, f"{root}/clean", f"{root}/profile", min_rows=500, min_terrain_rows=400)
    assert clean.count() == 600 and {r.bairro for r in clean.select("bairro").distinct().collect()} == {"SAO 0", "SAO 1", "SAO 2"}
    with pytest.raises(ValueError, match="rows=600"):
        batch.publish_clean(raw, f"{root}/clean", min_rows=10_000)
    assert batch.read_published(spark, f"{root}/clean").count() == 600
    table = batch.publish_features(clean, f"{root}/features", f"{root}/contract", min_rows=400)
    assert table.count() == 480
    explored = batch.explore(clean, f"{root}/eda", bins=10)
    assert explored["summary"].count() == 3 and explored["frequency_value"].count() == 10
    stored = batch.train(table, f"{root}/models", "2026.01.02.0304", training.default_candidates()[:2])
    assert stored.summary.first()["n_rows"] == 480 and spark.read.parquet(f"{root}/models/runs").count() == 2
    report = batch.validate(table, stored.path, "test", f"{root}/validation").first()
    assert (report["version"], report["n_holdout"]) == ("2026.01.02.0304", 96)
    assert report["mae"] == pytest.approx(stored.summary.first()["candidates"][0]["mae"])


def test_holdout_does_not_depend_on_file_splits(spark, tmp_path):
    from lotledger.operators.splits import temporal_holdout

    clean = spark.range(20_000).selectExpr(
        "'TERRENO' descricao_do_uso_iptu", "lpad(cast(id % 30 as string), 8, '0') cep", "cast(50 + id % 40 as double) area_do_terreno_m2",
        "cast(1000 + id % 70 as double) valor_venal_de_referencia", "make_date(cast(2020 + id % 3 as int), 1, 1) data_de_transacao").repartition(3)
    batch.publish_features(clean, str(tmp_path), min_periods=1)
    sets = []
    try:
        for size in ("16k", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            table = batch.read_published(spark, str(tmp_path))
            test = temporal_holdout(table, batch.ROW_ID).where("split = 'test'")
            sets.append({r["id"] for r in test.collect()})
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sets[0] == sets[1] and len(sets[0]) == 4000
    with pytest.raises(ValueError, match="missing required"):
        batch.train(table.drop("id"), str(tmp_path), "v")
