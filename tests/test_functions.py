import datetime
import unicodedata

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from lotledger.functions import payload, text, values


def column(spark, values_, fn, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values_)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(fn(F.col("v"))).collect()]


def test_repair_mojibake(spark):
    broken = ["NÃºmero", "Número", "plain", None, "Ã", "ÃÂ日本", "Â°C", "SÃ£o â‚¬"]

    def rule(x):
        if x is None or not ("Ã" in x or "Â" in x):
            return x
        try:
            return x.encode("latin1").decode("utf-8")
        except UnicodeError:
            return x

    assert column(spark, broken, text.repair_mojibake) == [rule(x) for x in broken]


TEXTS = ["São João", " ação nº 5 ", "10 m² ½ ℡ ﬁm …", "ß Æ ° ª", "日本 ａｂｃ 𝐀𝐁", "é", "", None, "\tx\n\x1f", "Ǆ ㎏ ⅷ"]


def ascii_rule(x):
    return None if x is None else unicodedata.normalize("NFKD", x).encode("ascii", "ignore").decode().upper().strip()


def test_normalize_text(spark):
    assert column(spark, TEXTS, lambda c: text.normalize_text(c, repair=False)) == [ascii_rule(x) for x in TEXTS]
    assert column(spark, ["SÃ£o Paulo"], text.normalize_text) == ["SAO PAULO"]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(blacklist_categories=["Cs"], blacklist_characters="\x00"), max_size=30), min_size=200, max_size=300))
def test_normalize_text_any_unicode(spark, texts):
    assert column(spark, texts, lambda c: text.normalize_text(c, repair=False)) == [ascii_rule(x) for x in texts]


def test_snake_case_names(spark):
    assert text.snake_case("Área do Terreno (m²)") == "area_do_terreno_m2"
    assert text.snake_case("  Nº  do Cadastro ") == "no_do_cadastro"
    df = spark.createDataFrame([(1, 2, 3)], "`A b` int, `a B` int, c int")
    assert text.snake_columns(df, drop_repeats=True).collect()[0].asDict() == {"a_b": 1, "c": 3}
    with pytest.raises(ValueError):
        text.snake_columns(df)


def test_parse_br_number(spark):
    cells = ["1.234,56", "1234.5", "R$ -3,5", "abc", "", None, "12", "1.234.567"]
    assert column(spark, cells, values.parse_br_number) == [1234.56, 12345.0, -3.5, None, None, None, 12.0, 1234567.0]
    assert column(spark, cells, lambda c: values.parse_br_number(c, "auto")) == [1234.56, 1234.5, -3.5, None, None, None, 12.0, 1234567.0]
    assert column(spark, ["1 234,5"], lambda c: values.parse_br_number(c, "legacy")) == [1234.5]


def test_parse_date(spark):
    cells = ["03/04/2024", "2024-01-10", "2024-01-10 05:06:07", "12/25/2024", "31/02/2024", "x", None]
    day = [d and d.strftime("%Y-%m-%d") for d in column(spark, cells, values.parse_date)]
    assert day == ["2024-04-03", "2024-01-10", "2024-01-10", "2024-12-25", None, None, None]
    month = column(spark, ["03/04/2024", "25/12/2024"], lambda c: values.parse_date(c, "monthfirst"))
    assert month == [datetime.datetime(2024, 3, 4), datetime.datetime(2024, 12, 25)]
    assert column(spark, ["03/04/2024"], lambda c: values.parse_date(c, "iso")) == [None]


def test_cep_and_period(spark):
    assert column(spark, ["01001-000", "--", None], values.digits_only) == ["01001000", None, None]
    rows = spark.createDataFrame([(2024, 3)], "a int, m int")
    assert rows.select(values.period_label(F.col("a"), F.col("m"))).first()[0] == "2024-03"


def test_sanitize_truncate_tokens(spark):
    assert column(spark, ["  a\x07b　", None], text.sanitize) == ["ab", ""]
    assert column(spark, ["abcdef"], lambda c: text.truncate(c, 3)) == ["abc..."]
    assert column(spark, ["", "abcdefghi"], text.estimate_tokens) == [1, 2]


def test_property_from_text(spark):
    said = "Quanto vale um apartamento com cep 04001000, area 80 e ano_mes 202401?"
    got = column(spark, [said], payload.property_from_text)[0].asDict()
    assert got == {"area_do_terreno_m2": "80", "cep": "04001000", "ano": None, "mes": None, "ano_mes": "202401"}


def test_regions_from_text(spark):
    got = column(spark, ["Compare Moema e Pinheiros usando valor_m2", "Compare São João e Água Branca.", "nada"], payload.regions_from_text)
    assert [tuple(g) for g in got] == [
        ("Moema", "Pinheiros", "valor_m2"), ("São João", "Água Branca", None), (None, None, None)]


def test_reply_payload(spark):
    replies = ['{"action":"x","action_input":{"q":1}}', 'ok {"thought":"t","action":"y"} fim', " nada ", "{quebrado"]
    got = [tuple(g) for g in column(spark, replies, payload.reply_payload)]
    assert got == [
        (None, "x", '{"q":1}', None), ("t", "y", None, None), ("fallback", "final", "", "nada"),
        ("fallback", "final", "", "{quebrado")]


def test_model_version(spark):
    assert column(spark, ["models/prod/model_2026.05.03.1334", "models/x"], payload.model_version) == ["2026.05.03.1334", "unknown"]
