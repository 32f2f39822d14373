"""Reading landed monthly parts, tables, documents and golden sets."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.text import strip
from ..operators.cleaning import drop_incomplete, require_columns
from ..operators.scale import sized_join
from ..session import materialize
from .records import cell_count, delimited_records, parse_cells

# The positional column names of a monthly sheet.
MONTHLY_COLUMNS = (
    "n_do_cadastro",
    "nome_do_logradouro",
    "numero",
    "complemento",
    "bairro",
    "nome_do_condominio",
    "cep",
    "natureza_de_transacao",
    "valor_de_transacao_declarado_pelo_contribuinte",
    "data_de_transacao",
    "valor_venal_de_referencia",
    "proporcao_transmitida",
    "valor_venal_de_referencia_proporcional",
    "base_de_calculo_adotada",
    "tipo_de_financiamento",
    "valor_financiado",
    "cartorio_de_registro",
    "matricula_do_imovel",
    "situacao_do_sql",
    "area_do_terreno_m2",
    "testada_m",
    "fracao_ideal",
    "area_construida_m2",
    "uso_iptu",
    "descricao_do_uso_iptu",
    "padrao_iptu",
    "descricao_do_padrao_iptu",
    "ano_da_construcao",
)
# Fixed value: a monthly sheet name, e.g. JAN-2024 (Portuguese month codes).
MONTH_SHEET = r"^(JAN|FEV|MAR|ABR|MAI|JUN|JUL|AGO|SET|OUT|NOV|DEZ)-20\d{2}$"
MIN_COLUMNS = 20
LINEAGE = ("arquivo", "aba")


def positional_names(width: int) -> list[str]:
    """The known names, then ``coluna_extra_<index>``."""
    return [*MONTHLY_COLUMNS[:width], *[f"coluna_extra_{i}" for i in range(len(MONTHLY_COLUMNS), width)]]


def is_month_sheet(sheet: Column) -> Column:
    return F.upper(strip(sheet)).rlike(MONTH_SHEET)


def name_part(df: DataFrame, arquivo: Column, aba: Column) -> DataFrame:
    """One header-less part: named by position, empty rows dropped, lineage added."""
    if len(df.columns) < MIN_COLUMNS:
        raise ValueError(f"a monthly part has too few columns: {len(df.columns)}")
    named = df.toDF(*positional_names(len(df.columns)))
    return named.na.drop("all").withColumns({"arquivo": arquivo, "aba": aba})


def union_parts(parts: Iterable[DataFrame]) -> DataFrame:
    """All parts as one table; a column absent from a part is NULL there."""
    parts = list(parts)
    if not parts:
        raise ValueError("no monthly part to read")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def string_schema(names: Sequence[str]) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


def _delimited(spark: SparkSession, sep: str):
    """A reader for what :func:`sinks.write_delimited` writes: quotes are doubled, cells may hold line breaks."""
    return spark.read.options(sep=sep, quote='"', escape='"', multiLine="true")


def read_delimited(spark: SparkSession, path: str, names: Sequence[str] | None = None, header: bool = True,
                   sep: str = ";") -> DataFrame:
    """Delimited files with every column a string; fails when there is no row.

    Without ``names`` the first record names the columns (see :func:`records.delimited_records`).
    """
    names = names or _delimited(spark, sep).option("header", header).csv(path).columns
    records = delimited_records(spark, path, sep)
    df = parse_cells(records.where(~F.col("first")) if header else records, names, sep).drop("_file")
    if df.isEmpty():
        raise ValueError(f"no row in {path}")
    return df


def read_monthly_parts(spark: SparkSession, root: str, sep: str = ";") -> DataFrame:
    """All monthly parts landed without header, as ``<root>/<arquivo>/<aba>.csv``
    or as the folders of :func:`sinks.write_part`, in files of any number and size.

    One scan covers every file: the schema is as wide as the widest record of any
    part (separators inside quotes don't count) and shorter rows are padded.
    Parts whose name is not a month are left out; a part without a record, or
    narrower than the minimum, is an error.
    """
    scan = {"recursiveFileLookup": "true", "pathGlobFilter": "*.csv"}

    def sheet(path: Column) -> Column:
        folder = F.url_decode(F.regexp_extract(path, r"/aba=([^/]+)/[^/]+$", 1))
        return F.coalesce(F.nullif(folder, F.lit("")), F.url_decode(F.regexp_extract(path, r"([^/]+)\.csv$", 1)))

    def lineage(df: DataFrame, path: Column) -> DataFrame:
        folder = F.url_decode(F.regexp_extract(path, r"/arquivo=([^/]+)/aba=[^/]+/[^/]+$", 1))
        arquivo = F.coalesce(F.nullif(folder, F.lit("")), F.url_decode(F.regexp_extract(path, r"([^/]+)/[^/]+$", 1)))
        return df.withColumns({"arquivo": arquivo, "aba": sheet(path)}).where(is_month_sheet(F.col("aba")))

    # the scan itself passes over files without a byte, so the listing is asked
    listed = spark.createDataFrame([(path,) for path in spark.read.options(**scan).text(root).inputFiles()], "path string")
    landed = lineage(listed, F.col("path")).select(*LINEAGE).distinct()
    records = delimited_records(spark, root, sep, scan, is_month_sheet(sheet(F.col("file"))))
    # one row per file, so that names are taken apart once
    wide = materialize(records.groupBy("file").agg(F.max(cell_count(F.col("record"), sep)).alias("w")), "widths")
    cells = lineage(wide, F.col("file")).groupBy(*LINEAGE).agg(F.max("w").alias("w"))
    widths = landed.join(cells, list(LINEAGE), "left")
    judged = widths.agg(F.max("w").alias("w"), F.min_by(F.struct(*LINEAGE, "w"), F.coalesce("w", F.lit(0))).alias("least")).first()
    if judged["least"] is None:
        raise ValueError(f"no monthly part under {root}")
    if (judged["least"]["w"] or 0) < MIN_COLUMNS:
        raise ValueError(f"a monthly part is empty or has an unexpected number of columns: {judged['least'].asDict()}")
    names = positional_names(max(judged["w"], len(MONTHLY_COLUMNS)))
    origin = lineage(wide.select(F.col("file").alias("_file")), F.col("_file"))
    return sized_join(parse_cells(records, names, sep), origin, ["_file"]).drop("_file").na.drop("all", subset=names)


def load_feature_table(df: DataFrame, required: Sequence[str], at_least: int = 10) -> DataFrame:
    """Rows complete in ``required`` with the postal code as a string."""
    return drop_incomplete(require_columns(df, required).withColumn("cep", F.col("cep").cast("string")),
                           required, at_least)


def period_from_file_name(name: Column) -> tuple[Column, Column]:
    """Year and month named in a file name (strings, NULL when absent)."""
    pattern = r"(\d{4}).*?(\d{2})"
    return (
        F.nullif(F.regexp_extract(name, pattern, 1), F.lit("")),
        F.nullif(F.regexp_extract(name, pattern, 2), F.lit("")),
    )


def year_from_file_name(name: Column) -> Column:
    """Number between the last ``_`` and the first ``.`` after it."""
    return F.split_part(F.element_at(F.split(name, "_"), -1), F.lit("."), F.lit(1)).try_cast("int")


def read_text_documents(spark: SparkSession, root: str) -> DataFrame:
    """Every ``.md`` and ``.txt`` file below ``root`` as (source, content)."""
    scan = spark.read.options(recursiveFileLookup="true", pathGlobFilter="*.{md,txt}").text(root, wholetext=True)
    return scan.select(F.col("_metadata.file_path").alias("source"), F.col("value").alias("content"))


GOLDEN_SET_SCHEMA = "id string, question string, expected_tool string, reference_answer string, category string"


def read_golden_set(spark: SparkSession, path: str, limit: int = 20) -> DataFrame:
    """Golden questions from JSON lines in id order; ``limit`` <= 0 keeps all.

    Blank lines are skipped; a malformed line, or one without an id, fails.
    """
    rows = spark.read.schema(GOLDEN_SET_SCHEMA).option("mode", "FAILFAST").json(path)
    rows = rows.withColumn("id", F.coalesce("id", F.raise_error(F.lit("a golden question has no id"))))
    return rows.orderBy("id").limit(limit) if limit > 0 else rows


def sample_rows(df: DataFrame, columns: Sequence[str], key: Sequence[str], n: int = 5000, seed: int = 42,
                hasher: str = "xxhash64") -> DataFrame:
    """An exact-size random sample that does not depend on partitioning.

    Rows are taken in order of a hash of the key, so each task keeps its own
    smallest ``n`` and no full sort happens.
    """
    if hasher == "md5":
        order = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in key], F.lit(str(seed))))
    else:
        order = F.xxhash64(*key, F.lit(seed))
    needed = list(dict.fromkeys([*columns, *key]))
    picked = df.select(*needed, order.alias("_order")).orderBy("_order", *key).limit(n)
    return picked.select(*columns)
