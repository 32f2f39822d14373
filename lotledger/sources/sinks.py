"""Exports: delimited files, JSON reports, run tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType

# Columns of the flat benchmark export, in order.
RUN_COLUMNS = (
    "config_name",
    "rag_top_k",
    "id",
    "category",
    "expected_tool",
    "tools_used",
    "chunks_retrieved",
    "latency_ms",
    "response_length",
    "success",
    "error",
    "sources",
    "question",
    "answer",
)


def write_delimited(df: DataFrame, path: str, sep: str = ";") -> None:
    """Delimited export with a header. Between stages use Parquet instead."""
    df.write.mode("errorifexists").options(
        sep=sep, header="true", quote='"', escape='"', ignoreLeadingWhiteSpace="false",
        ignoreTrailingWhiteSpace="false", emptyValue="",
    ).csv(path)


def write_part(df: DataFrame, root: str, arquivo: str, aba: str, sep: str = ";") -> None:
    """One monthly part, header-less, in the folder where :func:`raw.read_monthly_parts` looks for it.

    The part may be of any size: every task writes a file of its own.
    """
    df.write.mode("errorifexists").options(
        sep=sep, quote='"', escape='"', ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false", emptyValue="",
    ).csv(f"{root}/arquivo={arquivo}/aba={aba}")


def write_json_report(df: DataFrame, path: str) -> None:
    """Report rows as JSON lines; NULL fields are kept."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def flatten_lists(df: DataFrame, separator: str = "|") -> DataFrame:
    """List columns joined into one string each."""
    def flat(field) -> Column:
        col = F.col(field.name)
        return F.concat_ws(separator, col).alias(field.name) if isinstance(field.dataType, ArrayType) else col

    return df.select(*[flat(f) for f in df.schema.fields])


def write_runs(runs: DataFrame, json_path: str, csv_path: str, columns: Sequence[str] = RUN_COLUMNS) -> None:
    """Benchmark runs: nested JSON lines and a flat delimited file."""
    write_json_report(runs, json_path)
    write_delimited(flatten_lists(runs.select(*columns)), csv_path, sep=",")
