"""Fields pulled out of free text, logged replies and nested records."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import strip
from .values import digits_only, lenient_int, split_period

# How a property is described in free text.
AREA_IN_TEXT = r"(?i)area(?:_do_terreno_m2)?\s+(\d+(?:[.,]\d+)?)"
CEP_IN_TEXT = r"(?i)cep(?:_numero|_prefixo)?\s+([\d.\-]{1,12})"
ANO_IN_TEXT = r"(?i)\bano\s+(\d{4})"
MES_IN_TEXT = r"(?i)\bmes\s+(\d{1,2})"
ANO_MES_IN_TEXT = r"(?i)ano_mes\s+(\d{6})"
# Fixed value: "compare X e Y usando M".
COMPARE_IN_TEXT = (
    r"(?iU)compare\s+([\p{L}\s]+?)\s+e\s+([\p{L}\s]+?)"
    r"(?:\s+usando\s+([a-zA-Z0-9_]+)|[.?!,]|$)"
)
# Fixed value: version in a model folder name.
VERSION_IN_PATH = r"model_(\d+\.\d+\.\d+\.\d+)"


def _first_group(text: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def property_from_text(text: Column) -> Column:
    """Struct of the property fields named in a sentence (strings, NULL when absent)."""
    return F.struct(
        F.replace(_first_group(text, AREA_IN_TEXT), F.lit(","), F.lit(".")).alias("area_do_terreno_m2"),
        digits_only(_first_group(text, CEP_IN_TEXT)).alias("cep"),
        _first_group(text, ANO_IN_TEXT).alias("ano"),
        _first_group(text, MES_IN_TEXT).alias("mes"),
        _first_group(text, ANO_MES_IN_TEXT).alias("ano_mes"),
    )


def regions_from_text(text: Column) -> Column:
    """Struct of the two regions and the optional metric of a comparison request."""
    return F.struct(
        strip(_first_group(text, COMPARE_IN_TEXT, 1)).alias("region_a"),
        strip(_first_group(text, COMPARE_IN_TEXT, 2)).alias("region_b"),
        _first_group(text, COMPARE_IN_TEXT, 3).alias("metric"),
    )


def resolve_aliases(
    cep: Column, cep_prefixo: Column, area_do_terreno_m2: Column, area: Column,
    ano: Column, mes: Column, ano_mes: Column,
) -> Column:
    """Accept the alternative field names of a request.

    When either of year and month is missing, **both** come from ``ano_mes``.
    """
    period = F.nullif(ano_mes.cast("string"), F.lit(""))
    from_period = (ano.isNull() | mes.isNull()) & period.isNotNull()
    year, month = split_period(lenient_int(period))
    return F.struct(
        F.coalesce(cep, cep_prefixo).alias("cep"),
        F.coalesce(area_do_terreno_m2, area).alias("area_do_terreno_m2"),
        F.when(from_period, year).otherwise(lenient_int(ano)).alias("ano"),
        F.when(from_period, month).otherwise(lenient_int(mes)).alias("mes"),
    )


def reply_payload(reply: Column) -> Column:
    """Decision fields of a logged model reply.

    Tries the whole reply as JSON, then the outermost ``{...}``; anything else
    becomes a final answer as it stands.
    """
    whole = F.try_parse_json(reply)
    inner = F.try_parse_json(_first_group(reply, r"(?s)(\{.*\})"))
    doc = F.coalesce(whole, inner)

    def field(name: str, fallback: Column) -> Column:
        return F.when(doc.isNull(), fallback).otherwise(F.try_variant_get(doc, f"$.{name}", "string"))

    return F.struct(
        field("thought", F.lit("fallback")).alias("thought"),
        field("action", F.lit("final")).alias("action"),
        field("action_input", F.lit("")).alias("action_input"),
        field("final_answer", strip(reply)).alias("final_answer"),
    )


def model_version(path: Column) -> Column:
    """Version in a model path, else ``unknown``."""
    return F.coalesce(_first_group(path, VERSION_IN_PATH), F.lit("unknown"))


def distinct_sources(*nested: Column) -> Column:
    """Ordered distinct sources over columns of ``array<struct<sources: array<string>>>``."""
    lists = [F.flatten(F.transform(col, lambda s: s["sources"])) for col in nested]
    empty = F.array().cast("array<string>")
    return F.array_distinct(F.concat(*[F.coalesce(x, empty) for x in lists]))
