"""Numbers, dates and keys written the Brazilian way."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .text import strip

# Fixed value: the first number in a cell, after separators are rewritten.
_NUMBER = r"([-+]?[0-9]*\.?[0-9]+)"


def parse_br_number(col: Column, mode: str = "br") -> Column:
    """Text to double; NULL when the cell holds no digits.

    ``br`` drops every ``.`` and reads ``,`` as the decimal mark. ``auto``
    drops dots only when a comma is present or the dots group thousands, so
    ``1234.5`` stays 1234.5. ``legacy`` is ``br`` with spaces removed too.
    """
    text = col.cast("string")
    stripped = F.replace(F.replace(text, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    if mode == "legacy":
        stripped = F.replace(stripped, F.lit(" "), F.lit(""))
    elif mode == "auto":
        grouped = text.contains(",") | text.rlike(r"(^|[^0-9.])[0-9]{1,3}(\.[0-9]{3})+([^0-9.]|$)")
        stripped = F.when(grouped, stripped).otherwise(text)
    elif mode != "br":
        raise ValueError(f"unknown mode {mode!r}")
    return F.nullif(F.regexp_extract(stripped, _NUMBER, 1), F.lit("")).try_cast("double")


# Shapes of a date cell. Matching the shape first means the parser is only
# asked for formats that fit, instead of failing its way through a list.
_ISO_TIME = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"
_ISO = r"^\d{4}-\d{2}-\d{2}$"
_SLASHED = r"^\d{1,2}/\d{1,2}/\d{4}$"


def parse_date(col: Column, order: str = "dayfirst") -> Column:
    """Text to timestamp; NULL when the cell is not a date.

    ``dayfirst`` and ``monthfirst`` set how ``03/04/2024`` is read; the other
    order applies when the preferred one gives a month above 12. ``iso``
    accepts year-month-day only.
    """
    if order not in ("dayfirst", "monthfirst", "iso"):
        raise ValueError(f"unknown order {order!r}")
    out = F.when(col.rlike(_ISO), F.try_to_timestamp(col, F.lit("yyyy-MM-dd"))).when(
        col.rlike(_ISO_TIME), F.try_to_timestamp(col, F.lit("yyyy-MM-dd HH:mm:ss"))
    )
    if order == "iso":
        return out
    formats = ("d/M/yyyy", "M/d/yyyy") if order == "dayfirst" else ("M/d/yyyy", "d/M/yyyy")
    month_part = F.split_part(col, F.lit("/"), F.lit(2 if order == "dayfirst" else 1))
    slashed = F.when(month_part.try_cast("int") <= 12, F.try_to_timestamp(col, F.lit(formats[0]))).otherwise(
        F.try_to_timestamp(col, F.lit(formats[1]))
    )
    return out.when(col.rlike(_SLASHED), slashed)


def digits_only(col: Column) -> Column:
    """Postal code as digits; NULL when there are none."""
    return F.nullif(F.regexp_replace(col.cast("string"), "[^0-9]", ""), F.lit(""))


def with_period(df: DataFrame, date: str = "data_de_transacao") -> DataFrame:
    """Add ``ano``, ``mes`` and ``ano_mes`` from a date column."""
    ano, mes = F.year(date), F.month(date)
    return df.withColumns({"ano": ano, "mes": mes, "ano_mes": ano * 100 + mes})


def period_key(ano: Column, mes: Column) -> Column:
    return ano.cast("int") * 100 + mes.cast("int")


def split_period(ano_mes: Column) -> tuple[Column, Column]:
    """Year and month of a ``yyyymm`` number."""
    whole = ano_mes.cast("int")
    return F.floor(whole / 100).cast("int"), (whole % 100).cast("int")


def period_label(ano: Column, mes: Column) -> Column:
    """``YYYY-MM``."""
    return F.format_string("%d-%02d", ano.cast("int"), mes.cast("int"))


def price_per_m2(value: Column, area: Column) -> Column:
    """Price per square metre; NULL where the area is zero."""
    return F.try_divide(value, area)


def region_key(df: DataFrame, region: str = "bairro", fallback: str = "cep") -> Column:
    """Trimmed upper-case region, or the postal code where no region column exists."""
    name = region if region in df.columns else fallback
    if name not in df.columns:
        raise ValueError(f"neither {region!r} nor {fallback!r} is present")
    return F.upper(strip(F.col(name).cast("string")))


def lenient_double(col: Column) -> Column:
    """Number that may use a decimal comma."""
    return F.replace(col.cast("string"), F.lit(","), F.lit(".")).try_cast("double")


def lenient_int(col: Column) -> Column:
    """As :func:`lenient_double`, truncated toward zero."""
    return lenient_double(col).try_cast("int")
