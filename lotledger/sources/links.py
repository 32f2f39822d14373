"""Links to yearly files found in HTML pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import strip

# Elements whose text surrounds a link.
_BLOCK = r"(?i)</?(?:html|head|body|nav|header|footer|article|section|main|div|ul|ol|li|p|td|th|tr|table|h[1-6])\b[^>]*>"
_ANCHOR_START = r"(?i)(?=<a[\s/])"
# An attribute: a name, then maybe a value in either quote or bare. Possessive loops never give back.
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s"'>]++)"""
_OTHER = rf"""(?:[\s/]++(?!href[\s=])[^\s=>"'/]++(?:\s*+=\s*+{_VALUE})?+)*+"""
_HREF = rf"""(?is)^<a{_OTHER}[\s/]++href\s*+=\s*+"""
_QUOTES = (r'"([^"]*+)"', r"'([^']*+)'", r"""([^\s"'>]++)""")
_COMMENT = r"(?s)<!--.*?(?:-->|$)"
# A reference to a character: by name, number or hexadecimal number.
_REFERENCE = r"&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z]+);"
# Names of characters that text and URLs commonly refer to.
_NAMED = {
    "amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": "\u00a0", "ndash": "\u2013", "mdash": "\u2014", "ordm": "\u00ba", "ordf": "\u00aa",
    "aacute": "á", "agrave": "à", "acirc": "â", "atilde": "ã", "ccedil": "ç", "eacute": "é", "ecirc": "ê", "iacute": "í", "oacute": "ó", "ocirc": "ô",
    "otilde": "õ", "uacute": "ú", "Aacute": "Á", "Agrave": "À", "Acirc": "Â", "Atilde": "Ã", "Ccedil": "Ç", "Eacute": "É", "Ecirc": "Ê", "Iacute": "Í",
    "Oacute": "Ó", "Ocirc": "Ô", "Otilde": "Õ", "Uacute": "Ú",
}
_STRONG = r"(?is)<strong\b[^>]*>(.*?)</strong>"
# Fixed value: a year of this century.
YEAR = r"(20\d{2})"


def decode_references(text: Column) -> Column:
    """Character references replaced by their characters; unknown ones stay.

    The text is cut at references once, so the work is linear in it, and what a
    reference stands for is not read again.
    """
    names = F.create_map(*[x for name, char in _NAMED.items() for x in (F.lit(name), F.lit(char))])

    def char(name: Column) -> Column:
        hexadecimal = name.rlike("^#[xX]")
        digits = F.when(hexadecimal, F.conv(F.substring(name, 3, 6), 16, 10)).otherwise(F.substring(name, 2, 7)).cast("int")
        valid = digits.between(1, 0xD7FF) | digits.between(0xE000, 0x10FFFF)
        # UTF-32 tells any code point
        numbered = F.decode(F.unhex(F.lpad(F.hex(digits), 8, "0")), "UTF-32")
        return F.coalesce(F.when(name.startswith("#"), F.when(valid, numbered)).otherwise(F.try_element_at(names, name)),
                          F.concat(F.lit("&"), name, F.lit(";")))

    found, pieces = F.regexp_extract_all(text, F.lit(_REFERENCE), 1), F.split(text, _REFERENCE, -1)
    decoded = F.concat(F.element_at(pieces, 1), F.array_join(F.zip_with(
        found, F.slice(pieces, 2, F.size(pieces)), lambda name, after: F.concat(char(name), after)), ""))
    return F.when(text.contains("&"), decoded).otherwise(text)


def _href(piece: Column) -> Column:
    """The href of the anchor that ``piece`` starts with, decoded and stripped; NULL where it has none."""
    found = F.lit(None).cast("string")
    for quoted in _QUOTES[::-1]:
        found = F.when(piece.rlike(_HREF + quoted), F.regexp_extract(piece, _HREF + quoted, 1)).otherwise(found)
    return strip(decode_references(found))


def _plain(html: Column) -> Column:
    return strip(F.regexp_replace(decode_references(F.regexp_replace(html, r"(?s)<[^>]*>", " ")), r"[\s\u00a0]+", " "))


def absolute_url(base: Column, href: Column) -> Column:
    """``href`` resolved against ``base`` (without collapsing dot segments)."""
    scheme = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.\-]*):", 1)
    origin = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*)", 1)
    page = F.regexp_extract(base, r"^([^?#]*)", 1)
    folder = F.when(page == origin, F.concat(origin, F.lit("/"))).otherwise(F.regexp_extract(page, r"^(.*/)", 1))
    return (
        F.when(href.rlike(r"^[a-zA-Z][a-zA-Z0-9+.\-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(href.startswith("/"), F.concat(origin, href))
        .when(href.startswith("?"), F.concat(page, href))
        .when(href.startswith("#"), F.concat(F.regexp_extract(base, r"^([^#]*)", 1), href))
        .when(href == "", base)
        .otherwise(F.concat(folder, href))
    )


def page_links(pages: DataFrame, html: str = "html") -> DataFrame:
    """One row per ``<a href>`` with its position and surrounding text.

    The context is the last ``<strong>`` before the link followed by the text
    of the enclosing block. Pages are cut into blocks, and those at anchors,
    into rows; the last strong text is carried over a page's rows in order, so
    the work is linear in a page. Comments are passed over; attributes may be
    quoted either way or bare, and character references are decoded.
    """
    numbered = pages.withColumn("_rid", F.monotonically_increasing_id())
    blocks = numbered.select("*", F.posexplode(F.split(F.regexp_replace(F.col(html), _COMMENT, ""), _BLOCK)).alias("_i", "_block"))
    # piece 0 of a block precedes its first anchor
    pieces = blocks.select(
        *pages.columns, "_rid", "_i", _plain(F.col("_block")).alias("_text"),
        F.posexplode(F.split("_block", _ANCHOR_START)).alias("_j", "_piece"))
    strong = F.regexp_extract_all("_piece", F.lit(_STRONG), 1)
    pieces = pieces.withColumn("_href", _href(F.col("_piece")))
    told = pieces.select(
        *pages.columns, "_rid", "_i", "_j", "_text", F.col("_href").isNotNull().alias("_is_link"), "_href",
        F.when(F.size(strong) > 0, _plain(F.element_at(strong, -1))).alias("_strong")).where("_is_link or _strong is not null")
    order = Window.partitionBy("_rid").orderBy("_i", "_j")
    before = F.last("_strong", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    place = F.count_if("_is_link").over(order.rowsBetween(Window.unboundedPreceding, 0)) - 1
    placed = told.withColumn("_before", F.coalesce(before, F.lit(""))).withColumn("pos", place.cast("int")).where("_is_link")
    return placed.select(*pages.columns, "pos", F.col("_href").alias("href"), strip(F.concat_ws(" ", "_before", "_text")).alias("context"))


def keyed_links(pages: DataFrame, page: str = "page_id", base: str = "url", html: str = "html",
                suffix: str = ".xlsx", keyword: str = "itbi", key_pattern: str = YEAR) -> DataFrame:
    """(page, key, url): the last link per key whose href holds suffix and keyword.

    The key is the first match of ``key_pattern`` in the context, else in the href.
    """
    links = page_links(pages, html)
    href = F.lower("href")
    wanted = links.where(href.contains(suffix.lower()) & href.contains(keyword.lower()))
    key = F.coalesce(
        F.nullif(F.regexp_extract("context", key_pattern, 1), F.lit("")),
        F.nullif(F.regexp_extract("href", key_pattern, 1), F.lit("")),
    )
    return (
        wanted.withColumn("key", key).where(F.col("key").isNotNull())
        .groupBy(page, "key")
        .agg(F.max_by(absolute_url(F.col(base), F.col("href")), "pos").alias("link"))
    )


def year_links(pages: DataFrame, min_year: int = 2023, max_year: int = 2025, **options) -> DataFrame:
    """:func:`keyed_links` keyed by year within bounds."""
    found = keyed_links(pages, key_pattern=YEAR, **options)
    return found.withColumn("year", F.col("key").cast("int")).where(F.col("year").between(min_year, max_year)).drop("key")


def source_manifest(links: DataFrame, page: str = "page_id", key: str = "year", link: str = "link") -> DataFrame:
    """One row per page: its links in key order (a handful per page)."""
    entries = F.array_sort(F.collect_list(F.struct(F.col(key).alias("year"), F.col(link).alias("url"))))
    return links.groupBy(page).agg(entries.alias("years"))
