"""Text clean-up as Column expressions (no Python per row)."""

from __future__ import annotations

import functools
import json
import re
import sys
import unicodedata

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

# Characters whose presence marks UTF-8 text read as Latin-1.
MOJIBAKE_MARKERS = "[ÃÂ]"
# Fixed value: control characters removed from user text.
CONTROL_CHARS = r"[\x00-\x08\x0b\x0c\x0e-\x1f]"

# Every white-space character, the information separators 0x1c..0x1f included.
_SPACES = "".join(chr(p) for p in range(0x3001) if chr(p).isspace())


def strip(col: Column) -> Column:
    """Remove leading and trailing white space of any kind."""
    return F.btrim(col, F.lit(_SPACES))


def repair_mojibake(col: Column) -> Column:
    """Undo UTF-8 read as Latin-1.

    Touches only text that holds a marker, fits Latin-1, and whose bytes are
    valid UTF-8; everything else (NULL included) is returned unchanged.
    """
    latin1 = F.encode(col, "ISO-8859-1")
    # `when` evaluates lazily, so `encode` never sees a character it cannot map.
    fits = F.when(
        col.rlike(MOJIBAKE_MARKERS) & ~col.rlike(r"[^\x{00}-\x{ff}]"),
        F.is_valid_utf8(latin1),
    )
    return F.when(fits, F.decode(latin1, "UTF-8")).otherwise(col)


def repair_all(df: DataFrame) -> DataFrame:
    """:func:`repair_mojibake` over every string column."""
    return df.select(
        *[
            repair_mojibake(F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, StringType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


@functools.cache
def _ascii_tables() -> tuple[str, str, dict[str, str]]:
    """Compatibility decomposition restricted to its ASCII part.

    Built from the Unicode database: one-to-one pairs for ``translate`` and
    the one-to-many expansions (ligatures, fractions, units).
    """
    single_from, single_to, multi = [], [], {}
    for point in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= point <= 0xDFFF:
            continue
        char = chr(point)
        decomposed = unicodedata.normalize("NFKD", char)
        if decomposed == char:
            continue
        plain = decomposed.encode("ascii", "ignore").decode("ascii")
        if len(plain) == 1:
            single_from.append(char)
            single_to.append(plain)
        elif plain:
            multi[char] = plain
    return "".join(single_from), "".join(single_to), multi


def to_ascii(col: Column) -> Column:
    """Drop accents and every character without an ASCII equivalent.

    ASCII text is returned as it is and Latin-1 text takes one ``translate``
    (characters without a counterpart are deleted by it); only text with
    further characters pays for the full tables.
    """
    source, target, multi = _ascii_tables()
    pairs = [(a, b) for a, b in zip(source, target) if a <= "\xff"]
    short = {a: b for a, b in multi.items() if a <= "\xff"}
    mapped = {a for a, _ in pairs} | set(short)
    deleted = "".join(chr(p) for p in range(0x80, 0x100) if chr(p) not in mapped)
    latin = col
    for char, plain in short.items():
        latin = F.replace(latin, F.lit(char), F.lit(plain))
    latin = F.translate(latin, "".join(a for a, _ in pairs) + deleted, "".join(b for _, b in pairs))

    expansions = F.from_json(F.lit(json.dumps(multi)), "map<string,string>")
    expanded = F.when(
        col.rlike(_char_class(multi)),
        F.array_join(
            F.transform(F.split(col, ""), lambda ch: F.coalesce(F.try_element_at(expansions, ch), ch)), ""
        ),
    ).otherwise(col)
    wide = F.regexp_replace(F.translate(expanded, source, target), r"[^\x00-\x7f]", "")
    return (
        F.when(~col.rlike(r"[^\x00-\x7f]"), col)
        .when(~col.rlike(r"[^\x{00}-\x{ff}]"), latin)
        .otherwise(wide)
    )


def _char_class(chars) -> str:
    """A regex class for code points, neighbours joined into ranges."""
    points = sorted(ord(c) for c in chars)
    spans, start, prev = [], points[0], points[0]
    for point in points[1:]:
        if point != prev + 1:
            spans.append((start, prev))
            start = point
        prev = point
    spans.append((start, prev))
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in spans) + "]"


def normalize_text(col: Column, repair: bool = True, upper: bool = True) -> Column:
    """Canonical form for comparing labels: ASCII, upper case, trimmed.

    ``repair=False`` skips the mojibake step (legacy files); ``upper=False``
    keeps case (extraction stage).
    """
    out = to_ascii(repair_mojibake(col) if repair else col)
    return strip(F.upper(out) if upper else out)


def snake_case(name: str) -> str:
    """ASCII snake_case of a column name (plan time)."""
    if re.search(MOJIBAKE_MARKERS, name):
        try:
            name = name.encode("latin-1").decode("utf-8")
        except UnicodeError:
            pass
    plain = unicodedata.normalize("NFKD", name).encode("ascii", "ignore").decode("ascii")
    return re.sub(r"[^a-z0-9]+", "_", plain.lower()).strip("_")


def snake_columns(df: DataFrame, drop_repeats: bool = False) -> DataFrame:
    """Rename all columns to snake_case.

    With ``drop_repeats`` a later column whose name was already used is
    dropped; otherwise repeated names are an error.
    """
    names = [snake_case(c) for c in df.columns]
    first = {name: i for i, name in reversed(list(enumerate(names)))}
    if len(first) == len(names):
        return df.toDF(*names)
    if not drop_repeats:
        raise ValueError(f"repeated column names after renaming: {names}")
    positional = df.toDF(*[f"_c{i}" for i in range(len(names))])
    keep = sorted(first.items(), key=lambda kv: kv[1])
    return positional.select(*[F.col(f"_c{i}").alias(name) for name, i in keep])


def sanitize(col: Column) -> Column:
    """Remove control characters, then surrounding white space."""
    return strip(F.regexp_replace(F.coalesce(col, F.lit("")), CONTROL_CHARS, ""))


def truncate(col: Column, limit: int = 160) -> Column:
    """First ``limit`` characters and an ellipsis when the text is longer."""
    return F.when(F.length(col) > limit, F.concat(F.substring(col, 1, limit), F.lit("..."))).otherwise(col)


def estimate_tokens(col: Column) -> Column:
    """Rough token count: a quarter of the characters, at least one."""
    return F.greatest(F.lit(1), F.floor(F.char_length(col) / 4).cast("int"))
