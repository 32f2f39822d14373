"""Column helpers shared by the operators that stay in built-in functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Everything in ASCII but digits and lower-case letters separates words.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Rows up to which a side with a few short columns is broadcast.
SMALL_ROWS = 100_000


def refuse_clashes(keep: Sequence[str], results: Sequence[str]) -> None:
    """Fails where a kept column has a result's name, one that operators use (``_``...), or another's."""
    names = [c.lower() for c in keep]
    if clash := sorted({c for c in names if c.startswith("_") or c in results or names.count(c) > 1}):
        raise ValueError(f"kept columns clash with results: {clash}")


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z (and nothing else) in lower case; NULL becomes empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())


def words(text: Column) -> Column:
    """Maximal runs of ASCII digits, letters (lower-cased) and non-ASCII characters.

    Splitting at separators is an order of magnitude cheaper than extracting
    every match; empty pieces stand only at the two ends.
    """
    return F.array_remove(F.split(lower_ascii(text), SEPARATORS, -1), "")


def gram_hash(words_column: str, position: str | Column, size: int) -> Column:
    """64-bit hash of ``size`` words from ``position`` (NULL where they run out)."""
    at = F.col(position) if isinstance(position, str) else position
    parts = [F.get(words_column, at + i) for i in range(size)]
    return F.when(at + size <= F.size(words_column), F.xxhash64(*parts))


def positions(df: DataFrame, keep: Sequence[str], text: str = "text") -> DataFrame:
    """One row per word position of every text, and one for a text without words.

    Adds ``_rid`` (unique per row of this scan), ``_w`` (all words), ``n_words``
    and ``_pos`` (NULL where there are no words). The word array is not copied
    into rows that a later filter in the same stage drops.
    """
    split = df.select(*keep, F.monotonically_increasing_id().alias("_rid"), words(F.col(text)).alias("_w"))
    return split.select(*keep, "_rid", "_w", F.size("_w").cast("long").alias("n_words"),
                        F.posexplode_outer("_w").alias("_pos", "_word"))


def broadcast_small(df: DataFrame, rows: int, limit: int = SMALL_ROWS) -> DataFrame:
    """Broadcast hint for a side whose counted ``rows`` are within ``limit``."""
    return F.broadcast(df) if rows <= limit else df
