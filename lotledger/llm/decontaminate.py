"""Benchmark decontamination as a prefix-filtered set join, in built-in functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..session import materialize
from .native import SMALL_ROWS, broadcast_small, gram_hash, positions, refuse_clashes, words

# Words of a window, and of the shingles that windows are made of.
WINDOW, SHINGLE = 10, 5
# Letters of windows up to which they are broadcast; rows of the table of bits, of 64 bits each.
SMALL_LETTERS, FILTER_WORDS = 32 << 20, 1 << 18
# Slices of every key where a side is not broadcast, since one passage may stand in a third of the texts.
SLICES = 16


def windows_of(benchmark: DataFrame, item: str = "item_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """One row per different window: ``_wid``, ``_win`` (its words) and ``items``.

    A window is ``size`` consecutive words of an item, or all words of a
    shorter one.
    """
    items = benchmark.select(F.col(item).cast("string").alias("_item"), words(F.col(text)).alias("_w")).where(F.size("_w") > 0)
    last = F.greatest(F.size("_w") - size, F.lit(0))
    wins = items.select("_item", F.explode(F.transform(
        F.sequence(F.lit(0), last), lambda i: F.slice("_w", i + 1, size))).alias("_win"))
    wins = wins.groupBy("_win").agg(F.collect_set("_item").alias("items"))
    # the ids hold once the table is written
    return materialize(wins.select(F.monotonically_increasing_id().alias("_wid"), "_win", "items"), "windows")


def prefixes_of(wins: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """The necessary prefix of every window: its rarest shingle (by the benchmark's windows; ties by hash).

    Adds ``_len`` (words of the window), ``_n`` (words of the shingle, fewer in
    short windows), ``_off`` (its place) and ``_g`` (its hash).
    """
    offsets = F.sequence(F.lit(0), F.greatest(F.size("_win") - shingle, F.lit(0)))
    grams = wins.select("_wid", "_win", F.least(F.size("_win"), F.lit(shingle)).alias("_n"), F.explode(offsets).alias("_off"))
    # hashed word by word, as at every word position of the texts
    grams = grams.withColumn("_g", F.coalesce(*[
        F.when(F.col("_n") == n, gram_hash("_win", "_off", n)) for n in range(1, shingle + 1)]))
    counts = grams.groupBy("_n", "_g").agg(F.count(F.lit(1)).alias("_count"))
    rare = grams.join(counts, ["_n", "_g"]).groupBy("_wid", "_n").agg(
        F.min(F.struct("_count", "_g", "_off")).alias("_r"), F.first("_win").alias("_win"))
    return rare.select("_wid", "_win", F.size("_win").alias("_len"), "_n", F.col("_r._off").alias("_off"), F.col("_r._g").alias("_g"))


def _marked(positions_: DataFrame, side: DataFrame) -> DataFrame:
    """Positions whose hash may be one of ``side``, by a table of bits of bounded size."""
    word = lambda h: F.pmod(F.shiftrightunsigned(h, 6), F.lit(FILTER_WORDS))
    bit = lambda h: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(h, F.lit(64)).cast("int"))
    bits = side.groupBy(word(F.col("_g")).alias("_word_no")).agg(F.bit_or(bit(F.col("_g"))).alias("_bits"))
    held = (word(F.col("_h")) == F.col("_word_no")) & (F.col("_bits").bitwiseAND(bit(F.col("_h"))) != 0)
    return positions_.join(F.broadcast(bits), held, "left").withColumn("_h", F.when(F.col("_bits").isNotNull(), F.col("_h")))


def _sliced(large: DataFrame, small: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides of a join, so that a frequent key of ``large`` is met in ``SLICES`` tasks."""
    copies = small.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SLICES - 1).cast("long"))))
    return large.withColumn("_slice", F.pmod(F.xxhash64("_rid"), F.lit(SLICES))), copies


def scan(docs: DataFrame, benchmark: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text",
         item: str = "item_id", size: int = WINDOW, shingle: int = SHINGLE, small: int = SMALL_ROWS) -> DataFrame:
    """Words of every row that stand inside a window of the benchmark.

    1. Shingles are ordered by their rarity in the benchmark. A window must be
       contained whole, so its necessary prefix is its rarest shingle;
       neighbouring windows mostly share theirs.
    2. One pass over the texts joins the shingle at every word position to the
       prefixes. The prefix's place gives the only possible start; the window
       must lie inside the document, and is compared word by word at once.
    3. Only whole occurrences are counted by document.

    Up to ``small`` windows (of ``SMALL_LETTERS`` at most) are broadcast to the texts. With more, a broadcast
    table of bits (at most ``FILTER_WORDS`` rows) drops positions that hold no
    prefix, and the others meet the prefixes by hash, each with the words
    around it and never with its text.

    Returns ``keep`` plus ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``
    and ``contaminated``. NULL and empty texts have no words and no hits; so
    has everything with an empty benchmark. Items with NULL ids count for
    hits, not as items; repeated rows give repeated results, equal windows are
    one. Names that start with ``_`` or are a result's are refused in ``keep``.
    """
    refuse_clashes(keep, ("n_words", "n_hit", "n_items", "items_sha256", "contaminated"))
    wins = windows_of(benchmark, item, "text", size)
    prefixes = materialize(prefixes_of(wins, shingle), "prefixes")
    letters = F.length(F.concat_ws("", "_win"))
    sizes = prefixes.groupBy("_n").agg(F.count(F.lit(1)).alias("rows"), F.sum(letters).alias("letters")).collect()  # 1..shingle
    few = sum(r["rows"] for r in sizes) <= small and sum(r["letters"] for r in sizes) <= SMALL_LETTERS
    at, start = F.col("_pos"), F.col("_pos") - F.col("_off")
    first = at.isNull() | (at == 0)
    rows = positions(docs, keep, text)
    fits = (F.col("_h") == F.col("_g")) & (start >= 0) & (start + F.col("_len") <= F.col("n_words"))
    parts = []
    for n in sorted(r["_n"] for r in sizes) or [shingle]:
        side = prefixes.where(F.col("_n") == n).drop("_n")
        # the row at position 0 (or without any) stands for the document itself, once
        own = first if not parts else F.lit(False)
        hashed = rows.withColumn("_h", gram_hash("_w", "_pos", n))
        if few:
            found = hashed.join(F.broadcast(side), fits & (F.slice("_w", start + 1, F.col("_len")) == F.col("_win")), "left")
            found = found.where(F.col("_wid").isNotNull() | own)
        else:
            low = F.greatest(at - (size - n), F.lit(0))
            near = _marked(hashed, side).where(F.col("_h").isNotNull() | own).select(
                *keep, "_rid", "n_words", "_pos", "_h", low.alias("_low"),
                F.when(F.col("_h").isNotNull(), F.slice("_w", low + 1, 2 * size - n)).alias("_near"))
            near = materialize(near, "near")
            same = F.slice("_near", start - F.col("_low") + 1, F.col("_len")) == F.col("_win")
            dealt, copies = _sliced(near.where("_h is not null"), side)
            met = dealt.join(copies, fits & same & (F.col("_slice") == F.col("_copy"))).select(*keep, "_rid", "n_words", "_pos", "_off", "_len", "_wid")
            nothing = [F.lit(None).cast(t).alias(c) for c, t in (("_off", "int"), ("_len", "int"), ("_wid", "long"))]
            found = met.unionByName(near.where(own).select(*keep, "_rid", "n_words", "_pos", *nothing))
        parts.append(found.select(
            *keep, "_rid", F.greatest("n_words", F.lit(0).cast("long")).alias("n_words"), start.alias("_start"), "_len", "_wid",
            (own & (F.col("_wid").isNull() if not few else F.lit(True))).alias("_doc")))
    seen = parts[0]
    for part in parts[1:]:
        seen = seen.unionByName(part)
    seen = materialize(seen, "occurrences")

    whole = seen.where(F.col("_wid").isNotNull())
    hits = whole.select("_rid", F.lit(None).cast("string").alias("_item"),
                        F.explode(F.transform(F.sequence(F.lit(0), F.col("_len") - 1), lambda i: F.col("_start") + i)).alias("_p"))
    owners = wins.select("_wid", F.explode("items").alias("_item"))
    named = whole.select("_rid", "_wid").distinct()
    if wins.agg(F.coalesce(F.sum(F.size("items")), F.lit(0))).first()[0] <= SMALL_ROWS:
        named = named.join(F.broadcast(owners), "_wid")
    else:
        dealt, copies = _sliced(named, owners.withColumnRenamed("_wid", "_own"))
        named = dealt.join(copies, (F.col("_wid") == F.col("_own")) & (F.col("_slice") == F.col("_copy")))
    named = named.select("_rid", "_item", F.lit(None).cast("int").alias("_p"))
    per_doc = hits.unionByName(named).distinct().groupBy("_rid").agg(
        F.count("_p").alias("n_hit"), F.array_sort(F.collect_list("_item")).alias("_items"))
    # a document whose first word begins several windows has as many rows there
    own = seen.where("_doc").select(*keep, "_rid", "n_words").dropDuplicates(["_rid"])
    out = own.join(per_doc, "_rid", "left")
    names = F.coalesce("_items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select(
        *keep, "n_words", n_hit.alias("n_hit"), F.size(names).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", names), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id") -> DataFrame:
    """The same columns, without rows that hold any window of the benchmark (see :func:`scan`).

    Hits depend on the text alone, so rows are matched by the text's hash.
    """
    hashed = F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))
    found = scan(docs.select(hashed.alias("text_md5"), F.col(text).alias("text")), benchmark, ["text_md5"], "text", item)
    hit = materialize(found.where("contaminated").select(F.col("text_md5").alias("_hit")).distinct(), "contaminated")
    return docs.join(broadcast_small(hit, hit.count()), hashed == F.col("_hit"), "left_anti")
