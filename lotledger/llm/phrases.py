"""Collocations: phrases mined shard by shard, counted exactly, scored by their weakest cut."""

from __future__ import annotations

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.scale import sized_join
from ..session import materialize
from .batches import bound
from .phrase_tasks import Counter, HashFilter, bucketed, reaching

# A phrase counts from this support on; the corpus is mined in so many shards.
SUPPORT, SHARDS = 10, 4
# A phrase is part of a longer one that has this share (percent) of its occurrences.
ABSORBED = 50
# Phrases reported per language.
TOP = 2000
# Bits per hash of a filter, and the most bits of one (64 MB).
FILTER_BITS, MOST_BITS = 12, 1 << 29
# Parts in which a language's phrases are ranked before its best are compared.
RANK_SLICES = 64


def local_support(support: int, shards: int) -> int:
    """The support in one of ``shards`` that every phrase of global ``support`` reaches in one at least.

    Were it below this in all of them, its occurrences would sum to
    ``shards * (local - 1) < support``.
    """
    return 1 + (support - 1) // shards


def _texts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("_l"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_t"))


def _mine(texts: DataFrame, sizes: tuple[int, ...], shards: int, local: int, pairs=None) -> DataFrame:
    """(h) of the n-grams that reach ``local`` occurrences in one of the shards.

    A shard is every ``shards``-th partition of the scan; each is mined
    completely. ``pairs``: filter of pair hashes, for n-grams of three words.
    """
    def run(batches):
        import numpy as np
        import pyarrow as pa

        shard = TaskContext.get().partitionId() % shards
        counter = Counter(sizes, pairs.value if pairs else None)

        def rows(found):
            # the phrases of a stretch of texts, a row per bucket of hashes: single phrases would cost a row each
            made = [grams for _, size, grams in found if size]
            if not made:
                return
            for buckets, packed in bucketed(np.concatenate([g.hashes for g in made]), np.concatenate([g.counts for g in made]), local):
                yield pa.RecordBatch.from_arrays([
                    pa.array(buckets, pa.int32()), pa.array([shard] * len(packed), pa.int32()), pa.array(packed, pa.binary())], names=["bucket", "shard", "hashes"])

        for batch in batches:
            for language, said in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                yield from rows(counter.add(language, said))
        yield from rows(counter.flush())

    def reach(batches):
        import pyarrow as pa

        def batch_of(pieces):
            return pa.RecordBatch.from_arrays([pa.array(reaching(pieces.values(), local).view("int64"))], names=["h"])

        last, pieces = None, {}
        for batch in batches:
            for bucket, shard, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket != last and pieces:
                    yield batch_of(pieces)
                    pieces = {}
                last = bucket
                pieces.setdefault(shard, []).append(packed)
        if pieces:
            yield batch_of(pieces)

    counted = texts.mapInArrow(run, "bucket int, shard int, hashes binary")
    return counted.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(reach, "h long")


def _filter(hashes: DataFrame, bits: int = FILTER_BITS, most: int = MOST_BITS):
    """A broadcast filter that holds all ``hashes``; its blocks are made by tasks and have a bound."""
    spark = hashes.sparkSession
    count = max(1, min(hashes.count() * bits, most) // HashFilter.BLOCK_BITS)
    block = F.expr(f"CASE WHEN h >= 0 THEN h % {count} ELSE (((h % {count}) + {2 ** 64 % count}) % {count} + {count}) % {count} END")

    def run(pdf):
        import numpy as np
        import pandas as pd

        return pd.DataFrame([(int(pdf["block"].iloc[0]), HashFilter.part(pdf["h"].to_numpy(np.int64).view(np.uint64)))], columns=["block", "bits"])

    parts = hashes.select("h", block.alias("block")).groupBy("block").applyInPandas(run, "block long, bits binary").collect()
    return spark.sparkContext.broadcast(HashFilter({r["block"]: bytes(r["bits"]) for r in parts}, count))


def _count(texts: DataFrame, held) -> DataFrame:
    """(lang, size, phrase, n) of all phrases that pass the filter, and of all words (size 0), counted in full."""
    def run(batches):
        import pyarrow as pa

        counter = Counter((1, 2, 3), held=held.value)

        def rows(found):
            for language, size, grams in found:
                if not size:
                    yield pa.RecordBatch.from_arrays([pa.array([language]), pa.array([0], pa.int32()), pa.array([""]), pa.array([grams], pa.int64())],
                                                     names=["lang", "size", "phrase", "c"])
                    continue
                for said, counts in grams.slices():
                    yield pa.RecordBatch.from_arrays([
                        pa.array([language] * len(said), pa.string()), pa.array([size] * len(said), pa.int32()), said, counts],
                        names=["lang", "size", "phrase", "c"])

        for batch in batches:
            for language, said in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                yield from rows(counter.add(language, said))
        yield from rows(counter.flush())

    found = texts.mapInArrow(run, "lang string, size int, phrase string, c long")
    return found.groupBy("lang", "size", "phrase").agg(F.sum("c").alias("n"))


def phrase_counts(docs: DataFrame, text: str = "text", lang: str = "lang", support: int = SUPPORT, shards: int = SHARDS) -> DataFrame:
    """Exact counts of every word and phrase of two or three words with at least ``support`` occurrences.

    Three passes over the texts. The first two mine the shards at
    :func:`local_support` (pairs and words; then triples of which both pairs
    were found) and leave filters that hold every phrase some shard found. The
    last counts what passes the filter over all texts; a phrase that passes it
    by chance is counted as well and falls below ``support``. Returns ``lang``,
    ``size``, ``phrase`` and ``n``; size 0 holds the number of words.
    """
    bound(docs.sparkSession)
    texts, local = _texts(docs, text, lang), local_support(support, shards)
    short = materialize(_mine(texts, (1, 2), shards, local), "mined")
    pairs = _filter(short)
    triples = _mine(texts, (3,), shards, local, pairs)
    held = _filter(materialize(short.unionByName(triples), "mined"))
    return materialize(_count(texts, held).where((F.col("size") == 0) | (F.col("n") >= support)), "phrases")


def _part(phrase: Column, first: int, last: int | Column) -> Column:
    """Words ``first`` to ``last`` (from 0) of a phrase."""
    return F.array_join(F.slice(F.split(phrase, " "), first + 1, last - first + 1), " ")


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)) in whole numbers of up to 38 digits."""
    wide = lambda c: c.cast("decimal(16,0)")
    above = (wide(a) * wide(a) * F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(38,0)")
    below = (wide(left) * wide(right)).cast("decimal(38,0)")
    return F.call_function("div", above, below)


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", support: int = SUPPORT, absorbed: int = ABSORBED,
                 top: int = TOP, shards: int = SHARDS) -> DataFrame:
    """The best phrases of two or three words per language.

    Words are lower-cased (A-Z) runs without spaces and tabs inside pieces that
    end at punctuation or a line break. A phrase with ``a`` >= ``support``
    occurrences scores floor(1000000 * a * a / (l * r)) at its weakest cut into
    parts of ``l`` and ``r`` occurrences (ties: the earliest cut), and is dropped
    where a longer phrase around it has ``absorbed`` percent of its occurrences.
    Returns ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n`` (words of the
    language) and ``score``, best first; ties go to more occurrences, then to
    the lesser phrase in UTF-8 bytes.

    NULL texts are empty, a NULL language is ``und``, repeated rows count
    each, an empty table gives no rows. Other columns are not read, so their
    names cannot clash. A text is read whole, in blocks that end with a piece.
    """
    counts = phrase_counts(docs, text, lang, support, shards)
    phrases = counts.where("size >= 2").select("lang", "size", "phrase", F.col("n").alias("a"))
    pairs_in = F.explode(F.array(_part(F.col("phrase"), 0, 1), _part(F.col("phrase"), 1, 2)))
    longer = phrases.where("size = 3").select("lang", pairs_in.alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("_longer"))
    free = phrases.join(longer.withColumn("size", F.lit(2)), ["lang", "size", "phrase"], "left")
    free = free.where(F.coalesce(F.col("_longer") * 100 < F.col("a") * absorbed, F.lit(True)))

    # both parts of every cut meet their counts in one join; adaptive execution splits the parts that many phrases share
    cut = lambda k: [F.struct(F.lit(k).alias("k"), F.lit(side).alias("side"), part.alias("part")) for side, part in (
        ("l", _part(F.col("phrase"), 0, k - 1)), ("r", _part(F.col("phrase"), k, F.col("size") - 1)))]
    parts = F.explode(F.when(F.col("size") == 2, F.array(*cut(1))).otherwise(F.array(*cut(1), *cut(2))))
    parts = free.select("lang", "phrase", "a", parts.alias("_c")).select("lang", "phrase", "a", "_c.*")
    of = counts.where("size between 1 and 2").select("lang", F.col("phrase").alias("part"), "n")
    at = lambda k, side: F.max(F.when((F.col("k") == k) & (F.col("side") == side), F.col("n"))).alias(f"{side}{k}")
    sides = parts.join(of, ["lang", "part"]).groupBy("lang", "phrase", "a").agg(*[at(k, side) for k in (1, 2) for side in "lr"])
    scores = [F.struct(_score(F.col("a"), F.col(f"l{k}"), F.col(f"r{k}")).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))
              for k in (1, 2)]
    weakest = F.when(F.col("l2").isNull(), scores[0]).otherwise(F.least(*scores))
    scored = sides.select("lang", "phrase", "a", weakest.alias("_cut")).select("lang", "phrase", "a", "_cut.l", "_cut.r", "_cut.score")

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    scored = scored.withColumn("_slice", F.pmod(F.xxhash64("phrase"), F.lit(RANK_SLICES)))
    best = scored.withColumn("_rank", F.row_number().over(Window.partitionBy("lang", "_slice").orderBy(*order))).where(F.col("_rank") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    totals = counts.where("size = 0").select("lang", "n")
    return sized_join(ranked, totals, ["lang"]).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
