"""License scan by diagonal voting, in built-in functions only."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .native import broadcast_small, positions, refuse_clashes

# Phrases whose exact places are reported, with their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Further templates: names, tags and opening lines of common licenses.
TEMPLATES = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "boost software license": "bsl",
    "bsd license": "bsd",
    "isc license": "isc",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by sa": "cc-by-sa",
    "creative commons attribution": "cc-by",
    "released into the public domain": "public-domain",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "this program is free software you can redistribute it and or modify it under the terms of the": "gpl",
    "licensed under the apache license version 2 0": "apache",
}
K = 2
# Matched diagonals this close belong to one occurrence with inserted or lost words.
DIAGONAL_GAP = 2
# Share of a template's words that an occurrence must cover.
COVERAGE = 0.8


def template_grams(spark: SparkSession, phrases: Mapping[str, str], templates: Mapping[str, str]) -> DataFrame:
    """One row per template position and K-gram: the join's small side."""
    rows = []
    for t, (text, label) in enumerate([*phrases.items(), *templates.items()]):
        found = text.split()
        if len(found) < K:
            raise ValueError(f"template {text!r} has fewer than {K} words")
        rows += [(t, label, t < len(phrases), len(found), i, found[i], found[i + 1]) for i in range(len(found) - K + 1)]
    grams = spark.createDataFrame(rows, "_t int, _label string, _base boolean, _len int, _tpos int, _a string, _b string")
    return broadcast_small(grams.withColumn("_gram", F.xxhash64("_a", "_b")), len(rows))


def scan_licenses(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text",
                  phrases: Mapping[str, str] = PHRASES, templates: Mapping[str, str] = TEMPLATES) -> DataFrame:
    """License evidence of every row: base places, labels and a score.

    Every word position's two-word hash is joined to the template positions;
    equal hashes are compared word by word at once. Votes are counted by
    (document, template, diagonal = word position - template position). A
    diagonal with all of a phrase's grams is an exact place of it; neighbouring
    diagonals are merged, and an occurrence that covers ``COVERAGE`` of a
    template gives its label.

    Returns ``keep`` plus ``n_words``, ``n_base``, ``first_word``,
    ``last_word`` (NULL without base places), ``base_labels``, ``labels`` and
    ``score`` (1 with a base place, else the best coverage of a template).
    NULL and empty texts have no words, empty labels and score 0. Repeated
    rows give repeated results; ``keep`` may hold NULLs. Names that start
    with ``_`` or are a result's are refused in ``keep``.
    """
    refuse_clashes(keep, ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"))
    grams = template_grams(docs.sparkSession, phrases, templates)
    at = F.col("_pos")
    rows = positions(docs, keep, text)
    rows = rows.withColumn("_x", F.get("_w", at + 1)).withColumn("_h", F.xxhash64("_word", "_x")).drop("_w")
    same = (F.col("_h") == F.col("_gram")) & (F.col("_word") == F.col("_a")) & (F.col("_x") == F.col("_b"))
    hits = rows.join(grams, same, "left")
    # the row at position 0 (or without any) stands for the document itself
    hits = hits.where(F.col("_t").isNotNull() | at.isNull() | (at == 0)).select(
        *keep, "_rid", "n_words", "_t", "_label", "_base", "_len", "_tpos", (at - F.col("_tpos")).alias("_diag"))
    by_diagonal = hits.repartition("_rid").groupBy(*keep, "_rid", "n_words", "_t", "_label", "_base", "_len", "_diag").agg(
        F.collect_set("_tpos").alias("_tposes"))
    order = Window.partitionBy("_rid", "_t").orderBy("_diag")
    apart = (F.col("_diag") - F.lag("_diag").over(order)) > DIAGONAL_GAP
    merged = by_diagonal.withColumn("_new", F.when(apart, 1).otherwise(0)).withColumn(
        "_run", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    exact = F.col("_base") & (F.size("_tposes") == F.col("_len") - (K - 1))
    place = F.when(exact, F.col("_diag"))
    runs = merged.groupBy(*keep, "_rid", "n_words", "_t", "_label", "_base", "_len", "_run").agg(
        F.count(place).alias("_places"), F.min(place).alias("_first"), F.max(place).alias("_last"),
        F.size(F.array_distinct(F.flatten(F.collect_list(
            F.flatten(F.transform("_tposes", lambda p: F.sequence(p, p + (K - 1)))))))).alias("_covered"))
    coverage = F.when(~F.col("_base"), F.col("_covered") / F.col("_len"))
    labels = F.when(F.col("_base"), F.when(F.col("_places") > 0, F.col("_label"))).when(coverage >= COVERAGE, F.col("_label"))
    joined = lambda label: F.concat_ws(",", F.array_sort(F.collect_set(label)))
    return runs.groupBy(*keep, "_rid", "n_words").agg(
        F.sum("_places").alias("n_base"),
        F.min("_first").cast("long").alias("first_word"), F.max("_last").cast("long").alias("last_word"),
        joined(F.when(F.col("_places") > 0, F.col("_label"))).alias("base_labels"), joined(labels).alias("labels"),
        F.when(F.sum("_places") > 0, 1.0).otherwise(F.coalesce(F.max(coverage), F.lit(0.0))).alias("score"),
    ).withColumn("n_words", F.greatest("n_words", F.lit(0).cast("long"))).drop("_rid")
