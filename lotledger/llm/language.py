"""Language identification with a bidirectional gated recurrent network over bytes."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..session import local_table
from .batches import bound

# The network is fitted on at most this many labelled rows per language, and on one
# window of bytes of each.
ROWS_PER_LANGUAGE = 400
UNDETERMINED = "und"


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def training_rows(labelled: DataFrame, text: str, label: str, per_label: int, key: Column) -> list:
    """(text piece, label) of a sample: the ``per_label`` least hashes of every label that is not NULL.

    ``key`` is a 64-bit hash. Rows per label are bounded, labels are not. Cuts
    leave about four times ``per_label`` rows of a label to its top-k, so no
    label's rows are gathered in one task.
    """
    from .language_tasks import WINDOW

    # one piece from the middle of each sampled text
    piece = F.substring(F.col(text), F.greatest(F.floor(F.length(text) / 2) - WINDOW, F.lit(1)).cast("int"), F.lit(2 * WINDOW))
    rows = labelled.where(F.col(label).isNotNull() & has_letter(F.col(text)))
    rows = rows.select(F.col(label).alias("_l"), key.alias("_k"), piece.alias("_t"))
    counts = rows.groupBy("_l").agg(F.approx_count_distinct("_k").alias("distinct")).collect()
    cuts = {name: _cut(distinct, per_label) for name, distinct in counts}
    found = _least(rows, cuts, per_label)
    came = Counter(name for _, name in found)
    short = {name for name, cut in cuts.items() if cut is not None and came[name] < per_label}
    if short:
        found = [r for r in found if r[1] not in short] + _least(rows, dict.fromkeys(short), per_label)
    return found


def _cut(distinct: int, per_label: int) -> int | None:
    """A hash that about four times ``per_label`` of ``distinct`` keys do not exceed, so that tasks send little.

    None: all pass. Copies share a key and pass together, so keys count, not
    rows. Where fewer than ``per_label`` come back, the cut must go.
    """
    if distinct <= 4 * per_label:
        return None
    return max((4 * per_label << 64) // distinct - (1 << 63), -(1 << 63) + 1)


def _least(rows: DataFrame, cuts: dict, per_label: int) -> list:
    """(piece, label) of the least hashes of the labels in ``cuts``, none above its label's cut (None: all)."""
    schema = T.StructType([T.StructField("_l", rows.schema["_l"].dataType), T.StructField("_cut", T.LongType())])
    side = local_table(rows.sparkSession, list(cuts.items()), schema)
    passed = rows.join(F.broadcast(side), "_l").where(F.col("_cut").isNull() | (F.col("_k") <= F.col("_cut")))
    place = F.row_number().over(Window.partitionBy("_l").orderBy("_k", "_t"))
    top = passed.select("_l", "_k", "_t").distinct().withColumn("_place", place).where(F.col("_place") <= per_label)
    return [(r["_t"], r["_l"]) for r in top.collect()]


def fit(labelled: DataFrame, text: str = "text", label: str = "lang", key: Column | None = None,
        per_label: int = ROWS_PER_LANGUAGE):
    """A trained network (``language_tasks.Network``), or None without labelled rows.

    Rows with NULL label or text, or without a letter, teach nothing. Every
    other label is learned, however many there are; the driver holds
    ``per_label`` pieces of each.
    """
    from .language_tasks import train

    pairs = training_rows(labelled, text, label, per_label, F.xxhash64(text) if key is None else key)
    return train(pairs) if pairs else None


def identify(docs: DataFrame, network, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """Predicted language and its probability for every whole text.

    Texts are cut into windows of bytes; the network labels every position of
    every window, and the probabilities at positions of letters are pooled to
    the document's. NULL texts, texts without a letter, and everything where
    no network could be trained, are ``und`` with score 0. Ties go to the
    first language by name. Repeated rows give repeated results.
    """
    if clash := {"lang_pred", "score"} & set(keep):
        raise ValueError(f"kept columns clash with results: {sorted(clash)}")
    letters = F.when(has_letter(F.col(text)), F.col(text))
    if network is None:
        return docs.select(*keep, F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    bound(docs.sparkSession)
    schema = T.StructType([*[docs.schema[c] for c in keep], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    count = len(keep)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            names, scores = network.predict(batch.column(count).to_pylist(), UNDETERMINED)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:count], pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=[*batch.schema.names[:count], "lang_pred", "score"])

    return docs.select(*keep, letters.alias("_in")).mapInArrow(run, schema)


def keep_identified(docs: DataFrame, network, least: float, text: str = "text") -> DataFrame:
    """The same columns, without rows whose language cannot be told.

    Those are texts that :func:`identify` calls ``und`` and those whose best
    language has a pooled probability below ``least``. Without a network only
    texts without a letter (and NULL) go.
    """
    lettered = docs.where(has_letter(F.col(text)))
    if network is None:
        return lettered
    bound(docs.sparkSession)
    at = docs.columns.index(text)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            _, scores = network.predict(batch.column(at).to_pylist(), UNDETERMINED)
            yield batch.filter(pa.array([s >= least for s in scores], pa.bool_()))

    return lettered.mapInArrow(run, docs.schema)
