"""Quality score by nearest-neighbour voting in a latent-semantic space."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from operator import eq

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .batches import bound

# Labelled rows of each class that the space and the votes are fitted on.
SAMPLE_PER_CLASS = 1500
# Buckets of hashed byte trigrams, kept dimensions, and voters per document.
BUCKETS, DIMENSIONS, NEIGHBOURS = 2048, 48, 15
# Weight of a neighbour: its similarity to this power.
SHARPNESS = 8
# Bytes of a text that are counted at a time, and rows of a block of products.
BLOCK, ROWS = 1 << 20, 512


def term_counts(text: str | None) -> np.ndarray:
    """Terms of a whole text (None: empty), counted block by block.

    Hashed byte trigrams, then the words, then the words that repeat the one before.
    """
    text = text or ""
    counts = np.zeros(BUCKETS + 2, np.int64)
    raw = np.frombuffer(text.encode(), np.uint8)
    for at in range(0, max(0, len(raw) - 2), BLOCK):
        part = raw[at:at + BLOCK + 2].astype(np.uint32)
        mixed = part[:-2] * np.uint32(0x9E3779B1) + part[1:-1] * np.uint32(0x85EBCA77) + part[2:] * np.uint32(0xC2B2AE3D)
        mixed ^= mixed >> np.uint32(15)
        mixed *= np.uint32(0x2C1B3C6D)
        counts[:BUCKETS] += np.bincount(mixed >> np.uint32(21), minlength=BUCKETS)
    for at in range(0, len(text), BLOCK):
        words = text[at:at + BLOCK].split()
        counts[BUCKETS] += len(words)
        counts[BUCKETS + 1] += sum(map(eq, words, words[1:]))
    return counts


def term_weights(counts: np.ndarray) -> np.ndarray:
    """Square roots of the trigrams' shares, and of the share of repeated words."""
    total = np.maximum(counts[:, :BUCKETS].sum(1, keepdims=True), 1)
    repeated = counts[:, BUCKETS + 1] / np.maximum(counts[:, BUCKETS], 1)
    return np.sqrt(np.column_stack([counts[:, :BUCKETS] / total, repeated])).astype(np.float32)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-12)


@dataclass
class Voters:
    """What is broadcast: the projection, and the labelled vectors with their labels."""

    center: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def score(self, texts: list) -> np.ndarray:
        """Weighted share of label 1 among the nearest labelled vectors, by exact cosine products in blocks."""
        out = np.empty(len(texts))
        for at in range(0, len(texts), ROWS):
            counts = np.stack([term_counts(t) for t in texts[at:at + ROWS]])
            latent = unit((term_weights(counts) - self.center) @ self.projection)
            cosines = latent @ self.vectors.T
            k = min(NEIGHBOURS, cosines.shape[1])
            near = np.argpartition(-cosines, k - 1, axis=1)[:, :k] if k < cosines.shape[1] else np.tile(np.arange(k), (len(cosines), 1))
            weights = np.maximum(np.take_along_axis(cosines, near, 1), 1e-3).astype(np.float64) ** SHARPNESS
            out[at:at + ROWS] = (weights * self.labels[near]).sum(1) / weights.sum(1)
        return np.clip(out, 0.0, 1.0)


def fit_voters(counts: np.ndarray, labels: np.ndarray) -> Voters:
    """Latent space of the sample by truncated singular value decomposition."""
    terms = term_weights(counts)
    center = terms.mean(0)
    gram = (terms - center).T @ (terms - center)
    values, vectors = np.linalg.eigh(gram.astype(np.float64))
    kept = vectors[:, ::-1][:, :DIMENSIONS]
    projection = kept.astype(np.float32)
    return Voters(center, projection, unit((terms - center) @ projection).astype(np.float32), labels.astype(np.float64))


def fit(docs: DataFrame, labels: DataFrame, learn: Column, doc_id: str = "doc_id", text: str = "text",
        label: str = "quality", per_class: int = SAMPLE_PER_CLASS) -> Voters | None:
    """Voters from a bounded sample of labelled documents for which ``learn`` holds.

    The sample is the ``per_class`` least id hashes of each class; NULL labels
    teach nothing, and an id with both labels votes with their mean. None
    without any labelled document.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull() & learn).groupBy(doc_id).agg(
        F.avg(label).alias("_label"))
    there = docs.where(learn).select(doc_id).where(F.col(doc_id).isNotNull()).distinct().join(known, doc_id)
    order = [F.xxhash64(F.col(doc_id).cast("string")), F.col(doc_id)]
    chosen = there.where("_label >= 0.5").orderBy(*order).limit(per_class).unionByName(
        there.where("_label < 0.5").orderBy(*order).limit(per_class))
    # at most twice per_class ids
    sample = docs.select(doc_id, F.col(text).alias("_text")).join(F.broadcast(chosen), doc_id).select(F.col(doc_id).cast("string").alias("_id"), "_label", "_text")

    def count(batches):
        import pyarrow as pa

        for batch in batches:
            rows = [term_counts(t).astype(np.uint32).tobytes() for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, pa.binary())], names=["_id", "_label", "_counts"])

    rows = sample.mapInArrow(count, "_id string, _label double, _counts binary").dropDuplicates(["_id"]).orderBy("_id").collect()
    if not rows:
        return None
    return fit_voters(np.stack([np.frombuffer(r["_counts"], np.uint32) for r in rows]), np.array([r["_label"] for r in rows]))


def score(docs: DataFrame, voters: Voters | None, keep: Sequence[str] = ("doc_id",), text: str = "text",
          threshold: float = 0.3) -> DataFrame:
    """``score`` (0 to 1, higher: label 1 likelier) and ``predicted`` for every whole text.

    NULL and empty texts are scored like any text without terms. Without
    voters every score is 0.5. Repeated rows give repeated results.
    """
    if clash := {"score", "predicted"} & set(keep):
        raise ValueError(f"kept columns clash with results: {sorted(clash)}")
    if voters is None:
        scored = docs.select(*keep, F.lit(0.5).alias("score"))
    else:
        bound(docs.sparkSession)
        shared = docs.sparkSession.sparkContext.broadcast(voters)
        count = len(keep)
        schema = T.StructType([*[docs.schema[c] for c in keep], T.StructField("score", T.DoubleType())])

        def run(batches):
            import pyarrow as pa

            for batch in batches:
                found = shared.value.score(batch.column(count).to_pylist())
                yield pa.RecordBatch.from_arrays([*batch.columns[:count], pa.array(found)], names=[*batch.schema.names[:count], "score"])

        scored = docs.select(*keep, F.col(text).alias("_in")).mapInArrow(run, schema)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
