"""Byte-level BPE over columns of text and ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, types as T

from .batches import bound

# Bytes of a rank file that may be broadcast.
MAX_RANK_BYTES = 64 << 20
RANKS = "byte_bpe_50k.tiktoken"


def load_ranks(spark: SparkSession, path: str | None = None, pattern: str | None = None):
    """Broadcast rank file and the pattern that goes with it.

    The file is a vocabulary of fixed size, whatever the corpus; a larger one
    than ``MAX_RANK_BYTES`` is refused.
    """
    if path is None or pattern is None:
        import public_tokenizers

        path, pattern = path or public_tokenizers.path(RANKS), pattern or public_tokenizers.PATTERN
    with open(path, "rb") as file:
        raw = file.read(MAX_RANK_BYTES + 1)
    if len(raw) > MAX_RANK_BYTES:
        raise ValueError(f"{path} is larger than {MAX_RANK_BYTES} bytes")
    return spark.sparkContext.broadcast(raw), pattern


def _mapped(df: DataFrame, keep: Sequence[str], column: str, added: Sequence[tuple[str, T.DataType]], rows, ranks) -> DataFrame:
    """``keep`` plus columns that ``rows(coder, values)`` gives for ``column``, batch by batch."""
    if clash := {name for name, _ in added} & set(keep):
        raise ValueError(f"kept columns clash with results: {sorted(clash)}")
    bound(df.sparkSession)
    shared, pattern = ranks
    schema = T.StructType([*[df.schema[c] for c in keep], *[T.StructField(n, t) for n, t in added]])
    names = [n for n, _ in added]
    count = len(keep)

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type

        from .bpe_tasks import coder

        tool = coder(shared, pattern)
        types = [to_arrow_type(t) for _, t in added]
        for batch in batches:
            made = list(rows(tool, batch.column(count).to_pylist()))
            columns = [pa.array([m[i] for m in made], type=t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:count], *columns], names=[*batch.schema.names[:count], *names])
        tool.forget()

    return df.select(*keep, df[column].alias("_in")).mapInArrow(run, schema)


def _digests(tool, texts):
    return tool.digests(t or "" for t in texts)


def _ids(tool, texts):
    return ((b"".join(blocks),) for blocks in tool.each(t or "" for t in texts))


def _bytes(tool, values):
    return ((tool.decode(ids or b""),) for ids in values)


def digest(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text", ranks=None) -> DataFrame:
    """Token count and hashes of the ids and of what they decode to, per row.

    NULL and empty texts have no ids (and the hash of nothing). Long texts are
    taken in blocks. Repeated rows give repeated results, an empty table none.
    """
    added = [("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())]
    return _mapped(docs, keep, text, added, _digests, ranks or load_ranks(docs.sparkSession))


def encode(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text", ranks=None) -> DataFrame:
    """``ids`` of every row: little-endian unsigned 32-bit numbers (empty for NULL)."""
    return _mapped(docs, keep, text, [("ids", T.BinaryType())], _ids,
                   ranks or load_ranks(docs.sparkSession))


def decode(encoded: DataFrame, keep: Sequence[str] = ("doc_id",), ids: str = "ids", ranks=None) -> DataFrame:
    """``bytes`` that the ids of every row stand for (empty for NULL)."""
    return _mapped(encoded, keep, ids, [("bytes", T.BinaryType())], _bytes,
                   ranks or load_ranks(encoded.sparkSession))
