"""Per-batch helpers run inside tasks: text splitting, counting, scoring.

The module is shipped by value, so executors need no installed package.
"""

from __future__ import annotations

import sys
from collections import deque
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import TaskContext, cloudpickle

CHUNK_SIZE = 500
CHUNK_OVERLAP = 50
# Vector width and split points.
BUCKETS = 256
SEPARATORS = ("\n\n", "\n", " ", "")
# Score matrix cells held at once by a task, several times over.
_CELLS = 1_000_000

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def split_text(text: str, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP,
               separators: Sequence[str] = SEPARATORS) -> list[str]:
    """Split at the coarsest separator present, then pack pieces into chunks.

    A piece keeps the separator it starts with. Pieces too long for a chunk
    are split again at the finer separators. Consecutive chunks share up to
    ``overlap`` characters of whole pieces.
    """
    level = next((i for i, s in enumerate(separators) if s == "" or s in text), len(separators) - 1)
    mark, finer = separators[level], separators[level + 1:]
    if mark:
        head, *tail = text.split(mark)
        pieces = [p for p in [head, *[mark + t for t in tail]] if p]
    else:
        pieces = list(text)
    chunks: list[str] = []
    run: list[str] = []
    for piece in pieces:
        if len(piece) < size:
            run.append(piece)
            continue
        chunks += _pack(run, size, overlap)
        run = []
        chunks += split_text(piece, size, overlap, finer) if finer else [piece]
    return chunks + _pack(run, size, overlap)


def _pack(pieces: list[str], size: int, overlap: int) -> list[str]:
    chunks, window, length = [], deque(), 0

    def close() -> None:
        joined = "".join(window).strip()
        if joined:
            chunks.append(joined)

    for piece in pieces:
        if window and length + len(piece) > size:
            close()
            while window and (length > overlap or length + len(piece) > size):
                length -= len(window.popleft())
        window.append(piece)
        length += len(piece)
    close()
    return chunks


def chunker(size: int, overlap: int):
    """Task function: split the documents of a partition in order and number the chunks."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, done = TaskContext.get().partitionId(), 0
        for batch in batches:
            pieces = [split_text(t, size, overlap) if t else [] for t in batch["content"]]
            out = batch.drop(columns="content").loc[np.repeat(batch.index.to_numpy(), [len(p) for p in pieces])].copy()
            out["_part"] = np.int32(part)
            out["_local"] = np.arange(done, done + len(out))
            out["content"] = [c for p in pieces for c in p]
            done += len(out)
            yield out

    return run


def tally(rows: pd.Series) -> pd.DataFrame:
    """Distinct buckets of each row with their counts, for a whole batch at once."""
    lengths = rows.map(len).to_numpy()
    flat = np.concatenate([*rows.to_numpy(), np.empty(0, dtype=np.int32)]).astype(np.int64)
    cells, counts = np.unique(np.repeat(np.arange(len(rows)), lengths) * BUCKETS + flat, return_counts=True)
    cuts = np.searchsorted(cells // BUCKETS, np.arange(1, len(rows)))
    return pd.DataFrame({
        "buckets": np.split((cells % BUCKETS).astype(np.int32), cuts) if len(rows) else [],
        "counts": np.split(counts.astype(np.int32), cuts) if len(rows) else [],
    })


def matrix(vectors: pd.Series) -> np.ndarray:
    """Rows as a dense matrix; sparse rows hold bucket counts."""
    if len(vectors) and isinstance(vectors.iloc[0], dict):
        buckets = [np.asarray(v["buckets"], dtype=np.int64) for v in vectors]
        counts = [np.asarray(v["counts"], dtype=np.float64) for v in vectors]
        out = np.zeros((len(vectors), BUCKETS))
        out[np.repeat(np.arange(len(vectors)), [len(b) for b in buckets]), np.concatenate(buckets)] = np.concatenate(counts)
        return out
    return np.stack([np.asarray(v, dtype=np.float64) for v in vectors]) if len(vectors) else np.zeros((0, 0))


def _best_per_query(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Top ``k`` per row by score, lower id first among equals. ``ids`` has the shape of ``scores``."""
    order = np.lexsort((ids, -scores), axis=-1)[:, :k]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


def scorer(item: str, k: int):
    """Task function: the best ``k`` items of a slice for every query of a block."""
    def run(key, items: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(items) and len(asked):
            vectors, ids = matrix(items["vector"]), items[item].to_numpy(dtype=np.int64)
            queries, query_ids = matrix(asked["vector"]), asked["query_id"].to_numpy(dtype=np.int64)
            squares, item_squares = (queries * queries).sum(axis=1), (vectors * vectors).sum(axis=1)
            step = max(1, _CELLS // len(ids))
            for start in range(0, len(query_ids), step):
                rows = slice(start, start + step)
                # Counts are whole numbers, so the products are exact in any order.
                lengths = np.sqrt(squares[rows, None] * item_squares[None, :])
                dots = queries[rows] @ vectors.T
                scores = np.divide(dots, lengths, out=np.zeros_like(dots), where=lengths > 0)
                best, best_ids = _best_per_query(scores, np.broadcast_to(ids, scores.shape), k)
                out.append(pd.DataFrame({"query_id": np.repeat(query_ids[rows], best.shape[1]), item: best_ids.ravel(), "score": best.ravel()}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], item: [], "score": []})

    return run
