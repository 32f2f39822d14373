"""Byte-level BPE inside a task: pieces, merges by segment tree, and decoding."""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterable, Iterator
from operator import itemgetter

import numpy as np
import regex

# Words and pieces that a task remembers before it starts anew; affects speed only. A piece is
# needed again only by words not met before, so fewer of them are kept.
REMEMBERED, PIECES = 150_000, 20_000
# Characters of a text that are split at a time.
BLOCK = 1 << 18
# Bytes of a piece up to which pieces are merged together.
LOCKSTEP = 65
NONE = (1 << 31) - 1
_CUT = re.compile(r"\S(?= \S)")


def parse_ranks(raw: bytes) -> dict[bytes, int]:
    """Token bytes to ranks from lines of base64 and number."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, raw.splitlines()) if token}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece: the leftmost pair of least rank merges until none has a rank.

    Leaf ``i`` of the tree holds the rank of the pair that starts at byte
    ``i``, and inner nodes the least below them. A merge changes three leaves:
    the merged pair's, its right part's and its left neighbour's; so a piece of
    n bytes takes O(n log n).
    """
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    size = 1 << max(0, n - 2).bit_length()
    tree = [NONE] * (2 * size)
    rank = ranks.get
    for i in range(n - 1):
        tree[size + i] = rank(piece[i:i + 2], NONE)
    for i in range(size - 1, 0, -1):
        left, right = tree[2 * i], tree[2 * i + 1]
        tree[i] = left if left <= right else right
    end, before = list(range(1, n + 1)), list(range(-1, n))  # of the token at a start: its end; the token before it

    def put(at: int, value: int) -> None:
        i = size + at
        tree[i] = value
        i >>= 1
        while i:
            left, right = tree[2 * i], tree[2 * i + 1]
            least = left if left <= right else right
            if tree[i] == least:
                break
            tree[i] = least
            i >>= 1

    while (least := tree[1]) < NONE:
        i = 1
        while i < size:
            i = 2 * i if tree[2 * i] == least else 2 * i + 1
        at = i - size
        gone = end[at]
        stop = end[at] = end[gone]
        if gone < n - 1:
            put(gone, NONE)
        if stop < n:
            before[stop] = at
            put(at, rank(piece[at:end[stop]], NONE))
        else:
            put(at, NONE)
        if at:
            left = before[at]
            put(left, rank(piece[left:stop], NONE))
    ids, at = [], 0
    while at < n:
        ids.append(ranks[piece[at:end[at]]])
        at = end[at]
    return ids


def pair_table(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of ids whose bytes together are a token: sorted keys, and that token's rank."""
    keys, values = [], []
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                keys.append(left << 32 | right)
                values.append(rank)
    order = np.argsort(np.array(keys, np.int64), kind="stable")
    return np.array(keys, np.int64)[order], np.array(values, np.int32)[order]


class Merger:
    """:func:`merge` for many short pieces at once, one tree per piece, step by step together."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.keys, self.values = pair_table(ranks)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.values[at], np.int32(NONE))

    def merge_all(self, pieces: list[bytes]) -> list[bytes]:
        """Little-endian ids of each piece."""
        found: list = [None] * len(pieces)
        groups: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                found[i] = whole.to_bytes(4, "little")
            elif len(piece) > LOCKSTEP:
                ids = merge(piece, self.ranks)
                found[i] = struct.pack(f"<{len(ids)}I", *ids)
            else:
                groups.setdefault(1 << max(0, len(piece) - 2).bit_length(), []).append(i)
        for size, members in groups.items():
            for i, ids in zip(members, self._together([pieces[i] for i in members], size), strict=True):
                found[i] = ids
        return found

    def _together(self, pieces: list[bytes], size: int) -> list[bytes]:
        count, width = len(pieces), size + 1
        lengths = np.array([len(p) for p in pieces], np.int64)
        padded = np.frombuffer(b"".join([p.ljust(width, b"\0") for p in pieces]), np.uint8).reshape(count, width)
        ids = np.ascontiguousarray(self.byte_ids[padded].T)  # of the token that starts at a byte
        starts = np.arange(width + 1, dtype=np.int32)[:, None]
        after = np.repeat(starts + 1, count, 1)  # start of the next token
        before = np.repeat(starts - 1, count, 1)
        tree = np.full((2 * size, count), NONE, np.int32)
        tree[size:] = np.where(starts[:size] + 1 < lengths, self.pair_ranks(ids[:-1], ids[1:]), NONE)
        for i in range(size - 1, 0, -1):
            np.minimum(tree[2 * i], tree[2 * i + 1], out=tree[i])
        levels = size.bit_length() - 1
        own = np.flatnonzero(tree[1] < NONE)
        while len(own):
            least = tree[1, own]
            node = np.ones(len(own), np.int64)
            for _ in range(levels):
                node *= 2
                node += tree[node, own] != least
            at = node - size
            gone = after[at, own]
            stop = after[gone, own]
            ids[at, own] = least
            after[at, own] = stop
            before[stop, own] = at
            left = before[at, own]
            tree[np.minimum(gone, size - 1) + size, own] = np.where(gone < size, NONE, tree[2 * size - 1, own])
            inside = stop < lengths[own]
            tree[node, own] = np.where(inside, self.pair_ranks(least, ids[np.minimum(stop, size), own]), NONE)
            low = np.maximum(left, 0)
            tree[low + size, own] = np.where(left >= 0, self.pair_ranks(ids[low, own], least), tree[low + size, own])
            for leaf in (np.minimum(gone, size - 1), at, low):
                node = leaf + size
                for _ in range(levels):
                    node >>= 1
                    tree[node, own] = np.minimum(tree[2 * node, own], tree[2 * node + 1, own])
            own = own[tree[1, own] < NONE]
        starts_token = np.zeros((count, width), bool)
        at, own = np.zeros(count, np.int64), np.arange(count)
        while len(own):
            starts_token[own, at] = True
            at = after[at, own]
            kept = at < lengths[own]
            at, own = at[kept], own[kept]
        flat = ids.T[starts_token].astype("<u4").tobytes()
        ends = np.cumsum(starts_token.sum(1)) * 4
        return [flat[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]


class Coder:
    """Encodes and decodes with one rank file and one pattern."""

    def __init__(self, raw: bytes, pattern: str):
        ranks = parse_ranks(raw)
        self.vocabulary = {rank: token for token, rank in ranks.items()}
        self.merger = Merger(ranks)
        self.findall = regex.compile(pattern).findall
        # piece of the pattern -> its ids; what follows a space up to the next -> ids with that space
        self.pieces: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}

    def forget(self) -> None:
        """Drop what was learned: a worker lives on after its task, its memory should not."""
        self.chunks, self.pieces = {}, {}

    def _learn(self, pieces: set[str]) -> None:
        new = list(pieces.difference(self.pieces))
        self.pieces.update(zip(new, self.merger.merge_all([p.encode() for p in new]), strict=True))

    def encode_blocks(self, blocks: list[str]) -> list[bytes]:
        """Little-endian ids of every block.

        A single space between two other characters always starts a piece. A
        block in which every space is of that kind is taken from space to
        space; others go through the pattern whole.
        """
        if len(self.chunks) > REMEMBERED:
            self.forget()
        elif len(self.pieces) > PIECES:
            self.pieces = {}
        split, new = [], set()
        for block in blocks:
            parts = block.split(" ")
            head = parts.pop(0)
            new.update(parts)
            split.append((head, parts))
        new.difference_update(self.chunks)
        chunks, findall, known = self.chunks, self.findall, self.pieces
        found, wanted = {}, set()
        for part in new:
            if not part or part[0].isspace() or part[-1].isspace():
                chunks[part] = None  # a space beside it is not of that kind
            else:
                found[part] = pieces = findall(" " + part)
                wanted.update(pieces)
        heads = [findall(head) for head, _ in split]
        wanted.update(*heads)
        self._learn(wanted)
        for part, pieces in found.items():
            chunks[part] = known[pieces[0]] if len(pieces) == 1 else b"".join([known[p] for p in pieces])
        out = []
        for block, (head, parts), pieces in zip(blocks, split, heads, strict=True):
            own = [known[p] for p in pieces]
            rest = itemgetter(*parts)(chunks) if len(parts) > 1 else tuple(chunks[p] for p in parts)
            if parts and (head[-1:].isspace() or None in rest):
                pieces = findall(block)
                self._learn(set(pieces))
                out.append(b"".join([known[p] for p in pieces]))
            else:
                out.append(b"".join([*own, *rest]))
        return out

    def decode(self, ids: bytes) -> bytes:
        if len(ids) < 8:
            return self.vocabulary[int.from_bytes(ids, "little")] if ids else b""
        return b"".join(itemgetter(*np.frombuffer(ids, "<u4").tolist())(self.vocabulary))

    def each(self, texts: Iterable[str]) -> Iterator[Iterator[bytes]]:
        """For every text the ids of its consecutive blocks; short texts are encoded together."""
        group: list[str] = []
        size = 0
        for text in texts:
            if len(text) > BLOCK:
                yield from ((ids,) for ids in self.encode_blocks(group))
                group, size = [], 0
                yield (self.encode_blocks([block])[0] for block in blocks_of(text))
                continue
            group.append(text)
            size += len(text)
            if size > BLOCK:
                yield from ((ids,) for ids in self.encode_blocks(group))
                group, size = [], 0
        yield from ((ids,) for ids in self.encode_blocks(group))

    def digests(self, texts: Iterable[str]) -> Iterator[tuple[int, str, str]]:
        """(number of ids, hash of the ids, hash of the bytes that they decode to) of every text."""
        for blocks in self.each(texts):
            count, ids_hash, text_hash = 0, hashlib.sha256(), hashlib.sha256()
            for ids in blocks:
                count += len(ids) // 4
                ids_hash.update(ids)
                text_hash.update(self.decode(ids))
            yield count, ids_hash.hexdigest(), text_hash.hexdigest()


def blocks_of(text: str) -> Iterator[str]:
    """Blocks of about BLOCK characters that end before a single space between two other characters."""
    at = 0
    while at < len(text):
        cut = _CUT.search(text, at + BLOCK)
        stop = cut.end() if cut else len(text)
        yield text[at:stop]
        at = stop


_CODERS: dict = {}


def coder(broadcast, pattern: str) -> Coder:
    """This worker's coder for a broadcast rank file."""
    key = (broadcast.id if hasattr(broadcast, "id") else id(broadcast), pattern)
    if key not in _CODERS:
        raw = broadcast.value
        key = (hashlib.sha256(raw).digest(), pattern)
        if key not in _CODERS:
            _CODERS.clear()
            _CODERS[key] = Coder(raw, pattern)
    return _CODERS[key]
