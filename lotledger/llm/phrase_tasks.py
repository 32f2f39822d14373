"""Counting word n-grams of many texts inside a task, exactly and in bounded memory."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np

# What ends a piece; within a piece, spaces and tabs part words.
_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
# No byte of UTF-8, so it can stand for the end of a piece among words.
_BREAK = b"\xff"
_TO_BREAK = bytes.maketrans(_ENDS, _BREAK * len(_ENDS))
_END = re.compile(rb"[.,;:!?\x0a-\x0d]")
# Bytes of a text handled at once (a piece is never cut), words counted together, words with a number.
BLOCK, TOKENS, VOCABULARY = 4 << 20, 4_000_000, 1 << 20
# Places hashed at once; phrases spelled out at once.
CHUNK, SLICE = 1 << 18, 1 << 16
# Bits of a hash that name its bucket, and buckets sent at once.
BUCKET_BITS, BUCKETS_SENT = 12, 256
_BITS = np.uint64(21)  # three word numbers share one 64-bit code
_LOW = np.uint64((1 << 21) - 1)


def blocks(text: bytes) -> Iterator[bytes]:
    """``text`` in blocks that end where a piece ends."""
    at = 0
    while len(text) - at > BLOCK:
        end = _END.search(text, at + BLOCK)
        if end is None:
            break
        yield text[at:end.end()]
        at = end.end()
    yield text[at:]


def mixed(x: np.ndarray) -> np.ndarray:
    """Bits of 64-bit numbers spread over all places."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def hash_of(word: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")


class Vocabulary(dict):
    """Numbers of words in order of appearance; 0 is the end of a piece."""

    def __init__(self):
        super().__init__({_BREAK: 0})
        self.words = [_BREAK]

    def __missing__(self, word):
        number = self[word] = len(self.words)
        self.words.append(word)
        return number


class Grams:
    """Distinct phrases of one language in one stretch of texts, with their counts."""

    def __init__(self, size: int, codes: np.ndarray, counts: np.ndarray, hashes: np.ndarray, words: list):
        self.size, self.counts, self.hashes, self._codes, self._words = size, counts, hashes, codes, words

    def slices(self, rows: int = SLICE) -> Iterator[tuple]:
        """(phrases, counts) as Arrow arrays, so many at a time."""
        import pyarrow as pa
        import pyarrow.compute as pc

        words = pa.array(self._words, pa.large_binary())
        for at in range(0, len(self.counts), rows):
            ids = _split(self._codes[at:at + rows], self.size)
            said = pc.binary_join_element_wise(*[words.take(pa.array(ids[:, k])) for k in range(self.size)], pa.scalar(b" ", pa.large_binary()))
            yield said.cast(pa.large_string()).cast(pa.string()), pa.array(self.counts[at:at + rows], pa.int64())

    def phrases(self) -> list[str]:
        return [phrase for said, _ in self.slices() for phrase in said.to_pylist()]


def _split(codes: np.ndarray, size: int) -> np.ndarray:
    return np.stack([(codes >> (_BITS * np.uint64(size - 1 - k))) & _LOW for k in range(size)], 1).astype(np.int64)


def gram_hashes(word_hashes: list[np.ndarray], language: int) -> np.ndarray:
    """64-bit hash of n-grams, given the hashes of their first, second and third words; languages and lengths differ."""
    h = mixed(np.array([language], np.uint64) + np.uint64(len(word_hashes)))
    for part in word_hashes:
        h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + part)
    return h


class Counter:
    """Counts the n-grams of (language, text) pairs, a bounded stretch of words at a time."""

    def __init__(self, sizes: Iterable[int], joined: HashFilter | None = None, held: HashFilter | None = None):
        """``joined``: n-grams of three words count only where both pairs in them pass; ``held``: only what passes counts."""
        self.sizes, self.joined, self.held = tuple(sizes), joined, held
        self._start()

    def _start(self):
        self.vocabulary, self.ids, self.waiting = Vocabulary(), {}, 0

    def add(self, language: str, text: bytes) -> Iterator[tuple[str, int, Grams | int]]:
        for block in blocks(text):
            words = block.lower().translate(_TO_BREAK).replace(_BREAK, b" \xff ").split()
            words.append(_BREAK)
            self.ids.setdefault(language, []).append(np.fromiter(map(self.vocabulary.__getitem__, words), np.uint64, len(words)))
            self.waiting += len(words)
            if self.waiting >= TOKENS or len(self.vocabulary) >= VOCABULARY:
                yield from self.flush()

    def flush(self) -> Iterator[tuple[str, int, Grams | int]]:
        """(language, size, phrases); size 0 stands for the number of words."""
        words = self.vocabulary.words
        if len(words) >= 1 << 21:
            raise ValueError("one piece of text holds more distinct words than a code has room for")
        hashed = np.array([hash_of(w) for w in words], np.uint64)
        for language, parts in self.ids.items():
            ids = np.concatenate(parts)
            yield language, 0, int((ids > 0).sum())
            seed = hash_of(language.encode())
            for size in self.sizes:
                yield language, size, self._grams(ids, size, seed, hashed, words)
        self._start()

    def _grams(self, ids, size, seed, hashed, words):
        length = max(len(ids) - size + 1, 0)
        codes, whole = np.zeros(length, np.uint64), np.ones(length, bool)
        for k in range(size):
            part = ids[k:k + length]
            codes = (codes << _BITS) | part
            whole &= part > 0
        if self.joined is not None and size == 3:
            pair = np.zeros(max(len(ids) - 1, 0), bool)
            for at in range(0, len(pair), CHUNK):
                pair[at:at + CHUNK] = self.joined.holds(gram_hashes([hashed[ids[at:at + CHUNK]][:len(pair) - at], hashed[ids[at + 1:at + CHUNK + 1]]], seed))
            whole &= pair[:length] & pair[1:length + 1]
        if self.held is not None:
            for at in range(0, length, CHUNK):
                parts = [hashed[ids[at + k:min(at + CHUNK, length) + k]] for k in range(size)]
                whole[at:at + CHUNK] &= self.held.holds(gram_hashes(parts, seed))
        found, counts = np.unique(codes[whole], return_counts=True)
        split = _split(found, size)
        return Grams(size, found, counts, gram_hashes([hashed[split[:, k]] for k in range(size)], seed), words)


def bucketed(hashes: np.ndarray, counts: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """(buckets, the sorted hashes of each as bytes), every hash as often as it counts, at most ``most`` times."""
    every = np.sort(np.repeat(hashes, np.minimum(counts, most)))
    edges = np.searchsorted(every >> np.uint64(64 - BUCKET_BITS), np.arange((1 << BUCKET_BITS) + 1, dtype=np.uint64))
    filled = np.flatnonzero(np.diff(edges))
    for at in range(0, len(filled), BUCKETS_SENT):
        some = filled[at:at + BUCKETS_SENT]
        yield some, [every[edges[b]:edges[b + 1]].tobytes() for b in some.tolist()]


def reaching(parts: Iterable[list[bytes]], least: int) -> np.ndarray:
    """The hashes that stand ``least`` times or more in one of the ``parts`` (pieces as of :func:`bucketed`) of a bucket."""
    found = []
    for pieces in parts:
        every = np.sort(np.frombuffer(b"".join(pieces), np.uint64))
        found.append(every[:max(len(every) - least + 1, 0)][every[:max(len(every) - least + 1, 0)] == every[least - 1:]])
    return np.unique(np.concatenate(found))


class HashFilter:
    """A Bloom filter in blocks: it holds every hash put in, and few others."""

    BLOCK_BITS = 1 << 19
    PROBES = 4

    def __init__(self, parts: dict[int, bytes], count: int):
        self.count = count
        self.bits = np.zeros((count, self.BLOCK_BITS // 8), np.uint8)
        for number, part in parts.items():
            self.bits[number] = np.frombuffer(part, np.uint8)

    @staticmethod
    def places(hashes: np.ndarray) -> list[np.ndarray]:
        spread = mixed(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5))
        return [((spread >> np.uint64(11 * k)) & np.uint64(HashFilter.BLOCK_BITS - 1)).astype(np.int64) for k in range(HashFilter.PROBES)]

    @classmethod
    def part(cls, hashes: np.ndarray) -> bytes:
        bits = np.zeros(cls.BLOCK_BITS // 8, np.uint8)
        for at in cls.places(hashes):
            np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
        return bits.tobytes()

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        block = (hashes % np.uint64(self.count)).astype(np.int64)
        left = np.arange(len(hashes))  # what all probes so far found
        for at in self.places(hashes):
            at = at[left]
            left = left[(self.bits[block[left], at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0]
        found = np.zeros(len(hashes), bool)
        found[left] = True
        return found
