"""Shingle sets, parity sketches and their join keys, inside a task."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_RNG = np.random.default_rng(20240607)
_ODD = _RNG.integers(1 << 62, 1 << 63, 16, np.uint64) | np.uint64(1)
# A random number for every byte; A-Z share those of a-z.
_BYTES = _RNG.integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_BYTES[65:91] = _BYTES[97:123]
# A random number for every bit of a segment of a sketch.
_BITS = _RNG.integers(1, 1 << 63, 1 << 16, np.uint64)
BASE = int(_ODD[0]) | 1
# Bytes that are split into words at a time; a pass holds some 70 bytes for each.
BLOCK = 1 << 18
# Longs of the short sketch that filters candidate pairs.
LONGS = 8


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and its inverse modulo 2**64, for places in a block."""
    inverse = pow(BASE, -1, 1 << 64)
    out = []
    for base in (BASE, inverse):
        table = np.full(2 * BLOCK, base & (1 << 64) - 1, np.uint64)
        table[0] = 1
        out.append(np.multiply.accumulate(table))
    return out[0], out[1]


def _word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of every word of a block that ends with a space."""
    powers, inverses = _powers()
    if len(raw) > len(powers):
        # one word longer than a block, without spaces before it: the sum of all its bytes, part by part
        word, folded, shift, step = np.frombuffer(raw, np.uint8)[:-1], 0, 1, pow(BASE, BLOCK, 1 << 64)
        for i in range(0, len(word), BLOCK):
            part = word[i:i + BLOCK]
            folded += int((_BYTES[part] * powers[:len(part)]).sum(dtype=np.uint64)) * shift
            shift = shift * step % (1 << 64)
        return np.array([0]), mix(np.array([folded % (1 << 64)], np.uint64))
    codes = np.frombuffer(raw, np.uint8)
    space = SPACES[codes]
    edges = np.flatnonzero(np.diff(space, prepend=True))
    starts, ends = edges[::2], edges[1::2]
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(_BYTES[codes] * powers[:len(codes)], out=sums[1:])
    return starts, mix((sums[ends] - sums[starts]) * inverses[starts])


def _blocks(raw: bytes) -> Iterator[bytes]:
    """Blocks of whole words, each ending with a space; a word longer than a block is one alone."""
    codes = np.frombuffer(raw, np.uint8)
    at = 0
    while at < len(raw):
        stop = len(raw)
        if stop - at > BLOCK:
            gaps = np.flatnonzero(SPACES[codes[at:at + BLOCK + 1]])
            if len(gaps):
                stop = at + int(gaps[-1]) + 1
            elif gap := _SPACE.search(raw, at + BLOCK):
                stop = gap.start()
        yield raw[at:stop] + b" "
        at = stop


def _shingles(words: np.ndarray, size: int) -> np.ndarray:
    total = np.zeros(len(words) - size + 1, np.uint64)
    for i in range(size):
        total += words[i:len(words) - size + 1 + i] * _ODD[i + 1]
    return total


def shingle_sets(texts: list, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of every text (None: empty).

    Short texts share a pass over their joined bytes; a long one goes through
    in blocks of whole words.
    """
    group: list[bytes] = []
    held = 0
    for text in texts:
        raw = (text or "").encode()
        if held + len(raw) >= BLOCK:
            yield from _grouped(group, size)
            group, held = [], 0
        if len(raw) >= BLOCK:
            yield _distinct(np.concatenate([_word_hashes(b)[1] for b in _blocks(raw)]), size)
        else:
            group.append(raw)
            held += len(raw) + 1
    yield from _grouped(group, size)


def _distinct(words: np.ndarray, size: int) -> np.ndarray:
    if not len(words):
        return np.zeros(0, np.uint64)
    if len(words) < size:
        # the whole sequence; its length keeps it apart from longer shingles
        return mix(_shingles(words, len(words)) + _ODD[10 + len(words) % 5] + np.uint64(len(words)))
    found = np.sort(mix(_shingles(words, size)))
    return found[np.r_[True, found[1:] != found[:-1]]]


def _grouped(group: list[bytes], size: int) -> Iterator[np.ndarray]:
    if not group:
        return
    starts, words = _word_hashes(b" ".join(group) + b" ")
    ends = np.searchsorted(starts, np.cumsum([len(raw) + 1 for raw in group]))
    at = 0
    for end in ends.tolist():
        yield _distinct(words[at:end], size)
        at = end


class Plan:
    """Which join keys a set of a given size has, for one threshold.

    Two sets of a <= b shingles with similarity p/100 or more differ in at most
    (100 - p)(a + b)/(100 + p) shingles, and b <= 100a/p. Sizes form bands; the
    sets that may be partners of a band's sizes share one cut of the sketch
    into more segments than can differ, so linked sets agree in one.

    An empty segment says little, so it is no key: a band has ``spare``
    further segments, and a set with no more empty segments than that still
    has more others than can differ. Only the few sets beyond use their empty
    segments, with one another. Sets so small that partners differ by one
    shingle use hashes of the whole set and of the set without each shingle.
    """

    RATIO = 1.4

    def __init__(self, percent: int):
        self.percent = percent
        self.bands: list[tuple[int, int, int, int, int]] = []  # low, high, largest partner, segments, spare
        self.first = 1
        while self.differ(self.first) < 2:
            self.first += 1

    def differ(self, a: int) -> int:
        """Most shingles by which a set of ``a`` and a partner as large or larger differ."""
        return (100 - self.percent) * (a + 100 * a // self.percent) // (100 + self.percent)

    def pair_limit(self, a: int, b: int) -> int:
        return (100 - self.percent) * (a + b) // (100 + self.percent)

    def _extend(self, size: int) -> None:
        while not self.bands or self.bands[-1][1] < size:
            low = self.bands[-1][1] + 1 if self.bands else self.first
            high = max(low, int(low * self.RATIO) - 1)
            least = self.differ(high) + 1
            spare, enough = 0, least
            while spare < enough:
                middle = (spare + enough) // 2
                if self._tail(low, least + middle, middle) > 1e-4:
                    spare = middle + 1
                else:
                    enough = middle
            self.bands.append((low, high, 100 * high // self.percent, least + spare, spare))

    @staticmethod
    def _tail(size: int, segments: int, spare: int) -> float:
        """About the share of sets of ``size`` with more than ``spare`` empty segments."""
        mean = segments * math.exp(-size / segments)
        # logarithms: exp(-mean) is 0 for means above 745
        terms = np.r_[0.0, np.cumsum(math.log(mean) - np.log(np.arange(1, spare + 1)))] - mean
        return max(0.0, 1 - float(np.exp(terms).sum()))

    def keys(self, tokens: np.ndarray) -> np.ndarray:
        """All keys (int64, distinct) of a sorted set."""
        size = len(tokens)
        out = []
        if size <= self.first:
            whole = np.bitwise_xor.reduce(tokens) if size else np.uint64(0)
            if 0 < size < self.first:  # equal sets, and those with one shingle more
                out.append(_key(size, 0, np.array([whole], np.uint64)))
            if size > 1 and self.differ(size - 1) == 1:
                out.append(_key(size - 1, 0, whole ^ tokens))
        if size >= self.first:
            self._extend(size)
            bits = np.bitwise_xor.accumulate(np.r_[np.uint64(0), _BITS[(tokens & np.uint64(0xFFFF)).astype(np.intp)]])
            for low, high, largest, segments, spare in reversed(self.bands):
                if low > size:
                    continue
                if largest < size:
                    break
                cuts = np.r_[0, np.searchsorted(tokens, _thresholds(segments)), size]
                patterns = bits[cuts[1:]] ^ bits[cuts[:-1]]
                keys = _key(low, np.arange(1, segments + 1, dtype=np.uint64), patterns)
                full = patterns != 0
                out.append(keys if segments - full.sum() > spare else keys[full])
        return np.unique(np.concatenate(out)).view(np.int64) if out else np.zeros(0, np.int64)


@lru_cache(4096)
def _thresholds(segments: int) -> np.ndarray:
    return np.array([(i << 64) // segments for i in range(1, segments)], np.uint64)


def _key(band: int, segment, pattern: np.ndarray) -> np.ndarray:
    at = np.atleast_1d(np.asarray(segment, np.uint64)) * _ODD[9] + np.atleast_1d(np.uint64(band)) * _ODD[8]
    return mix(pattern + mix(at))


def short_sketch(tokens: np.ndarray) -> list[int]:
    """Parity of the tokens per bit, as LONGS signed 64-bit numbers."""
    places = ((tokens >> np.uint64(16)) & np.uint64(64 * LONGS - 1)).astype(np.intp)
    parity = (np.bincount(places, minlength=64 * LONGS) & 1).astype(np.uint8)
    return np.packbits(parity).view(np.int64).tolist()


def long_sketch(tokens: np.ndarray) -> bytes | None:
    """Parity of the tokens per bit, with 4 to 8 bits a token; None where the short sketch has as many."""
    if len(tokens) * 4 <= 64 * LONGS:
        return None
    bits = 1 << (4 * len(tokens) - 1).bit_length()
    places = ((tokens >> np.uint64(16)) & np.uint64(bits - 1)).astype(np.intp)
    return np.packbits((np.bincount(places, minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def distance(a: bytes, b: bytes) -> int:
    """Hamming distance of two long sketches; the longer one is folded, which keeps parities."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    if len(x) > len(y):
        x, y = y, x
    while len(y) > len(x):
        y = y[:len(y) // 2] ^ y[len(y) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


def shared(a: bytes, b: bytes) -> int:
    """Size of the intersection of two sets stored as bytes."""
    both = np.concatenate([np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)])
    both.sort()
    return int((both[1:] == both[:-1]).sum())
