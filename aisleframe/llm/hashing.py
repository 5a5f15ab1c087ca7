"""Words and word windows of many texts as 64-bit hashes, with numpy, inside a task.

A word is a maximal run of bytes other than space and \\t \\n \\v \\f \\r, which in UTF-8 is the run of characters
`[^\\x20\\x09-\\x0D]+`. Hashes are polynomials over bytes (or word hashes) modulo 2**64 with mixed coefficients and
a mixed result; two different sequences of the same length get the same hash with a chance near 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute

CHUNK = 1 << 19
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every input bit (two multiply-and-shift rounds)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_OF_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(k: int, n: int) -> np.ndarray:
    """The first n powers of the base (k = 0) or of its inverse (k = 1)."""
    if len(_powers[k]) < n:
        size = max(n, CHUNK + 2)
        steps = np.full(size, (_BASE, _INVERSE)[k], np.uint64)
        steps[0] = 1
        _powers[k] = np.cumprod(steps)
    return _powers[k][:n]


def _words(buf: bytes) -> tuple[np.ndarray, np.ndarray]:
    a = np.frombuffer(buf, np.uint8)
    free = np.concatenate(([True], _SPACE[a], [True]))
    edges = np.flatnonzero(free[1:] != free[:-1])
    starts, ends = edges[::2], edges[1::2]
    sums = np.zeros(len(a) + 1, np.uint64)
    np.cumsum(_OF_BYTE[a] * _power(0, len(a)), out=sums[1:])
    value = (sums[ends] - sums[starts]) * _power(1, len(a) + 1)[starts]
    return mix(value + (ends - starts).astype(np.uint64) * _BASE), starts


def hash_words(buf: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first byte) of each word of buf, worked off in pieces of about half a megabyte cut at white space."""
    found, at = [], 0
    while at < len(buf) or not found:
        end = at + CHUNK
        while end < len(buf) and buf[end] not in b" \t\n\v\f\r":
            end += 1
        h, starts = _words(buf[at:end])
        found.append((h, starts + at))
        at = end
    return (found[0] if len(found) == 1 else
            (np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found])))


def windows(h: np.ndarray, n: int) -> np.ndarray:
    """The hash of each n consecutive entries of h: len(h) - n + 1 values, none if h is shorter."""
    if len(h) < n:
        return np.empty(0, np.uint64)
    sums = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * _power(0, len(h)), out=sums[1:])
    return mix((sums[n:] - sums[:-n]) * _power(1, len(h) + 1)[: len(h) - n + 1] + np.uint64(n))


class Texts:
    """Hashed words of a few texts: `hash` of all words in order, `counts` words of each text."""

    def __init__(self, texts: list[bytes], lower: bool = False):
        buf = b"\n".join(texts)
        self.hash, starts = hash_words(buf.lower() if lower else buf)
        ends = np.cumsum([len(t) + 1 for t in texts])
        firsts = np.searchsorted(starts, ends)
        self.counts = np.diff(firsts, prepend=0)
        self.of = np.repeat(np.arange(len(texts)), self.counts)

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, index of the first word) of each window of n words inside one text."""
        h = windows(self.hash, n)
        at = np.flatnonzero(self.of[: len(h)] == self.of[n - 1:][: len(h)])
        return h[at], at

    def position(self, at: np.ndarray) -> np.ndarray:
        """Word numbers within their text of words given by index."""
        return at - (np.cumsum(self.counts) - self.counts)[self.of[at]]


def as_bytes(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8; null is empty."""
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def chunked(batches: Iterable[pa.RecordBatch], text: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with about CHUNK bytes of text (a longer text alone), so memory follows the longest text."""
    for batch in batches:
        column = batch.column(text)
        sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(column), 0)).astype(np.int64)
        before = np.cumsum(sizes) - sizes
        at = 0
        while at < len(sizes):
            end = max(at + 1, int(np.searchsorted(before, before[at] + CHUNK, "right")) - 1)
            if end + 1 == len(sizes) and before[end] + sizes[end] - before[at] <= CHUNK:
                end += 1
            part = batch.slice(at, end - at)
            yield part, as_bytes(part.column(text))
            at = end


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
