"""Vectorised words and hashes over UTF-8 bytes, used inside Arrow tasks.

Texts are handled as bytes. Many texts are joined with a line feed, which is no word byte, and
worked on as one byte array of about SLICE_BYTES, so that memory is bounded by that size or by
the longest single text."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

SLICE_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)

#: Bytes of words: all but ASCII white space; ASCII letters, digits and all non-ASCII bytes.
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

#: Lower-cases A-Z only.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
_LOWER_64 = LOWER.astype(np.uint64) + np.uint64(1)

_powers: dict[int, np.ndarray] = {}


def _powers_of(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(20, int(n - 1).bit_length())
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.multiply.accumulate(steps)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def prefix_hashes(data: np.ndarray, lower: bool) -> np.ndarray:
    """Polynomial hash sums of every prefix; see span_hashes."""
    values = _LOWER_64[data] if lower else data.astype(np.uint64) + np.uint64(1)
    values *= _powers_of(_BASE, len(data))
    out = np.empty(len(data) + 1, np.uint64)
    out[0] = 0
    np.cumsum(values, out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each span, the same wherever they stand."""
    raw = prefix[ends] - prefix[starts]
    raw *= _powers_of(_BASE_INVERSE, len(prefix))[starts]
    raw += (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return mix(raw)


def slices(texts: Iterable[bytes | None], limit: int = SLICE_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts of about `limit` bytes, each with the index of its first text."""
    first, held, size = 0, [], 0
    for i, text in enumerate(texts):
        text = text or b""
        if held and size + len(text) > limit:
            yield first, held
            first, held, size = i, [], 0
        held.append(text)
        size += len(text) + 1
    if held:
        yield first, held


class Words:
    """The words of some texts: their places in `data`, their hashes (of the words in lower case, unless
    told otherwise) and the words of each text."""

    def __init__(self, texts: list[bytes], table: np.ndarray, lower: bool = True) -> None:
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        self.text_starts = np.zeros(len(texts), np.int64)
        np.cumsum(lengths[:-1] + 1, out=self.text_starts[1:])
        flags = np.zeros(len(self.data) + 1, np.int8)
        flags[1:] = table[self.data]
        edges = np.flatnonzero(np.diff(flags))
        self.starts, self.ends = edges[0::2], edges[1::2]
        self.hashes = span_hashes(prefix_hashes(self.data, lower), self.starts, self.ends)
        #: Words [bounds[i], bounds[i + 1]) belong to text i.
        self.bounds = np.append(np.searchsorted(self.starts, self.text_starts), len(self.starts))
        self.counts = np.diff(self.bounds)

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes().lower()


def shingle_hashes(words: Words, size: int, min_words: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's runs of `size` words (of all its words, if fewer), not yet distinct,
    and the bounds of each text's part. Texts of less than `min_words` words have none."""
    n, counts = len(words.hashes), np.where(words.counts < min_words, 0, words.counts)
    made = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    bounds = np.append(0, np.cumsum(made))
    owner = np.repeat(np.arange(len(counts)), made)
    at = words.bounds[owner] + np.arange(bounds[-1]) - bounds[owner]
    ends = np.minimum(at + size, words.bounds[owner + 1])
    if n == 0:
        return np.zeros(0, np.uint64), bounds
    sums = np.append(np.uint64(0), np.cumsum(words.hashes * _powers_of(_BASE, n)))
    raw = (sums[ends] - sums[at]) * _powers_of(_BASE_INVERSE, n + 1)[at]
    return mix(raw + (ends - at).astype(np.uint64)), bounds


def distinct_within(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct values of each part, and the new bounds."""
    if not len(values):
        return values, np.zeros(len(bounds), np.int64)
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    keep = np.ones(len(values), bool)
    keep[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return values[keep], np.searchsorted(owner[keep], np.arange(len(bounds)))
