"""Periodic runs of words, found by catchers of squares over completed power-of-two blocks.

A level k watches periods from 2^k to 2^(k+1) - 1. Each completed block of 2^k words on the grid of
that level has a catcher, which compares its block with the last 2^k words of the text at each of
the 2^k words appended from its end on; one that is equal, q words after the block, is a square in
the making. A run of at least four periods holds two neighbouring blocks of that grid
that catch at the same distance, so lone catches are dropped and chains of neighbours merge. The
merged stretch then grows word by word in powers of two to its full extent, and is confirmed on
the words themselves. The catchers of a level advance together, as one array operation each step
of a slice of texts: n comparisons a level, and as many levels as the longest text has."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from spendlens.llm.text import _BASE, _BASE_INVERSE, SPACED, Words, _powers_of, mix, slices

#: (doc_id, number of words) to the word that stands at each place, or None for the text as it is.
Edit = Callable[[object, int], np.ndarray | None]


class Slice:
    """The words of some texts in a row, as hashes, with words of no text after each, and after the
    last as many as the catchers of the last blocks look at."""

    def __init__(self, parts: list[np.ndarray]) -> None:
        sizes = np.array([len(p) for p in parts], np.int64)
        self.longest = int(sizes.max(initial=0))
        self.starts = np.append(0, np.cumsum(sizes + 1))[:-1]
        n = int(sizes.sum()) + len(parts) + 2 * self.longest
        self.words = mix(np.arange(n, dtype=np.uint64) + np.uint64(0xA5A5 << 40))
        for start, part in zip(self.starts, parts, strict=True):
            self.words[start : start + len(part)] = part
        self.sums = np.append(np.uint64(0), np.cumsum(self.words * _powers_of(_BASE, n)))
        self.inverse = _powers_of(_BASE_INVERSE, n + 1)

    def hashes(self, at: np.ndarray | slice, size: int) -> np.ndarray:
        """Hashes of the `size` words from each place on."""
        if isinstance(at, slice):
            return (self.sums[at.start + size : at.stop + size] - self.sums[at]) * self.inverse[at]
        return (self.sums[at + size] - self.sums[at]) * self.inverse[at]


def _caught(text: Slice, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chains of neighbouring blocks that catch at one distance: first and last place known to repeat
    (the last block's end), and the distance."""
    size = 1 << level
    blocks = (len(text.words) - 2 * size + 1) // size
    none = np.zeros(0, np.int64)
    if blocks < 2:
        return none, none, none
    own = text.hashes(np.arange(blocks) * size, size)
    after = text.hashes(slice(size, size + blocks * size), size).reshape(blocks, size)
    equal = after == own[:, None]
    pair = equal[1:] & equal[:-1]
    first, step = np.nonzero(pair)
    if not len(first):
        return none, none, none
    order = np.lexsort((first, step))
    first, step = first[order], step[order]
    new = np.ones(len(first), bool)
    new[1:] = (step[1:] != step[:-1]) | (first[1:] != first[:-1] + 1)
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(first)) - 1
    return first[heads] * size, (first[tails] + 2) * size, step[heads] + size


def _grown(text: Slice, low: np.ndarray, high: np.ndarray, period: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """The whole stretch [low, high) of places that equal those a period later. It ends less than
    a block away on either side, as the next block of the grid has not caught."""
    n = len(text.words)
    low, high = low.copy(), high.copy()
    for size in (1 << k for k in range(level, -1, -1)):
        fits = np.flatnonzero(low >= size)
        same = text.hashes(low[fits] - size, size) == text.hashes(low[fits] - size + period[fits], size)
        low[fits[same]] -= size
        fits = np.flatnonzero(high + period + size <= n)
        same = text.hashes(high[fits], size) == text.hashes(high[fits] + period[fits], size)
        high[fits[same]] += size
    return low, high


def find_runs(parts: list[np.ndarray], min_length: int, min_exponent: int) -> list[tuple[int, int, int, int]]:
    """(text, start, length, period) of the runs in texts given by the hashes of their words, up to
    equal hashes of different stretches. `min_exponent` is 4 at least."""
    text = Slice(parts)
    found = []
    level = 0
    while min_exponent << level <= text.longest:
        low, high, period = _caught(text, level)
        if len(low):
            low, high = _grown(text, low, high, period, level)
            length = high - low + period
            keep = length >= np.maximum(min_length, min_exponent * period)
            found.append(np.stack([low[keep], length[keep], period[keep]], axis=1))
        level += 1
    runs = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 3), np.int64)
    # A stretch whose period is a multiple of a smaller one was caught at both; it keeps the smaller.
    if len(runs):
        smallest = np.append(True, np.any(runs[1:, :2] != runs[:-1, :2], axis=1))
        runs = runs[smallest]
    owner = np.searchsorted(text.starts, runs[:, 0], side="right") - 1
    return [(int(o), int(s - text.starts[o]), int(n), int(p)) for o, (s, n, p) in zip(owner, runs, strict=True)]


def compared_runs(words: list, min_length: int, min_exponent: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of one text by comparing words at each distance: for the
    texts in which hashes have misled."""
    runs: dict[tuple[int, int], int] = {}
    ids = _numbered(words)
    for period in range(1, len(ids) // min_exponent + 1):
        equal = np.concatenate([[False], ids[period:] == ids[:-period], [False]])
        edges = np.flatnonzero(equal[1:] != equal[:-1])
        for low, high in zip(edges[0::2].tolist(), edges[1::2].tolist(), strict=True):
            if high - low + period >= max(min_length, min_exponent * period):
                runs.setdefault((low, high - low + period), period)
    return sorted((s, n, p) for (s, n), p in runs.items())


def _numbered(words: list) -> np.ndarray:
    numbers: dict = {}
    return np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)


def _confirmed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bool:
    """Whether every run repeats on the words themselves and cannot be extended."""
    for start, length, period in runs:
        end = start + length
        if words[start : end - period] != words[start + period : end]:
            return False
        if start and words[start - 1] == words[start - 1 + period]:
            return False
        if end < len(words) and words[end] == words[end - period]:
            return False
    return True


def periodic_runs(documents: DataFrame, min_length: int = 6, min_exponent: int = 4, edit: Edit | None = None) -> DataFrame:
    """The runs of each document (doc_id, text): stretches of consecutive words (bytes other than ASCII
    white space) with smallest period q, of `min_length` words and `min_exponent` * q at least, which
    no neighbouring word extends. One row per document (doc_id, n_words long, runs
    array<struct<start, length, period>> by start and period, collapsed string): `collapsed` are
    the words that no run holds after its first period, joined by single spaces.

    A null or empty text has no words, no runs and an empty `collapsed`. Repeated rows and null
    doc_ids give a row each; other columns are not read. A text is worked on whole, in memory of
    some ten numbers a word. `edit` may say which word stands at each place (see Edit).
    `min_exponent` must be 4 at least."""
    if min_exponent < 4 or min_length < 1:
        raise ValueError("runs have four periods and one word at least")
    kind = dict(documents.dtypes)["doc_id"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, column = batch.column("doc_id"), batch.column("text").cast(pa.binary())
            for first, texts in slices(column.to_pylist()):
                own = ids.slice(first, len(texts))
                numbers, runs, collapsed = _worked(own.to_pylist(), texts, min_length, min_exponent, edit)
                yield pa.RecordBatch.from_arrays(
                    [own, pa.array(numbers, pa.int64()), pa.array(runs, RUNS), pa.array(collapsed, pa.binary()).cast(pa.string())],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    schema = f"doc_id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return documents.select("doc_id", "text").mapInArrow(work, schema)


RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _worked(ids: list, texts: list[bytes], min_length: int, min_exponent: int, edit: Edit | None) -> tuple[list, list, list]:
    split = Words(texts, SPACED, lower=False)
    parts, words = [], []
    for i, text in enumerate(texts):
        hashes, own = split.hashes[split.bounds[i] : split.bounds[i + 1]], text.split()
        order = edit(ids[i], len(own)) if edit is not None and own else None
        if order is not None:
            hashes, own = hashes[order], [own[j] for j in order.tolist()]
        parts.append(hashes)
        words.append(own)
    by_text: dict[int, list] = {}
    for i, *run in find_runs(parts, min_length, min_exponent):
        by_text.setdefault(i, []).append(tuple(run))
    collapsed = []
    for i, own in enumerate(words):
        runs = by_text.get(i)
        if runs and not _confirmed(own, runs):
            runs = by_text[i] = compared_runs(own, min_length, min_exponent)
        collapsed.append(b" ".join(_kept(own, runs) if runs else own))
    listed = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in by_text.get(i, [])] for i in range(len(texts))]
    return [len(w) for w in words], listed, collapsed


def _kept(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]
