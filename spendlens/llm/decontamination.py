"""Benchmark decontamination: multi-pattern search with block shifts (Wu and Manber) over words."""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import stored
from spendlens.llm.text import ALNUM, Words, mix, slices

#: (item, window) rows searched in one pass over the documents; bounds a broadcast to some 30 MB.
PASS_WINDOWS = 100_000
#: Entries of a shift table.
_SHIFTS = 1 << 20
#: Words that one lane of the search walks through.
_LANE = 512


def benchmark_windows(benchmark: DataFrame, size: int) -> DataFrame:
    """The distinct windows (item_id string, window string) of (item_id, text): runs of `size`
    words, or all words of an item that has fewer; a window is its words joined by spaces. A null
    or wordless text has none; a null item_id is the empty text."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("item_id").to_pylist()
            for first, texts in slices(batch.column("text").to_pylist()):
                words = Words(texts, ALNUM)
                rows = set()
                for i, (a, b) in enumerate(zip(words.bounds[:-1], words.bounds[1:], strict=True)):
                    own = [words.word(k) for k in range(a, b)]
                    for k in range(max(1, len(own) - size + 1) if own else 0):
                        rows.add((ids[first + i], b" ".join(own[k : k + size])))
                columns = [pa.array([r[k] for r in rows], t) for k, t in ((0, pa.string()), (1, pa.binary()))]
                yield pa.RecordBatch.from_arrays(columns, ["item_id", "window"])

    named = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
        F.col("text").cast("binary").alias("text"),
    )
    return named.mapInArrow(cut, "item_id string, window binary").distinct()


class _Patterns:
    """The shift table and the suffix buckets of all windows of one length."""

    def __init__(self, windows: dict[bytes, list[str]], length: int) -> None:
        self.length, self.block = length, min(2, length)
        words = Words(list(windows), ALNUM)
        blocks = _blocks(words.hashes, self.block)
        self.shifts = np.full(_SHIFTS, length - self.block + 1, np.uint8 if length < 200 else np.int32)
        first = words.bounds[:-1]
        for j in range(self.block - 1, length):
            at = (blocks[first + j] & np.uint64(_SHIFTS - 1)).astype(np.int64)
            np.minimum.at(self.shifts, at, length - 1 - j)
        #: By the last block of the windows: the windows that end in it, and their items.
        self.buckets: dict[int, dict[bytes, list[str]]] = defaultdict(dict)
        for window, last in zip(windows, blocks[first + length - 1].tolist(), strict=True):
            self.buckets[last][window] = windows[window]

    def find(self, words: Words) -> Iterator[tuple[int, int, list[str]]]:
        """(text, first word, items) of every occurrence."""
        if not len(words.hashes):
            return
        blocks = _blocks(words.hashes, self.block)
        shift = self.shifts[(blocks & np.uint64(_SHIFTS - 1)).astype(np.int64)]
        # Lanes: runs of possible last words of a window, each within one text.
        begin, end = words.bounds[:-1] + self.length - 1, words.bounds[1:]
        lanes = np.maximum(0, -(-(end - begin) // _LANE))
        of_text = np.repeat(np.arange(len(begin)), lanes)
        nth = np.arange(len(of_text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        at = begin[of_text] + nth * _LANE
        stop = np.minimum(at + _LANE, end[of_text])
        found = []
        while len(at):
            step = shift[at]
            found.append(np.stack((at[step == 0], of_text[step == 0])))
            at = at + np.maximum(step, 1)
            going = at < stop
            at, stop, of_text = at[going], stop[going], of_text[going]
        for last, text in np.concatenate(found, axis=1).T.tolist() if found else ():
            if bucket := self.buckets.get(int(blocks[last])):
                first = last - self.length + 1
                items = bucket.get(b" ".join(map(words.word, range(first, last + 1))))
                if items:
                    yield text, first, items


def _blocks(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of the block of words that ends at each word."""
    if size == 1 or not len(hashes):
        return hashes
    out = hashes.copy()
    out[1:] = mix(hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:])
    return out


def find_benchmark(documents: DataFrame, benchmark: DataFrame, window: int = 10, pass_windows: int = PASS_WINDOWS) -> DataFrame:
    """Marks the words of documents that lie in an occurrence of a benchmark window.

    documents must have `text`; all its columns pass through, followed by n_words long, n_hit
    long, items array<string> (sorted, distinct) and spans array<struct<first, last>> of long
    (maximal runs of hit words, by word number, both ends included). Columns of these names that
    documents already has are replaced. benchmark has (item_id, text), see benchmark_windows.

    A null, empty or wordless text has 0 words and no hits; repeated rows each get their result.
    The documents are read once for every `pass_windows` windows and are never shuffled; windows
    are dealt to passes by hash, so that each broadcast is bounded whatever the benchmark's size.
    Only a benchmark of several passes writes the documents in between."""
    made = ("n_words", "n_hit", "items", "spans")
    frame = documents.select(*[c for c in documents.columns if c not in made])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema)
    schema = f"{fields}, n_words long, n_hit long, items array<string>, spans array<struct<first:long,last:long>>"
    frame = frame.select(
        "*",
        F.lit(0).cast("long").alias("n_words"),
        F.lit(0).cast("long").alias("n_hit"),
        F.array().cast("array<string>").alias("items"),
        F.array().cast("array<struct<first:long,last:long>>").alias("spans"),
    )
    windows = stored(benchmark_windows(benchmark, window), "windows")
    passes = max(1, -(-windows.count() // pass_windows))
    for i in range(passes):
        part = windows.filter(F.pmod(F.xxhash64("window"), F.lit(passes)) == i)
        frame = _search(frame if i == 0 else stored(frame, "searched"), part, schema)
    return frame


def _search(frame: DataFrame, part: DataFrame, schema: str) -> DataFrame:
    by_length: dict[int, dict[bytes, list[str]]] = defaultdict(lambda: defaultdict(list))
    for item, text in part.collect():
        by_length[text.count(b" ") + 1][bytes(text)].append(item)
    held = frame.sparkSession.sparkContext.broadcast({n: dict(x) for n, x in by_length.items()})
    names = frame.columns
    struct = pa.struct([("first", pa.int64()), ("last", pa.int64())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = [_Patterns(windows, length) for length, windows in sorted(held.value.items())]
        for batch in batches:
            old_items, old_spans = batch.column("items").to_pylist(), batch.column("spans").to_pylist()
            n_words, n_hit, items, spans = [], [], [], []
            for begin, texts in slices(_utf8(batch.column("text"))):
                words = Words(texts, ALNUM)
                cover = np.zeros(len(words.hashes) + 1, np.int32)
                named: dict[int, set[str]] = defaultdict(set)
                for k in range(len(texts)):
                    named[k].update(old_items[begin + k])
                    for x in old_spans[begin + k]:
                        cover[words.bounds[k] + x["first"]] += 1
                        cover[words.bounds[k] + x["last"] + 1] -= 1
                for p in patterns:
                    for text, first, found in p.find(words):
                        named[text].update(found)
                        cover[first] += 1
                        cover[first + p.length] -= 1
                hit = np.cumsum(cover)[:-1] > 0
                edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
                runs: dict[int, list[dict]] = defaultdict(list)
                # A run of hit words may go on into the next text: it is cut at the bounds.
                owners = np.searchsorted(words.bounds, edges[0::2], "right") - 1
                for a, b, k in zip(edges[0::2].tolist(), edges[1::2].tolist(), owners.tolist(), strict=True):
                    while a < b:
                        stop = min(b, int(words.bounds[k + 1]))
                        if stop > a:
                            base = int(words.bounds[k])
                            runs[k].append({"first": a - base, "last": stop - 1 - base})
                        a, k = stop, k + 1
                for k in range(len(texts)):
                    n_words.append(int(words.counts[k]))
                    n_hit.append(sum(x["last"] - x["first"] + 1 for x in runs[k]))
                    items.append(sorted(named[k]))
                    spans.append(runs[k])
            made = {
                "n_words": pa.array(n_words, pa.int64()),
                "n_hit": pa.array(n_hit, pa.int64()),
                "items": pa.array(items, pa.list_(pa.string())),
                "spans": pa.array(spans, pa.list_(struct)),
            }
            yield pa.RecordBatch.from_arrays([made.get(c, batch.column(i)) for i, c in enumerate(names)], names)

    return frame.mapInArrow(search, schema)


def _utf8(column: pa.Array) -> Iterator[bytes | None]:
    return iter(column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist())


def items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
