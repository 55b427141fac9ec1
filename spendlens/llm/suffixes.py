"""Suffix-array deduplication: blockwise sorting of suffixes with a difference cover."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import packed_columns, stored
from spendlens.llm.neardup import map_groups
from spendlens.llm.text import mix, prefix_hashes, slices, span_hashes

#: Period of the difference cover: ties longer than this are resolved by ranks of the sample.
PERIOD = 32
#: Bytes of candidate text that are sorted at once; bounds the memory of a task.
SORT_BYTES = 1 << 20
#: Suffixes of a bucket, but for those that share their first two bytes.
BUCKET = 1 << 16
#: Distinct pieces of a sync group up to which its suffixes are sorted together, in one task.
GROUP_PIECES = 16_384
#: Windows of a run at most.
_RUN = 256
#: Longer texts are worked on in overlapping segments of this size.
_SEGMENT = 1 << 20


def difference_cover(period: int) -> np.ndarray:
    """Residues of which every difference modulo the period occurs, found greedily."""
    cover = [0, 1]
    while True:
        have = {(a - b) % period for a in cover for b in cover}
        if len(have) == period:
            return np.array(sorted(cover))
        cover.append(max(range(period), key=lambda x: len({d for a in cover for d in ((a - x) % period, (x - a) % period)} - have)))


class SuffixRanks:
    """Order of the suffixes of `data` by their first `length` bytes and beyond, for sorting one
    bucket of suffixes at a time."""

    def __init__(self, data: np.ndarray, length: int, period: int = PERIOD) -> None:
        self.period = period
        pad = np.zeros(length + 2 * period + 8, np.uint8)
        self.data = np.concatenate((data, pad))
        cover = difference_cover(period)
        is_cover = np.zeros(period, bool)
        is_cover[cover] = True
        #: shift[a, b]: how far from residues a and b both reach the cover.
        self.shift = np.zeros((period, period), np.int64)
        for a in range(period):
            for b in range(period):
                self.shift[a, b] = next(d for d in range(period) if is_cover[(a + d) % period] and is_cover[(b + d) % period])
        # Words of eight bytes, big-endian, so that integers order as bytes do.
        wide = self.data.astype(np.uint64)
        words = np.zeros(len(self.data) - 7, np.uint64)
        for k in range(8):
            words |= wide[k : len(words) + k] << np.uint64(56 - 8 * k)
        self.words = words
        # Ranks of the cover sample by ever longer prefixes: each round doubles what is known.
        reach = len(data) + period
        sample = np.flatnonzero(is_cover[np.arange(reach) % period])
        order = np.lexsort([words[sample + 8 * k] for k in reversed(range(period // 8))])
        new = np.zeros(len(sample), bool)
        for k in range(period // 8):
            column = words[sample + 8 * k][order]
            new[1:] |= column[1:] != column[:-1]
        self.rank = np.zeros(len(self.data) + 2 * length, np.int64)
        self.rank[sample[order]] = np.cumsum(new) + 1
        known = period
        while known < length + period:
            key = (self.rank[sample] << 32) | self.rank[sample + known]
            self.rank[sample] = np.unique(key, return_inverse=True)[1] + 1
            known *= 2

    def sort(self, suffixes: np.ndarray) -> np.ndarray:
        """The suffixes of one bucket in order: by their first bytes, up to the period, and in ties
        by the ranks of the first sample positions that the tied suffixes reach together."""
        columns = [self.words[suffixes + 8 * k] for k in range(self.period // 8)]
        order = np.lexsort(columns[::-1])
        suffixes = suffixes[order]
        new = np.ones(len(suffixes), bool)
        new[1:] = False
        for column in columns:
            column = column[order]
            new[1:] |= column[1:] != column[:-1]
        tie = np.cumsum(new) - 1
        size = np.bincount(tie)
        tied = np.flatnonzero(size[tie] > 1)
        if not len(tied):
            return suffixes
        at, group = suffixes[tied], tie[tied]
        residue = at % self.period
        # A tie of one residue class: the rank of the next sample position orders it.
        key = self.rank[at + self.shift[residue, residue]]
        first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        mixed = np.minimum.reduceat(residue, first) != np.maximum.reduceat(residue, first)
        mixed = np.flatnonzero(np.repeat(mixed, np.diff(np.append(first, len(at)))))
        if len(mixed):
            key[mixed] = self._places(at[mixed], group[mixed], residue[mixed])
        suffixes[tied] = at[np.argsort((group << 32) | key, kind="stable")]
        return suffixes

    def _places(self, at: np.ndarray, group: np.ndarray, residue: np.ndarray) -> np.ndarray:
        """The place of each suffix in its tie: how many of each residue class come before it,
        compared by the ranks of the sample positions that both classes reach at one distance."""
        before = np.zeros(len(at), np.int64)
        members = {r: np.flatnonzero(residue == r) for r in np.unique(residue).tolist()}
        for b, other in members.items():
            for a, own in members.items():
                shift = self.shift[a, b]
                theirs = np.sort((group[other] << 32) | self.rank[at[other] + shift])
                mine = group[own] << 32
                low = np.searchsorted(theirs, mine)
                before[own] += np.searchsorted(theirs, mine | self.rank[at[own] + shift]) - low
        return before

    def same_as_next(self, suffixes: np.ndarray, length: int) -> np.ndarray:
        """Whether each sorted suffix and the next share `length` bytes; the last is false."""
        same = np.zeros(len(suffixes), bool)
        if len(suffixes) > 1:
            ok = np.ones(len(suffixes) - 1, bool)
            for k in [*range(0, length - 7, 8), length - 8]:
                left = np.flatnonzero(ok)
                ok[left] = self.words[suffixes[left] + k] == self.words[suffixes[left + 1] + k]
            same[:-1] = ok
        return same


def repeated_starts(
    pieces: list[bytes], windows: list[int], copies: np.ndarray, length: int, anchors: np.ndarray | None = None
) -> list[np.ndarray]:
    """For each piece, which of its first `windows` suffixes share their first `length` bytes with
    another suffix, or stand in a piece with copies. The suffixes are put into buckets of about
    BUCKET, by ranges of the first two bytes, and sorted one bucket at a time. `anchors`, a place in each piece that equal strings
    have in common, only saves time: pieces are laid so that equal suffixes are of one residue."""
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    lead = (PERIOD - (anchors % PERIOD)) % PERIOD if anchors is not None else np.zeros(len(pieces), np.int64)
    room = -(-(lead + sizes + 1) // PERIOD) * PERIOD  # with a gap behind each piece
    starts = np.cumsum(room) - room + lead
    data = np.zeros(room.sum(), np.uint8)
    flat = np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    data[flat] = np.frombuffer(b"".join(pieces), np.uint8)
    ranks = SuffixRanks(data, length)
    counts = np.array(windows)
    of = np.repeat(np.arange(len(pieces)), counts)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
    suffixes = starts[of] + nth
    found = np.zeros(len(data) + 1, bool)
    head = (ranks.words[suffixes] >> np.uint64(48)).astype(np.int64)
    upto = np.cumsum(np.bincount(head, minlength=1 << 16))
    bucket = (upto // BUCKET)[head]
    order = np.argsort(bucket, kind="stable")
    edges = np.append(np.flatnonzero(np.diff(bucket[order], prepend=-1)), len(order))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        if b - a < 2:
            continue
        inside = ranks.sort(suffixes[order[a:b]])
        same = ranks.same_as_next(inside, length)
        found[inside[same]] = True
        found[inside[1:][same[:-1]]] = True
    hit = found[suffixes] | (copies[of] > 1)
    return np.split(hit, np.cumsum(counts)[:-1])


def _sync_runs(texts: list[bytes], length: int, gram: int) -> tuple[np.ndarray, ...]:
    """The suffixes of at least `length` bytes in runs of one sync hash: the least hash of the grams
    in their first `length` bytes, so suffixes that share these bytes have the same. Returns (text,
    start, count, sync hash, hash of the run's bytes, whether the run may repeat within itself)."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    texts_at = np.append(0, np.cumsum(sizes + 1))
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    n, width = len(data) - length + 1, length - gram + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, bool),)
    prefix = prefix_hashes(data, False)
    grams = np.arange(len(data) - gram + 1)
    hashes = span_hashes(prefix, grams, grams + gram)
    # Sliding minimum over `width` grams: running minima of blocks, from both sides.
    blocks = -(-len(hashes) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(hashes)] = hashes
    padded = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])
    owner = np.repeat(np.arange(len(texts)), sizes + 1)[:n]
    valid = np.arange(n) + length <= texts_at[owner + 1] - 1
    new = np.ones(n, bool)
    new[1:] = (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    within = np.arange(n) - np.repeat(first, np.diff(np.append(first, n)))
    new |= within % _RUN == 0
    # The gram has left the window and yet is in it: the run holds it twice.
    again = np.zeros(n + 1, np.int64)
    again[2:] = np.cumsum((hashes[: n - 1] == least[1:n]) & (owner[1:] == owner[:-1]))
    starts = np.flatnonzero(new)
    stops = np.append(starts[1:], n)
    stops = np.minimum(stops, texts_at[owner[starts] + 1] - length)
    some = valid[starts] & (stops > starts)
    starts, stops = starts[some], stops[some]
    body = span_hashes(prefix, starts, stops + length - 1)
    twice = again[stops] > again[np.minimum(starts + 1, stops)]
    of = owner[starts]
    return of, starts - texts_at[of], stops - starts, least[starts], mix(body ^ least[starts]), twice


def _keyed(documents: DataFrame) -> DataFrame:
    """Two columns that tell rows apart, equal for equal rows."""
    return documents.withColumns(
        {
            "_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(0)),
            "_hash": F.xxhash64("doc_id", "text"),
        }
    )


def _packed(documents: DataFrame) -> DataFrame:
    """The rows with their text compressed, for a shuffle."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zip_ = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            i = batch.schema.get_field_index("text")
            column = batch.column(i)
            binary = column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())
            packed = pa.array([None if t is None else zip_.compress(t) for t in binary.to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([packed if k == i else c for k, c in enumerate(batch.columns)], batch.schema.names)

    fields = ", ".join(f"`{f.name}` {'binary' if f.name == 'text' else f.dataType.simpleString()}" for f in documents.schema)
    return documents.mapInArrow(pack, fields)


def repeated_spans(documents: DataFrame, length: int = 200, gram: int = 64) -> DataFrame:
    """(_id, _hash, spans array<struct<start, stop>>) of _keyed documents: the runs of bytes that are
    covered by strings of `length` bytes that also start elsewhere, not yet merged.

    First, the suffixes that can have a twin are found: those whose sync gram occurs twice. All
    others drop out before anything is sorted. The rest, equal runs once with their number, meet
    by sync gram, where all suffixes with equal first `length` bytes are together, and are sorted
    there: bucket by bucket, long ties by the ranks of a difference-cover sample. For a gram in
    more than GROUP_PIECES different runs, which no task should hold, strings of `length` bytes are
    counted by a 128-bit hash instead, combined before the shuffle."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pieces, at = [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                for base in range(0, max(1, len(text or b"") - length + 1), _SEGMENT):
                    pieces.append((text or b"")[base : base + _SEGMENT + length - 1])
                    at.append((i, base))
            row, base = np.array(at, np.int64).reshape(-1, 2).T
            for first, texts in slices(pieces):
                of, start, count, sync, body, twice = _sync_runs(texts, length, gram)
                columns = [batch.column(c).take(pa.array(row[first + of])) for c in ("_id", "_hash")]
                made = (start + base[first + of], count, sync.view(np.int64), body.view(np.int64), 1 + twice.astype(np.int64))
                columns += [pa.array(c) for c in made]
                yield pa.RecordBatch.from_arrays(columns, ["_id", "_hash", "start", "n", "sync", "body", "k"])

    texts = documents.select("_id", "_hash", F.col("text").cast("binary").alias("text"))
    # Written, as both the search for twins and the join with them read it.
    runs = stored(texts.mapInArrow(cut, "_id long, _hash long, start long, n long, sync long, body long, k long"), "runs")
    twins = runs.groupBy("sync").agg(F.sum("k").alias("all")).filter("all > 1").select("sync")
    live = stored(runs.join(twins.hint("merge"), "sync"), "live-runs")
    firsts = live.groupBy("sync", "body").agg(
        F.sum("k").alias("k"), F.count(F.lit(1)).alias("copies"),
        *[F.first(c).alias(c) for c in ("_id", "_hash", "start", "n")],
    )
    firsts = stored(firsts, "distinct-runs")
    large = firsts.groupBy("sync").count().filter(F.col("count") > GROUP_PIECES).select("sync", F.lit(True).alias("large"))
    wanted = firsts.join(large, "sync", "left").groupBy("_id", "_hash").agg(
        F.collect_list(F.struct("start", "n", "sync", "body", "copies", F.coalesce("large", F.lit(False)).alias("large"))).alias("runs")
    )

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        names = ["sync", "body", "copies", "n", "large", "piece"]
        for batch in batches:
            rows = []
            for packed, own in zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist(), strict=True):
                text = unzip.decompress(packed)
                rows.extend((r["sync"], r["body"], r["copies"], r["n"], r["large"], text[r["start"] : r["start"] + r["n"] + length - 1]) for r in own)
            columns = zip(*rows, strict=True) if rows else [[]] * 6
            kinds = [pa.int64()] * 4 + [pa.bool_(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    # Of rows that are equal, one is cut into pieces. The grouping brings the exchange of the join.
    once = _packed(texts).groupBy("_id", "_hash").agg(F.first("text").alias("text"))
    matched = once.hint("merge").join(wanted, ["_id", "_hash"])
    pieces = matched.mapInArrow(extract, "sync long, body long, copies long, n long, large boolean, piece binary")
    if large.isEmpty():
        found = _sorted_hits(pieces.drop("large"), length, gram)
    else:
        pieces = stored(pieces, "pieces")
        found = _sorted_hits(pieces.filter("NOT large").drop("large"), length, gram).unionByName(
            _counted_hits(pieces.filter("large").drop("large"), length)
        )
    spans = live.join(found.hint("merge"), ["sync", "body"]).select(
        "_id", "_hash", F.expr("inline(transform(hits, x -> named_struct('start', start + x.start, 'stop', start + x.stop)))")
    )
    # A set, as each of the equal rows has brought the same spans.
    return spans.groupBy("_id", "_hash").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))


_HITS = "sync long, body long, hits array<struct<start:long,stop:long>>"
_SPAN = pa.struct([("start", pa.int64()), ("stop", pa.int64())])


def _covered(hits: np.ndarray, length: int) -> list[dict[str, int]]:
    """The maximal runs of bytes that the windows with a hit cover."""
    at = np.flatnonzero(hits)
    if not len(at):
        return []
    gap = np.flatnonzero(np.diff(at) > length)
    return [{"start": int(a), "stop": int(b) + length} for a, b in zip(at[np.append(0, gap + 1)], at[np.append(gap, len(at) - 1)], strict=True)]


def _anchors(pieces: list[bytes], syncs: np.ndarray, gram: int) -> np.ndarray:
    """Where the sync gram of each piece first stands in it."""
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    first = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(pieces), np.uint8)
    at = np.arange(len(data) - gram + 1)
    hashes = span_hashes(prefix_hashes(data, False), at, at + gram)
    hit = np.flatnonzero(hashes == np.repeat(syncs, sizes)[: len(at)])
    return hit[np.searchsorted(hit, first)] - first


def _sorted_hits(pieces: DataFrame, length: int, gram: int) -> DataFrame:
    def work(groups: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for group in groups:
            held.append(group)
            size += group.nbytes
            if size >= SORT_BYTES:
                yield settle(pa.Table.from_batches(held))
                held, size = [], 0
        if held:
            yield settle(pa.Table.from_batches(held))

    def settle(table: pa.Table) -> pa.RecordBatch:
        texts = table.column("piece").to_pylist()
        anchors = _anchors(texts, np.asarray(table.column("sync")).view(np.uint64), gram)
        windows, copies = table.column("n").to_pylist(), np.asarray(table.column("copies"))
        hits = repeated_starts(texts, windows, copies, length, anchors)
        spans = pa.array([_covered(h, length) for h in hits], pa.list_(_SPAN))
        keys = [table.column(c).combine_chunks() for c in ("sync", "body")]
        return pa.RecordBatch.from_arrays([*keys, spans], ["sync", "body", "hits"])

    return map_groups(pieces, ["sync"], work, _HITS).filter("size(hits) > 0")


def _counted_hits(pieces: DataFrame, length: int) -> DataFrame:
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = np.asarray(batch.column("n"))
            row = np.repeat(np.arange(len(n)), n)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            texts = batch.column("piece").to_pylist()
            at = np.append(0, np.cumsum([len(t) for t in texts]))[row] + nth
            data = np.frombuffer(b"".join(texts), np.uint8)
            prefix = prefix_hashes(data, False)
            one = span_hashes(prefix, at, at + length)
            two = mix(span_hashes(prefix, at, at + length // 2) ^ (one >> np.uint64(7)))
            columns = [batch.column(c).take(pa.array(row)) for c in ("sync", "body", "copies")]
            made = (nth, one.view(np.int64), two.view(np.int64))
            yield pa.RecordBatch.from_arrays([*columns, *map(pa.array, made)], ["sync", "body", "copies", "nth", "one", "two"])

    each = pieces.mapInArrow(windows, "sync long, body long, copies long, nth long, one long, two long")
    twins = each.groupBy("one", "two").agg(F.sum("copies").alias("all")).filter("all > 1")
    hit = each.join(twins.hint("merge"), ["one", "two"]).groupBy("sync", "body").agg(F.collect_list("nth").alias("at"))
    return hit.select("sync", "body", F.expr(f"transform(at, x -> named_struct('start', x, 'stop', x + {length}L))").alias("hits"))


def remove_repeats(documents: DataFrame, length: int = 200, gram: int = 64) -> DataFrame:
    """Adds kept binary, n_bytes, n_removed and n_spans long to documents (doc_id, text, ...): the
    UTF-8 bytes of the text that no string of `length` bytes covers that also starts anywhere else,
    in this text or another, and the numbers of bytes, removed bytes and maximal removed runs.

    Strings are judged on the input; occurrences may overlap and never cross texts. All copies of a
    repeated string go. A null text counts as the empty one, repeated rows as copies. Other columns
    pass through, but for the text; columns of the four names are replaced. `gram` only decides how suffixes are
    dealt to tasks."""
    return _without_repeats(documents, length, gram, decoded=False)


def text_without_repeats(documents: DataFrame, length: int = 200, gram: int = 64) -> DataFrame:
    """`kept_text(remove_repeats(...))` in one pass over the rows: a second one in the same stage would
    hold a second Python worker per core, and an idle worker keeps its memory."""
    return _without_repeats(documents, length, gram, decoded=True)


_MADE = ("kept", "n_bytes", "n_removed", "n_spans")


def _without_repeats(documents: DataFrame, length: int, gram: int, decoded: bool) -> DataFrame:
    """The rows with what is left of their texts: as bytes, with the counts, or decoded as text."""
    row = packed_columns(documents, (*_MADE, "text"))
    keyed = _keyed(documents.select(row, "doc_id", F.coalesce("text", F.lit("")).alias("text")))
    spans = repeated_spans(keyed, length, gram)
    joined = _packed(keyed).hint("merge").join(spans, ["_id", "_hash"], "left")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        for batch in batches:
            kept, counts = [], []
            for packed, own in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                text = unzip.decompress(packed)
                parts, at, removed, runs, reach = [], 0, 0, 0, -1
                for start, stop in sorted((s["start"], s["stop"]) for s in own or ()):
                    if start > reach:
                        runs += 1
                        parts.append(text[max(at, 0) : start])
                        removed += stop - start
                        reach = stop
                    elif stop > reach:
                        removed += stop - reach
                        reach = stop
                    at = reach
                parts.append(text[max(at, 0) :])
                kept.append(b"".join(parts))
                counts.append((len(text), removed, runs))
            if decoded:
                yield pa.RecordBatch.from_arrays([batch.column("_row"), _decoded(kept)], ["_row", "text"])
                continue
            sums = np.array(counts, np.int64).reshape(-1, 3).T
            columns = [batch.column("_row"), pa.array(kept, pa.binary()), *map(pa.array, sums)]
            yield pa.RecordBatch.from_arrays(columns, ["_row", *_MADE])

    rows = joined.select("_row", "text", "spans")
    made = "text string" if decoded else "kept binary, n_bytes long, n_removed long, n_spans long"
    schema = f"_row {rows.schema['_row'].dataType.simpleString()}, {made}"
    return rows.mapInArrow(finish, schema).select("_row.*", *(["text"] if decoded else _MADE))


def _decoded(texts: list[bytes]) -> pa.Array:
    return pa.array([t.decode("utf-8", "ignore") for t in texts], pa.string())


def kept_text(cut: DataFrame) -> DataFrame:
    """The rows of remove_repeats with text string in place of kept and the counts. Bytes of
    characters that a cut divides are left out."""
    names = [c for c in cut.columns if c not in (*_MADE, "text")]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _decoded(batch.column("kept").to_pylist())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), texts], [*names, "text"])

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in cut.select(*names).schema)
    return cut.select(*names, "kept").mapInArrow(decode, f"{fields}text string")
