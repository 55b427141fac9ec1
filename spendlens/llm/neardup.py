"""Near duplicates by Jaccard similarity of word shingles: signatures, banding, exact verification
and connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import components, stored
from spendlens.llm.signatures import band_keys, superminhash
from spendlens.llm.text import SPACED, Words, distinct_within, mix, shingle_hashes, slices

Signature = Callable[[np.ndarray, np.ndarray, int], np.ndarray]

#: Members of a candidate group that one task compares with as many others; a larger group is
#: divided into parts of about this size, and every two parts meet in a task of their own.
PART_ROWS = 128
PART_SHINGLES = 400_000


def shingle_sets(texts: list[bytes], size: int, min_words: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text, sorted, and their bounds."""
    return distinct_within(*shingle_hashes(Words(texts, SPACED), size, min_words))


def fingerprints(
    items: DataFrame, size: int, signature: Signature, bands: int, rows: int, min_words: int = 1
) -> DataFrame:
    """(id, text_key long, n_shingles long, set_1 long, set_2 long, bands array<long>) for items (id
    long, text): a hash of the text, the size of the set of shingles, a 128-bit hash of the set, and
    one key per band."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, text_keys = batch.column("id"), batch.column("text_key")
            for first, texts in slices(batch.column("text").to_pylist()):
                values, bounds = shingle_sets(texts, size, min_words)
                sizes = np.diff(bounds)
                sums = [np.append(np.uint64(0), np.cumsum(mix(values + np.uint64(k)))) for k in (1, 2)]
                hashes = [mix(s[bounds[1:]] - s[bounds[:-1]]).view(np.int64) for s in sums]
                keys = band_keys(signature(values, bounds, bands * rows), rows)
                offsets = np.append(0, np.cumsum(np.where(sizes > 0, bands, 0))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[sizes > 0].ravel()))
                given = [c.slice(first, len(texts)) for c in (ids, text_keys)]
                columns = [*given, pa.array(sizes), *map(pa.array, hashes), lists]
                yield pa.RecordBatch.from_arrays(columns, FINGERPRINT)

    schema = "id long, text_key long, n_shingles long, set_1 long, set_2 long, bands array<long>"
    return _keyed_texts(items).mapInArrow(work, schema)


FINGERPRINT = ["id", "text_key", "n_shingles", "set_1", "set_2", "bands"]


def _keyed_texts(items: DataFrame) -> DataFrame:
    """(id long, text_key long, text binary): the hash tells the texts of one id apart."""
    text = F.col("text").cast("binary")
    return items.select(F.col("id").cast("long").alias("id"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def similar_edges(marked: DataFrame, items: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """Edges (a, b) between the items (id, text) whose sets have den * |intersection| >= num *
    |union|, enough of them to connect all items that such links connect. marked has (id, text_key,
    n_shingles, bands) of one item of each set; an id may have several texts.

    All members of a band are candidates of each other. They meet in the group of the band's
    smallest id, which compares full sets exactly and emits a spanning forest only, never all
    pairs. A member is a text, which comes once however many rows repeat it. Groups are divided
    into parts, so no task holds more than two parts."""
    exploded = marked.filter("id IS NOT NULL").select(F.explode("bands").alias("band"), *MEMBER)
    leaders = (
        exploded.groupBy("band")
        .agg(F.min("id").alias("leader"), F.max("id").alias("other"))
        .filter("leader <> other")
        .select("band", "leader")
    )
    members = exploded.join(leaders, "band").select("leader", *MEMBER).distinct()
    members = stored(members, "members")
    parts = members.groupBy("leader").agg(
        F.ceil(F.greatest(F.count(F.lit(1)) / PART_ROWS, F.sum("n_shingles") / PART_SHINGLES)).cast("int").alias("parts")
    )
    own = F.pmod(F.hash("id", "text_key", F.lit(7)), F.col("parts"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    placed = (
        members.join(parts, "leader")
        .select("leader", "id", "text_key", own.alias("own"), other.alias("other"))
        .select(
            "id",
            "text_key",
            F.struct("leader", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")).alias("place"),
        )
    )
    texts = _keyed_texts(items).filter("id IS NOT NULL").dropDuplicates(["id", "text_key"])
    rows = texts.hint("merge").join(placed, ["id", "text_key"]).select("place.leader", "place.i", "place.j", "id", "text")

    def compare(groups: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups:
            ids = np.asarray(group.column("id"))
            values, bounds = shingle_sets(group.column("text").to_pylist(), size)
            a, b = _forest(ids, values, bounds, num, den)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return map_groups(rows, ["leader", "i", "j"], compare, "a long, b long")


MEMBER = ["id", "text_key", "n_shingles"]


def map_groups(
    frame: DataFrame,
    keys: list[str],
    work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str,
) -> DataFrame:
    """Calls work with the rows of each group of integer keys, one record batch per group. Groups
    are streamed in order, so memory is bounded by one group and one batch."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [np.asarray(batch.column(k)) for k in keys]
            new = np.zeros(batch.num_rows, bool)
            for column in columns:
                new[1:] |= column[1:] != column[:-1]
            if held:
                last = [held[-1].column(k)[held[-1].num_rows - 1].as_py() for k in keys]
                new[0] = last != [c[0] for c in columns]
            edges = [*np.flatnonzero(new).tolist(), batch.num_rows]
            if edges[0] > 0:
                held.append(batch.slice(0, edges[0]))
            for start, stop in zip(edges[:-1], edges[1:], strict=True):
                if held:
                    yield _joined(held)
                held = [batch.slice(start, stop - start)]
        if held:
            yield _joined(held)

    return (
        frame.repartition(*keys)
        .sortWithinPartitions(*keys)
        .mapInArrow(lambda batches: work(stream(batches)), schema)
    )


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return batches[0] if len(batches) == 1 else pa.concat_batches(batches)


def _forest(ids: np.ndarray, values: np.ndarray, bounds: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between sets: the pairs that first joined two trees."""
    n, sizes = len(ids), np.diff(bounds)
    shared = _intersections(values, bounds)
    union = sizes[:, None] + sizes[None, :] - shared
    linked = np.triu(den * shared >= num * union, 1) & (sizes[:, None] > 0)
    a, b = [], []
    left = np.ones(n, bool)
    both = linked | linked.T
    for start in range(n):
        if not left[start]:
            continue
        left[start] = False
        queue = [start]
        while queue:
            k = queue.pop()
            fresh = np.flatnonzero(both[k] & left)
            left[fresh] = False
            queue.extend(fresh.tolist())
            a.extend([ids[k]] * len(fresh))
            b.extend(ids[fresh].tolist())
    return np.array(a, np.int64), np.array(b, np.int64)


def _intersections(values: np.ndarray, bounds: np.ndarray, block: int = 4096) -> np.ndarray:
    """How many values every two sets share, by products of blocks of the membership matrix."""
    n = len(bounds) - 1
    out = np.zeros((n, n), np.int64)
    owner = np.repeat(np.arange(n), np.diff(bounds))
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    column = np.cumsum(new) - 1
    common = np.bincount(column)[column] > 1 if len(values) else new
    column, owner = column[common], owner[common]
    if len(column):
        column = np.unique(column, return_inverse=True)[1]
        starts = np.searchsorted(column, np.arange(0, column[-1] + block + 1, block))
        for start, stop in zip(starts[:-1], starts[1:], strict=True):
            if stop > start:
                here = column[start:stop]
                part = np.zeros((n, here[-1] - here[0] + 1), np.float32)
                part[owner[start:stop], here - here[0]] = 1
                out += (part @ part.T).astype(np.int64)
    out[np.arange(n), np.arange(n)] = np.diff(bounds)
    return out


def near_duplicates(
    documents: DataFrame,
    num: int = 80,
    den: int = 100,
    size: int = 5,
    bands: int = 25,
    rows: int = 5,
    signature: Signature = superminhash,
    min_words: int = 1,
) -> DataFrame:
    """For documents (doc_id, text): one row (doc_id, n_shingles long, component_id long, kept
    boolean) per row. Documents are linked if den * |intersection| >= num * |union| of their sets
    of `size` words; component_id is the smallest doc_id that links reach, kept tells whether it
    is the document's own.

    Words are what ASCII white space divides, A-Z in lower case. A text of fewer words is one
    shingle. Without words, or with less than `min_words`, the set is empty: the document is linked with nothing and kept. A null
    doc_id is linked with nothing, has a null component_id and is kept. Rows of one doc_id count
    as one document that has the links of each. Other columns are ignored.

    Equal sets are collapsed first by a hash of the whole set, so exact copies cost no
    comparison. `bands` keys of `rows` signature values each find a pair of similarity s with
    probability 1 - (1 - s^rows)^bands: 99.99995 % at 0.85, 99.995 % at 0.8."""
    items = documents.select(F.col("doc_id").cast("long").alias("id"), "text")
    marked = stored(fingerprints(items, size, signature, bands, rows, min_words), "fingerprints")
    filled = marked.filter("n_shingles > 0 AND id IS NOT NULL")
    least = filled.groupBy("set_1", "set_2").agg(F.min(F.struct("id", "text_key")).alias("least"))
    bands_once = F.when(F.struct("id", "text_key") == F.col("least"), F.col("bands")).alias("bands")
    classed = stored(
        filled.join(least, ["set_1", "set_2"]).select(*MEMBER, F.col("least.id").alias("first"), bands_once), "classes"
    )
    leaders = classed.filter("bands IS NOT NULL")
    edges = similar_edges(leaders, items, size, num, den)
    copies = classed.filter("id <> first").select(F.col("first").alias("a"), F.col("id").alias("b"))
    reached = components(edges.union(copies))
    return (
        marked.select("id", "n_shingles")
        .join(reached, "id", "left")
        .select(
            F.col("id").alias("doc_id"),
            "n_shingles",
            F.coalesce("component", "id").alias("component_id"),
            (F.col("id").isNull() | (F.coalesce("component", "id") == F.col("id"))).alias("kept"),
        )
    )
