"""Substring deduplication: near-equal paragraphs by MinHash banding.

A paragraph is a stretch of a line from one sentence end to the next, so that a passage that stands
in the middle of a longer line is compared by itself. Short ones are left alone: such lines and
phrases recur in texts that have nothing else in common."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import stored
from spendlens.llm.neardup import near_duplicates
from spendlens.llm.signatures import minhash

#: Between paragraphs: after a line feed, and after the blank behind a sentence end.
_BREAK = "(?<=\n)|(?<=[.!?] )"
#: Bits of a paragraph's number in its id.
_NUMBER_BITS = 20


def tune_bands(similarity: float, recall: float, size: int) -> tuple[int, int]:
    """(bands, rows): the most rows per band, hence the fewest chance collisions, for which at most
    `size` hashes find a pair of the similarity with the probability `recall`."""
    best = (size, 1)
    for rows in range(1, size + 1):
        bands = math.ceil(math.log1p(-recall) / math.log1p(-(similarity**rows)))
        if bands * rows > size:
            break
        best = (bands, rows)
    return best


def _paragraphs(text: Column) -> Column:
    """The paragraphs of a text, each with the blank or the line feed that ends it."""
    return F.split(F.coalesce(text, F.lit("")), _BREAK)


def _number(documents: DataFrame) -> DataFrame:
    """(doc_id long, number int, id long, text) of every paragraph. The id tells paragraphs apart: both
    numbers, or where these have no room in one, a negative hash."""
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.posexplode(_paragraphs(F.col("text"))).alias("number", "text"),
    )
    fits = F.col("doc_id").between(0, (1 << (63 - _NUMBER_BITS)) - 1) & (F.col("number") < 1 << _NUMBER_BITS)
    packed = F.shiftleft("doc_id", _NUMBER_BITS) + F.col("number")
    hashed = -F.abs(F.xxhash64("doc_id", "number") % (1 << 62)) - 1
    identity = F.when(F.col("doc_id").isNotNull(), F.when(fits, packed).otherwise(hashed))
    return rows.select("doc_id", "number", identity.alias("id"), "text")


def repeated_paragraphs(
    documents: DataFrame,
    num: int = 80,
    den: int = 100,
    size: int = 5,
    min_words: int = 20,
    recall: float = 0.9999,
    hashes: int = 48,
) -> DataFrame:
    """Paragraphs of documents (doc_id, text) to remove: (doc_id long, number int, id long,
    component_id long), number counting the paragraphs of the text from 0.

    A paragraph is a sentence within a line, of `min_words` words or more. Two are linked if
    den * |intersection| >= num * |union| of their sets of `size` words; of each component the
    paragraph of the smallest document, and there the first, stays. Bands are tuned to find a linked
    pair with probability `recall` and every candidate is verified on full sets. Null and empty
    texts have no paragraph, a null doc_id keeps all of its, and rows of one doc_id count as one
    document."""
    bands, rows = tune_bands(num / den, recall, hashes)
    numbered = _number(documents).filter(F.regexp_count("text", F.lit(r"[^ \t-\r]+")) >= min_words)
    marks = near_duplicates(
        numbered.select(F.col("id").alias("doc_id"), "text"),
        num, den, size, bands, rows, signature=minhash, min_words=min_words,
    )
    # Ids are in the order of documents only where both numbers fit, so the survivor of a component is
    # looked for among its paragraphs.
    others = marks.filter("NOT kept").select(F.col("doc_id").alias("id"), "component_id").distinct()
    members = others.unionByName(others.select(F.col("component_id").alias("id"), "component_id").distinct())
    placed = stored(members.join(numbered.select("doc_id", "number", "id").distinct(), "id"), "repeated-paragraphs")
    first = placed.groupBy("component_id").agg(F.min(F.struct("doc_id", "number")).alias("_first"))
    gone = placed.join(first, "component_id").filter(F.struct("doc_id", "number") != F.col("_first"))
    return gone.select("doc_id", "number", "id", "component_id")


def removal_summary(documents: DataFrame, removed: DataFrame) -> DataFrame:
    """(doc_id long, n_paragraphs long, n_removed long, removed array<int>) per document row."""
    lists = removed.groupBy("doc_id").agg(F.array_sort(F.collect_list("number")).alias("removed"))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), _count(F.col("text")).alias("n_paragraphs"))
    return rows.join(lists, "doc_id", "left").select(
        "doc_id",
        "n_paragraphs",
        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("removed", F.array().cast("array<int>")).alias("removed"),
    )


def _count(text: Column) -> Column:
    some = F.filter(_paragraphs(text), lambda p: F.trim(F.regexp_replace(p, "\n", "")) != "")
    return F.size(some).cast("long")


def without_paragraphs(documents: DataFrame, removed: DataFrame) -> DataFrame:
    """The documents with the removed paragraphs taken out of their texts; all columns stay. A line
    that began with another paragraph keeps its line feed."""
    lists = removed.groupBy(F.col("doc_id").alias("_doc")).agg(F.collect_set("number").alias("_gone"))
    left = documents.join(lists, documents["doc_id"].cast("long") == F.col("_doc"), "left")
    parts = _paragraphs(F.col("text"))

    def kept(part: Column, i: Column) -> Column:
        inside = part.endswith("\n") & ~F.get(parts, i - 1).endswith("\n")
        return F.when(~F.array_contains(F.col("_gone"), i), part).when(inside, "\n").otherwise("")

    text = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(F.array_join(F.transform(parts, kept), ""))
    return left.withColumn("text", text).select(*documents.columns)


def estimated_recall(similarity: float, bands: int, rows: int) -> float:
    return float(1 - np.power(1 - similarity**rows, bands))
