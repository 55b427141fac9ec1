"""Toxicity: ordinal regression with cumulative logit links on sparse word features."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import stored
from spendlens.llm.text import ALNUM, Words, distinct_within, slices


@dataclass(frozen=True)
class SeverityModel:
    #: Sorted word hashes, and the weight of each: the same for all thresholds.
    features: np.ndarray
    weights: np.ndarray
    #: Ascending: P(grade >= k) = sigmoid(x . weights - thresholds[k - 1]).
    thresholds: np.ndarray


def fit_severity(
    labelled: DataFrame,
    sample_rows: int = 20_000,
    max_features: int = 4096,
    min_z: float = 6.0,
    min_rows: int = 3,
    toxic_levels: int = 2,
    penalty: float = 1e-5,
) -> SeverityModel:
    """Fits on labelled (text, grade int), grades from 0, on about `sample_rows` rows at most,
    drawn by a hash of the text. Rows with a null text or grade are not used.

    The features are the words that at least `min_rows` rows have and whose share of rows differs
    most between grade 0 and the higher grades (two-proportion z of `min_z` or more, the
    `max_features` largest); they are found by a grouped count on the executors. If the labels
    know only 0 and 1, grade 1 is divided into `toxic_levels` grades at the quantiles of the
    number of feature words in a row, which stands in for severity. The driver gets the sparse
    rows of the sample, which `sample_rows` and `max_features` bound."""
    rows = labelled.select("text", F.col("grade").cast("int").alias("grade")).filter(
        "text IS NOT NULL AND grade IS NOT NULL AND grade >= 0"
    )
    total, bad = rows.agg(F.count(F.lit(1)), F.count_if(F.col("grade") > 0)).first()
    nothing = SeverityModel(np.zeros(0, np.uint64), np.zeros(0), np.array([np.inf]))
    if not bad or bad == total:
        return nothing
    share = min(1.0, sample_rows / total)
    if share < 1:
        drawn = F.pmod(F.xxhash64("text", F.lit("sample")), F.lit(1 << 30))
        rows = rows.filter(drawn < int(share * (1 << 30)))
    rows = stored(rows.select(F.col("text").cast("binary").alias("text"), "grade"), "labelled")

    def words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grades = batch.column("grade").to_numpy(zero_copy_only=False)
            for first, texts in slices(batch.column("text").to_pylist()):
                words = Words(texts, ALNUM)
                values, bounds = distinct_within(words.hashes, words.bounds)
                of = np.repeat(grades[first : first + len(texts)] > 0, np.diff(bounds))
                some, at = np.unique(values, return_inverse=True)
                columns = [some.view(np.int64), np.bincount(at, ~of), np.bincount(at, of)]
                columns = [columns[0], *(c.astype(np.int64) for c in columns[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["word", "clean", "toxic"])

    sizes = rows.agg(F.count_if(F.col("grade") == 0), F.count_if(F.col("grade") > 0)).first()
    n0, n1 = (max(1, n) for n in sizes)
    counts = rows.mapInArrow(words_of, "word long, clean long, toxic long").groupBy("word")
    counts = counts.agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    pooled = (F.col("clean") + F.col("toxic") + 1) / (n0 + n1 + 2)
    z = (F.col("toxic") / n1 - F.col("clean") / n0) / F.sqrt(pooled * (1 - pooled) * (1 / n0 + 1 / n1))
    chosen = (
        counts.withColumn("z", z)
        .filter((F.col("clean") + F.col("toxic") >= min_rows) & (F.abs("z") >= min_z))
        .orderBy(F.abs("z").desc(), "word")
        .limit(max_features)
        .select("word", "z")
        .collect()
    )
    if not chosen:
        return nothing
    features = np.array([w for w, _ in chosen], np.int64).view(np.uint64)
    order = np.argsort(features)
    features, signs = features[order], np.array([z for _, z in chosen])[order]

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grades = batch.column("grade").to_numpy(zero_copy_only=False)
            for first, texts in slices(batch.column("text").to_pylist()):
                owner, at = _matches(Words(texts, ALNUM), features)
                parts = np.split(at, np.searchsorted(owner, np.arange(1, len(texts))))
                grade = pa.array(grades[first : first + len(texts)].astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [grade, pa.array([p.tolist() for p in parts], pa.list_(pa.int32()))], ["grade", "at"]
                )

    sample = rows.mapInArrow(sparse, "grade int, at array<int>").collect()
    grades = np.array([r[0] for r in sample])
    owner = np.repeat(np.arange(len(sample)), [len(r[1]) for r in sample])
    at = np.array([k for r in sample for k in r[1]], np.int64)
    if grades.max() == 1 and toxic_levels > 1:
        evidence = np.bincount(owner, signs[at] > 0, len(sample))
        cuts = np.quantile(evidence[grades == 1], np.arange(1, toxic_levels) / toxic_levels)
        grades = np.where(grades == 1, 1 + np.searchsorted(cuts, evidence, "left"), 0)
    weights, thresholds = _fit(grades, owner, at, len(features), penalty)
    return SeverityModel(features, weights, thresholds)


def _matches(words: Words, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The text and the feature of every word that is a feature."""
    place = np.minimum(np.searchsorted(features, words.hashes), max(0, len(features) - 1))
    is_one = np.flatnonzero(features[place] == words.hashes) if len(features) else np.zeros(0, np.int64)
    return np.searchsorted(words.bounds, is_one, "right") - 1, place[is_one]


def _cells(owner: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse design: text, feature and value log(1 + count)."""
    key, count = np.unique(owner.astype(np.int64) * width + at, return_counts=True)
    return key // width, key % width, np.log1p(count)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _fit(grades: np.ndarray, owner: np.ndarray, at: np.ndarray, width: int, penalty: float) -> tuple[np.ndarray, np.ndarray]:
    """Maximum penalised likelihood of the proportional-odds model, by gradient steps with
    adaptive rates. Thresholds are a first one and positive gaps, so they stay in order."""
    rows, columns, values = _cells(owner, at, width)
    n, top = len(grades), int(grades.max())
    reach = np.clip([(grades >= k).mean() for k in range(1, top + 1)], 1e-6, 1 - 1e-6)
    start = -np.log(reach / (1 - reach))
    free = np.concatenate((np.zeros(width), start[:1], np.log(np.maximum(np.diff(start), 1e-2))))
    first, second = np.zeros_like(free), np.zeros_like(free)
    for step in range(1, 1501):
        weights, theta = free[:width], np.cumsum(np.append(free[width], np.exp(free[width + 1 :])))
        score = np.bincount(rows, values * weights[columns], n)
        edges = np.concatenate(([-np.inf], theta, [np.inf]))
        below, above = _sigmoid(edges[grades] - score), _sigmoid(edges[grades + 1] - score)
        mass = np.maximum(above - below, 1e-12)
        slope_below, slope_above = below * (1 - below), above * (1 - above)
        by_score = (slope_above - slope_below) / mass / n
        by_theta = np.array(
            [((grades == k) * slope_below - (grades == k - 1) * slope_above)[...] @ (1 / mass) / n for k in range(1, top + 1)]
        )
        tail = np.cumsum(by_theta[::-1])[::-1]
        gradient = np.concatenate(
            (
                np.bincount(columns, by_score[rows] * values, width) + penalty * weights,
                tail[:1],
                tail[1:] * np.exp(free[width + 1 :]),
            )
        )
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        free = free - 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
    return free[:width], np.cumsum(np.append(free[width], np.exp(free[width + 1 :])))


def score_severity(documents: DataFrame, model: SeverityModel) -> DataFrame:
    """Adds severity double (the expected grade), grade int (how many thresholds are passed with a
    probability of a half or more) and p_toxic double (that of grade 1 or more) to documents, which
    must have `text`; other columns pass through, those of the three names are replaced.

    Whole texts are scored, without a shuffle. A null, empty or wordless text has grade 0 and no
    probability of more; so has every text under a model without features."""
    made = ("severity", "grade", "p_toxic")
    frame = documents.select(*[c for c in documents.columns if c not in made])
    held = documents.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        width = max(1, len(model.features))
        for batch in batches:
            reached = [np.zeros((0, len(model.thresholds)))]
            column = batch.column("text")
            binary = column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())
            for _, texts in slices(binary.to_pylist()):
                words = Words(texts, ALNUM)
                rows, columns, values = _cells(*_matches(words, model.features), width)
                evidence = np.bincount(rows, values * model.weights[columns] if len(rows) else None, len(texts))
                p = _sigmoid(evidence[:, None] - model.thresholds)
                p[words.counts == 0] = 0
                reached.append(p)
            p = np.concatenate(reached)
            made = [pa.array(p.sum(axis=1)), pa.array((p >= 0.5).sum(axis=1).astype(np.int32))]
            made.append(pa.array(p[:, 0].copy()))
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*batch.schema.names, "severity", "grade", "p_toxic"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema)
    return frame.mapInArrow(score, f"{fields}, severity double, grade int, p_toxic double")
