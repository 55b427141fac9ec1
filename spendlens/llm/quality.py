"""Quality: document evidence combined with site and path posteriors by hierarchical empirical Bayes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import packed_columns, stored
from spendlens.llm.text import SPACED, Words, distinct_within, slices

_CLASSES = [
    (0x30, 0x3A),  # digits
    (0x41, 0x5B),  # capitals
    (0x61, 0x7B),  # small letters
    (0x80, 0x100),  # other alphabets
]
N_FEATURES = 12


@dataclass(frozen=True)
class QualityModel:
    means: np.ndarray
    scales: np.ndarray
    weights: np.ndarray
    bias: float


def _features(texts: list[bytes]) -> np.ndarray:
    """[texts, N_FEATURES] of writing style: lengths, shares of kinds of bytes, repetition."""
    words = Words(texts, SPACED)
    size = np.diff(np.append(words.text_starts, len(words.data))).astype(float)
    shares = []
    for low, high in _CLASSES:
        is_one = (words.data >= low) & (words.data < high)
        shares.append(np.add.reduceat(is_one, words.text_starts, dtype=np.int64) / size)
    lines = np.add.reduceat(words.data == 0x0A, words.text_starts, dtype=np.int64)
    n = np.maximum(words.counts, 1).astype(float)
    distinct = np.diff(distinct_within(words.hashes, words.bounds)[1])
    owner = np.repeat(np.arange(len(texts)), words.counts)
    length = (words.ends - words.starts).astype(float)
    same = np.zeros(len(words.hashes))
    same[1:] = (words.hashes[1:] == words.hashes[:-1]) & (owner[1:] == owner[:-1])
    mean = np.bincount(owner, length, len(texts)) / n
    spread = np.sqrt(np.maximum(0, np.bincount(owner, length**2, len(texts)) / n - mean**2))
    other = 1 - np.sum(shares, axis=0)
    return np.stack(
        [
            np.log1p(words.counts), *shares, other, np.log1p(lines), distinct / n, np.log1p(n) * distinct / n,
            np.bincount(owner, same, len(texts)) / n, mean, spread,
        ],
        axis=1,
    )


def fit_quality(labelled: DataFrame, sample_rows: int = 20_000, ridge: float = 1.0) -> QualityModel:
    """Logistic regression of labelled (text, quality 0 or 1), on about `sample_rows` rows at most,
    drawn by a hash of the text. Rows with a null text or another label are not used. Without
    both labels the model gives one half to every text."""
    rows = labelled.select("text", F.col("quality").cast("int").alias("quality"))
    rows = rows.filter("text IS NOT NULL AND quality IN (0, 1)")
    share = min(1.0, sample_rows / max(1, rows.count()))
    if share < 1:
        drawn = F.pmod(F.xxhash64("text", F.lit("sample")), F.lit(1 << 30))
        rows = rows.filter(drawn < int(share * (1 << 30)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in slices(batch.column("text").to_pylist()):
                made = pa.array(_features(texts).tolist(), pa.list_(pa.float64()))
                columns = [batch.column("quality").slice(first, len(texts)), made]
                yield pa.RecordBatch.from_arrays(columns, ["quality", "x"])

    binary = rows.select(F.col("text").cast("binary").alias("text"), "quality")
    sample = binary.mapInArrow(work, "quality int, x array<double>").collect()
    y = np.array([r[0] for r in sample], float)
    if not len(y) or y.min() == y.max():
        return QualityModel(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(2 * N_FEATURES), 0.0)
    x = np.array([r[1] for r in sample])
    means, scales = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    design = np.column_stack((_expand((x - means) / scales), np.ones(len(y))))
    beta = np.zeros(design.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        penalty = np.append(np.full(len(beta) - 1, ridge), 1e-6)
        hessian = (design * (p * (1 - p))[:, None]).T @ design + np.diag(penalty)
        step = np.linalg.solve(hessian, design.T @ (y - p) - penalty * beta)
        beta = beta + step
        if np.abs(step).max() < 1e-6:
            break
    return QualityModel(means, scales, beta[:-1], float(beta[-1]))


def _expand(z: np.ndarray) -> np.ndarray:
    z = np.clip(z, -6, 6)
    return np.column_stack((z, z**2))


def score_documents(documents: DataFrame, model: QualityModel) -> DataFrame:
    """Replaces the text of documents (text, ...) by evidence double, the probability of good
    quality by the text alone. A null, empty or wordless text has evidence 0."""
    kept = [c for c in documents.columns if c not in ("text", "evidence")]
    held = documents.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in batches:
            parts = [np.zeros(0)]
            for _, texts in slices(batch.column("text").to_pylist()):
                z = _expand((_features(texts) - model.means) / model.scales)
                p = 1 / (1 + np.exp(-np.clip(z @ model.weights + model.bias, -30, 30)))
                p[Words(texts, SPACED).counts == 0] = 0
                parts.append(p)
            columns = [batch.column(c) for c in kept] + [pa.array(np.concatenate(parts))]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "evidence"])

    frame = documents.select(*kept, F.col("text").cast("binary").alias("text"))
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in frame.select(*kept).schema)
    return frame.mapInArrow(score, f"{fields}evidence double")


def _logit(p: Column) -> Column:
    p = F.greatest(F.least(p, F.lit(1 - 1e-9)), F.lit(1e-9))
    return F.log(p / (1 - p))


def site_posteriors(scored: DataFrame) -> DataFrame:
    """For scored (host, path, evidence): one row (host, path, n_path, path_posterior, n_host,
    host_posterior, prior) per host and path.

    The prior is the mean evidence. A host's posterior is its mean evidence shrunk to the prior, a
    path's is its own shrunk to the host's, each with a pseudo-count that the data give: the
    within-group variance over the variance between groups, by moments. So sites with few documents
    stay near the level above. Only sums are grouped, combined before the shuffle, so a site that
    holds most documents costs no more. Null hosts and paths are sites of their own."""
    sums = (F.count(F.lit(1)).alias("n"), F.sum("evidence").alias("s"), F.sum(F.col("evidence") ** 2).alias("q"))
    paths = scored.groupBy("host", "path").agg(*sums)
    add = tuple(F.sum(c).alias(c) for c in ("n", "s", "q"))
    hosts = paths.groupBy("host").agg(*add)
    n, s, q, of_host = hosts.agg(
        F.sum("n"), F.sum("s"), F.sum("q"), F.struct(*_moments(F.lit(None)))
    ).first()
    if not n:
        prior, host_count, path_count = 0.5, 1.0, 1.0
    else:
        prior = s / n
        host_count = _pseudo_count(of_host, prior)
        nested = paths.join(hosts.select("host", (F.col("s") / F.col("n")).alias("up")), paths["host"].eqNullSafe(hosts["host"]))
        of_path = nested.agg(F.struct(*_moments(F.col("up")))).first()[0]
        path_count = _pseudo_count(of_path, None)
    host = (F.col("s") + host_count * prior) / (F.col("n") + host_count)
    up = hosts.select(F.col("host").alias("up"), F.col("n").alias("n_host"), host.alias("host_posterior"))
    path = (F.col("s") + path_count * F.col("host_posterior")) / (F.col("n") + path_count)
    joined = paths.join(up, F.col("host").eqNullSafe(F.col("up")))
    return joined.select(
        "host", "path", F.col("n").alias("n_path"), path.alias("path_posterior"), "n_host", "host_posterior",
        F.lit(float(prior)).alias("prior"),
    )


def _moments(up: Column) -> list[Column]:
    """Groups, rows, rows squared, the variance within groups and around the level above."""
    n, s, q = F.col("n"), F.col("s"), F.col("q")
    return [
        F.count(F.lit(1)).alias("k"), F.sum(n).alias("n"), F.sum(n.cast("double") * n).alias("nn"),
        F.sum(q - s * s / n).alias("within"), F.sum(s * s / n).alias("ss"), F.sum(s).alias("s"),
        F.sum(n * (s / n - up) ** 2).alias("around"),
    ]


def _pseudo_count(m, centre: float | None) -> float:
    """Within-group over between-group variance; large where groups do not differ."""
    k, n = m["k"], m["n"]
    if k < 2 or n <= k:
        return 1.0
    within = max(m["within"] / (n - k), 1e-12)
    around = m["around"] if centre is None else m["ss"] - 2 * centre * m["s"] + n * centre**2
    between = (around - (k - 1) * within) / max(n - m["nn"] / n, 1.0)
    return float(min(1e6, within / max(between, 1e-12)))


def hierarchical_quality(scored: DataFrame) -> DataFrame:
    """Adds host_posterior, path_posterior, quality double and keep boolean to scored (host, path,
    evidence, ...): quality is the probability by the text with the path's posterior in place of
    the common prior; keep is quality of a half or more. Columns of these names are replaced."""
    made = ("n_path", "path_posterior", "n_host", "host_posterior", "prior", "quality", "keep")
    # Read several times below; the texts that it comes from are read once.
    frame = stored(scored.select("host", "path", "evidence", packed_columns(scored, made)), "evidence")
    sites = site_posteriors(frame).withColumnsRenamed({"host": "_host", "path": "_path"})
    joined = frame.join(sites, F.col("host").eqNullSafe(F.col("_host")) & F.col("path").eqNullSafe(F.col("_path")))
    logit = _logit(F.col("evidence")) + _logit(F.col("path_posterior")) - _logit(F.col("prior"))
    quality = F.when(F.col("evidence") > 0, 1 / (1 + F.exp(-logit))).otherwise(0.0)
    return joined.select("_row.*", "host_posterior", "path_posterior", quality.alias("quality"), (quality >= 0.5).alias("keep"))
