"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import packed_columns, stored
from spendlens.llm.text import mix, slices

#: Languages whose probabilities are broadcast and scored together; bounds a broadcast matrix to
#: 256 x 2^15 floats, 32 MB. More languages make more blocks, scored one after the other.
BLOCK_LANGUAGES = 256
#: Rows of counts per language that are broadcast at most; more are joined by a shuffle.
BROADCAST_LANGUAGES = 100_000
UNKNOWN = "und"


@dataclass(frozen=True)
class LanguageBlock:
    """Languages that follow each other by name."""

    languages: list[str]
    #: float32 [buckets, languages]: log probability of a hashed n-gram under a language.
    log_probability: np.ndarray
    log_prior: np.ndarray


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    #: The blocks as broadcasts, in the order of the languages.
    blocks: list[Broadcast[LanguageBlock]]
    sizes: tuple[int, ...]


def _grams(texts: list[bytes], sizes: tuple[int, ...], buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n: the bucket of each character n-gram and the index of its text. An n-gram that
    crosses texts or runs over white space of more than one character is not one. Digits and
    punctuation count as white space; a text stands between two spaces."""
    chars = [" " + t.decode("utf-8", "replace").lower() + " " for t in texts]
    code = np.frombuffer("\x00".join(chars).encode("utf-32-le", "replace"), np.uint32).copy()
    owner = np.repeat(np.arange(len(chars)), [len(c) + 1 for c in chars])[: len(code)]
    end = code == 0
    blank = (code < 0x41) | ((code > 0x5A) & (code < 0x61)) | ((code > 0x7A) & (code < 0xAA))
    code[blank] = 0x20
    code[end] = 0
    keep = np.ones(len(code), bool)
    keep[1:] = (code[1:] != 0x20) | (code[:-1] != 0x20)
    code, owner = code[keep].astype(np.uint64), owner[keep]
    packed = code.copy()
    crosses = code == 0
    for n in range(1, max(sizes) + 1):
        if n > 1:
            if len(code) < n:
                return
            packed = (packed[:-1] << np.uint64(21)) ^ (packed[:-1] >> np.uint64(43)) ^ code[n - 1 :]
            crosses = crosses[:-1] | (code[n - 1 :] == 0)
        if n in sizes:
            ok = ~crosses if n > 1 else ~crosses & (code != 0x20)
            bucket = mix(packed[ok] + np.uint64(n << 58)) & np.uint64(buckets - 1)
            yield bucket.astype(np.int64), owner[: len(packed)][ok]


def _has_letter(text: bytes) -> bool:
    return any(map(str.isalpha, text.decode("utf-8", "replace")))


def fit_languages(
    labelled: DataFrame,
    rows_per_language: int = 5_000,
    sizes: tuple[int, ...] = (1, 3),
    buckets: int = 1 << 15,
    alpha: float = 0.1,
    block: int = BLOCK_LANGUAGES,
) -> LanguageModel:
    """Fits on labelled (text, lang): the n-grams of about `rows_per_language` rows of each language,
    drawn by a hash of the text, so that a rare language is learned whole; the priors count all
    rows. Equal texts are drawn together, and each language has one text at least. Rows whose text or
    language is null are not used. Without any row the model is empty.

    No number of languages is refused. The counts are summed per language and bucket on the executors;
    the driver gets the summed matrix of `block` languages at a time, whose size `buckets` bounds."""
    rows = labelled.select("text", "lang").filter("text IS NOT NULL AND lang IS NOT NULL")
    draw = F.pmod(F.xxhash64("text", F.lit("sample")), F.lit(1 << 30))
    totals = stored(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("total"), F.min(draw).alias("least")), "languages")
    kinds, largest, everything = totals.agg(F.count(F.lit(1)), F.max("total"), F.sum("total")).first()
    if not kinds:
        return LanguageModel([], [], sizes)
    if largest > rows_per_language:
        share = F.lit(rows_per_language) / F.col("total") * (1 << 30)
        limits = totals.select("lang", F.greatest(F.ceil(share), F.col("least") + 1).alias("limit"))
        limits = F.broadcast(limits) if kinds <= BROADCAST_LANGUAGES else limits
        rows = rows.join(limits, "lang").filter(draw < F.col("limit")).select("text", "lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        documents: dict[str, int] = {}
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for first, texts in slices(batch.column("text").to_pylist()):
                here = langs[first : first + len(texts)]
                for lang in set(here):
                    sums.setdefault(lang, np.zeros(buckets, np.int64))
                    documents[lang] = documents.get(lang, 0) + here.count(lang)
                names = sorted(set(here))
                of_text = np.searchsorted(names, here)
                for bucket, owner in _grams(texts, sizes, buckets):
                    flat = np.bincount(of_text[owner] * buckets + bucket, minlength=len(names) * buckets)
                    for i, lang in enumerate(names):
                        sums[lang] += flat[i * buckets : (i + 1) * buckets]
        for lang, counts in sums.items():
            used = np.flatnonzero(counts)
            names = pa.array([lang] * (len(used) + 1))
            at = pa.array(np.append(-1, used).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [names, at, pa.array(np.append(documents[lang], counts[used]))], ["lang", "bucket", "n"]
            )

    binary = rows.select(F.col("text").cast("binary").alias("text"), "lang")
    sums = binary.mapInArrow(count, "lang string, bucket int, n long")
    counted = stored(sums.groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "language-counts")
    prior = dict(totals.select("lang", "total").toPandas().itertuples(index=False))
    languages = sorted(prior)
    context = labelled.sparkSession.sparkContext
    blocks = []
    for start in range(0, len(languages), block):
        names = languages[start : start + block]
        table = counted.filter(F.col("bucket").between(0, buckets - 1) & F.col("lang").between(names[0], names[-1])).toPandas()
        counts = np.full((buckets, len(names)), alpha)
        column = table["lang"].map({x: i for i, x in enumerate(names)}).to_numpy(np.int64)
        counts[table["bucket"].to_numpy(np.int64), column] += table["n"].to_numpy(np.float64)
        log_probability = np.log(counts / counts.sum(axis=0)).astype(np.float32)
        log_prior = np.log(np.array([prior[x] for x in names], np.float64) / everything)
        blocks.append(context.broadcast(LanguageBlock(names, log_probability, log_prior)))
    return LanguageModel(languages, blocks, sizes)


def predict_languages(documents: DataFrame, model: LanguageModel) -> DataFrame:
    """Adds (lang_pred string, score double) to (text, ...) and drops the text; other columns
    pass through, those of the two names are replaced. Only the text decides.

    score is the posterior of the predicted language, the evidence scaled to one log ratio per
    character, as n-grams of a text are not independent. A null text, one without a letter, or an
    empty model gives `und` with score 0. Equal posteriors give the first language by name.

    The blocks of a model are scored in a row in one job, each with its own broadcast: a row carries the
    best language so far, its evidence, and the sum of the scaled posteriors in relation to it."""
    documents = documents.select(*[c for c in documents.columns if c not in ("lang_pred", "score")])
    kept = [c for c in documents.columns if c != "text"]
    scored = documents.select(
        packed_columns(documents, without=("text",)) if kept else F.lit(0).alias("_row"),
        F.col("text").cast("binary").alias("text"),
        F.lit(None).cast("string").alias("_best"),
        F.lit(float("-inf")).alias("_top"),
        F.lit(0.0).alias("_total"),
    )
    schema = scored.schema
    for held in model.blocks:
        scored = scored.mapInArrow(_scorer(held, model.sizes), schema)
    known = F.col("_best").isNotNull()
    columns = [F.col("_row").getField(c).alias(c) for c in kept]
    return scored.select(
        *columns,
        F.coalesce("_best", F.lit(UNKNOWN)).alias("lang_pred"),
        F.when(known, 1 / F.col("_total")).otherwise(0.0).alias("score"),
    )


def _scorer(held: Broadcast[LanguageBlock], sizes: tuple[int, ...]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = held.value
        matrix = np.ascontiguousarray(block.log_probability.T, np.float64)
        for batch in batches:
            best, tops, totals = [], [], []
            before = batch.column("_best").to_pylist()
            top_before = np.asarray(batch.column("_top"))
            total_before = np.asarray(batch.column("_total"))
            for first, texts in slices(batch.column("text").to_pylist()):
                span = slice(first, first + len(texts))
                sums = np.tile(block.log_prior, (len(texts), 1))
                for bucket, owner in _grams(texts, sizes, matrix.shape[1]):
                    bounds = np.searchsorted(owner, np.arange(len(texts)))
                    some = np.diff(np.append(bounds, len(owner))) > 0
                    if some.any():
                        for k in range(len(block.languages)):
                            sums[some, k] += np.add.reduceat(matrix[k][bucket], bounds[some])
                lengths = np.maximum(1, np.fromiter(map(len, texts), np.int64, len(texts)))
                scale = np.log2(lengths + 1)
                at, here = sums.argmax(axis=1), sums.max(axis=1)
                top = np.maximum(here, top_before[span])
                total = np.exp((sums - top[:, None]) / scale[:, None]).sum(axis=1)
                total += total_before[span] * np.exp((top_before[span] - top) / scale)
                better = here > top_before[span]
                for i, text in enumerate(texts):
                    lettered = before[first + i] is not None or _has_letter(text)
                    best.append((block.languages[at[i]] if better[i] else before[first + i]) if lettered else None)
                tops.append(top)
                totals.append(total)
            columns = [batch.column("_row"), batch.column("text"), pa.array(best, pa.string())]
            columns += [pa.array(np.concatenate([*x, np.zeros(0)])) for x in (tops, totals)]
            yield pa.RecordBatch.from_arrays(columns, ["_row", "text", "_best", "_top", "_total"])

    return score
