"""The operators as queries over the whole test tables, and those that SQL can express in SQL."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.llm.common import id_hash_mod, ship_package
from spendlens.llm.decontamination import find_benchmark
from spendlens.llm.language import fit_languages, predict_languages
from spendlens.llm.lattice import VOCABULARY, score_texts
from spendlens.llm.mixing import mix_sources
from spendlens.llm.neardup import near_duplicates
from spendlens.llm.oracles import ORACLES
from spendlens.llm.packing import Limits, documents_as_examples, pack_examples
from spendlens.llm.paragraphs import removal_summary, repeated_paragraphs
from spendlens.llm.periodic import periodic_runs
from spendlens.llm.quality import fit_quality, hierarchical_quality, score_documents
from spendlens.llm.similarity import similar_vectors
from spendlens.llm.suffixes import remove_repeats
from spendlens.llm.toxicity import fit_severity, score_severity
from spendlens.llm.whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_epsilon_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_vectors(table(spark, sf_dir, "embeddings"), threshold=0.93)


def op2_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents").select("doc_id", "source"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source of a document is its host, the language section of the source its path."""
    documents = table(spark, sf_dir, "documents")
    labelled = labelled_sample(spark, sf_dir, documents, "quality")
    rows = documents.select("doc_id", F.col("source").alias("host"), F.col("lang").alias("path"), "text")
    return hierarchical_quality(score_documents(rows, fit_quality(labelled)))


def op4_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), num=85, den=100)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_benchmark(documents, table(spark, sf_dir, "benchmark"), window=10)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op6_lattice(spark: SparkSession, sf_dir: str, vocabulary: str = VOCABULARY) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    train = id_hash_mod("doc_id", 5) != 1
    scored = score_texts(documents.select("doc_id", "text", train.alias("train")), vocabulary)
    return scored.withColumn("held_out", ~F.col("train")).drop("train")


#: Labelled documents that a model is fitted on at most.
LABEL_SAMPLE = 20_000


def labelled_sample(spark: SparkSession, sf_dir: str, documents: DataFrame, label: str) -> DataFrame:
    """(text, label) of at most about LABEL_SAMPLE labelled documents. The labels are drawn by a hash
    of the id before the join, whose bound allows to broadcast them, so the texts are not shuffled."""
    labels = table(spark, sf_dir, "labels").filter(F.col(label).isNotNull()).select("doc_id", label)
    share = LABEL_SAMPLE / max(1, labels.count())
    if share < 1:
        drawn = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30))
        labels = labels.filter(drawn < int(share * (1 << 30)))
    few = F.broadcast(labels.limit(2 * LABEL_SAMPLE))
    return documents.select("doc_id", "text").join(few, "doc_id").select("text", label)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    labelled = labelled_sample(spark, sf_dir, documents, "toxic").withColumnRenamed("toxic", "grade")
    model = fit_severity(labelled)
    scored = score_severity(documents, model)
    return scored.select("doc_id", "severity", "grade", "p_toxic", (F.col("grade") > 0).alias("toxic"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held_out = id_hash_mod("doc_id", 5) == 0
    model = fit_languages(documents.filter(~held_out).select("text", "lang"))
    return predict_languages(documents.select("doc_id", "text", held_out.alias("held_out")), model)


def op9_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), length=200)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    summary = removal_summary(documents, repeated_paragraphs(documents))
    return summary.withColumn("removed", F.array_join(F.col("removed").cast("array<string>"), ","))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per vector and component. A deviation beyond a long is null; `deviation_exact` has it."""
    found = whiten(table(spark, sf_dir, "embeddings"), n_components=16, scale=64, offset=1_000_000)
    per_component = found.select("*", F.posexplode(F.arrays_zip("whitened", "explained", "eigenvalues")).alias("at", "_c"))
    return per_component.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        "n",
        F.expr("try_cast(deviation AS BIGINT)").alias("deviation"),
        F.col("_c.whitened").alias("whitened"),
        F.col("_c.explained").alias("explained"),
        "identity_error",
        F.col("_c.eigenvalues").alias("eigenvalue"),
        F.col("deviation").alias("deviation_exact"),
    )


def planted_repetition(doc_id: object, n: int) -> np.ndarray | None:
    """The words of one document in ten repeat with a period from a place on, both drawn by its id."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % (1 + (n - a) // (3 + g % 8)))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(table(spark, sf_dir, "documents"), min_length=6, min_exponent=4, edit=planted_repetition)
    # Runs come by start and period, so the first one of the greatest exponent wins.
    best = F.expr(
        "aggregate(runs, CAST(NULL AS STRUCT<start: BIGINT, length: BIGINT, period: BIGINT>),"
        " (b, r) -> IF(b IS NULL OR r.length * b.period > b.length * r.period, r, b))"
    )
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.array_join(F.transform(line, lambda text: F.concat(text, F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("best.length * 1000 DIV best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    examples = documents_as_examples(table(spark, sf_dir, "documents"))
    pieces = pack_examples(examples, Limits(tokens=2048, segments=128, loss=2048))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


QUERIES: dict[str, Query] = {
    "op1_epsilon_grid": op1_epsilon_grid,
    "op2_pfair_mix": op2_pfair_mix,
    "op3_quality": op3_quality,
    "op4_superminhash": op4_superminhash,
    "op5_decontamination": op5_decontamination,
    "op6_lattice": op6_lattice,
    "op7_toxicity": op7_toxicity,
    "op8_language": op8_language,
    "op9_suffixes": op9_suffixes,
    "op10_paragraphs": op10_paragraphs,
    "op11_whitening": op11_whitening,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_packing": op13_packing,
}

__all__ = ["ORACLES", "QUERIES"]
