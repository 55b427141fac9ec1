"""A corpus pipeline over `documents`: toxic documents go, one of each group of near duplicates
stays, repeated passages are cut, contaminated documents go, and the rest is mixed by source."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from spendlens.llm.common import packed_columns, stored  # noqa: E402
from spendlens.llm.decontamination import find_benchmark  # noqa: E402
from spendlens.llm.mixing import mix_sources  # noqa: E402
from spendlens.llm.neardup import near_duplicates  # noqa: E402
from spendlens.llm.queries import labelled_sample, table  # noqa: E402
from spendlens.llm.suffixes import text_without_repeats  # noqa: E402
from spendlens.llm.toxicity import fit_severity, score_severity  # noqa: E402

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of severity grade 0, by a model fitted on the labelled among them. Null and empty
    texts have grade 0 and stay."""
    labelled = labelled_sample(spark, sf_dir, docs, "toxic").withColumnRenamed("toxic", "grade")
    scored = score_severity(docs, fit_severity(labelled))
    return scored.filter("grade = 0").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, that of the smallest id, of each group of near duplicates: five-word shingles, a
    similarity of 0.8 or more. Documents without words stay. Rows are compared by a key of their
    own, so of those with one id or without an id also one stays; a null id comes last."""
    table(spark, sf_dir, "documents")
    keyed = stored(docs.select(F.monotonically_increasing_id().alias("_key"), packed_columns(docs)), "keyed")
    marks = near_duplicates(keyed.select(F.col("_key").alias("doc_id"), "_row.text"))
    groups = stored(marks.select(F.col("doc_id").alias("_key"), "component_id"), "groups")
    grouped = groups.groupBy("component_id").count().filter("count > 1").select("component_id")
    members = groups.join(grouped, "component_id").join(keyed.select("_key", F.col("_row.doc_id").alias("id")), "_key")
    order = F.struct(F.col("id").isNull(), "id", "_key")
    stays = members.groupBy("component_id").agg(F.min(order)["_key"].alias("stays"))
    gone = members.join(stays, "component_id").filter("_key <> stays").select("_key")
    return keyed.join(gone.hint("merge"), "_key", "left_anti").select("_row.*")


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the bytes of strings of 200 that also start elsewhere; n_chars is
    counted anew. A character that a cut divides goes as a whole. Null texts become empty."""
    table(spark, sf_dir, "documents")
    cut = text_without_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of ten words of a benchmark item occurs."""
    found = find_benchmark(docs, table(spark, sf_dir, "benchmark"))
    return found.filter("n_hit = 0").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their place in a mix by the root of the sources' sizes."""
    return mix_sources(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("suffix_repeats", cut_repeats),
    ("decontamination", drop_contaminated),
    ("mixing", mix),
]

#: The fitted model of the first stage has no SQL form; tests/llm compares each stage with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
