"""Raw records that cannot be read: kept apart and counted by reason, in the pass that stores the rest."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlens.schema import TENANT

# The column in which Spark leaves the text of a record that it cannot parse.
CORRUPT = "_corrupt_record"
# In order: a record counts under the first that holds.
REASONS = ["record", "time", "platform"]
READ = "none"


def with_corrupt(schema: T.StructType) -> T.StructType:
    """A raw schema for ``read_documents`` that also tells unreadable records apart."""
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def marked(raw: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows``, the normalised columns of ``raw`` with their unreadable values as null, and
    ``reject``: the first of REASONS that holds, or READ."""
    corrupt = F.col(CORRUPT).isNotNull() if CORRUPT in raw.columns else F.lit(False)
    reason = (
        F.when(corrupt, "record").when(F.col("time").isNull(), "time").when(F.col("platform").isNull(), "platform")
    )
    return rows.withColumn("reject", reason.otherwise(READ)).drop(CORRUPT)


def counted(rows: DataFrame, observation: Observation) -> DataFrame:
    """The same rows; whichever action reads them first also leaves ``rows`` and one count per
    reason in the observation."""
    by_reason = [F.count_if(F.col("reject") == r).alias(r) for r in REASONS]
    return rows.observe(observation, F.count(F.lit(1)).alias("rows"), *by_reason)


def accepted(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("reject") == READ).drop("reject")


@dataclass(frozen=True)
class Landing:
    """Marked rows in storage, a folder per reason: the rejected are neither read with the others
    nor lost, and their counts per tenant cost no second scan of the documents."""

    root: str

    def add(self, rows: DataFrame) -> None:
        rows.write.mode("append").partitionBy("reject").parquet(self.root)

    def rows(self, spark: SparkSession) -> DataFrame:
        return accepted(spark.read.parquet(self.root))

    def rejected(self, spark: SparkSession) -> DataFrame:
        """(company, app, reason, n long) of what was rejected."""
        gone = spark.read.parquet(self.root).filter(F.col("reject") != READ)
        return gone.groupBy(*TENANT, F.col("reject").alias("reason")).agg(F.count("*").alias("n"))
