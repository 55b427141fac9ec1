"""Raw documents to the normalised purchase, session and profile tables.

Rows without a readable time or platform are dropped; a missing user is kept as null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlens.functions.parsing import any_time, coerce_double, coerce_int, epoch_ms, json_field
from spendlens.schema import TENANT
from spendlens.sources.rejects import CORRUPT, accepted, marked


def read_documents(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json") -> DataFrame:
    """Scan raw documents under a fixed schema; nothing is inferred."""
    return spark.read.format(fmt).schema(schema).load(path)


def _tenant(raw: DataFrame, company: str | None, app: str | None) -> list[Column]:
    given = {"company": company, "app": app}
    return [F.col(c) if given[c] is None else F.lit(given[c]).alias(c) for c in TENANT]


def _field(raw: DataFrame, name: str) -> tuple[Column, T.DataType]:
    return F.col(name), raw.schema[name].dataType


def _corrupt(raw: DataFrame) -> list[Column]:
    return [F.col(CORRUPT)] if CORRUPT in raw.columns else []


def _readable(raw: DataFrame, rows: DataFrame) -> DataFrame:
    if CORRUPT in raw.columns:
        return accepted(rows)
    return rows.filter(F.col("time").isNotNull() & F.col("platform").isNotNull()).drop("reject")


def mark_purchases(raw: DataFrame, company: str | None = None, app: str | None = None) -> DataFrame:
    """All records, also those that cannot be read, with the column ``reject`` of ``sources.rejects``."""
    rows = raw.select(
        *_tenant(raw, company, app),
        F.col("id").cast("string").alias("id"),
        F.col("userId").cast("string").alias("user_id"),
        coerce_double(F.col("price")).alias("price"),
        any_time(*_field(raw, "time")).alias("time"),
        json_field(*_field(raw, "device"), "osType").alias("platform"),
        coerce_int(F.col("paymentSystem")).alias("payment_system"),
        *_corrupt(raw),
    )
    return marked(raw, rows)


def normalize_purchases(raw: DataFrame, company: str | None = None, app: str | None = None) -> DataFrame:
    """``company`` and ``app`` are columns of ``raw`` unless given (one table per tenant)."""
    return _readable(raw, mark_purchases(raw, company, app))


def mark_sessions(raw: DataFrame, company: str | None = None, app: str | None = None) -> DataFrame:
    """All records, also those that cannot be read, with the column ``reject`` of ``sources.rejects``."""
    rows = raw.select(
        *_tenant(raw, company, app),
        F.col("id").cast("string").alias("id"),
        F.col("userId").cast("string").alias("user_id"),
        any_time(*_field(raw, "startTime")).alias("time"),
        json_field(*_field(raw, "device"), "osType").alias("platform"),
        *_corrupt(raw),
    )
    return marked(raw, rows)


def normalize_sessions(raw: DataFrame, company: str | None = None, app: str | None = None) -> DataFrame:
    return _readable(raw, mark_sessions(raw, company, app))


def normalize_profiles(raw: DataFrame, company: str | None = None, app: str | None = None) -> DataFrame:
    """User profiles with the columns of their tenant, the form that the journeys take."""
    return raw.select(*_tenant(raw, company, app), "userId", "purchases", "sessions")


def profile_purchases(profiles: DataFrame, company: str | None = None, app: str | None = None) -> DataFrame:
    """One row per purchase nested in a user profile."""
    return (
        profiles.select(
            *_tenant(profiles, company, app),
            F.col("userId").cast("string").alias("user_id"),
            F.explode("purchases").alias("item"),
        )
        .select(
            *TENANT,
            "user_id",
            epoch_ms(F.col("item.time")).alias("time"),
            F.col("item.platform").alias("platform"),
            coerce_int(F.col("item.paymentSystem")).alias("payment_system"),
        )
        .filter(F.col("time").isNotNull() & F.col("platform").isNotNull())
    )


def profile_sessions(profiles: DataFrame, company: str | None = None, app: str | None = None) -> DataFrame:
    """One row per session nested in a user profile."""
    return (
        profiles.select(
            *_tenant(profiles, company, app),
            F.col("userId").cast("string").alias("user_id"),
            F.explode("sessions").alias("item"),
        )
        .select(
            *TENANT,
            "user_id",
            epoch_ms(F.col("item.startTime")).alias("time"),
            F.col("item.platform").alias("platform"),
        )
        .filter(F.col("time").isNotNull() & F.col("platform").isNotNull())
    )
