"""The test tables as inputs of the package: ``events`` re-cast as purchases and sessions."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.operators.tenants import Tenants, build_catalogue
from spendlens.operators.windows import Windows

# Fixed values of the fixture mapping.
PLATFORM = "CASE event_id % 3 WHEN 0 THEN 'Android' WHEN 1 THEN 'iOS' ELSE 'Web' END"
PAYMENT_SYSTEM = "1 + CAST(get_json_object(props, '$.k') AS INT) % 3"
# One company and app, computed from a column: as literals they would vanish from the keys of
# joins and shuffles, which a stored table keeps.
COMPANY = "IF(event_id IS NULL, 'none', 'acme')"
MAIN = "IF(event_id IS NULL, 'none', 'main')"
APP = "concat('app', CAST(user_id % 2 AS STRING))"
SESSION_EVENTS = ["view", "click", "signup"]

FIRST_DAY = datetime(2024, 1, 1)
WEEK = timedelta(days=7)

# All 30 days of the test data are inside: five adjacent weeks, or 30 days.
WEEKS = Windows.every(FIRST_DAY, WEEK, 5)
DAYS = Windows.every(FIRST_DAY, timedelta(days=1), 30)
WEEK_2 = Windows.single(datetime(2024, 1, 8), datetime(2024, 1, 15))
# Overlapping windows, as days from the first.
LISTED = [(0, 10), (5, 6), (5, 20), (28, 30)]
OVERLAPPING = Windows.of(
    (FIRST_DAY + timedelta(hours=6 * n), FIRST_DAY + timedelta(hours=6 * n + 72)) for n in range(108)
)
MONTH = Windows.single(FIRST_DAY, datetime(2024, 1, 31))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def purchases(spark: SparkSession, sf_dir: str, app: str = MAIN) -> DataFrame:
    return (
        events(spark, sf_dir)
        .filter(F.col("event_type") == "purchase")
        .select(
            F.expr(COMPANY).alias("company"),
            F.expr(app).alias("app"),
            F.col("event_id").cast("string").alias("id"),
            F.col("user_id").cast("string").alias("user_id"),
            F.col("value").alias("price"),
            F.col("ts").alias("time"),
            F.expr(PLATFORM).alias("platform"),
            F.expr(PAYMENT_SYSTEM).alias("payment_system"),
        )
    )


def sessions(spark: SparkSession, sf_dir: str, app: str = MAIN) -> DataFrame:
    return (
        events(spark, sf_dir)
        .filter(F.col("event_type").isin(SESSION_EVENTS))
        .select(
            F.expr(COMPANY).alias("company"),
            F.expr(app).alias("app"),
            F.concat(F.col("user_id"), F.lit("-"), F.date_format("ts", "yyyyMMddHH")).alias("id"),
            F.col("user_id").cast("string").alias("user_id"),
            F.col("ts").alias("time"),
            F.expr(PLATFORM).alias("platform"),
        )
    )


def one_tenant(spark: SparkSession, *more_platforms: str) -> Tenants:
    platforms = ", ".join(f"'{p}'" for p in ("Android", "iOS", *more_platforms))
    return Tenants.of(
        spark.sql(
            f"SELECT * FROM VALUES ('acme', 'main', array({platforms}), array(1, 2))"
            " AS t(company, app, platforms, payment_systems)"
        )
    )


def company_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company documents (name, apps), built from the users in the events."""
    apps = events(spark, sf_dir).select(F.expr(APP).alias("app")).distinct()
    return apps.groupBy(F.lit("acme").alias("name")).agg(F.sort_array(F.collect_list("app")).alias("apps"))


def app_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Settings documents (appType, paymentSystems) of the two apps; they differ."""
    apps = events(spark, sf_dir).select(F.expr(APP).alias("app")).distinct()
    return apps.select(
        F.lit("acme").alias("company"),
        "app",
        F.expr("CASE app WHEN 'app0' THEN array('Android', 'iOS') ELSE array('Web', 'iOS') END").alias("appType"),
        F.expr("CASE app WHEN 'app0' THEN array(1, 2) ELSE array(2, 3) END").alias("paymentSystems"),
    )


def two_tenants(spark: SparkSession, sf_dir: str) -> Tenants:
    return Tenants.of(build_catalogue(company_documents(spark, sf_dir), app_documents(spark, sf_dir)))
