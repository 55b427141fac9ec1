"""Exact distinct users over any span of days, from bitmaps that are kept by day.

A distinct count of a week cannot be had from those of its days, but from their sets it can. Every
user of a tenant gets a number, once; a day and platform is a set of numbers, stored as bitmaps of
32,768 bits. Sets of days and platforms are united bit by bit, and bits are counted: the sessions
are read once, when they arrive, and longer spans cost a few bytes per user and day.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spendlens.operators.tenants import Tenants
from spendlens.plans.cubes import USER
from spendlens.schema import TENANT
from spendlens.sources.store import Run, Store

CODES, DAILY = "user_codes", "daily_users"
CODES_SCHEMA = "company string, app string, user_id string, code long"
DAILY_SCHEMA = "company string, app string, platform string, day date, bucket long, bits binary"
# Users of a tenant are numbered in so many parts side by side.
SHARDS = 1024


@dataclass(frozen=True)
class DailyUsers:
    """The numbers of users and the daily bitmaps under ``root``. A missing user is one of them."""

    root: str

    def advance(self, spark: SparkSession, sessions: DataFrame, label: str | None = None) -> bool:
        """Take in the sessions that have arrived since the last batch, of any time: late ones add
        bitmaps to their day. Each batch is one published run; one whose ``label`` was taken in
        before is left out, and the result is then False."""
        store = Store(self.root)
        if label is not None and any(r.label == label for r in store.published(spark)):
            return False
        run = store.begin(label)
        days = sessions.select(*USER, "platform", F.col("time").cast("date").alias("day")).distinct()
        seen = run.scratch(days.filter("company IS NOT NULL AND app IS NOT NULL"), "seen")
        known = store.rows(spark, CODES, CODES_SCHEMA).drop("_sequence")
        fresh = _numbered(run, seen.select(*USER).distinct(), known)
        run.append(fresh, CODES)
        codes = known.unionByName(fresh)
        coded = seen.join(codes, _same_user(seen, codes)).select(
            *[seen[c] for c in TENANT], "platform", "day", F.bitmap_bucket_number("code").alias("bucket"), "code"
        )
        bits = F.bitmap_construct_agg(F.bitmap_bit_position("code")).alias("bits")
        run.append(coded.groupBy(*TENANT, "platform", "day", "bucket").agg(bits), DAILY)
        run.publish(spark)
        return True

    def users(self, spark: SparkSession, spans: Iterable[tuple[date, date]], tenants: Tenants | None = None) -> DataFrame:
        """(company, app, lower, upper, platform, users long): distinct users from the day ``lower`` up to
        the day before ``upper``, per platform and, with a null platform, over all of them, where a
        user of two counts once. With tenants, only on configured platforms. Spans may overlap;
        one without sessions has no row."""
        spans = sorted(set(spans))
        in_span = [(a, b, a + timedelta(days=i)) for a, b in spans for i in range((b - a).days)]
        wanted = spark.createDataFrame(in_span, "lower date, upper date, day date")
        rows = Store(self.root).rows(spark, DAILY, DAILY_SCHEMA).drop("_sequence")
        if in_span:
            days = [day for _, _, day in in_span]
            rows = rows.filter(F.col("day").between(F.lit(min(days)), F.lit(max(days))))
        if tenants is not None:
            rows = tenants.flag(rows).filter("on_platform")
        cell = [*TENANT, "lower", "upper", "platform"]
        united = rows.join(wanted, "day").groupBy(*cell, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
        both = united.select(
            *[c for c in cell if c != "platform"], "bucket", "bits", F.explode(F.array("platform", F.lit(None))).alias("platform")
        )
        sets = both.groupBy(*cell, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
        return sets.groupBy(*cell).agg(F.sum(F.bitmap_count("bits")).alias("users"))


def _same_user(a: DataFrame, b: DataFrame) -> Column:
    return (a["company"] == b["company"]) & (a["app"] == b["app"]) & a["user_id"].eqNullSafe(b["user_id"])


def _numbered(run: Run, users: DataFrame, known: DataFrame) -> DataFrame:
    """The users without a number, with numbers that go on from those of their tenant without gaps.
    They are counted by shard, and each shard is numbered from where those before it end, so that
    a large tenant is not one task."""
    shard = F.pmod(F.xxhash64("user_id"), F.lit(SHARDS)).cast("int").alias("shard")
    fresh = run.scratch(users.join(known, _same_user(users, known), "left_anti").select(*USER, shard), "fresh")
    earlier = W.partitionBy(*TENANT).orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    sizes = fresh.groupBy(*TENANT, "shard").agg(F.count("*").alias("n"))
    starts = sizes.select(*TENANT, "shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    last = known.groupBy(*TENANT).agg(F.max("code").alias("last"))
    base = starts.join(last, TENANT, "left").select(
        *TENANT, "shard", (F.coalesce("last", F.lit(0)) + F.col("before")).alias("base")
    )
    nth = F.row_number().over(W.partitionBy(*TENANT, "shard").orderBy("user_id"))
    numbered = fresh.join(base, [*TENANT, "shard"]).select(*USER, (F.col("base") + nth).alias("code"))
    return run.scratch(numbered, "numbered")
