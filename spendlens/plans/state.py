"""First purchases that are kept from run to run.

Sessions up to the first purchase look at a user's whole past. The state holds what is needed
to go on from there: sessions per user, platform and day, and for every user who has bought, the
time of the first purchase, in all and by platform and payment system, with the number of sessions
up to it. A new batch of rows, a day or an hour, changes it by these rules:

* a first purchase that is new, or earlier than the known one, is counted anew: the days before it
  from the kept counts, and its own day from the rows of the session table;
* sessions that arrive late, before a first purchase that stays, are added to its number;
* anything else changes nothing.

So a batch reads its own rows, the kept tables and those days of the session table on which a changed
first purchase lies. Every batch is one published run of the state: it counts once or not at all.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.operators.tenants import Tenants
from spendlens.plans.cubes import USER
from spendlens.sources.store import Store

SERIES_TYPE = "STRUCT<platform: STRING, payment_system: INT>"
# All purchases of a user, on any platform.
ALL = f"CAST(NULL AS {SERIES_TYPE})"
SESSION_DAYS, REACHED = "session_days", "reached"
DAYS_SCHEMA = "company string, app string, user_id string, platform string, day date, n long"
REACHED_SCHEMA = f"company string, app string, user_id string, series {SERIES_TYPE}, time timestamp_ntz, sessions long"


@dataclass(frozen=True)
class FirstPurchases:
    """The state under ``root``. Users are those of known purchases and sessions; null is none."""

    root: str

    def advance(
        self, spark: SparkSession, purchases: DataFrame, sessions: DataFrame, history: DataFrame, label: str | None = None
    ) -> bool:
        """Take in a batch: ``purchases`` and ``sessions`` are the rows that have arrived since the last
        one, of any time. ``history`` is the whole session table, the batch included; a ``day``
        column, as ``save_events`` writes it, lets only the needed days be read. A batch whose
        ``label`` was taken in before is left out, and the result is then False."""
        store = Store(self.root)
        if label is not None and any(r.label == label for r in store.published(spark)):
            return False
        run = store.begin(label)
        visits = sessions.filter(F.col("user_id").isNotNull()).select(*USER, "platform", "time")
        days = visits.groupBy(*USER, "platform", F.col("time").cast("date").alias("day")).agg(F.count("*").alias("n"))
        new_days = run.scratch(days, "days")
        firsts = run.scratch(_firsts(purchases), "firsts")
        before = _latest(store.rows(spark, REACHED, REACHED_SCHEMA))
        merged = run.scratch(_merged(firsts, before), "merged")
        changed = merged.filter("old_time IS NULL OR time < old_time").select(*USER, "series", "time")
        all_days = new_days.unionByName(store.rows(spark, SESSION_DAYS, DAYS_SCHEMA).drop("_sequence"))
        counted = _recounted(changed, all_days, history)
        stay = before.join(changed.select(*USER, "series"), _same_series(before, changed), "left_anti")
        run.append(counted.unionByName(_with_late(stay, visits)), REACHED)
        run.append(new_days, SESSION_DAYS)
        run.publish(spark)
        return True

    def reached(self, spark: SparkSession, tenants: Tenants) -> DataFrame:
        """Per user and series (platform and payment system; both null for the first purchase of all),
        the sessions up to the first purchase, as ``sessions_before_first`` gives them: the total
        and the configured pairs of known tenants."""
        current = _latest(Store(self.root).rows(spark, REACHED, REACHED_SCHEMA))
        flagged = tenants.flag(current.select(*USER, "series.platform", "series.payment_system", "series", "sessions"))
        return flagged.filter("series IS NULL OR (on_platform AND on_system)").select(*USER, "platform", "payment_system", "sessions")

    def compact(self, spark: SparkSession, target: FirstPurchases, label: str | None = None) -> None:
        """Write the state as one run of another place, without what later runs have replaced."""
        store, run = Store(self.root), Store(target.root).begin(label)
        run.append(_latest(store.rows(spark, REACHED, REACHED_SCHEMA)), REACHED)
        days = store.rows(spark, SESSION_DAYS, DAYS_SCHEMA)
        run.append(days.groupBy(*USER, "platform", "day").agg(F.sum("n").alias("n")), SESSION_DAYS)
        run.publish(spark)


def _firsts(purchases: DataFrame) -> DataFrame:
    """(USER, series, time): the earliest purchases of a batch, by pair and of all."""
    known = purchases.filter(F.col("user_id").isNotNull())
    by_pair = known.groupBy(*USER, F.struct("platform", "payment_system").alias("series")).agg(F.min("time").alias("time"))
    both = by_pair.selectExpr(*USER, f"explode(array({ALL}, series)) AS series", "time")
    return both.groupBy(*USER, "series").agg(F.min("time").alias("time"))


def _latest(known: DataFrame) -> DataFrame:
    """(USER, series, time, sessions) as the last run has them that changed them."""
    newest = F.max_by(F.struct("time", "sessions"), "_sequence").alias("now")
    return known.groupBy(*USER, "series").agg(newest).select(*USER, "series", "now.*")


def _same_series(a: DataFrame, b: DataFrame):
    same = a["series"].eqNullSafe(b["series"])
    for c in USER:
        same = same & (a[c] == b[c])
    return same


def _merged(firsts: DataFrame, before: DataFrame) -> DataFrame:
    """The series of a batch with the times known before. Those of other users stay where they are."""
    theirs = before.join(firsts.select(*USER).distinct(), USER, "left_semi")
    rows = firsts.select(*USER, "series", "time", F.lit(None).cast("timestamp_ntz").alias("old_time")).unionByName(
        theirs.select(*USER, "series", F.lit(None).cast("timestamp_ntz").alias("time"), F.col("time").alias("old_time"))
    )
    grouped = rows.groupBy(*USER, "series").agg(F.min("time").alias("time"), F.min("old_time").alias("old_time"))
    return grouped.filter(F.col("time").isNotNull())


def _recounted(changed: DataFrame, days: DataFrame, history: DataFrame) -> DataFrame:
    """Sessions up to each changed first purchase: whole days before it, and the rows of its day."""
    wanted = changed.select(*USER, "series", F.col("time").alias("first"), F.col("time").cast("date").alias("first_day"))
    on_series = F.col("series").isNull() | (F.col("platform") == F.col("series.platform"))
    earlier = days.join(wanted, USER).filter((F.col("day") < F.col("first_day")) & on_series)
    # One date per day on which a first purchase has changed: in a nightly run one, or few.
    at = [r.first_day for r in wanted.select("first_day").distinct().collect()]
    rows = history.filter(F.col("user_id").isNotNull() & (F.col("day").isin(at) if "day" in history.columns else F.lit(True)))
    rows = rows.select(*USER, "platform", "time").withColumn("first_day", F.col("time").cast("date"))
    own_day = rows.filter(F.col("first_day").isin(at)).join(wanted, [*USER, "first_day"])
    own_day = own_day.filter((F.col("time") <= F.col("first")) & on_series)
    none = wanted.select(*USER, "series", "first", F.lit(0).cast("long").alias("n"))
    # The packed user brings an exchange after the joins, where a large user can be split.
    parts = [f.select(F.struct(*USER).alias("owner"), "series", "first", n) for f, n in ((earlier, F.col("n")), (own_day, F.lit(1).cast("long").alias("n")), (none, F.col("n")))]
    summed = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("owner", "series", "first").agg(F.sum("n").alias("sessions"))
    return summed.select("owner.*", "series", F.col("first").alias("time"), "sessions")


def _with_late(stay: DataFrame, visits: DataFrame) -> DataFrame:
    """The series that stay, where sessions of the batch lie before their first purchase."""
    met = visits.withColumnRenamed("time", "visit").join(stay, USER).filter(
        (F.col("visit") <= F.col("time")) & (F.col("series").isNull() | (F.col("platform") == F.col("series.platform")))
    )
    late = met.select(F.struct(*USER).alias("owner"), "series", "time", "sessions").groupBy("owner", "series", "time", "sessions")
    return late.agg(F.count("*").alias("n")).select("owner.*", "series", "time", (F.col("sessions") + F.col("n")).alias("sessions"))
