"""Sessions before the first purchase and between purchases.

Both join the sessions with one row per paying user. A user may own a large share of the
sessions, so each join is followed by an exchange on other keys: adaptive execution can then
split the user's partition of the join, and the next step is keyed finer than by user.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlens.operators.intervals import interval_totals
from spendlens.operators.tenants import Tenants
from spendlens.operators.windows import Windows
from spendlens.plans.core import payers, slice_purchases, slice_sessions
from spendlens.plans.cubes import USER
from spendlens.schema import KEY, TENANT, USER_KEY
from spendlens.sources.normalize import profile_purchases, profile_sessions

NOWHERE = ["CAST(NULL AS STRING) AS platform", "CAST(NULL AS INT) AS payment_system"]


@dataclass(frozen=True)
class History:
    """Where the user histories come from: the flat tables, or nested user profiles. With
    profiles, only payers that have one take part."""

    purchases: DataFrame
    sessions: DataFrame
    profiles: DataFrame | None = None

    @classmethod
    def of(cls, purchases: DataFrame, sessions: DataFrame, profiles: DataFrame | None = None) -> History:
        if profiles is None:
            return cls(purchases, sessions)
        return cls(profile_purchases(profiles), profile_sessions(profiles), profiles)

    def with_profile(self, users: DataFrame) -> DataFrame:
        if self.profiles is None:
            return users
        known = self.profiles.select(*TENANT, F.col("userId").cast("string").alias("user_id")).distinct()
        return users.join(known, USER, "left_semi")


def weight(sessions: DataFrame) -> Column:
    """How many sessions a row stands for."""
    return F.col("n") if "n" in sessions.columns else F.lit(1).cast("long").alias("n")


def _owner() -> Column:
    """The user packed into one column, see sessions_before_first."""
    return F.struct(*USER).alias("owner")


def _firsts_by_owner(purchases: DataFrame, tenants: Tenants) -> DataFrame:
    flagged = tenants.flag(purchases.filter(F.col("user_id").isNotNull()))
    configured = F.col("on_platform") & F.col("on_system")
    earliest = flagged.groupBy(*USER, "platform", "payment_system", configured.alias("configured")).agg(
        F.min("time").alias("time")
    )
    entry = F.struct("platform", "payment_system", "time")
    return earliest.groupBy(_owner()).agg(
        F.min("time").alias("first_any"),
        F.collect_list(F.when(F.col("configured"), entry)).alias("firsts"),
    )


def first_purchases(purchases: DataFrame, tenants: Tenants) -> DataFrame:
    """Per user: the time of the first purchase ever (``first_any``), and the first purchase on
    each configured platform with each configured payment system (``firsts``, an array with at
    most one item per configured pair)."""
    return _firsts_by_owner(purchases, tenants).select("owner.*", "first_any", "firsts")


def sessions_before_first(history: History, users: DataFrame, tenants: Tenants) -> DataFrame:
    """Lifetime session counts of ``users`` up to their first purchases. One row per user and
    series: the total (platform and payment_system null; any session up to the first purchase
    of all), and each pair bought with (sessions on the platform up to the first such
    purchase). Users without any such session have a row with 0."""
    # The user is packed into one column wherever rows are keyed by user alone. The join with the
    # sessions, on the separate columns, then has an exchange on both sides and another one after
    # it: the form in which adaptive execution can split the partition of a large user.
    # Naming first_any in a filter keeps it in both uses, which then share one exchange.
    # Only the purchases of these users are aggregated.
    bought = history.purchases.join(users.select(*USER).distinct(), USER, "left_semi")
    wanted = _firsts_by_owner(bought, tenants).filter(F.col("first_any").isNotNull())
    total = "array(named_struct('platform', CAST(NULL AS STRING), 'payment_system', CAST(NULL AS INT)))"
    pair = "f -> named_struct('platform', f.platform, 'payment_system', f.payment_system)"
    present = wanted.select(
        "owner", F.explode(F.expr(f"concat({total}, transform(firsts, {pair}))")).alias("series"), F.lit(0).cast("long").alias("n")
    )
    reached = "filter(firsts, f -> f.platform = platform AND time <= f.time)"
    met = F.expr(f"concat(IF(time <= first_any, {total}, array()), transform({reached}, {pair}))")
    sessions = history.sessions.select(*USER, "time", "platform", weight(history.sessions)).filter(F.col("user_id").isNotNull())
    # Sessions after the last of a user's first purchases count for none of them.
    latest = F.expr("coalesce(array_max(transform(firsts, f -> f.time)), first_any)").alias("latest")
    thresholds = wanted.select("owner.*", "first_any", "firsts", latest)
    counted = (
        sessions.join(thresholds, USER)
        .filter("time <= latest")
        .select(_owner(), F.explode(met).alias("series"), "n")
    )
    return (
        counted.unionByName(present)
        .groupBy("owner", "series")
        .agg(F.sum("n").alias("sessions"))
        .select("owner.*", "series.*", "sessions")
    )


def first_purchase_measures(
    history: History, paying: DataFrame, tenants: Tenants, reached: DataFrame | None = None
) -> DataFrame:
    """Measure rows: summed sessions to the first purchase and the users they belong to. ``reached``
    are kept results of ``sessions_before_first`` for these users; without them, the whole history
    is read."""
    matched = history.with_profile(paying.filter("qualified").select(*USER_KEY))
    per_user = sessions_before_first(history, matched, tenants) if reached is None else reached
    by_series = (
        matched.join(per_user, USER)
        .groupBy(*KEY, "platform", "payment_system")
        .agg(F.sum("sessions").alias("first_sessions"), F.count("*").alias("first_users"))
    )
    # The sessions of a pair also add to its platform, whose users are those of the total.
    own = "named_struct('platform', platform, 'payment_system', payment_system, 's', first_sessions, 'u', first_users)"
    platform = "named_struct('platform', platform, 'payment_system', CAST(NULL AS INT), 's', first_sessions, 'u', 0L)"
    cells = f"IF(platform IS NULL, array({own}), array({own}, {platform}))"
    return by_series.selectExpr(*KEY, f"inline({cells}) AS (platform, payment_system, first_sessions, first_users)")


def between_purchases(
    purchases: DataFrame, sessions: DataFrame, paying: DataFrame
) -> DataFrame:
    """Sessions between consecutive purchases, per user and series (see interval_totals).
    ``purchases`` and ``sessions`` are sliced by window. Only users with several purchases in the
    window can count, and of their sessions those between the first and the last purchase; all
    other rows leave before the events are ordered."""
    repeat = paying.filter("purchases > 1").select(*USER_KEY, "first_time", "last_time")
    inside = (
        sessions.filter(F.col("user_id").isNotNull())
        .select(*USER_KEY, "time", "platform", "on_platform", weight(sessions))
        .join(repeat, USER_KEY)
        .filter(F.col("time").between(F.col("first_time"), F.col("last_time")))
        .drop("first_time", "last_time")
    )
    if "n" not in sessions.columns:
        # Sessions at one time become one row before they are ordered. The packed user brings the
        # exchange that lets the join be split.
        owned = inside.select(F.struct(*USER_KEY).alias("owner"), "time", "platform", "on_platform", "n")
        merged = owned.groupBy("owner", "time", "platform", "on_platform").agg(F.sum("n").alias("n"))
        inside = merged.select("owner.*", "time", "platform", "on_platform", "n")
    bought = purchases.filter(F.col("user_id").isNotNull()).join(
        repeat.select(*USER_KEY), USER_KEY, "left_semi"
    )
    return interval_totals(bought, inside, USER_KEY)


def between_purchase_measures(
    history: History, paying: DataFrame, tenants: Tenants, windows: Windows
) -> DataFrame:
    """Measure rows: summed sessions between purchases, the matched users and, among them,
    those with more than one purchase in the window."""
    matched = history.with_profile(paying)
    bought = slice_purchases(history.purchases, tenants, windows)
    if history.profiles is None:
        active = matched
    else:
        # the purchases that count are those of the profile
        active = payers(history.purchases, tenants, windows).join(matched, USER_KEY, "left_semi")
    totals = between_purchases(bought, slice_sessions(history.sessions, tenants, windows), active)
    if history.profiles is not None:
        totals = totals.join(matched, USER_KEY, "left_semi")
    sums = totals.groupBy(*KEY, "platform", "payment_system").agg(F.sum("adjusted").alias("between_sessions"))
    repeats = F.count_if(F.col("purchases") > 1).alias("repeat_payers")
    users = F.count("*").alias("between_users")
    if history.profiles is None:
        counted = matched.groupBy(*KEY).agg(users, repeats)
    else:
        counted = (
            matched.groupBy(*KEY)
            .agg(users)
            .unionByName(active.groupBy(*KEY).agg(repeats), allowMissingColumns=True)
        )
    kept = [c for c in counted.columns if c not in KEY]
    return sums.unionByName(counted.selectExpr(*KEY, *NOWHERE, *kept), allowMissingColumns=True)
