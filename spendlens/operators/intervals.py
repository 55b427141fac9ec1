"""Counting a user's sessions inside the intervals between consecutive purchases."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.operators.ordered import SLAB, with_slab

# Fixed value: the two sessions in which the purchases themselves were made do not count
# when there are more than two.
PURCHASE_SESSIONS = 2


def adjusted(sessions: str) -> str:
    return f"IF({sessions} > {PURCHASE_SESSIONS}, {sessions} - {PURCHASE_SESSIONS}, {sessions})"


def interval_totals(
    purchases: DataFrame, sessions: DataFrame, keys: list[str], slab: str = SLAB
) -> DataFrame:
    """Sessions with ``t_i <= time <= t_{i+1}`` over consecutive purchase times, summed.

    ``purchases`` has ``keys``, time, platform, payment_system, on_platform and on_system;
    ``sessions`` has ``keys``, time, platform, on_platform and, where a row stands for
    several sessions, their number n. ``keys`` ends in the user.

    One result row per user and series: the total series (platform and payment_system null)
    takes everything; a platform series the purchases and sessions on a configured platform;
    a payment system series the purchases with that configured system on the platform and all
    sessions on the platform. Columns: ``pairs``, ``raw`` and ``adjusted`` (summed counts).

    There is no join of pairs with sessions. With running session counts ``inc`` (sessions up
    to and including a time) and ``exc`` (sessions before it), a pair has
    ``inc(t_{i+1}) - exc(t_i)`` sessions. Counts run inside a slab of time; pairs that span
    slabs are completed from one summary row per slab.
    """
    columns = [*keys, "time", "platform"]
    bought = purchases.selectExpr(*columns, "on_platform", "payment_system", "on_system", "0L AS session")
    count = "n" if "n" in sessions.columns else "1L"
    visited = sessions.selectExpr(
        *columns, "on_platform", "CAST(NULL AS INT) AS payment_system", "false AS on_system", f"{count} AS session"
    )
    # The explicit exchange keeps the slab in the partitioning even where the inputs arrive
    # already partitioned by user; everything down to the slab summary then stays local.
    local = with_slab(bought.unionByName(visited), "time", slab).repartition(*keys, "slab")
    return _chain(_summarise(local, keys), keys)


def _summarise(events: DataFrame, keys: list[str]) -> DataFrame:
    """One row per user, slab and series with the counts inside the slab."""
    # The sort compares the first column by its prefix alone, so the most selective comes first.
    scope = ", ".join(["slab", *reversed(keys), "scope"])
    scoped = events.selectExpr(
        *keys,
        "slab",
        "explode(IF(on_platform, array(NULL, platform), array(CAST(NULL AS STRING)))) AS scope",
        "time",
        "payment_system",
        "on_system",
        "session",
    )
    # One ordering, three frames: up to, strictly before, and the whole slab.
    over = f"OVER (PARTITION BY {scope} ORDER BY time RANGE BETWEEN UNBOUNDED PRECEDING AND"
    counted = scoped.selectExpr(
        "*",
        f"sum(session) {over} CURRENT ROW) AS inc",
        f"coalesce(sum(session) {over} INTERVAL '0.000001' SECOND PRECEDING), 0L) AS exc",
        f"sum(session) {over} UNBOUNDED FOLLOWING) AS in_slab",
    )
    series = counted.selectExpr(
        "*",
        "explode(IF(session = 0 AND scope IS NOT NULL AND on_system,"
        " array(NULL, payment_system), array(CAST(NULL AS INT)))) AS system",
    )
    # Purchases sort first, so the next row of a purchase is the next purchase or a session,
    # and a session has no count to offer.
    paired = series.selectExpr(
        "*",
        f"IF(session = 0, lead(IF(session = 0, inc, NULL)) OVER (PARTITION BY {scope}, system"
        " ORDER BY session, time) - exc, NULL) AS between_pair",
    )
    return paired.groupBy(*keys, "slab", "scope", "system").agg(
        F.expr("sum(session)").alias("sessions"),
        F.expr("count_if(session = 0)").alias("purchases"),
        F.expr("count(between_pair)").alias("pairs"),
        F.expr("coalesce(sum(between_pair), 0L)").alias("raw"),
        F.expr(f"coalesce(sum({adjusted('between_pair')}), 0L)").alias("adjusted"),
        # sessions of the slab after its first purchase, and from its last purchase on
        F.expr("max(IF(session = 0, in_slab - inc, NULL))").alias("after_first"),
        F.expr("min(IF(session = 0, in_slab - exc, NULL))").alias("from_last"),
    )


def _chain(slabs: DataFrame, keys: list[str]) -> DataFrame:
    """Complete the pairs that span slabs and sum up per user and series."""
    scope = ", ".join([*reversed(keys), "scope"])
    running = slabs.selectExpr(
        "*",
        f"sum(sessions) OVER (PARTITION BY {scope} ORDER BY slab"
        " RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto",
    ).filter("purchases > 0")
    linked = running.selectExpr(
        "*",
        f"upto - after_first - lag(upto - from_last) OVER (PARTITION BY {scope}, system ORDER BY slab) AS spanning",
    )
    return linked.groupBy(*keys, F.col("scope").alias("platform"), F.col("system").alias("payment_system")).agg(
        F.expr("sum(pairs) + count(spanning)").alias("pairs"),
        F.expr("sum(raw + coalesce(spanning, 0L))").alias("raw"),
        F.expr(f"sum(adjusted + coalesce({adjusted('spanning')}, 0L))").alias("adjusted"),
    )
