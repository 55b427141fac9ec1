"""Core tables: sliced purchases and sessions, payers, and the two per-user outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.operators.ordered import listed, numbered
from spendlens.operators.tenants import Tenants
from spendlens.operators.windows import Windows
from spendlens.plans.cubes import BY_USER, USER, by_window, session_cube, sessions_per_user_of
from spendlens.schema import USER_KEY


def slice_purchases(purchases: DataFrame, tenants: Tenants, windows: Windows) -> DataFrame:
    """Purchases of known tenants by window, on any platform, with configuration flags."""
    return tenants.flag(windows.assign(purchases))


def slice_sessions(sessions: DataFrame, tenants: Tenants, windows: Windows) -> DataFrame:
    return tenants.flag(windows.assign(sessions))


def payers(purchases: DataFrame, tenants: Tenants, windows: Windows) -> DataFrame:
    """One row per user with a purchase in the window, on any platform: how many purchases,
    the time of the first and the last, and whether one was on a configured platform with a
    configured payment system (``qualified``).

    Several measures use this table, each other columns of it. The filter, which is always
    true, names every column, so that the aggregate is not pruned differently for each use and
    Spark reuses its exchange. ``Cubes`` keeps it as a stored table instead."""
    known = tenants.flag(purchases.filter(F.col("user_id").isNotNull()))
    aggregates = {
        "purchases": F.count("*"),
        "first_time": F.min("time"),
        "last_time": F.max("time"),
        "qualified": F.bool_or(F.col("on_platform") & F.col("on_system")),
    }
    again = {"purchases": F.sum, "first_time": F.min, "last_time": F.max, "qualified": F.bool_or}
    grouped = by_window(known, windows, USER, aggregates, again).select(*USER_KEY, *aggregates)
    return grouped.filter("first_time IS NOT NULL AND last_time IS NOT NULL AND qualified IS NOT NULL")


def paying_user_purchases(purchases: DataFrame, tenants: Tenants, windows: Windows) -> DataFrame:
    """The purchases of the paying users, one row each. No shuffle."""
    return (
        slice_purchases(purchases, tenants, windows)
        .filter(F.col("user_id").isNotNull())
        .select(*USER_KEY, "id", "time", "platform", "payment_system", "on_platform", "on_system")
    )


def numbered_purchases(rows: DataFrame) -> DataFrame:
    """``paying_user_purchases`` with ``ordinal``: 1, 2, ... by time and id within the user and window.
    The long form of a document, for users of any size: a user is numbered slab by slab."""
    return numbered(rows, USER_KEY, ["time", "id", "platform", "payment_system"])


def listed_purchases(rows: DataFrame) -> DataFrame:
    """``paying_user_purchases`` collected: one row per user and window with ``n``, how many, and ``ids``,
    all of their ids by time and id, divided by commas; null ids count and are not listed."""
    return listed(rows, USER_KEY, ["time", "id"], "id", "ids")


def purchases_by_system(rows: DataFrame) -> DataFrame:
    """Configured purchases per user, window, platform and payment system, combined before the exchange."""
    configured = rows.filter(F.col("on_platform") & F.col("on_system"))
    return configured.groupBy(*USER_KEY, "platform", "payment_system").agg(F.count("*").alias("purchases"))


def configured_counts(rows: DataFrame, tenants: Tenants) -> DataFrame:
    """``purchases_by_system`` with every configured platform of each paying user: one on which
    nothing counts has a row without payment system and 0 purchases."""
    flags = (F.col("on_platform") & F.col("on_system")).alias("counts")
    by_cell = rows.groupBy(*USER_KEY, "platform", "payment_system", flags).agg(F.count("*").alias("purchases"))
    users = tenants.join(by_cell.select(*USER_KEY).distinct())
    empty = users.selectExpr(*USER_KEY, "explode(platforms) AS platform", "CAST(NULL AS INT) AS payment_system", "0L AS purchases")
    return by_cell.filter("counts").drop("counts").unionByName(empty)


def paying_user_documents(rows: DataFrame, tenants: Tenants) -> DataFrame:
    """The nested view of ``paying_user_purchases``: one document per paying user and window with
    all purchases by time, and for every configured platform the purchases on it with a configured
    payment system (possibly none). A document holds all purchases of its user; the rows, which
    the store keeps, are the form for users of any size."""
    item = F.struct("time", "id", "platform", "payment_system", "on_platform", "on_system")
    collected = rows.groupBy(*USER_KEY).agg(F.sort_array(F.collect_list(item)).alias("items"))

    def bare(item):
        return F.struct(
            item["id"].alias("purchase_id"), item["time"].alias("time"), item["payment_system"].alias("payment_system")
        )

    def on(platform):
        kept = F.filter("items", lambda i: (i["platform"] == platform) & i["on_platform"] & i["on_system"])
        return F.struct(platform.alias("platform"), F.transform(kept, bare).alias("purchases"))

    everything = F.transform(
        "items",
        lambda i: F.struct(
            i["id"].alias("purchase_id"),
            i["time"].alias("time"),
            i["payment_system"].alias("payment_system"),
            i["platform"].alias("platform"),
        ),
    )
    return tenants.join(collected).select(
        *USER_KEY,
        everything.alias("purchases"),
        F.transform(F.array_sort("platforms"), on).alias("purchases_per_platform"),
    )


def sessions_per_user(sessions: DataFrame, tenants: Tenants, windows: Windows) -> DataFrame:
    """Session rows (not distinct ids) per user: total, and by platform in name order."""
    return sessions_per_user_of(session_cube(sessions, tenants, windows, (BY_USER,)))
