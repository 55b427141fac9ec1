"""Aggregates at the grain of users, which all measures of a run share.

Each is computed by one scan, written once, and rolled up from there: purchases by window, user,
platform and payment system; sessions by window, platform and user or session id; and, for the
users with a purchase in a window, their purchases and their sessions by time.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlens.operators import exact
from spendlens.operators.tenants import Tenants
from spendlens.operators.windows import Windows
from spendlens.schema import KEY, TENANT, USER_KEY, WINDOW

USER = TENANT + ["user_id"]
PURCHASE_CELL = [*USER_KEY, "platform", "payment_system", "on_platform", "on_system"]

# What a session is counted by: its user, with null as one of them, or its id.
BY_USER, BY_ID = "user", "id"


def by_window(
    rows: DataFrame,
    windows: Windows,
    keys: list[str],
    aggregates: dict[str, Column],
    again: dict[str, Callable[[str], Column]],
) -> DataFrame:
    """``rows`` grouped by window and ``keys``. Windows that overlap are taken apart into elementary
    intervals: every row is aggregated once, in its own, and what came out is aggregated
    ``again`` by window. So the facts are read and shuffled once, however many windows hold them."""
    if not windows.listed:
        assigned = windows.assign(rows)
        return assigned.groupBy(*WINDOW, *keys).agg(*[c.alias(name) for name, c in aggregates.items()])
    pieces = windows.locate(rows).groupBy("piece", *keys).agg(*[c.alias(name) for name, c in aggregates.items()])
    return windows.expand(pieces).groupBy(*WINDOW, *keys).agg(*[again[name](name).alias(name) for name in aggregates])


def purchase_cube(purchases: DataFrame, tenants: Tenants, windows: Windows) -> DataFrame:
    """Per window, user (null is one), platform and payment system, with the flags of configuration:
    the revenue in exact parts (a row per magnitude of the price), the number of purchases, and the
    times of the first and the last."""
    keys = [c for c in PURCHASE_CELL if c not in WINDOW] + [exact.BIN]
    aggregates = {
        **exact.sums(),
        "n": F.count("*"),
        "first_time": F.min("time"),
        "last_time": F.max("time"),
    }
    again = {**dict.fromkeys([*exact.SUMS, "n"], F.sum), "first_time": F.min, "last_time": F.max}
    cube = by_window(exact.split(tenants.flag(purchases), "price"), windows, keys, aggregates, again)
    return cube.select(*PURCHASE_CELL, exact.BIN, *aggregates)


def session_cube(
    sessions: DataFrame, tenants: Tenants, windows: Windows, kinds: tuple[str, ...] = (BY_USER, BY_ID)
) -> DataFrame:
    """Sessions on configured platforms per window and platform, counted by user and by session id
    (``kind``, ``value``): ``n`` rows each. Both come from one scan, as a row for each of the
    wanted kinds that is combined before the exchange."""
    columns = {BY_USER: "user_id", BY_ID: "id"}
    named = ", ".join(f"named_struct('kind', '{k}', 'value', {columns[k]})" for k in kinds)
    rows = tenants.flag(sessions).filter("on_platform").selectExpr(*TENANT, "platform", "time", f"inline(array({named}))")
    keys = [*TENANT, "platform", "kind", "value"]
    cube = by_window(rows, windows, keys, {"n": F.count("*")}, {"n": F.sum})
    return cube.select(*KEY, "platform", "kind", "value", "n")


def payers_of(cube: DataFrame) -> DataFrame:
    """The payers (see ``plans.core.payers``) of a stored purchase cube."""
    return (
        cube.filter(F.col("user_id").isNotNull())
        .groupBy(*USER_KEY)
        .agg(
            F.sum("n").alias("purchases"),
            F.min("first_time").alias("first_time"),
            F.max("last_time").alias("last_time"),
            F.bool_or(F.col("on_platform") & F.col("on_system")).alias("qualified"),
        )
    )


def sessions_per_user_of(cube: DataFrame) -> DataFrame:
    """Session rows per known user (see ``plans.core.sessions_per_user``) of a stored session cube."""
    known = cube.filter((F.col("kind") == BY_USER) & F.col("value").isNotNull())
    by_platform = known.select(*KEY, F.col("value").alias("user_id"), "platform", F.col("n").alias("sessions"))
    return merge_platform_counts(by_platform)


def merge_platform_counts(by_platform: DataFrame) -> DataFrame:
    """Per user and platform counts to one row per user; the array holds one item per platform."""
    return by_platform.groupBy(*USER_KEY).agg(
        F.sum("sessions").alias("total"),
        F.sort_array(F.collect_list(F.struct("platform", "sessions"))).alias("platforms"),
    )


def payer_purchases(purchases: DataFrame, users: DataFrame) -> DataFrame:
    """All purchases of ``users`` (TENANT, user_id), also those outside the windows."""
    columns = [*USER, "id", "time", "platform", "payment_system"]
    return purchases.select(*columns).join(users, USER, "left_semi")


def payer_sessions(sessions: DataFrame, users: DataFrame) -> DataFrame:
    """The sessions of ``users``: ``n`` per user, platform and time, so that sessions at one time are
    one row in everything after."""
    kept = sessions.select(*USER, "time", "platform")
    # The user is packed, as in plans.journey: the join can then be split where a user is large.
    owned = kept.join(users, USER, "left_semi").select(F.struct(*USER).alias("owner"), "time", "platform")
    return owned.groupBy("owner", "platform", "time").agg(F.count("*").alias("n")).select("owner.*", "platform", "time", "n")


@dataclass(frozen=True)
class Cubes:
    """The shared aggregates of a run, as stored tables: ``purchases`` and ``sessions`` are cubes,
    ``bought`` and ``visited`` the purchases and sessions of payers; ``payers`` are those of the cube."""

    purchases: DataFrame
    sessions: DataFrame
    payers: DataFrame
    bought: DataFrame
    visited: DataFrame

    @classmethod
    def written(
        cls,
        purchases: DataFrame,
        sessions: DataFrame,
        tenants: Tenants,
        windows: Windows,
        write: Callable[[DataFrame, str], DataFrame],
        lifetime: bool = True,
    ) -> Cubes:
        """Two scans of each table, those of one table beside those of the other. ``write`` stores a
        frame under a name and reads it back. ``lifetime`` keeps what payers did outside the
        windows, which first purchases need."""
        past = [t if lifetime else windows.cover(t) for t in (purchases, sessions)]
        with ThreadPoolExecutor(2) as beside:
            visited_by = beside.submit(inheritable_thread_target(write), session_cube(sessions, tenants, windows), "session_cube")
            bought_by = write(purchase_cube(purchases, tenants, windows), "purchase_cube")
            paying = payers_of(bought_by)
            users = paying.select(*USER).distinct()
            visited = beside.submit(inheritable_thread_target(write), payer_sessions(past[1], users), "payer_sessions")
            bought = write(payer_purchases(past[0], users), "payer_purchases")
            return cls(bought_by, visited_by.result(), paying, bought, visited.result())
