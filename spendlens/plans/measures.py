"""Additive measures per tenant, window, platform and payment system.

Every source of measures is a small aggregate over one scan. Their rows are unioned with the
zero-filled report grid and summed once by cell, which replaces the joins of metric with
metric and of results with the grid. Cells: the total has no platform and no payment system,
a platform cell has no payment system.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlens.operators import exact
from spendlens.operators.tenants import Tenants
from spendlens.operators.windows import Windows
from spendlens.plans.core import payers
from spendlens.plans.cubes import BY_ID, BY_USER, Cubes, by_window, session_cube
from spendlens.plans.journey import NOWHERE, History, between_purchase_measures, first_purchase_measures
from spendlens.schema import GRAIN_KEY, KEY, TENANT, WINDOW

MEASURES = [
    "configured",
    "revenue",
    "any_purchases",
    "purchases",
    "paying_users",
    "active_users",
    "sessions",
    "session_rows",
    "first_sessions",
    "first_users",
    "between_sessions",
    "between_users",
    "repeat_payers",
]


def _cell(platform: str, payment_system: str, **values: str) -> str:
    named = ", ".join(f"'{name}', {value}" for name, value in values.items())
    return (
        f"named_struct('platform', CAST({platform} AS STRING),"
        f" 'payment_system', CAST({payment_system} AS INT), {named})"
    )


def purchases_by_cell(purchases: DataFrame, tenants: Tenants, windows: Windows, by_payers: bool = True) -> DataFrame:
    """Per window, platform, payment system and magnitude of the price, with the flags of configuration:
    revenue (in the parts of ``operators.exact``), purchases (``n``) and, if ``by_payers``, those
    that have a user (``paid``)."""
    aggregates = {**exact.sums(), "n": F.count("*")}
    if by_payers:
        aggregates["paid"] = F.count("user_id")
    rows = exact.split(tenants.flag(purchases), "price")
    return by_window(rows, windows, [*PURCHASE_GRAIN, exact.BIN], aggregates, dict.fromkeys(aggregates, F.sum))


def cells_of_cube(cube: DataFrame) -> DataFrame:
    """``purchases_by_cell`` of a stored purchase cube."""
    paid = F.sum(F.when(F.col("user_id").isNotNull(), F.col("n")).otherwise(0)).alias("paid")
    revenue = [total.alias(name) for name, total in exact.sums().items()]
    return cube.groupBy(*WINDOW, *PURCHASE_GRAIN, exact.BIN).agg(*revenue, F.sum("n").alias("n"), paid)


PURCHASE_GRAIN = [*TENANT, "platform", "payment_system", "on_platform", "on_system"]


def purchase_measures(by_system: DataFrame) -> DataFrame:
    """Measure rows of ``purchases_by_cell``, one per cell. ``revenue`` and ``any_purchases`` take every payment system
    on the configured platforms, with or without a user. ``purchases`` are those of paying users:
    every one in the total, and in the platform cells those with a configured payment system;
    they are left out where they were not counted."""
    by_payers = "paid" in by_system.columns
    revenue = {part: f"IF(on_platform, {part}, {'0D' if part == exact.BEYOND else '0L'})" for part in exact.SUMS}
    found = {**revenue, "any_purchases": "IF(on_platform, n, 0L)"}
    known = {**found, **({"purchases": "IF(on_system, paid, 0L)"} if by_payers else {})}
    total = _cell("NULL", "NULL", **found, **({"purchases": "paid"} if by_payers else {}))
    platform = _cell("platform", "NULL", **known)
    system = _cell("platform", "payment_system", **known)
    # A purchase off the configured platforms counts in the total only, and one without payment
    # system has no cell of its own.
    cells = (
        f"CASE WHEN NOT on_platform THEN array({total})"
        f" WHEN payment_system IS NULL THEN array({total}, {platform})"
        f" ELSE array({total}, {platform}, {system}) END"
    )
    rows = by_system.selectExpr(*KEY, exact.BIN, f"inline({cells})")
    return exact.added_up(rows, GRAIN_KEY, "revenue", [c for c in ("any_purchases", "purchases") if c in rows.columns])


SESSION_KINDS = {"active_users": BY_USER, "session_rows": BY_USER, "sessions": BY_ID}


def kinds_for(wanted: set[str] | None) -> tuple[str, ...]:
    names = SESSION_KINDS if wanted is None else [name for name in SESSION_KINDS if name in wanted]
    return tuple(dict.fromkeys(SESSION_KINDS[name] for name in names))


def session_measures(cube: DataFrame) -> DataFrame:
    """Distinct users, distinct session ids (a missing value is one of them) and session rows of
    known users, of a session cube. The total adds up the platforms, so a user of two platforms
    counts twice. What the cube does not have is 0."""
    by_user = F.col("kind") == BY_USER
    counted = cube.groupBy(*KEY, "platform").agg(
        F.count_if(by_user).alias("active_users"),
        F.coalesce(F.sum(F.when(by_user & F.col("value").isNotNull(), F.col("n"))), F.lit(0)).alias("session_rows"),
        F.count_if(F.col("kind") == BY_ID).alias("sessions"),
    )
    values = {c: c for c in SESSION_KINDS}
    cells = f"array({_cell('NULL', 'NULL', **values)}, {_cell('platform', 'NULL', **values)})"
    return counted.selectExpr(*KEY, f"inline({cells})")


def payer_measures(paying: DataFrame) -> DataFrame:
    counted = paying.groupBy(*KEY).agg(F.count("*").alias("paying_users"))
    return counted.selectExpr(*KEY, *NOWHERE, "paying_users")


def measure_cells(
    purchases: DataFrame,
    sessions: DataFrame,
    tenants: Tenants,
    windows: Windows,
    sources: set[str],
    profiles: DataFrame | None = None,
    measures: set[str] | None = None,
    cubes: Cubes | None = None,
    reached: DataFrame | None = None,
) -> DataFrame:
    """All cells with the measures of the named ``sources``, or of these only ``measures``; others
    are 0. ``cubes`` are the shared aggregates of these tables, where they have been written, and
    ``reached`` the kept counts of sessions to the first purchase (``plans.state``). With profiles,
    journeys are those of the profiles."""
    paying = None if cubes is None else cubes.payers
    if paying is None and not sources.isdisjoint({"payers", "first", "between"}):
        paying = payers(purchases, tenants, windows)
    history = History.of(purchases, sessions, profiles)
    if cubes is not None and profiles is None:
        history = History.of(cubes.bought, cubes.visited)

    def by_cell() -> DataFrame:
        if cubes is not None:
            return cells_of_cube(cubes.purchases)
        return purchases_by_cell(purchases, tenants, windows, measures is None or "purchases" in measures)

    def by_session() -> DataFrame:
        return session_cube(sessions, tenants, windows, kinds_for(measures)) if cubes is None else cubes.sessions

    plans = {
        "purchases": lambda: purchase_measures(by_cell()),
        "sessions": lambda: session_measures(by_session()),
        "payers": lambda: payer_measures(paying),
        "first": lambda: first_purchase_measures(history, paying, tenants, reached),
        "between": lambda: between_purchase_measures(history, paying, tenants, windows),
    }
    grid = tenants.grid(windows).withColumn("configured", F.lit(1))
    parts = [grid] + [plan() for name, plan in plans.items() if name in sources]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    present = set(rows.columns)

    def summed(measure: str) -> Column:
        return F.coalesce(F.sum(measure), F.lit(0)).cast("double")

    return rows.groupBy(*GRAIN_KEY).agg(
        *[(summed(m) if m in present else F.lit(0.0)).alias(m) for m in MEASURES]
    )
