"""A whole run: every tenant and window, per-user tables and metrics, written to the store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spendlens.operators.tenants import Tenants
from spendlens.operators.windows import Windows
from spendlens.plans.core import paying_user_purchases
from spendlens.plans.cubes import Cubes, sessions_per_user_of
from spendlens.plans.metrics import METRIC_NAMES, metric_values
from spendlens.plans.state import FirstPurchases
from spendlens.sources.store import Store


def run(
    spark: SparkSession,
    purchases: DataFrame,
    sessions: DataFrame,
    tenants: Tenants,
    windows: Windows,
    store: Store,
    profiles: DataFrame | None = None,
    state: FirstPurchases | None = None,
) -> int:
    """Compute the shared aggregates, by two scans of each table, and everything else from them. With a
    ``state``, which has taken in the rows of these tables, nothing older than the first window
    is read; without, first purchases are looked up in the whole history of the payers. The
    tables become visible together, once all are written; returns the place of the run in the
    sequence."""
    keys = tenants.keys(windows)
    out = store.begin()
    reached = None if state is None or profiles is not None else state.reached(spark, tenants)
    cubes = Cubes.written(purchases, sessions, tenants, windows, out.scratch, lifetime=reached is None)
    values = metric_values(purchases, sessions, tenants, windows, METRIC_NAMES, profiles, cubes, reached)
    out.write(values, "metric_values")
    out.write(cubes.payers, "payers", keys)
    out.write(paying_user_purchases(cubes.bought, tenants, windows), "paying_users", keys)
    out.write(sessions_per_user_of(cubes.sessions), "sessions_per_user", keys)
    return out.publish(spark)
