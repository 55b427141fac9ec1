"""The metrics, as rows of the long table ``metric_values``.

Each metric is a formula over the measures of its own cell and of the cells above it: the
platform cell (``p_`` columns) and the total cell (``t_`` columns).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from spendlens.functions.arithmetic import ratio_sql as _ratio
from spendlens.operators.tenants import Tenants
from spendlens.operators.windows import Windows
from spendlens.plans.cubes import Cubes
from spendlens.plans.measures import measure_cells
from spendlens.schema import GRAIN_KEY, KEY, METRIC_VALUES

# The profit margin on total and platform revenue, and the margin applied at
# payment system level.
PROFIT_MARGIN = 0.70
PAYMENT_MARGIN = 0.029

TOTAL, PLATFORM, SYSTEM = "total", "platform", "system"

# Measures that formulas read from the cells above their own.
FROM_PLATFORM = ["any_purchases", "active_users", "sessions", "session_rows"]
FROM_TOTAL = ["paying_users", "first_users", "between_users", "repeat_payers"]


def _by_grain(total: str, platform: str, system: str) -> str:
    return f"CASE grain WHEN '{TOTAL}' THEN {total} WHEN '{PLATFORM}' THEN {platform} ELSE {system} END"


def _at_platform(measure: str) -> str:
    """In the total cell its own measure, elsewhere that of the platform."""
    return _by_grain(measure, measure, f"p_{measure}")




@dataclass(frozen=True)
class Metric:
    """SQL expressions over the columns of a cell, all doubles. ``numerator`` and ``denominator``
    make the value, unless ``value`` says otherwise; a metric without denominator is its
    numerator. ``shown`` selects the cells that report the metric."""

    sources: frozenset[str]
    numerator: str
    denominator: str | None = None
    value: str | None = None
    shown: str = "configured > 0"

    def measures(self) -> set[str]:
        """The measures that the expressions name, at any grain."""
        text = " ".join(filter(None, (self.numerator, self.denominator, self.value, self.shown)))
        return {word.removeprefix("p_").removeprefix("t_") for word in re.findall(r"\w+", text)}

    def entry(self, name: str) -> str:
        value = self.value
        if value is None:
            value = self.numerator if self.denominator is None else _ratio(self.numerator, self.denominator)
        return (
            f"named_struct('metric', '{name}', 'shown', {self.shown}, 'value', {value},"
            f" 'numerator', {self.numerator},"
            f" 'denominator', {self.denominator or 'CAST(NULL AS DOUBLE)'})"
        )


def _sources(*names: str) -> frozenset[str]:
    return frozenset(names)


UPPER_GRAINS = f"grain IN ('{TOTAL}', '{PLATFORM}')"

# Revenue is shown for every payment system found, configured or not; a platform without any
# purchase shows its configured ones with zero.
REVENUE_CELLS = f"{UPPER_GRAINS} OR any_purchases > 0 OR (configured > 0 AND p_any_purchases = 0)"

ARPU = _ratio("revenue", _at_platform("active_users"))
MARGIN = _by_grain(f"{PROFIT_MARGIN}D", f"{PROFIT_MARGIN}D", f"{PAYMENT_MARGIN}D")

METRICS = {
    "total_revenue": Metric(_sources("purchases"), "revenue", shown=REVENUE_CELLS),
    "active_users": Metric(_sources("sessions"), "active_users", shown=UPPER_GRAINS),
    "number_sessions": Metric(_sources("sessions"), "sessions", shown=UPPER_GRAINS),
    "sessions_per_user": Metric(_sources("sessions"), "session_rows", shown=UPPER_GRAINS),
    "paying_users": Metric(_sources("payers"), "paying_users", shown=f"grain = '{TOTAL}'"),
    "arpu": Metric(_sources("purchases", "sessions"), "revenue", _at_platform("active_users")),
    "avg_revenue_session": Metric(_sources("purchases", "sessions"), "revenue", _at_platform("sessions")),
    "lifetime_value": Metric(
        _sources("purchases", "sessions"), ARPU, value=f"{ARPU} * {_at_platform('session_rows')} * {MARGIN}"
    ),
    "avg_purchases_user": Metric(_sources("purchases", "payers"), "purchases", "t_paying_users"),
    "purchases_per_session": Metric(_sources("purchases", "sessions"), "purchases", _at_platform("sessions")),
    "sessions_first_purchase": Metric(
        _sources("first"), "first_sessions", _by_grain("first_users", "t_first_users", "first_users")
    ),
    "sessions_between_purchases": Metric(
        _sources("between"),
        "between_sessions",
        _by_grain("between_users", "t_repeat_payers", "t_repeat_payers"),
    ),
}

METRIC_NAMES = tuple(METRICS)


def metric_values(
    purchases: DataFrame,
    sessions: DataFrame,
    tenants: Tenants,
    windows: Windows,
    metrics: Iterable[str] = METRIC_NAMES,
    profiles: DataFrame | None = None,
    cubes: Cubes | None = None,
    reached: DataFrame | None = None,
) -> DataFrame:
    """The named metrics for every tenant and window, in one plan. Only the tables and columns
    that these metrics need are read, each once per group of measures; or, given ``cubes``, only
    what was aggregated before (see ``measure_cells``)."""
    wanted = list(dict.fromkeys(metrics))
    unknown = set(wanted) - set(METRICS)
    if unknown:
        raise ValueError(f"unknown metrics: {sorted(unknown)}")
    measures = set().union(*(METRICS[name].measures() for name in wanted))
    sources = {source for name in wanted for source in METRICS[name].sources}
    cells = measure_cells(purchases, sessions, tenants, windows, sources, profiles, measures, cubes, reached)
    return from_cells(cells, wanted)


def from_cells(cells: DataFrame, metrics: Iterable[str] = METRIC_NAMES) -> DataFrame:
    window, platform = ", ".join(KEY), ", ".join([*KEY, "platform"])
    above = [
        *[f"max(IF(platform IS NULL, {m}, NULL)) OVER (PARTITION BY {window}) AS t_{m}" for m in FROM_TOTAL],
        *[
            f"max(IF(payment_system IS NULL, {m}, NULL)) OVER (PARTITION BY {platform}) AS p_{m}"
            for m in FROM_PLATFORM
        ],
    ]
    grain = (
        f"CASE WHEN platform IS NULL THEN '{TOTAL}' WHEN payment_system IS NULL THEN '{PLATFORM}'"
        f" ELSE '{SYSTEM}' END AS grain"
    )
    entries = ", ".join(METRICS[name].entry(name) for name in metrics)
    return (
        cells.selectExpr("*", grain, *above)
        .selectExpr(*GRAIN_KEY, "grain", f"inline(array({entries}))")
        .filter("shown")
        .select(*METRIC_VALUES.fieldNames())
    )


def _single(name: str) -> Callable[..., DataFrame]:
    def plan(
        purchases: DataFrame,
        sessions: DataFrame,
        tenants: Tenants,
        windows: Windows,
        profiles: DataFrame | None = None,
    ) -> DataFrame:
        return metric_values(purchases, sessions, tenants, windows, [name], profiles)

    plan.__name__ = name
    return plan


total_revenue = _single("total_revenue")
active_users = _single("active_users")
number_sessions = _single("number_sessions")
arpu = _single("arpu")
avg_revenue_session = _single("avg_revenue_session")
lifetime_value = _single("lifetime_value")
avg_purchases_user = _single("avg_purchases_user")
purchases_per_session = _single("purchases_per_session")
sessions_first_purchase = _single("sessions_first_purchase")
sessions_between_purchases = _single("sessions_between_purchases")
