"""Known values for one week of the test data."""

from datetime import datetime

import pytest
from conftest import GOLDEN, cells

from spendlens.checks import inputs as I
from spendlens.operators.windows import Windows
from spendlens.plans.core import sessions_per_user
from spendlens.plans.metrics import metric_values, total_revenue

WEEK = Windows.single(datetime(2024, 1, 8), datetime(2024, 1, 15))

T, A, S = (None, None), ("Android", None), ("iOS", None)
A1, A2, A3, S1, S2, S3 = ("Android", 1), ("Android", 2), ("Android", 3), ("iOS", 1), ("iOS", 2), ("iOS", 3)

EXPECTED = {
    "total_revenue": {
        T: 14435.11, A: 7535.42, S: 6899.69,
        A1: 2472.81, A2: 2012.94, A3: 3049.67, S1: 2342.60, S2: 2245.73, S3: 2311.36,
    },
    "active_users": {T: 287, A: 145, S: 142},
    "number_sessions": {T: 938, A: 465, S: 473},
    "sessions_per_user": {T: 944, A: 468, S: 476},
    "paying_users": {T: 141},
    "arpu": {
        T: 50.296551, A: 51.968414, S: 48.589366, A1: 17.053862, A2: 13.882345, S1: 16.497183, S2: 15.815000,
    },
    "avg_revenue_session": {
        T: 15.389243, A: 16.205204, S: 14.587082, A1: 5.317871, A2: 4.328903, S1: 4.952643, S2: 4.747844,
    },
    "lifetime_value": {
        T: 33235.9606, A: 17024.8524, S: 16189.9768,
        A1: 231.455016, A2: 188.411184, S1: 227.727115, S2: 218.310260,
    },
    "avg_purchases_user": {
        T: 3.163121, A: 0.687943, S: 0.631206, A1: 0.390071, A2: 0.297872, S1: 0.326241, S2: 0.304965,
    },
    "purchases_per_session": {
        T: 0.475480, A: 0.208602, S: 0.188161, A1: 0.118280, A2: 0.090323, S1: 0.097252, S2: 0.090909,
    },
    "sessions_first_purchase": {
        T: 2.811321, A: 7.971698, S: 7.924528, A1: 5.058140, A2: 4.880952, S1: 5.057471, S2: 4.651163,
    },
    "sessions_between_purchases": {
        T: 2.822695, A: 0.358333, S: 0.375000, A1: 7 / 120, A2: 7 / 120, S1: 3 / 120, S2: 4 / 120,
    },
}


def test_all_metrics_of_a_week(spark):
    values = metric_values(I.purchases(spark, GOLDEN), I.sessions(spark, GOLDEN), I.one_tenant(spark), WEEK)
    found = cells(values)
    expected = {(m, p, y): v for m, by_cell in EXPECTED.items() for (p, y), v in by_cell.items()}
    assert set(found) == set(expected)
    for key, value in expected.items():
        assert found[key] == pytest.approx(value, abs=6e-5 if key[0] == "lifetime_value" else 6e-7), key


def test_sessions_of_the_busiest_user(spark):
    top = (
        sessions_per_user(I.sessions(spark, GOLDEN), I.one_tenant(spark), WEEK)
        .orderBy("total", ascending=False)
        .first()
    )
    assert (top.user_id, top.total) == ("12", 13)
    assert [(p.platform, p.sessions) for p in top.platforms] == [("Android", 5), ("iOS", 8)]


def test_backfill_of_seven_days(spark):
    windows = Windows.backfill(datetime(2024, 1, 20))
    values = total_revenue(I.purchases(spark, GOLDEN), I.sessions(spark, GOLDEN), I.one_tenant(spark), windows)
    totals = [r.value for r in values.filter("grain = 'total'").orderBy("lower").collect()]
    assert totals == pytest.approx([2763.73, 2016.20, 2086.52, 2408.28, 2793.70, 1537.54, 2040.74])


def test_a_day_of_a_backfill_equals_the_day_alone(spark):
    inputs = (I.purchases(spark, GOLDEN), I.sessions(spark, GOLDEN), I.one_tenant(spark))
    day = Windows.daily(datetime(2024, 1, 10))
    alone = metric_values(*inputs, day)
    together = metric_values(*inputs, I.DAYS).filter(f"lower = timestamp_ntz'{day.first}'")
    assert sorted(map(str, alone.collect())) == sorted(map(str, together.collect()))
