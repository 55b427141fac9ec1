"""Purchases collected to one list per user."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

from conftest import SMALL, make_purchases, make_tenants

from spendlens.checks.queries import QUERIES
from spendlens.operators.windows import Windows
from spendlens.plans.core import listed_purchases, paying_user_purchases

START = datetime(2024, 1, 10)
DAY = Windows(((START, START + timedelta(days=1)),))


def test_listed_purchases(spark):
    """Many slabs and one with many rows, equal times, repeated, empty and null ids, and a user without ids."""
    rng = random.Random(3)
    rows = [(f"p{n % 350}", rng.choice("uvw"), START + timedelta(seconds=rng.choice([0, 30, *range(3000)])), "iOS", 1) for n in range(400)]
    rows += [(i, "u", START + timedelta(hours=20, seconds=s), "Web", 9) for s, i in enumerate(["", None, "z", None])]
    rows += [(f"q{n}", "x", START + timedelta(milliseconds=n % 7), "iOS", 2) for n in range(500)]
    rows += [(None, "y", START, "iOS", 1), (None, "y", START + timedelta(hours=3), "iOS", 1), ("lost", None, START, "iOS", 1)]
    expected = defaultdict(list)
    for i, user, time, *_ in rows:
        expected[user].append((time, i))
    del expected[None]
    found = listed_purchases(paying_user_purchases(make_purchases(spark, rows), make_tenants(spark), DAY)).collect()
    assert {r.user_id: (r.n, r.ids) for r in found} == {
        u: (len(items), ",".join(i for _, i in sorted(x for x in items if x[1] is not None))) for u, items in expected.items()
    }
    assert len(found) == len(expected)


def test_collect_purchases_has_the_whole_list(spark):
    rows = QUERIES["collect_purchases"](spark, SMALL).collect()
    assert rows and all(r.n == len(r.ids.split(",")) for r in rows) and len({r.user_id for r in rows}) == len(rows)
