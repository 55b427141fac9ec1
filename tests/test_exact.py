"""Exact sums of doubles against fractions, and revenue under any partitioning."""

import math
import random
from datetime import datetime, timedelta
from fractions import Fraction

from conftest import make_purchases, make_sessions, make_tenants
from pyspark.sql import functions as F

from spendlens.operators import exact
from spendlens.operators.windows import Windows
from spendlens.plans.cubes import Cubes
from spendlens.plans.metrics import metric_values

START = datetime(2024, 1, 1)


def _values():
    draw = random.Random(7)
    groups = {
        "prices": [round(draw.random() * 100, 2) for _ in range(500)],
        "negative": [draw.choice([-1, 1]) * round(draw.random() * 100, 2) for _ in range(500)],
        "cancelled": [1e16, 0.01, -1e16, 3.0, 1e-9, -3.0],
        "tiny": [1e-200 * draw.random() for _ in range(50)] + [5e-281],
        "wide": [draw.choice([-1, 1]) * draw.random() * 10.0 ** draw.randint(-30, 30) for _ in range(500)],
        "huge": [1.7e308, -1.7e308, 1e300, 12.5],
        "powers": [2.0**e for e in range(-960, 1000, 7)] + [-(2.0**e) for e in range(-960, 990, 7)],
        "edges": [math.nextafter(2.0 ** (24 * k), d) for k in range(-39, 42) for d in (0, math.inf)],
        "zero": [0.0, -0.0],
        "null": [None, None],
        "some null": [None, 0.1, 0.2],
    }
    return [(name, x) for name, xs in groups.items() for x in xs]


def _sums(frame):
    return {r.name: r.total for r in exact.added_up(exact.split(frame, "value"), ["name"], "total").collect()}


def test_sums_are_those_of_fractions(spark):
    rows = _values()
    found = _sums(spark.createDataFrame(rows, "name string, value double"))
    want = {}
    for name, x in rows:
        want[name] = want.get(name, Fraction(0)) + Fraction(x or 0)
    assert found == {name: float(total) for name, total in want.items()}


def test_sums_do_not_depend_on_order_or_partitions(spark):
    rows, results = _values(), []
    for seed, parts in ((1, 1), (2, 3), (3, 11)):
        random.Random(seed).shuffle(rows)
        frame = spark.createDataFrame(rows, "name string, value double").repartition(parts)
        # Sums of sums are as exact as one sum.
        twice = exact.split(frame, "value").groupBy("name", F.hash("value") % 5, exact.BIN).agg(*[c.alias(n) for n, c in exact.sums().items()])
        results += [_sums(frame), {r.name: r.total for r in exact.added_up(twice, ["name"], "total").collect()}]
    assert all(r == results[0] for r in results)


def test_what_is_not_finite_stays_so(spark):
    rows = [("up", math.inf), ("up", 1.0), ("both", math.inf), ("both", -math.inf), ("none", math.nan), ("none", 2.0), ("down", -math.inf)]
    found = _sums(spark.createDataFrame(rows, "name string, value double"))
    assert found["up"] == math.inf and found["down"] == -math.inf and math.isnan(found["both"]) and math.isnan(found["none"])
    empty = spark.createDataFrame([], "name string, value double")
    assert _sums(empty) == {}


def test_revenue_is_equal_to_the_bit(spark):
    """In any order, with or without shared aggregates and for adjacent and overlapping windows."""
    draw = random.Random(3)
    rows = [
        (f"p{i}", draw.choice(["a", "b", None]), START + timedelta(hours=draw.randrange(96)), draw.choice(["Android", "iOS", "Web"]),
         draw.choice([1, 2, 3, None]), draw.choice([0.1, 1e9, 1e-7, 33.33, -1e9]) * draw.random())
        for i in range(400)
    ]
    sessions = make_sessions(spark, [("s1", "a", START, "Android")])
    edges = [START + timedelta(hours=h) for h in (0, 48, 100)]
    plain = Windows.every(START, timedelta(hours=48), 2)
    listed = Windows(((edges[0], edges[1]), (edges[0], edges[2]), (edges[1] - timedelta(hours=7), edges[2])))
    want = sum(Fraction(r[5]) for r in rows if r[3] != "Web")
    for windows in (plain, listed):
        results = []
        for seed in (1, 2):
            random.Random(seed).shuffle(rows)
            bought = make_purchases(spark, rows).repartition(5 * seed)
            tenants = make_tenants(spark)
            cubes = Cubes.written(bought, sessions, tenants, windows, lambda frame, name: frame)
            for given in (None, cubes):
                values = metric_values(bought, sessions, tenants, windows, ["total_revenue"], cubes=given)
                results.append({(r.lower, r.upper, r.platform, r.payment_system): r.value for r in values.collect()})
        assert all(r == results[0] for r in results)
        if windows is listed:
            assert results[0][edges[0], edges[2], None, None] == float(want)
