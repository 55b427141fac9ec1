"""The slab-wise operators against brute force on small random histories."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from conftest import cells, make_purchases, make_sessions, make_tenants
from pyspark.sql import functions as F

from spendlens.operators.intervals import interval_totals
from spendlens.operators.ordered import numbered, with_next
from spendlens.operators.windows import Windows
from spendlens.plans.core import payers, paying_user_documents, paying_user_purchases, slice_purchases, slice_sessions
from spendlens.plans.journey import History, sessions_before_first
from spendlens.plans.metrics import metric_values

START = datetime(2024, 1, 10)
DAY = Windows.single(START, START + timedelta(days=1))
PLATFORMS = ["Android", "iOS", "Web"]


def history(seed, users=6, minutes=30):
    """Times on a coarse grid, so that ties between and within the two tables are common."""
    rng = random.Random(seed)

    def moment():
        return START + timedelta(seconds=10 * rng.randrange(minutes * 6))

    bought = [
        (str(i), f"u{rng.randrange(users)}", moment(), rng.choice(PLATFORMS), rng.randrange(1, 4)) for i in range(60)
    ]
    visits = [(f"s{i}", f"u{rng.randrange(users)}", moment(), rng.choice(PLATFORMS)) for i in range(120)]
    # one user owns about a third of everything
    bought += [(f"h{i}", "hot", moment(), rng.choice(PLATFORMS), rng.randrange(1, 4)) for i in range(30)]
    visits += [(f"hs{i}", "hot", moment(), rng.choice(PLATFORMS)) for i in range(60)]
    return bought, visits


def expected_intervals(bought, visits):
    series = defaultdict(list)
    for _, user, time, platform, system in sorted(bought, key=lambda r: (r[2], r[0])):
        series[user, None, None].append(time)
        if platform != "Web":
            series[user, platform, None].append(time)
            if system < 3:
                series[user, platform, system].append(time)
    result = {}
    for (user, platform, system), times in series.items():
        counts = [
            sum(1 for _, u, t, p in visits if u == user and platform in (None, p) and a <= t <= b)
            for a, b in zip(times, times[1:])
        ]
        adjusted = sum(n - 2 if n > 2 else n for n in counts)
        result[user, platform, system] = (len(counts), sum(counts), adjusted)
    return result


@pytest.mark.parametrize("slab", ["1 minute", "7 minutes", "1 day"])
@pytest.mark.parametrize("seed", [1, 2])
def test_interval_totals(spark, seed, slab):
    bought, visits = history(seed)
    tenants = make_tenants(spark)
    totals = interval_totals(
        slice_purchases(make_purchases(spark, bought), tenants, DAY),
        slice_sessions(make_sessions(spark, visits), tenants, DAY),
        ["company", "app", "lower", "upper", "user_id"],
        slab,
    )
    found = {(r.user_id, r.platform, r.payment_system): (r.pairs, r.raw, r.adjusted) for r in totals.collect()}
    assert found == expected_intervals(bought, visits)


def test_sessions_before_first(spark):
    bought, visits = history(3)
    tenants = make_tenants(spark)
    purchases, sessions = make_purchases(spark, bought), make_sessions(spark, visits)
    users = payers(purchases, tenants, DAY).filter("qualified")
    rows = sessions_before_first(History.of(purchases, sessions), users, tenants).collect()
    firsts = {}
    for _, user, time, platform, system in bought:
        keys = [(user, None, None)]
        if platform != "Web" and system < 3:
            keys.append((user, platform, system))
        for key in keys:
            firsts[key] = min(time, firsts.get(key, time))
    qualified = {user for user, platform, _ in firsts if platform}
    expected = {
        key: sum(1 for _, u, t, p in visits if u == key[0] and key[1] in (None, p) and t <= first)
        for key, first in firsts.items()
        if key[0] in qualified
    }
    assert {(r.user_id, r.platform, r.payment_system): r.sessions for r in rows} == expected


def test_profiles_give_the_same_as_flat_tables(spark):
    bought, visits = history(4)
    purchases, sessions = make_purchases(spark, bought), make_sessions(spark, visits)
    ms = F.expr("CAST(unix_millis(CAST(time AS TIMESTAMP)) AS DOUBLE)")
    p = purchases.groupBy("company", "app", F.col("user_id").alias("userId")).agg(
        F.collect_list(
            F.struct(ms.alias("time"), "platform", F.col("payment_system").cast("double").alias("paymentSystem"))
        ).alias("purchases")
    )
    s = sessions.groupBy("company", "app", F.col("user_id").alias("userId")).agg(
        F.collect_list(F.struct(ms.alias("startTime"), "platform")).alias("sessions")
    )
    profiles = p.join(s, ["company", "app", "userId"], "full").cache()
    names = ["sessions_first_purchase", "sessions_between_purchases"]
    flat = cells(metric_values(purchases, sessions, make_tenants(spark), DAY, names))
    nested = cells(metric_values(purchases, sessions, make_tenants(spark), DAY, names, profiles))
    assert nested == flat

    # a payer without profile does not take part
    fewer = profiles.filter("userId != 'hot'")
    without = [r for r in bought if r[1] != "hot"]
    expected = cells(metric_values(make_purchases(spark, without), sessions, make_tenants(spark), DAY, names))
    assert cells(metric_values(purchases, sessions, make_tenants(spark), DAY, names, fewer)) == expected
    profiles.unpersist()


def test_order_within_a_user(spark):
    bought, _ = history(5)
    rows = make_purchases(spark, bought).select("user_id", "time", "id")
    by_user = defaultdict(list)
    for id_, user, time, *_ in bought:
        by_user[user].append((time, id_))
    ordered = {user: sorted(items) for user, items in by_user.items()}

    found = numbered(rows, ["user_id"], ["time", "id"]).collect()
    assert {(r.user_id, r.id): r.ordinal for r in found} == {
        (u, id_): n for u, items in ordered.items() for n, (_, id_) in enumerate(items, 1)
    }
    found = with_next(rows, ["user_id"], ["time", "id"]).collect()
    assert {(r.user_id, r.id): r.next and r.next.id for r in found} == {
        (u, id_): following
        for u, items in ordered.items()
        for (_, id_), following in zip(items, [i for _, i in items[1:]] + [None])
    }


def test_documents_of_paying_users(spark):
    bought, _ = history(6)
    tenants = make_tenants(spark)
    documents = paying_user_documents(paying_user_purchases(make_purchases(spark, bought), tenants, DAY), tenants)
    found, on = defaultdict(list), defaultdict(list)
    for r in documents.collect():
        assert r.user_id not in found
        found[r.user_id] += [p.purchase_id for p in r.purchases]
        assert [p.platform for p in r.purchases_per_platform] == ["Android", "iOS"]
        for p in r.purchases_per_platform:
            on[r.user_id, p.platform] += [x.purchase_id for x in p.purchases]
    ordered = sorted(bought, key=lambda r: (r[2], r[0]))
    for user in found:
        assert found[user] == [r[0] for r in ordered if r[1] == user]
        for platform in ("Android", "iOS"):
            assert on[user, platform] == [r[0] for r in ordered if r[1] == user and r[3] == platform and r[4] < 3]
