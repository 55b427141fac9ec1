"""Runs that share aggregates, end too early or go on from a kept state; overlapping windows."""

import random
from datetime import datetime, timedelta

import pytest
from conftest import SMALL, make_purchases, make_sessions, make_tenants, shown
from pyspark.sql import functions as F

from spendlens.checks import inputs as I
from spendlens.operators import exact
from spendlens.operators.windows import Windows
from spendlens.plans.core import configured_counts, numbered_purchases, paying_user_purchases
from spendlens.plans.cubes import BY_ID, Cubes, payers_of, purchase_cube, session_cube
from spendlens.plans.metrics import METRIC_NAMES, metric_values
from spendlens.plans.run import run
from spendlens.plans.state import FirstPurchases
from spendlens.schema import SESSIONS
from spendlens.sources.shared import written
from spendlens.sources.store import Store, load_events, save_events

DAY = Windows.single(datetime(2024, 1, 10), datetime(2024, 1, 11))


def scans(df, path):
    """Scans of a table in the final plan, once the query has run; reused exchanges count once."""
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return final.count(path)


# Shared aggregates


def test_all_metrics_take_two_scans_of_each_table(spark, tmp_path_factory):
    tmp_path = tmp_path_factory.mktemp("t")  # short, as plans shorten long paths
    bought, visited = str(tmp_path / "bought"), str(tmp_path / "visited")
    I.purchases(spark, SMALL).write.parquet(bought)
    I.sessions(spark, SMALL).write.parquet(visited)
    tables = spark.read.parquet(bought), spark.read.parquet(visited)
    tenants, found = I.one_tenant(spark), {"bought": [], "visited": []}  # lists: two threads write

    def counted(df, name):
        # every write is a query of its own, so scans add up
        for table in found:
            found[table].append(scans(df, f"{tmp_path}/{table}"))
        return written(df, name)

    cubes = Cubes.written(*tables, tenants, I.WEEKS, counted)
    values = metric_values(*tables, tenants, I.WEEKS, METRIC_NAMES, cubes=cubes)
    for table in found:
        found[table].append(scans(values, f"{tmp_path}/{table}"))
    assert {table: sum(n) for table, n in found.items()} == {"bought": 2, "visited": 2}
    assert shown(values) == shown(metric_values(*tables, tenants, I.WEEKS))


def test_cubes_of_unusual_rows(spark):
    tenants = make_tenants(spark)
    bought = make_purchases(
        spark,
        [("1", None, "2024-01-10 10:00:00", "iOS", 1, 2.0), ("2", "u", "2024-01-10 10:00:00", "Web", 9, 4.0),
         ("3", "u", "2024-01-10 10:00:00", "iOS", None, 8.0), ("4", "v", "2024-01-10 11:00:00", "iOS", 1, 16.0)],
    )
    cube = purchase_cube(bought, tenants, DAY)
    amounts = exact.added_up(cube, ["user_id", "platform", "payment_system"], "amount", ["n"])
    assert sorted((str(r.user_id), r.platform, r.payment_system or 0, r.amount, r.n) for r in amounts.collect()) == [
        ("None", "iOS", 1, 2.0, 1), ("u", "Web", 9, 4.0, 1), ("u", "iOS", 0, 8.0, 1), ("v", "iOS", 1, 16.0, 1),
    ]
    assert sorted((r.user_id, r.purchases, r.qualified) for r in payers_of(cube).collect()) == [("u", 2, False), ("v", 1, True)]
    visits = make_sessions(spark, [("s", None, "2024-01-10 10:00:00", "iOS"), ("s", "u", "2024-01-10 10:00:00", "iOS"), (None, "u", "2024-01-10 12:00:00", "Web")])
    rows = sorted((r.kind, str(r.value), r.n) for r in session_cube(visits, tenants, DAY).collect())
    assert rows == [("id", "s", 2), ("user", "None", 1), ("user", "u", 1)]
    assert session_cube(make_sessions(spark, []), tenants, DAY, (BY_ID,)).count() == 0


def test_long_rows_of_paying_users(spark):
    tenants = make_tenants(spark)
    bought = make_purchases(
        spark, [(str(n), "u", f"2024-01-10 1{n % 3}:00:00", ("iOS", "Web")[n % 2], 1 + n % 3) for n in range(9)] + [("x", "v", "2024-01-10 10:00:00", "Web", 1)]
    )
    rows = paying_user_purchases(bought, tenants, DAY)
    order = [r.id for r in numbered_purchases(rows).filter("user_id = 'u'").orderBy("ordinal").collect()]
    assert order == ["0", "3", "6", "1", "4", "7", "2", "5", "8"]
    counts = configured_counts(rows, tenants).groupBy("user_id", "platform").agg(F.sum("purchases").alias("n"))
    assert {(r.user_id, r.platform): r.n for r in counts.collect()} == {
        ("u", "iOS"): 3, ("u", "Android"): 0, ("v", "iOS"): 0, ("v", "Android"): 0,
    }


# Overlapping windows


@pytest.mark.parametrize("closed", ["both", "left"])
def test_elementary_intervals(spark, closed):
    rng = random.Random(7)
    start = datetime(2024, 1, 10)
    edges = [start + timedelta(hours=h, seconds=s) for h in range(0, 120, 7) for s in (0, 1)]
    bounds = [tuple(sorted(rng.choices(edges, k=2))) for _ in range(300)] + [(edges[3], edges[3])]
    windows = Windows.of(bounds, closed)
    assert windows.listed
    times = [e + timedelta(microseconds=d) for e in edges for d in (-1, 0, 1)] + [start + timedelta(minutes=17 * n) for n in range(500)]
    rows = make_sessions(spark, [(str(n), "u", t, "iOS") for n, t in enumerate(times)])
    located = windows.locate(rows).select("id", "piece").collect()
    assert len(located) == len({r.id for r in located}) == sum(
        windows.first <= t and (t <= windows.last if closed == "both" else t < windows.last) for t in times
    )
    found = {(r.id, r.lower, r.upper) for r in windows.assign(rows).collect()}
    want = {
        (str(n), a, b) for n, t in enumerate(times) for a, b in windows.bounds if a <= t and (t <= b if closed == "both" else t < b)
    }
    assert found == want


def test_thousands_of_overlapping_windows(spark):
    start = datetime(2024, 1, 1)
    windows = Windows.of((start + timedelta(minutes=15 * n), start + timedelta(minutes=15 * n, days=2)) for n in range(2600))
    cube = purchase_cube(I.purchases(spark, SMALL), I.one_tenant(spark), windows)
    totals = exact.added_up(cube, ["lower"], "amount", ["n"])
    assert scans(totals, "events.parquet") == 1
    by_lower = {r.lower: (r.n, r.amount) for r in totals.collect()}
    rows = [(r.time, r.price) for r in I.purchases(spark, SMALL).collect()]
    for n in range(0, 2600, 97):
        lower = start + timedelta(minutes=15 * n)
        inside = [p for t, p in rows if lower <= t <= lower + timedelta(days=2)]
        assert by_lower.get(lower, (0, 0)) == (len(inside), pytest.approx(sum(inside)))


# Publishing


def test_a_run_that_ends_early_is_never_seen(spark, tmp_path, monkeypatch):
    store, tenants = Store(str(tmp_path / "out")), make_tenants(spark)
    visits = make_sessions(spark, [("s", "u", "2024-01-10 10:00:00", "iOS")])

    def bought(price):
        return make_purchases(spark, [("1", "u", "2024-01-10 10:00:00", "iOS", 1, price)])

    def seen(at=store):
        revenue = at.metric(spark, "total_revenue", *DAY.bounds[0]).filter("grain = 'total'").first().value
        return revenue, {t: shown(at.read(spark, t)) for t in ("payers", "paying_users", "sessions_per_user")}

    assert run(spark, bought(1.0), visits, tenants, DAY, store) == 1
    before = seen()
    snapshot = store.snapshot(spark)
    write = Store.begin

    def begin(self, label=None):
        out = write(self, label)
        own = out.write

        def fails(df, table, keys=None):
            if table == "paying_users":
                raise RuntimeError("lost")
            own(df, table, keys)

        object.__setattr__(out, "write", fails)
        return out

    with monkeypatch.context() as m:
        m.setattr(Store, "begin", begin)
        with pytest.raises(RuntimeError, match="lost"):
            run(spark, bought(2.0), make_sessions(spark, []), tenants, DAY, store)
    assert len(list((tmp_path / "out" / "metric_values").rglob("run=*"))) == 2
    assert seen() == before
    assert run(spark, bought(3.0), visits, tenants, DAY, store) == 2
    assert seen()[0] == 3.0 and seen(snapshot) == before
    assert not list((tmp_path / "out" / "_scratch").glob("*/payers*")) or len(list((tmp_path / "out" / "_scratch").iterdir())) == 1


def test_the_sequence_decides_not_the_clock(spark, tmp_path, monkeypatch):
    store = Store(str(tmp_path / "out"))
    values = spark.sql(
        "SELECT 'c' AS company, 'a' AS app, TIMESTAMP_NTZ'2024-01-10' AS lower, TIMESTAMP_NTZ'2024-01-11' AS upper, 'm' AS metric, 1D AS value"
    )
    early, late = store.begin(), store.begin()
    late.write(values.withColumn("value", F.lit(2.0)), "metric_values")
    early.write(values, "metric_values")
    monkeypatch.setattr("time.time_ns", lambda: 0)
    assert (late.publish(spark), early.publish(spark)) == (1, 2)
    assert [r.value for r in store.read(spark, "metric_values").collect()] == [1.0]
    # A place that another run has taken meanwhile is not overwritten.
    third = store.begin()
    third.write(values.withColumn("value", F.lit(3.0)), "metric_values")
    real, calls = Store.published, []

    def stale(self, session):
        calls.append(1)
        return real(self, session)[: 1 if len(calls) == 1 else None]

    monkeypatch.setattr(Store, "published", stale)
    assert third.publish(spark) == 3 and len(calls) == 2
    monkeypatch.undo()
    assert [r.value for r in store.read(spark, "metric_values").collect()] == [3.0]


# First purchases that are kept


def batches(seed):
    """Purchases and sessions that arrive in four batches: by day, but every sixth row later than its day."""
    rng = random.Random(seed)
    bought, visited = [[] for _ in range(4)], [[] for _ in range(4)]
    for n in range(160):
        t = datetime(2024, 1, 8 + rng.randrange(4), rng.randrange(24), rng.randrange(4) * 15)
        arrives = t.day - 8 if rng.randrange(6) else 3
        user, platform = rng.choice(["a", "b", "c", None]), rng.choice(["iOS", "Android", "Web"])
        if n % 4 == 0:
            bought[arrives].append((str(n), user, t, platform, rng.choice([1, 2, 3, None])))
        else:
            visited[arrives].append((str(n), user, t, platform))
    return bought, visited


def test_kept_first_purchases_equal_a_full_recomputation(spark, tmp_path):
    bought, visited = batches(1)
    tenants, state = make_tenants(spark), FirstPurchases(str(tmp_path / "state"))
    days = Windows.every(datetime(2024, 1, 8), timedelta(days=1), 4)
    for n in range(4):
        purchases, sessions = (make_purchases(spark, sum(bought[: n + 1], [])), make_sessions(spark, sum(visited[: n + 1], [])))
        arrived = make_purchases(spark, bought[n]), make_sessions(spark, visited[n])
        assert state.advance(spark, *arrived, sessions, label=f"day {n}")
        if n > 1:
            kept = metric_values(purchases, sessions, tenants, days, ["sessions_first_purchase"], reached=state.reached(spark, tenants))
            assert shown(kept) == shown(metric_values(purchases, sessions, tenants, days, ["sessions_first_purchase"]))
    before = shown(state.reached(spark, tenants))
    assert before and not state.advance(spark, *arrived, sessions, label="day 3")
    state.advance(spark, make_purchases(spark, []), make_sessions(spark, []), sessions, label="empty")
    small = FirstPurchases(str(tmp_path / "small"))
    state.compact(spark, small)
    assert shown(state.reached(spark, tenants)) == shown(small.reached(spark, tenants)) == before


def test_a_second_day_does_not_read_the_first(spark, tmp_path):
    path, tenants = str(tmp_path / "sessions"), make_tenants(spark)
    day = [[(f"{d}{n}", "u", f"2024-01-{d} 0{n}:00:00", "iOS") for n in range(8)] for d in (10, 11)]
    first, second = (make_sessions(spark, rows) for rows in day)
    state = FirstPurchases(str(tmp_path / "state"))
    save_events(first, path)
    state.advance(spark, make_purchases(spark, []), first, load_events(spark, path, SESSIONS))
    save_events(second, path)
    # A reader that opened the folder of the first day would fail on this file.
    (tmp_path / "sessions" / "company=c" / "app=a" / "day=2024-01-10" / "part-broken.parquet").write_bytes(b"broken")
    bought = make_purchases(spark, [("1", "u", "2024-01-11 03:00:00", "iOS", 1)])
    state.advance(spark, bought, second, load_events(spark, path, SESSIONS))
    reached = {(r.platform, r.payment_system): r.sessions for r in state.reached(spark, tenants).collect()}
    assert reached == {(None, None): 12, ("iOS", 1): 12}
    with pytest.raises(Exception, match="broken"):
        load_events(spark, path, SESSIONS).count()


def test_a_run_with_kept_first_purchases(spark, tmp_path):
    tables, tenants = (I.purchases(spark, SMALL), I.sessions(spark, SMALL)), I.one_tenant(spark)
    state, store = FirstPurchases(str(tmp_path / "state")), Store(str(tmp_path / "out"))
    state.advance(spark, *tables, tables[1])
    week = I.WEEK_2
    run(spark, *tables, tenants, week, store, state=state)
    found = store.read(spark, "metric_values")
    want = metric_values(*tables, tenants, week)
    assert shown(found.select(*want.columns)) == shown(want)
