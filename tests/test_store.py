"""Results in storage: replaced by key, found by window."""

from datetime import datetime, timedelta

import pytest
from conftest import SMALL, make_purchases, make_sessions, make_tenants, shown

from pyspark.sql import functions as F

from spendlens.checks import inputs as I
from spendlens.operators.tenants import Tenants
from spendlens.operators.windows import Windows
from spendlens.plans.metrics import METRIC_NAMES, metric_values
from spendlens.plans.run import run
from spendlens.schema import METRIC_VALUES, PURCHASES
from spendlens.sources.store import Store, load_events, lookup_sum, metric_documents, save_events

THREE_DAYS = Windows.every(datetime(2024, 1, 8), timedelta(days=1), 3)


@pytest.fixture(scope="module")
def inputs(spark):
    return I.purchases(spark, SMALL), I.sessions(spark, SMALL), I.one_tenant(spark)


def test_a_run_and_its_repetition(spark, inputs, tmp_path):
    store = Store(str(tmp_path / "out"))
    run(spark, *inputs, THREE_DAYS, store)
    expected = shown(metric_values(*inputs, THREE_DAYS))

    def stored(table):
        return shown(store.read(spark, table))

    first = {t: stored(t) for t in ("metric_values", "payers", "paying_users", "sessions_per_user")}
    values = store.read(spark, "metric_values").select(*METRIC_VALUES.fieldNames())
    assert shown(values) == expected
    assert {r.metric for r in values.collect()} == set(METRIC_NAMES)

    # another window is added, the repeated one replaces its rows
    run(spark, *inputs, Windows.single(datetime(2024, 1, 10), datetime(2024, 1, 11)), store)
    assert {t: stored(t) for t in first} == first
    two_days = Windows.single(datetime(2024, 1, 10), datetime(2024, 1, 12))
    run(spark, *inputs, two_days, store)
    assert len(stored("metric_values")) == len(expected) + metric_values(*inputs, two_days).count()

    day = store.metric(spark, "total_revenue", datetime(2024, 1, 8), datetime(2024, 1, 9))
    assert {(r.lower.day, r.upper.day) for r in day.collect()} == {(8, 9)}
    days = store.within(spark, "metric_values", datetime(2024, 1, 8), datetime(2024, 1, 11))
    summed = lookup_sum(days, "number_sessions", datetime(2024, 1, 8), datetime(2024, 1, 11))
    by_grain = {(r.grain, r.platform): r for r in summed.collect()}
    assert by_grain["total", None].windows == 3
    assert by_grain["total", None].value == sum(r.value for (g, _), r in by_grain.items() if g == "platform")


def test_a_key_without_rows_replaces_earlier_rows(spark, tmp_path):
    store, tenants = Store(str(tmp_path / "out")), make_tenants(spark)
    day = Windows.single(datetime(2024, 1, 10), datetime(2024, 1, 11))
    bought = make_purchases(spark, [("1", "u", "2024-01-10 10:00:00", "iOS", 1)])
    visits = make_sessions(spark, [("s", "u", "2024-01-10 10:00:00", "iOS")])
    run(spark, bought, visits, tenants, day, store)
    assert store.read(spark, "paying_users").count() == 1
    run(spark, make_purchases(spark, []), make_sessions(spark, []), tenants, day, store)
    for table in ("payers", "paying_users", "sessions_per_user"):
        assert store.read(spark, table).count() == 0
    assert store.read(spark, "metric_values").agg({"value": "sum"}).first()[0] == 0.0


def test_files_do_not_grow_with_tenants_and_metrics(spark, tmp_path):
    names = ", ".join(f"('c', 'app{i}', array('Android', 'iOS'), array(1, 2))" for i in range(20))
    tenants = Tenants.of(spark.sql(f"SELECT * FROM VALUES {names} AS t(company, app, platforms, payment_systems)"))
    by_app = I.purchases(spark, SMALL).selectExpr("*", "CAST(user_id AS INT) % 20 AS n")
    bought = by_app.selectExpr("'c' AS company", "concat('app', n) AS app", "id", "user_id", "price", "time", "platform", "payment_system")
    visits = make_sessions(spark, [])
    store, week = Store(str(tmp_path / "out")), Windows.every(datetime(2024, 1, 8), timedelta(days=1), 7)
    values = metric_values(bought, visits, tenants, week)
    store.write(values, "metric_values")
    assert len(list((tmp_path / "out").rglob("*.parquet"))) <= 7 * 4
    one = store.metric(spark, "total_revenue", datetime(2024, 1, 8), datetime(2024, 1, 9))
    assert one.filter("grain = 'total'").count() == 20
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(lower_edge" in plan

    # one metric of one window and tenant is replaced, all else stays
    part = values.filter("metric = 'total_revenue' AND app = 'app3' AND lower = TIMESTAMP_NTZ'2024-01-08'")
    store.write(part.withColumn("value", F.lit(-1.0)), "metric_values")
    found = store.read(spark, "metric_values")
    assert found.count() == values.count()
    assert {r.app for r in found.filter("value = -1").collect()} == {"app3"}
    store.compact(spark, "metric_values", Store(str(tmp_path / "small")))
    assert Store(str(tmp_path / "small")).read(spark, "metric_values").count() == values.count()


def test_nested_documents(spark):
    bought = make_purchases(
        spark,
        [("1", "u", "2024-01-10 10:00:00", "iOS", 2, 4.0), ("2", "u", "2024-01-10 11:00:00", "iOS", 1, 1.0)],
    )
    visits = make_sessions(spark, [("s", "u", "2024-01-10 10:00:00", "iOS")])
    day = Windows.single(datetime(2024, 1, 10), datetime(2024, 1, 11))
    values = metric_values(bought, visits, make_tenants(spark), day, ["arpu", "active_users"])
    documents = {r.metric: r for r in metric_documents(values).collect()}
    arpu = documents["arpu"]
    assert arpu.result == 5.0
    assert [(p.platform, p.res) for p in arpu.platforms] == [("Android", 0.0), ("iOS", 5.0)]
    assert [(y.system, y.res) for y in arpu.platforms[1].payment_systems] == [(1, 1.0), (2, 4.0)]
    assert [p.payment_systems for p in documents["active_users"].platforms] == [[], []]


def test_saved_events_are_pruned_by_day(spark, tmp_path):
    path = str(tmp_path / "purchases")
    save_events(I.purchases(spark, SMALL), path)
    save_events(I.purchases(spark, SMALL), path)
    loaded = load_events(spark, path, PURCHASES)
    assert loaded.count() == I.purchases(spark, SMALL).count()
    sliced = THREE_DAYS.assign(loaded)
    plan = sliced._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    assert sliced.count() == THREE_DAYS.assign(I.purchases(spark, SMALL)).count()
