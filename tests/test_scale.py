"""What the plans must look like for large inputs, and relations that always hold."""

from datetime import datetime

import pytest
from conftest import SMALL, cells, make_purchases, make_sessions, make_tenants, shown

from spendlens.checks import inputs as I
from spendlens.operators import tenants as tenants_module
from spendlens.operators.tenants import Tenants, build_catalogue
from spendlens.plans.metrics import METRIC_NAMES, metric_values
from spendlens.operators.windows import Windows


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def inputs(spark):
    return I.purchases(spark, SMALL), I.sessions(spark, SMALL), I.one_tenant(spark)


def test_the_window_reaches_the_scan(inputs):
    plan = plan_of(metric_values(*inputs, I.DAYS, ["total_revenue"]))
    pushed = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(pushed) == 1
    assert "EqualTo(event_type,purchase)" in pushed[0]
    assert "GreaterThanOrEqual(ts," in pushed[0]
    assert "user_id" not in pushed[0].split("Batched")[0]


def test_no_metric_multiplies_rows(inputs):
    plan = plan_of(metric_values(*inputs, I.DAYS))
    assert "CartesianProduct" not in plan
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan


def test_a_hot_user_is_split_in_the_joins(spark, tmp_path):
    """One user owns a third of the sessions. Their partition of each join is read in pieces."""
    rows = spark.range(0, 120_000, 1, 12).selectExpr(
        "'c' AS company",
        "'a' AS app",
        "CAST(id AS STRING) AS id",
        "IF(id % 3 = 0, 'hot', CAST(id % 997 AS STRING)) AS user_id",
        "2.0D AS price",
        "TIMESTAMP_NTZ'2024-01-10' + make_interval(0, 0, 0, 0, 0, 0, CAST(id % 80000 AS DECIMAL(18, 6))) AS time",
        "IF(id % 2 = 0, 'iOS', 'Android') AS platform",
        "CAST(1 + id % 2 AS INT) AS payment_system",
    )
    path = str(tmp_path / "rows")
    rows.write.parquet(path)
    stored = spark.read.parquet(path)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.files.openCostInBytes": "64m",
        "spark.sql.shuffle.partitions": "12",
    }
    before = {k: spark.conf.get(k) for k in settings}
    day = Windows.single(datetime(2024, 1, 10), datetime(2024, 1, 11))
    bought = stored.filter("CAST(id AS BIGINT) % 40 < 2")
    expected = {}
    try:
        for split in (False, True):
            for k, v in (settings if split else before).items():
                spark.conf.set(k, v)
            for name in ("sessions_first_purchase", "sessions_between_purchases"):
                values = metric_values(bought, stored.drop("price", "payment_system"), make_tenants(spark), day, [name])
                found = cells(values)
                if split:
                    assert found == expected[name]
                    values.collect()
                    joins = [line.strip() for line in plan_of(values).splitlines() if "Join" in line]
                    assert any("SortMergeJoin(skew=true)" in line for line in joins), joins
                else:
                    expected[name] = found
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_a_large_catalogue_is_not_broadcast(spark, monkeypatch):
    bought, visited = I.purchases(spark, SMALL, I.APP), I.sessions(spark, SMALL, I.APP)
    small = I.two_tenants(spark, SMALL)
    monkeypatch.setattr(tenants_module, "BROADCAST_ROWS", 1)
    large = Tenants.of(build_catalogue(I.company_documents(spark, SMALL), I.app_documents(spark, SMALL)))
    assert small.small and not large.small
    names = ["total_revenue", "purchases_per_session"]
    one, two = (shown(metric_values(bought, visited, t, I.WEEKS, names)) for t in (small, large))
    assert one == two


def test_unknown_metrics_are_refused(inputs):
    with pytest.raises(ValueError):
        metric_values(*inputs, I.WEEKS, ["revenue"])


def test_relations_between_metrics(spark, inputs):
    rows = metric_values(*inputs, I.WEEKS, METRIC_NAMES).collect()
    value = {(r.lower, r.metric, r.platform, r.payment_system): r.value for r in rows}
    for lower in {r.lower for r in rows}:
        of = lambda m, p=None, y=None: value[lower, m, p, y]
        for metric in ("total_revenue", "active_users", "number_sessions", "sessions_per_user"):
            assert of(metric) == pytest.approx(of(metric, "Android") + of(metric, "iOS"))
        for p in ("Android", "iOS"):
            systems = [v for (l, m, q, y), v in value.items() if (l, m, q) == (lower, "total_revenue", p) and y]
            assert sum(systems) == pytest.approx(of("total_revenue", p))
            assert of("number_sessions", p) <= of("sessions_per_user", p)
            assert of("avg_revenue_session", p) * of("number_sessions", p) == pytest.approx(of("total_revenue", p))


def test_sessions_of_strangers_do_not_count(spark):
    bought = make_purchases(spark, [("1", None, "2024-01-10 10:00:00", "iOS", 1)])
    visits = make_sessions(spark, [("s", None, "2024-01-10 10:00:00", "iOS")])
    day = Windows.single(datetime(2024, 1, 10), datetime(2024, 1, 11))
    found = cells(metric_values(bought, visits, make_tenants(spark), day))
    assert found["total_revenue", None, None] == 1.0
    assert found["active_users", None, None] == 1.0
    assert found["paying_users", None, None] == 0.0
    assert found["sessions_per_user", None, None] == 0.0
    assert found["avg_purchases_user", None, None] == 0.0
    assert found["purchases_per_session", None, None] == 0.0


def test_purchases_without_a_user_are_nobodys(spark):
    times = [f"2024-01-10 1{i}:00:00" for i in range(3)]
    bought = make_purchases(spark, [(str(i), "u" if i == 0 else None, t, "iOS", 1) for i, t in enumerate(times)])
    visits = make_sessions(spark, [("s", "u", times[0], "iOS"), ("t", "v", times[1], "iOS")])
    day = Windows.single(datetime(2024, 1, 10), datetime(2024, 1, 11))
    found = cells(metric_values(bought, visits, make_tenants(spark), day))
    for cell in ((None, None), ("iOS", None), ("iOS", 1)):
        assert found["avg_purchases_user", *cell] == 1.0
        assert found["purchases_per_session", *cell] == 0.5
    assert found["total_revenue", None, None] == 3.0


def test_small_amounts_are_not_rounded_away(spark):
    rows = [("1", "u", "2024-01-10 10:00:00", "iOS", 1, 0.1), ("2", "u", "2024-01-10 11:00:00", "iOS", 1, 0.0000004)]
    day = Windows.single(datetime(2024, 1, 10), datetime(2024, 1, 11))
    found = cells(metric_values(make_purchases(spark, rows), make_sessions(spark, []), make_tenants(spark), day))
    assert found["total_revenue", None, None] == pytest.approx(0.1000004, abs=1e-12)


def test_an_app_without_settings_shows_its_total(spark):
    kinds = "company string, app string, platforms array<string>, payment_systems array<int>"
    tenants = Tenants.of(spark.createDataFrame([("c", "a", None, None)], kinds))
    bought = make_purchases(spark, [("1", "u", "2024-01-10 10:00:00", "iOS", 1)])
    day = Windows.single(datetime(2024, 1, 10), datetime(2024, 1, 11))
    values = metric_values(bought, make_sessions(spark, []), tenants, day, ["total_revenue", "paying_users"])
    assert cells(values) == {("total_revenue", None, None): 0.0, ("paying_users", None, None): 1.0}


def test_only_the_wanted_distinct_count_is_planned(inputs):
    plan = plan_of(metric_values(*inputs, I.DAYS, ["active_users"]))
    assert "Expand" not in plan
    assert "yyyyMMddHH" not in plan  # the session id is not built
    everything = plan_of(metric_values(*inputs, I.DAYS, ["active_users", "number_sessions", "sessions_per_user"]))
    assert "Expand" not in everything and everything.count("FileScan") == 1
