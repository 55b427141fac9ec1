"""Hand-made rows at the edges of the definitions."""

from datetime import date, datetime, timedelta

import pytest
from conftest import at, cells, make_purchases, make_sessions, make_tenants
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlens.functions.arithmetic import safe_ratio
from spendlens.functions.parsing import any_time, coerce_int, epoch_ms, iso_day, json_field, path_safe, printed_date
from spendlens.operators.windows import Windows, contained_in
from spendlens.plans.core import sessions_per_user
from spendlens.plans.metrics import metric_values
from spendlens.schema import RAW_PURCHASES, RAW_SESSIONS
from spendlens.sources.normalize import normalize_purchases, normalize_sessions

DAY = Windows.single(datetime(2024, 1, 10), datetime(2024, 1, 11))

SESSIONS = [
    ("s1", "u1", "2024-01-10 00:00:00", "iOS"),
    ("s2", "u1", "2024-01-11 00:00:00", "Android"),
    ("s3", "u1", "2024-01-11 00:00:00.500", "iOS"),
    ("s2", "u2", "2024-01-10 12:00:00", "Android"),
    ("s4", "u2", "2024-01-10 13:00:00", "Web"),
    ("s5", None, "2024-01-10 14:00:00", "iOS"),
    ("s6", "u3", None, "iOS"),
]


def test_session_counts_at_the_edges(spark):
    sessions, tenants = make_sessions(spark, SESSIONS), make_tenants(spark)
    found = cells(
        metric_values(make_purchases(spark, []), sessions, tenants, DAY, ["active_users", "number_sessions"])
    )
    assert found == {
        ("active_users", None, None): 4,
        ("active_users", "Android", None): 2,
        ("active_users", "iOS", None): 2,
        ("number_sessions", None, None): 3,
        ("number_sessions", "Android", None): 1,
        ("number_sessions", "iOS", None): 2,
    }
    rows = {
        r.user_id: (r.total, [(p.platform, p.sessions) for p in r.platforms])
        for r in sessions_per_user(sessions, tenants, DAY).collect()
    }
    assert rows == {"u1": (2, [("Android", 1), ("iOS", 1)]), "u2": (1, [("Android", 1)])}


def test_nothing_happened(spark):
    found = cells(metric_values(make_purchases(spark, []), make_sessions(spark, []), make_tenants(spark), DAY))
    assert len(found) == 8 * 7 + 3 * 3 + 1
    assert set(found.values()) == {0.0}


def test_revenue_shows_found_systems_or_configured_zeros(spark):
    bought = [("1", "u", "2024-01-10 10:00:00", "iOS", 3, 2.5), ("2", "u", "2024-01-10 11:00:00", "Web", 1, 9.0)]
    found = cells(
        metric_values(
            make_purchases(spark, bought), make_sessions(spark, []), make_tenants(spark), DAY, ["total_revenue"]
        )
    )
    assert found == {
        ("total_revenue", None, None): 2.5,
        ("total_revenue", "iOS", None): 2.5,
        ("total_revenue", "iOS", 3): 2.5,
        ("total_revenue", "Android", None): 0.0,
        ("total_revenue", "Android", 1): 0.0,
        ("total_revenue", "Android", 2): 0.0,
    }


def test_purchases_and_sessions_of_two_users(spark):
    bought = [
        ("1", "a", "2024-01-10 09:00:00", "iOS", 1),
        ("2", "a", "2024-01-10 12:00:00", "iOS", 1),
        ("3", "a", "2024-01-10 15:00:00", "iOS", 1),
        ("4", "b", "2024-01-10 10:00:00", "iOS", 1),
    ]
    visits = [("s1", "a", "2024-01-09 08:00:00", "iOS")]
    visits += [(f"s{h}", "a", f"2024-01-10 {h}:00:00", "iOS") for h in ("09", "10", "12", "14")]
    visits += [("t", "b", "2024-01-10 11:00:00", "iOS")]
    found = cells(
        metric_values(
            make_purchases(spark, bought),
            make_sessions(spark, visits),
            make_tenants(spark),
            DAY,
            ["sessions_between_purchases", "sessions_first_purchase"],
        )
    )
    assert found["sessions_between_purchases", None, None] == 1.5
    assert found["sessions_between_purchases", "iOS", None] == 3.0
    assert found["sessions_first_purchase", None, None] == 1.0


def test_midnight_belongs_to_both_days_unless_closed_left(spark):
    bought = make_purchases(spark, [("1", "u", "2024-01-11 00:00:00", "iOS", 1, 5.0)])
    for closed, expected in (("both", [5.0, 5.0, 0.0]), ("left", [0.0, 5.0, 0.0])):
        windows = Windows.every(datetime(2024, 1, 10), timedelta(days=1), 3, closed)
        values = metric_values(bought, make_sessions(spark, []), make_tenants(spark), windows, ["total_revenue"])
        totals = values.filter("grain = 'total'").orderBy("lower").collect()
        assert [r.value for r in totals] == expected


def test_outer_edges_of_adjacent_windows(spark):
    edges = ["2024-01-09 23:59:59.999999", "2024-01-10", "2024-01-13", "2024-01-13 00:00:00.000001"]
    rows = make_sessions(spark, [(str(i), "u", e, "iOS") for i, e in enumerate(edges)])
    windows = Windows.every(datetime(2024, 1, 10), timedelta(days=1), 3)
    found = {(r.id, r.lower, r.upper) for r in windows.assign(rows).collect()}
    assert found == {
        ("1", at("2024-01-10"), at("2024-01-11")),
        ("2", at("2024-01-12"), at("2024-01-13")),
    }


def test_listed_windows_may_overlap(spark):
    bounds = [(at("2024-01-10"), at("2024-01-12")), (at("2024-01-11 06:00"), at("2024-01-11 18:00"))]
    rows = make_sessions(spark, [(str(h), "u", datetime(2024, 1, 10) + timedelta(hours=h), "iOS") for h in range(60)])
    for closed in ("both", "left"):
        windows = Windows.of(bounds, closed)
        assert windows.step is None
        found = sorted((int(r.id), r.lower) for r in windows.assign(rows).collect())
        expected = sorted(
            (h, lower)
            for h in range(60)
            for lower, upper in bounds
            for t in [datetime(2024, 1, 10) + timedelta(hours=h)]
            if lower <= t and (t <= upper if closed == "both" else t < upper)
        )
        assert found == expected


def test_window_sets():
    assert Windows.daily(date(2024, 3, 1)).bounds == ((datetime(2024, 2, 29), datetime(2024, 3, 1)),)
    backfill = Windows.backfill(date(2024, 3, 17))
    assert [b[0].day for b in backfill.bounds] == [1, 2, 3, 4, 5, 6, 7]
    assert backfill.step == timedelta(days=1)
    with pytest.raises(ValueError):
        Windows.single(datetime(2024, 1, 2), datetime(2024, 1, 1))
    with pytest.raises(ValueError):
        Windows.of([])
    with pytest.raises(ValueError):
        Windows.single(datetime(2024, 1, 1), datetime(2024, 1, 2), "right")


def test_containment_of_stored_windows(spark):
    frame = Windows.every(datetime(2024, 1, 1), timedelta(days=1), 5).frame(spark)
    found = contained_in(frame, datetime(2024, 1, 2), datetime(2024, 1, 4)).orderBy("lower").collect()
    assert [r.lower.day for r in found] == [2, 3]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_parsing_does_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        texts = [
            "Thu Jan 11 00:00:05 UTC 2024",
            "Thu Jan 11 00:00:05 +0100 2024",
            "Sun Mar 10 02:30:00 UTC 2024",
            "1.4204124E12",
            "1420412400123",
            "junk",
            "1e300",
            None,
        ]
        df = spark.createDataFrame([(t,) for t in texts], "t string")
        col = F.col("t")
        rows = df.select(
            printed_date(col).alias("p"), epoch_ms(col).alias("e"), any_time(col, T.StringType()).alias("a")
        ).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [r.p for r in rows] == [
        at("2024-01-11 00:00:05"), at("2024-01-10 23:00:05"), at("2024-03-10 02:30:00"), *[None] * 5
    ]
    assert [r.e for r in rows[3:]] == [at("2015-01-04 23:00:00"), at("2015-01-04 23:00:00.123"), None, None, None]
    assert [r.a is None for r in rows] == [False] * 5 + [True] * 3


def test_small_functions(spark):
    df = spark.createDataFrame(
        [("2.9", '{"osType":"iOS"}', "2024-01-10T05:06:07Z", 3.0, 0.0), ("x", "junk", "soon", 1.0, 4.0)],
        "n string, j string, d string, a double, b double",
    )
    rows = df.select(
        coerce_int(F.col("n")).alias("n"),
        json_field(F.col("j"), T.StringType(), "osType").alias("j"),
        iso_day(F.col("d")).alias("d"),
        safe_ratio("a", "b").alias("r"),
        path_safe(F.lit("my app")).alias("p"),
    ).collect()
    assert [tuple(r) for r in rows] == [
        (2, "iOS", date(2024, 1, 10), 0.0, "my_app"),
        (None, None, None, 0.25, "my_app"),
    ]


def test_raw_documents(spark, tmp_path):
    lines = [
        '{"id":"1","userId":"u","price":"2.5","paymentSystem":1,"time":1704877200000,"device":{"osType":"iOS"}}',
        '{"id":"2","userId":"u","price":1,"paymentSystem":"1.0","time":"Wed Jan 10 10:00:00 UTC 2024",'
        '"device":{"osType":"iOS"}}',
        '{"id":"3","userId":"u","price":1,"paymentSystem":"1","time":"junk","device":{"osType":"iOS"}}',
        '{"id":"4","userId":"u","price":1,"paymentSystem":"1","time":1704877200000,"device":{}}',
    ]
    (tmp_path / "p.json").write_text("\n".join(lines))
    bought = normalize_purchases(spark.read.schema(RAW_PURCHASES).json(str(tmp_path)), "c", "a")
    rows = sorted((r.id, r.price, r.time, r.platform, r.payment_system) for r in bought.collect())
    assert rows == [
        ("1", 2.5, at("2024-01-10 09:00:00"), "iOS", 1),
        ("2", 1.0, at("2024-01-10 10:00:00"), "iOS", 1),
    ]
    found = cells(
        metric_values(bought, make_sessions(spark, []), make_tenants(spark), DAY, ["total_revenue"])
    )
    assert found["total_revenue", "iOS", 1] == 3.5  # "1" and "1.0" are one system


def test_raw_sessions(spark):
    raw = spark.createDataFrame(
        [
            ("1", None, "Wed Jan 10 10:00:00 UTC 2024", '{"osType":"iOS"}'),
            ("2", "u", "junk", '{"osType":"iOS"}'),
        ],
        RAW_SESSIONS,
    )
    rows = normalize_sessions(raw, "c", "a").collect()
    assert [(r.id, r.user_id, r.platform) for r in rows] == [("1", None, "iOS")]
