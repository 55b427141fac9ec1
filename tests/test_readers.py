"""Raw documents as JSON text, through the readers to metrics."""

import json
from datetime import datetime

import pytest
from conftest import cells

from spendlens.operators.tenants import Tenants, build_catalogue
from spendlens.operators.windows import Windows
from spendlens.plans.metrics import metric_values
from spendlens.schema import RAW_APP_SETTINGS, RAW_COMPANIES, RAW_PROFILES, RAW_PURCHASES, RAW_SESSIONS
from spendlens.sources.collections import read_collections
from spendlens.sources.normalize import (
    normalize_profiles,
    normalize_purchases,
    normalize_sessions,
    profile_purchases,
    profile_sessions,
    read_documents,
)

DAY = Windows.single(datetime(2024, 1, 10), datetime(2024, 1, 11))
TEN = 1704880800000.0  # 2024-01-10 10:00:00 UTC in milliseconds


@pytest.fixture
def read(spark, tmp_path):
    def reader(name, schema, rows):
        (tmp_path / f"{name}.json").write_text("\n".join(map(json.dumps, rows)))
        return read_documents(spark, str(tmp_path / f"{name}.json"), schema)

    return reader


def test_flat_documents(read):
    bought = read(
        "purchases",
        RAW_PURCHASES,
        [
            {"id": 1, "userId": "u", "price": 2.5, "paymentSystem": 1.0, "time": TEN, "device": {"osType": "iOS"}},
            {"id": 2, "userId": "u", "price": "1.5", "paymentSystem": "2", "time": "Wed Jan 10 11:00:00 UTC 2024", "device": {"osType": "iOS"}},
            {"id": 3, "userId": None, "price": 1, "paymentSystem": None, "time": TEN, "device": {"osType": "Web"}},
            {"id": 4, "userId": "u", "price": 9, "paymentSystem": 1, "time": "junk", "device": {"osType": "iOS"}},
            {"id": 5, "userId": "u", "price": 9, "paymentSystem": 1, "time": TEN, "device": {}},
            {"id": 6, "userId": "u", "price": 9, "paymentSystem": 1, "time": 1e18, "device": {"osType": "iOS"}},
        ],
    )
    visits = read(
        "sessions",
        RAW_SESSIONS,
        [
            {"id": "s", "userId": "u", "startTime": "Wed Jan 10 09:00:00 UTC 2024", "device": {"osType": "iOS"}},
            {"id": "t", "userId": "v", "startTime": "Wed Jan 10 12:00:00 +0000 2024", "device": {"osType": "Android"}},
        ],
    )
    companies = read("companies", RAW_COMPANIES, [{"name": "c", "apps": ["a", "bare"]}])
    settings = read("settings", RAW_APP_SETTINGS, [{"company": "c", "app": "a", "appType": ["iOS", "Android"], "paymentSystems": [1, 2]}])
    purchases, sessions = normalize_purchases(bought, "c", "a"), normalize_sessions(visits, "c", "a")
    assert sorted((r.id, r.price, r.payment_system, r.platform) for r in purchases.collect()) == [
        ("1", 2.5, 1, "iOS"), ("2", 1.5, 2, "iOS"), ("3", 1.0, None, "Web")
    ]
    tenants = Tenants.of(build_catalogue(companies, settings))
    found = metric_values(purchases, sessions, tenants, DAY)
    values = cells(found.filter("app = 'a'"))
    assert values["total_revenue", "iOS", None] == 4.0 and values["total_revenue", "iOS", 2] == 1.5
    assert values["arpu", None, None] == 2.0 and values["avg_purchases_user", None, None] == 2.0
    assert {r.grain for r in found.filter("app = 'bare'").collect()} == {"total"}


def test_profiles(read):
    raw = read(
        "profiles",
        RAW_PROFILES,
        [
            {"userId": "u", "purchases": [{"time": TEN, "platform": "iOS", "paymentSystem": 1.0}], "sessions": [{"startTime": TEN - 1000, "platform": "iOS"}]},
            {"userId": "v", "purchases": None, "sessions": [{"startTime": TEN, "platform": "Web"}]},
        ],
    )
    profiles = normalize_profiles(raw, "c", "a")
    purchases = profile_purchases(profiles).selectExpr("*", "'1' AS id", "1.0D AS price")
    sessions = profile_sessions(profiles).selectExpr("*", "'s' AS id")
    assert purchases.count() == 1 and sessions.count() == 2
    spark = raw.sparkSession
    tenants = Tenants.of(spark.sql("SELECT 'c' AS company, 'a' AS app, array('iOS') AS platforms, array(1) AS payment_systems"))
    names = ["sessions_first_purchase", "sessions_between_purchases"]
    found = cells(metric_values(purchases, sessions, tenants, DAY, names, profiles))
    assert found["sessions_first_purchase", None, None] == 1.0
    assert found["sessions_between_purchases", None, None] == 0.0


def test_collections_of_several_tenants(spark, tmp_path):
    def collection(name, *rows):
        folder = tmp_path / name
        folder.mkdir()
        (folder / "part.json").write_text("\n".join(json.dumps(r) for r in rows))

    def purchase(n):
        return {"id": n, "userId": f"u{n}", "price": n, "paymentSystem": 1, "time": 1.7e12, "device": {"osType": "iOS"}}

    collection("acme_purchases_shop", purchase(1), purchase(2))
    collection("big_co_purchases_my_app", purchase(3))  # underscores stand for spaces and for themselves
    collection("acme_purchases_other", purchase(4))
    collection("acme_mobileSessions_shop", {"id": 9, "userId": "u", "startTime": "junk", "device": {"osType": "iOS"}})
    (tmp_path / "acme_purchases_other" / "part.json.gz").write_bytes(b"an error for whoever opens it")
    kinds = "company string, app string, platforms array<string>, payment_systems array<int>"
    known = [("acme", "shop", ["iOS"], [1]), ("big_co", "my app", ["iOS"], [1]), ("none", "none", [], [])]
    tenants = Tenants.of(spark.createDataFrame(known, kinds))
    raw = read_collections(spark, str(tmp_path), "purchases", RAW_PURCHASES, tenants)
    found = normalize_purchases(raw)
    assert sorted((r.company, r.app, r.id, r.price) for r in found.collect()) == [
        ("acme", "shop", "1", 1.0), ("acme", "shop", "2", 2.0), ("big_co", "my app", "3", 3.0),
    ]
    assert read_collections(spark, str(tmp_path), "mobileSessions", RAW_SESSIONS, tenants).count() == 1
    large = Tenants(tenants.frame, False)
    assert read_collections(spark, str(tmp_path), "mobileSessions", RAW_SESSIONS, large).first().app == "shop"
