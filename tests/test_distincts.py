"""Distinct users from daily bitmaps against direct counts; rejected records."""

import json
import random
from datetime import date, datetime, timedelta

from conftest import make_sessions, make_tenants
from pyspark.sql import Observation
from pyspark.sql import functions as F

from spendlens.plans import distincts
from spendlens.plans.distincts import CODES, CODES_SCHEMA, DailyUsers
from spendlens.schema import RAW_PURCHASES
from spendlens.sources.normalize import mark_purchases, normalize_purchases, read_documents
from spendlens.sources.rejects import Landing, counted, with_corrupt
from spendlens.sources.store import Store

START = datetime(2024, 1, 1)


def _sessions(seed, n, days):
    draw = random.Random(seed)
    users = [None, "", *[f"u{i}" for i in range(60)]]
    return [
        (f"s{seed}-{i}", draw.choice(users), START + timedelta(days=draw.randrange(days), minutes=draw.randrange(1440)),
         draw.choice(["Android", "iOS", "Web"]))
        for i in range(n)
    ]


def _direct(rows, lower, upper, platforms):
    inside = [r for r in rows if lower <= r[2].date() < upper and r[3] in platforms]
    counts = {p: len({r[1] for r in inside if r[3] == p}) for p in {r[3] for r in inside}}
    return counts | ({None: len({r[1] for r in inside})} if inside else {})


def _found(frame):
    out = {}
    for r in frame.collect():
        assert r.platform not in out.setdefault((r.lower, r.upper), {})
        out[r.lower, r.upper][r.platform] = r.users
    return out


def test_daily_bitmaps_equal_direct_counts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(distincts, "SHARDS", 5)
    kept = DailyUsers(str(tmp_path / "kept"))
    batches = [_sessions(1, 150, 4), _sessions(2, 60, 20), _sessions(3, 30, 3)]
    spans = [(date(2024, 1, 1), date(2024, 1, 8)), (date(2024, 1, 3), date(2024, 1, 5)), (date(2024, 1, 1), date(2024, 2, 1)),
             (date(2025, 1, 1), date(2025, 1, 3))]
    rows = []
    for i, batch in enumerate(batches):
        assert kept.advance(spark, make_sessions(spark, batch), f"b{i}")
        assert not kept.advance(spark, make_sessions(spark, batch), f"b{i}")
        rows += batch
        for tenants, platforms in ((None, {"Android", "iOS", "Web"}), (make_tenants(spark), {"Android", "iOS"})):
            expected = {s: _direct(rows, *s, platforms) for s in spans}
            assert _found(kept.users(spark, spans, tenants)) == {s: v for s, v in expected.items() if v}
    codes = Store(kept.root).rows(spark, CODES, CODES_SCHEMA).collect()
    assert sorted(r.code for r in codes) == list(range(1, len({r[1] for r in rows}) + 1))
    assert len({(r.company, r.app, r.user_id) for r in codes}) == len(codes)


def test_no_sessions(spark, tmp_path):
    kept = DailyUsers(str(tmp_path / "kept"))
    week = [(date(2024, 1, 1), date(2024, 1, 8))]
    assert kept.users(spark, week).count() == 0
    kept.advance(spark, make_sessions(spark, []))
    assert kept.users(spark, week).count() == 0
    kept.advance(spark, make_sessions(spark, _sessions(1, 5, 1)))
    assert kept.users(spark, []).count() == 0


def test_users_beyond_one_bitmap(spark, tmp_path):
    base = make_sessions(spark, [("s", "u", START, "iOS")]).drop("user_id")
    many = base.crossJoin(spark.range(70_000).select(F.col("id").cast("string").alias("user_id")))
    kept = DailyUsers(str(tmp_path / "kept"))
    kept.advance(spark, many)
    kept.advance(spark, many.filter("user_id % 2 = 0").withColumn("time", F.expr("time + INTERVAL 1 DAY")))
    spans = [(date(2024, 1, 1), date(2024, 1, 3)), (date(2024, 1, 2), date(2024, 1, 3))]
    assert _found(kept.users(spark, spans)) == {spans[0]: {"iOS": 70_000, None: 70_000}, spans[1]: {"iOS": 35_000, None: 35_000}}


def test_rejected_records_are_counted_in_the_pass_that_stores_the_others(spark, tmp_path):
    good = {"id": 1, "userId": "u", "price": 2, "paymentSystem": 1, "time": 1.7e12, "device": {"osType": "iOS"}}
    lines = [json.dumps(good), json.dumps(good | {"time": "junk"}), json.dumps(good | {"device": {}}), '{"id": 4, "ti',
             json.dumps(good | {"time": None, "device": None})]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(lines))
    raw = read_documents(spark, str(tmp_path / "in"), with_corrupt(RAW_PURCHASES))
    seen, landing = Observation(), Landing(str(tmp_path / "landed"))
    landing.add(counted(mark_purchases(raw, "c", "a"), seen))
    assert seen.get == {"rows": 5, "record": 1, "time": 2, "platform": 1}
    assert {(r.company, r.app, r.reason): r.n for r in landing.rejected(spark).collect()} == {
        ("c", "a", "record"): 1, ("c", "a", "time"): 2, ("c", "a", "platform"): 1,
    }
    plain = normalize_purchases(read_documents(spark, str(tmp_path / "in"), RAW_PURCHASES), "c", "a")
    assert landing.rows(spark).collect() == plain.collect() == normalize_purchases(raw, "c", "a").collect()
    assert "reject" not in plain.columns
    plan = landing.rows(spark)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(reject" in plan
