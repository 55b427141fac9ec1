"""One query per operator. Each takes (spark, sf_dir) and reads the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlens.checks import inputs as I
from spendlens.functions.arithmetic import safe_ratio
from spendlens.functions.parsing import coerce_int, epoch_ms, iso_day, json_field, path_safe, printed_date
from spendlens.operators import exact
from spendlens.operators.ordered import with_next
from spendlens.operators.tenants import build_catalogue
from spendlens.operators.windows import Windows, contained_in
from spendlens.plans.core import (
    configured_counts,
    listed_purchases,
    numbered_purchases,
    payers,
    paying_user_purchases,
    purchases_by_system,
    sessions_per_user,
    slice_purchases,
    slice_sessions,
)
from spendlens.plans.cubes import BY_USER, USER, Cubes, by_window, session_cube
from spendlens.plans.distincts import DailyUsers
from spendlens.plans.journey import History, between_purchases, first_purchases, sessions_before_first
from spendlens.plans.measures import measure_cells, purchase_measures, purchases_by_cell
from spendlens.plans.metrics import METRIC_NAMES, metric_values
from spendlens.plans.run import run
from spendlens.plans.state import FirstPurchases
from spendlens.sources.normalize import (
    mark_purchases,
    normalize_purchases,
    normalize_sessions,
    profile_purchases,
    profile_sessions,
)
from spendlens.sources.rejects import CORRUPT, Landing
from spendlens.sources.shared import fresh_folder, written
from spendlens.sources.store import Store, lookup, lookup_sum, metric_documents

Query = Callable[[SparkSession, str], DataFrame]

# Raw forms of the time of an event.
PRINTED = "concat(date_format(ts, 'EEE MMM dd HH:mm:ss'), ' UTC ', date_format(ts, 'yyyy'))"
EPOCH_MS = (
    "CAST(CAST((unix_date(CAST(ts AS DATE)) * 86400L + hour(ts) * 3600 + minute(ts) * 60) * 1000L"
    " + CAST(floor(extract(SECOND FROM ts) * 1000) AS BIGINT) AS DOUBLE) AS STRING)"
)
EITHER_TIME = f"CASE WHEN event_id % 2 = 0 THEN {EPOCH_MS} ELSE {PRINTED} END"
DEVICE = f"concat('{{\"osType\":\"', {I.PLATFORM}, '\"}}')"


def _report(values: DataFrame, *extra: str) -> DataFrame:
    """Metric rows as shown: no nulls in the cell columns, six decimals."""
    return values.select(
        "company",
        "app",
        "lower",
        "upper",
        "metric",
        "grain",
        F.coalesce("platform", F.lit("*")).alias("platform"),
        F.coalesce("payment_system", F.lit(0)).alias("payment_system"),
        F.round("value", 6).alias("value"),
        *[F.round(c, 6).alias(c) for c in extra],
    )


def _metric(name: str, *extra: str) -> Query:
    def query(spark: SparkSession, d: str) -> DataFrame:
        values = metric_values(I.purchases(spark, d), I.sessions(spark, d), I.one_tenant(spark), I.WEEKS, [name])
        return _report(values, *extra)

    return query


def _daily_values(spark: SparkSession, d: str, *names: str) -> DataFrame:
    return metric_values(I.purchases(spark, d), I.sessions(spark, d), I.one_tenant(spark), I.DAYS, names)


def raw_purchases(spark: SparkSession, d: str) -> DataFrame:
    return (
        I.events(spark, d)
        .filter(F.col("event_type") == "purchase")
        .selectExpr(
            "event_id AS id",
            "user_id AS userId",
            "CAST(value AS STRING) AS price",
            f"concat({I.PAYMENT_SYSTEM}, IF(event_id % 2 = 0, '.0', '')) AS paymentSystem",
            f"{EITHER_TIME} AS time",
            f"{DEVICE} AS device",
        )
    )


def raw_sessions(spark: SparkSession, d: str) -> DataFrame:
    return (
        I.events(spark, d)
        .filter(F.col("event_type").isin(I.SESSION_EVENTS))
        .selectExpr(
            "event_id AS id",
            "user_id AS userId",
            f"{PRINTED} AS startTime",
            f"named_struct('osType', {I.PLATFORM}) AS device",
        )
    )


def raw_profiles(spark: SparkSession, d: str) -> DataFrame:
    """User profile documents, one per user and day."""
    return (
        I.events(spark, d)
        .selectExpr(
            "CAST(user_id AS STRING) AS userId",
            f"CAST({EPOCH_MS} AS DOUBLE) AS time",
            f"{I.PLATFORM} AS platform",
            f"CAST({I.PAYMENT_SYSTEM} AS DOUBLE) AS paymentSystem",
            "event_type",
            "CAST(ts AS DATE) AS block",
        )
        .groupBy(F.lit("acme").alias("company"), F.lit("main").alias("app"), "userId", "block")
        .agg(
            F.collect_list(
                F.when(F.col("event_type") == "purchase", F.struct("time", "platform", "paymentSystem"))
            ).alias("purchases"),
            F.collect_list(
                F.when(
                    F.col("event_type").isin(I.SESSION_EVENTS),
                    F.struct(F.col("time").alias("startTime"), "platform"),
                )
            ).alias("sessions"),
        )
    )


def scan_purchases(spark, d):
    return normalize_purchases(raw_purchases(spark, d), "acme", "main")


def scan_sessions(spark, d):
    return normalize_sessions(raw_sessions(spark, d), "acme", "main")


def profile_unnest(spark, d):
    profiles = raw_profiles(spark, d)
    bought = profile_purchases(profiles).select(F.lit("purchase").alias("kind"), "user_id", "time", "platform", "payment_system")
    visited = profile_sessions(profiles).select(
        F.lit("session").alias("kind"), "user_id", "time", "platform", F.lit(0).alias("payment_system")
    )
    return bought.unionByName(visited)


def metric_lookup(spark, d):
    values = _daily_values(spark, d, "total_revenue", "active_users")
    return _report(lookup(values, "total_revenue", datetime(2024, 1, 8), datetime(2024, 1, 15)))


def metric_lookup_sum(spark, d):
    values = _daily_values(spark, d, "number_sessions", "active_users")
    summed = lookup_sum(values, "number_sessions", I.FIRST_DAY, datetime(2024, 1, 31))
    return summed.select(
        "company", "app", "grain", F.coalesce("platform", F.lit("*")).alias("platform"), "value", "windows"
    )


def tenant_apps(spark, d):
    companies = I.company_documents(spark, d).withColumn("apps", F.concat("apps", F.array(F.lit("bare"), F.lit("blank"))))
    settings = I.app_documents(spark, d)
    blank = settings.selectExpr(
        "company", "'blank' AS app", "CAST(NULL AS ARRAY<STRING>) AS appType", "CAST(NULL AS ARRAY<INT>) AS paymentSystems"
    )
    catalogue = build_catalogue(companies, settings.union(blank))
    return catalogue.select(
        "company",
        "app",
        F.array_join(F.array_sort("platforms"), ",").alias("platforms"),
        F.array_join(F.transform(F.array_sort("payment_systems"), lambda y: y.cast("string")), ",").alias(
            "payment_systems"
        ),
    )


def metric_document(spark, d):
    values = metric_values(
        I.purchases(spark, d), I.sessions(spark, d), I.one_tenant(spark), I.WEEKS, ["total_revenue", "active_users", "arpu"]
    )
    money = "CAST(CAST({} AS DECIMAL(18,4)) AS STRING)"
    systems = f"array_join(transform(p.payment_systems, y -> concat(y.system, ':', {money.format('y.res')})), ';')"
    shown = f"array_join(transform(platforms, p -> concat(p.platform, '=', {money.format('p.res')}, '(', {systems}, ')')), ' ')"
    return metric_documents(values).selectExpr(
        "company", "app", "lower", "upper", "metric", "round(result, 6) AS result", f"{shown} AS platforms"
    )


def slice_window_platform(spark, d):
    sliced = slice_sessions(I.sessions(spark, d), I.one_tenant(spark), I.WEEKS).filter("on_platform")
    return sliced.select("lower", "upper", "id", "user_id", "time", "platform")


def filter_window_containment(spark, d):
    daily = _daily_values(spark, d, "total_revenue")
    return _report(contained_in(daily, datetime(2024, 1, 8), datetime(2024, 1, 15)).filter("grain = 'total'"))


def filter_window(spark, d):
    return I.WEEK_2.assign(I.purchases(spark, d)).select("lower", "upper", "id", "user_id", "time")


def filter_configured(spark, d):
    return I.one_tenant(spark).configured(I.purchases(spark, d)).select("id", "platform", "payment_system")


def _payers(spark, d, windows):
    return payers(I.purchases(spark, d), I.one_tenant(spark), windows)


def qualifying_payers(spark, d):
    return _payers(spark, d, I.WEEKS).filter("qualified").select("lower", "upper", "user_id")


def json_field_query(spark, d):
    events = I.events(spark, d)
    return events.select("event_id", json_field(F.col("props"), T.StringType(), "k").alias("k"))


def parse_printed_date(spark, d):
    return I.events(spark, d).select("event_id", printed_date(F.expr(PRINTED)).alias("parsed"))


def parse_epoch_ms(spark, d):
    return I.events(spark, d).select("event_id", epoch_ms(F.expr(EPOCH_MS)).alias("parsed"))


def parse_iso_day(spark, d):
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return I.events(spark, d).select("event_id", iso_day(text).cast("string").alias("day"))


def coerce_int_query(spark, d):
    return I.events(spark, d).select("event_id", coerce_int(F.col("value").cast("string")).alias("whole"))


def paying_profiles_semi(spark, d):
    history = History.of(I.purchases(spark, d), I.sessions(spark, d), raw_profiles(spark, d))
    users = _payers(spark, d, I.WEEKS).filter("qualified").select(*USER).distinct()
    matched = history.with_profile(users)
    items = history.purchases.selectExpr(*USER, "1 AS purchase", "0 AS session").unionAll(
        history.sessions.selectExpr(*USER, "0 AS purchase", "1 AS session")
    )
    return items.join(matched, USER, "left_semi").groupBy("user_id").agg(
        F.sum("purchase").alias("purchases"), F.sum("session").alias("sessions")
    )


def join_metrics_platform(spark, d):
    cells = measure_cells(
        I.purchases(spark, d), I.sessions(spark, d), I.one_tenant(spark), I.DAYS, {"purchases", "sessions"}
    )
    return cells.filter("platform IS NOT NULL AND payment_system IS NULL").select(
        "lower",
        "upper",
        "platform",
        F.round("revenue", 6).alias("revenue"),
        "active_users",
        F.round(safe_ratio("revenue", "active_users"), 6).alias("ratio"),
    )


def sessions_in_interval(spark, d):
    tenant = I.one_tenant(spark)
    totals = between_purchases(
        slice_purchases(I.purchases(spark, d), tenant, I.WEEKS),
        slice_sessions(I.sessions(spark, d), tenant, I.WEEKS),
        _payers(spark, d, I.WEEKS),
    ).filter("pairs > 0")
    return totals.select(
        "lower",
        "upper",
        "user_id",
        F.coalesce("platform", F.lit("*")).alias("platform"),
        F.coalesce("payment_system", F.lit(0)).alias("payment_system"),
        "pairs",
        "raw",
        "adjusted",
    )


def sessions_before_event(spark, d):
    history = History.of(I.purchases(spark, d), I.sessions(spark, d))
    users = _payers(spark, d, I.WEEKS).filter("qualified")
    return sessions_before_first(history, users, I.one_tenant(spark)).select(
        "user_id",
        F.coalesce("platform", F.lit("*")).alias("platform"),
        F.coalesce("payment_system", F.lit(0)).alias("payment_system"),
        "sessions",
    )


def zero_fill_grid(spark, d):
    cells = measure_cells(
        I.purchases(spark, d), I.sessions(spark, d), I.one_tenant(spark), I.DAYS, {"purchases"}
    ).filter("configured > 0")
    return cells.select(
        "lower",
        "upper",
        F.coalesce("platform", F.lit("*")).alias("platform"),
        F.coalesce("payment_system", F.lit(0)).alias("payment_system"),
        F.round("revenue", 6).alias("revenue"),
    )


def _user_counts(merged: DataFrame) -> DataFrame:
    shown = "array_join(transform(platforms, p -> concat(p.platform, ':', p.sessions)), ',')"
    return merged.selectExpr("lower", "upper", "user_id", "total", f"{shown} AS platforms")


def merge_user_platform_counts(spark, d):
    """All platforms are configured, so that a user's counts are of all sessions."""
    return _user_counts(sessions_per_user(I.sessions(spark, d), I.one_tenant(spark, "Web"), I.MONTH))


def sessions_per_user_query(spark, d):
    return _user_counts(sessions_per_user(I.sessions(spark, d), I.one_tenant(spark), I.WEEKS))


def sum_by_system(spark, d):
    cells = purchases_by_cell(I.purchases(spark, d), I.one_tenant(spark), I.MONTH).filter("on_platform")
    sums = exact.added_up(cells, ["platform", "payment_system"], "revenue")
    return sums.withColumn("revenue", F.round("revenue", 6))


def rollup_revenue(spark, d):
    rows = purchase_measures(purchases_by_cell(I.purchases(spark, d), I.one_tenant(spark), I.WEEKS))
    return (
        rows.filter("any_purchases > 0")
        .groupBy("lower", "platform", "payment_system")
        .agg(F.round(F.sum("revenue"), 6).alias("revenue"))
        .withColumns({"platform": F.coalesce("platform", F.lit("*")), "payment_system": F.coalesce("payment_system", F.lit(0))})
    )


def distinct_per_platform(spark, d):
    cells = measure_cells(I.purchases(spark, d), I.sessions(spark, d), I.one_tenant(spark), I.MONTH, {"sessions"})
    return cells.filter("platform IS NOT NULL AND payment_system IS NULL").select(
        "platform", "active_users", "sessions"
    )


def count_by_user(spark, d):
    cube = session_cube(I.sessions(spark, d), I.one_tenant(spark), I.WEEKS, (BY_USER,))
    return cube.select("lower", "platform", F.col("value").alias("user_id"), F.col("n").alias("sessions"))


def _paying(spark, d, windows):
    return paying_user_purchases(I.purchases(spark, d), I.one_tenant(spark), windows)


def collect_purchases(spark, d):
    """The purchases of a user in order: their number and the list of their ids."""
    return listed_purchases(_paying(spark, d, I.MONTH)).select("user_id", "n", "ids")


def paying_users(spark, d):
    rows = numbered_purchases(_paying(spark, d, I.WEEKS))
    listed = (F.col("on_platform") & F.col("on_system")).alias("on_platform_list")
    return rows.select("lower", "upper", "user_id", "ordinal", "id", "platform", "payment_system", listed)


def count_if_system(spark, d):
    counts = configured_counts(_paying(spark, d, I.WEEKS), I.one_tenant(spark))
    on = "coalesce(sum(IF(payment_system = {}, purchases, 0)), 0)"
    return counts.groupBy("lower", "user_id", "platform").agg(
        F.sum("purchases").alias("n"), F.expr(on.format(1)).alias("n1"), F.expr(on.format(2)).alias("n2")
    )


def reduce_long(spark, d):
    per_user = purchases_by_system(_paying(spark, d, I.WEEKS))
    return per_user.groupBy("lower", "platform", "payment_system").agg(
        F.sum("purchases").alias("purchases"), F.count("*").alias("users")
    )


def safe_ratio_query(spark, d):
    by_day = (
        I.events(spark, d)
        .groupBy("user_id", F.col("ts").cast("date").cast("string").alias("day"))
        .agg(
            F.coalesce(F.sum(F.when(F.col("event_type") == "purchase", F.col("value"))), F.lit(0.0)).alias("paid"),
            F.count_if(F.col("event_type").isin(I.SESSION_EVENTS)).alias("sessions"),
        )
    )
    return by_day.select("user_id", "day", F.round(safe_ratio("paid", "sessions"), 6).alias("ratio"))


def consecutive_purchases(spark, d):
    bought = I.MONTH.assign(I.purchases(spark, d)).select("user_id", "time", "id")
    return (
        with_next(bought, ["user_id"], ["time", "id"])
        .filter("next IS NOT NULL")
        .select("user_id", "id", "time", F.col("next.id").alias("next_id"), F.col("next.time").alias("next_time"))
    )


def first_purchase(spark, d):
    firsts = first_purchases(I.purchases(spark, d), I.one_tenant(spark))
    return firsts.select("user_id", F.col("first_any").alias("first_time"))


def first_purchase_by_system(spark, d):
    firsts = first_purchases(I.purchases(spark, d), I.one_tenant(spark))
    return firsts.selectExpr("user_id", "inline(firsts) AS (platform, payment_system, first_time)")


def daily_windows(spark, d):
    windows = Windows.daily(date(2024, 1, 31), days=30)
    events = windows.assign(I.events(spark, d), "ts")
    return events.groupBy("lower", "upper").agg(F.count("*").alias("events"))


def backfill_revenue_daily(spark, d):
    windows = Windows.backfill(date(2024, 1, 15), days=30)
    values = metric_values(
        I.purchases(spark, d), I.sessions(spark, d), I.one_tenant(spark), windows, ["total_revenue"]
    )
    return _report(values.filter("grain = 'total'"))


def tenant_revenue(spark, d):
    values = metric_values(
        I.purchases(spark, d, I.APP),
        I.sessions(spark, d, I.APP),
        I.two_tenants(spark, d),
        I.WEEKS,
        ["total_revenue"],
    )
    return _report(values)


def _shared_values(purchases, sessions, tenants, windows, names=METRIC_NAMES):
    """Metrics from aggregates that are written once."""
    cubes = Cubes.written(purchases, sessions, tenants, windows, written)
    return metric_values(purchases, sessions, tenants, windows, names, cubes=cubes)


def metrics_all(spark, d):
    return _report(_shared_values(I.purchases(spark, d), I.sessions(spark, d), I.one_tenant(spark), I.DAYS))


def tenant_metrics_all(spark, d):
    tables = I.purchases(spark, d, I.APP), I.sessions(spark, d, I.APP)
    return _report(_shared_values(*tables, I.two_tenants(spark, d), I.WEEKS))


def metrics_overlapping(spark, d):
    """Windows of three days that start every six hours: twelve hold each row."""
    tables = I.purchases(spark, d), I.sessions(spark, d)
    names = ["total_revenue", "active_users", "number_sessions", "paying_users", "purchases_per_session"]
    return _report(_shared_values(*tables, I.one_tenant(spark), I.OVERLAPPING, names))


def stored_metrics(spark, d):
    """A whole run, read back from the store; before it, one that ended too early and one of other rows."""
    store, tables = Store(fresh_folder(spark, "store")), (I.purchases(spark, d), I.sessions(spark, d))
    some = metric_values(*tables, I.one_tenant(spark), I.WEEKS, ["arpu"])
    store.begin().write(some, "metric_values")
    store.write(some.withColumn("value", -F.col("value")), "metric_values")
    run(spark, *tables, I.one_tenant(spark), I.WEEKS, store)
    return _report(store.read(spark, "metric_values"))


def stored_paying_users(spark, d):
    store = Store(fresh_folder(spark, "store"))
    store.write(_paying(spark, d, I.WEEKS), "paying_users", I.one_tenant(spark).keys(I.WEEKS))
    stored = store.within(spark, "paying_users", I.WEEK_2.first, I.WEEK_2.last)
    return stored.select("lower", "upper", "user_id", "id", "time", "platform", "payment_system")


def stored_sessions_per_user(spark, d):
    store, tenants = Store(fresh_folder(spark, "store")), I.one_tenant(spark)
    store.write(sessions_per_user(I.sessions(spark, d), tenants, I.WEEKS), "sessions_per_user", tenants.keys(I.WEEKS))
    return _user_counts(store.read(spark, "sessions_per_user"))


def first_purchase_state(spark, d):
    """Sessions to the first purchase from the kept state. The rows arrive in three batches, by time; one
    row in eleven of the first two comes late, with the third."""
    tables = I.purchases(spark, d), I.sessions(spark, d)
    late = F.pmod(F.xxhash64("user_id", "time"), F.lit(11)) == 0
    batch = F.when(late | (F.col("time") >= F.lit("2024-01-20").cast("timestamp_ntz")), 3)
    batch = batch.when(F.col("time") >= F.lit("2024-01-09").cast("timestamp_ntz"), 2).otherwise(1)
    state, tenants = FirstPurchases(fresh_folder(spark, "state")), I.one_tenant(spark)
    for n in (1, 2, 3):
        arrived = [t.filter(batch == n) for t in tables]
        state.advance(spark, *arrived, tables[1].filter(batch <= n), label=f"batch {n}")
    values = metric_values(*tables, tenants, I.WEEKS, ["sessions_first_purchase"], reached=state.reached(spark, tenants))
    return _report(values, "numerator", "denominator")


def metrics_with_missing_fields(spark, d):
    """Every seventh event has no user."""
    user = F.when(F.col("known"), F.col("user_id"))
    bought = I.purchases(spark, d).withColumn("known", F.col("id").cast("long") % 7 != 0).withColumn("user_id", user)
    return _report(
        metric_values(bought.drop("known"), I.sessions(spark, d), I.one_tenant(spark), I.WEEKS, METRIC_NAMES)
    )


def journeys_from_profiles(spark, d):
    """The two session journeys, with user profiles as the history."""
    names = ["sessions_first_purchase", "sessions_between_purchases"]
    values = metric_values(
        I.purchases(spark, d), I.sessions(spark, d), I.one_tenant(spark), I.WEEKS, names, raw_profiles(spark, d)
    )
    return _report(values, "numerator", "denominator")


def windows_left_closed(spark, d):
    windows = Windows.every(I.FIRST_DAY, timedelta(days=1), 30, closed="left")
    return windows.assign(I.events(spark, d), "ts").groupBy("lower", "upper").agg(F.count("*").alias("events"))


def windows_listed(spark, d):
    """Overlapping windows of different widths."""
    bounds = tuple((I.FIRST_DAY + timedelta(days=a), I.FIRST_DAY + timedelta(days=b)) for a, b in I.LISTED)
    aggregates = {"purchases": F.count("*"), "revenue": F.sum("price")}
    found = by_window(I.purchases(spark, d), Windows(bounds), [], aggregates, dict.fromkeys(aggregates, F.sum))
    return found.withColumn("revenue", F.round("revenue", 6))


def purchases_in_window(spark, d):
    """Purchases of profiles inside one window, and how many each profile has (array lengths)."""
    bought = I.WEEK_2.assign(profile_purchases(raw_profiles(spark, d)))
    return bought.groupBy("lower", "upper", "user_id").agg(F.count("*").alias("purchases"))


def platforms_in_order(spark, d):
    values = metric_values(
        I.purchases(spark, d), I.sessions(spark, d), I.one_tenant(spark), I.WEEKS, ["number_sessions"]
    )
    return metric_documents(values).select(
        "lower", "upper", F.array_join(F.col("platforms.platform"), ",").alias("platforms"), "result"
    )


def path_safe_names(spark, d):
    name = F.concat(F.lit("app "), F.col("event_type"), F.lit("."), F.expr("CAST(user_id % 5 AS STRING)"))
    return I.events(spark, d).select("event_id", path_safe(name).alias("name"))


def distinct_users_by_span(spark, d):
    """Two weeks, then the others with late sessions of the first; counted by week and month."""
    sessions, kept = I.sessions(spark, d), DailyUsers(fresh_folder(spark, "daily-users"))
    late = (F.col("time") >= "2024-01-15") | (F.xxhash64("id") % 5 == 0)
    kept.advance(spark, sessions.filter(~late), "first")
    kept.advance(spark, sessions.filter(late), "second")
    weeks = [(I.FIRST_DAY + I.WEEK * i, I.FIRST_DAY + I.WEEK * (i + 1)) for i in range(5)]
    spans = [(a.date(), b.date()) for a, b in [*weeks, (I.FIRST_DAY, datetime(2024, 1, 31))]]
    found = kept.users(spark, spans, I.one_tenant(spark))
    return found.withColumns(
        {**{c: F.col(c).cast("timestamp_ntz") for c in ("lower", "upper")}, "platform": F.coalesce("platform", F.lit("*"))}
    )


def rejected_records(spark, d):
    """Records of two apps, some without a readable time, platform or form, by reason."""
    raw = I.events(spark, d).filter("event_type = 'purchase'").selectExpr(
        f"{I.COMPANY} AS company",
        f"{I.APP} AS app",
        "event_id AS id",
        "user_id AS userId",
        "CAST(value AS STRING) AS price",
        f"CAST({I.PAYMENT_SYSTEM} AS STRING) AS paymentSystem",
        f"IF(event_id % 7 = 0, 'unknown', {EITHER_TIME}) AS time",
        f"IF(event_id % 11 = 0, '{{}}', {DEVICE}) AS device",
        f"IF(event_id % 13 = 0, '{{', NULL) AS {CORRUPT}",
    )
    landing = Landing(fresh_folder(spark, "landing"))
    landing.add(mark_purchases(raw))
    read = landing.rows(spark).groupBy("company", "app").agg(F.count("*").alias("n"))
    return landing.rejected(spark).unionByName(read.withColumn("reason", F.lit("none")))


QUERIES: dict[str, Query] = {
    "distinct_users_by_span": distinct_users_by_span,
    "rejected_records": rejected_records,
    # scans and sinks
    "scan_purchases": scan_purchases,
    "scan_sessions": scan_sessions,
    "profile_unnest": profile_unnest,
    "metric_lookup": metric_lookup,
    "metric_lookup_sum": metric_lookup_sum,
    "tenant_apps": tenant_apps,
    "metric_document": metric_document,
    # filters and projections
    "slice_window_platform": slice_window_platform,
    "filter_window_containment": filter_window_containment,
    "filter_window": filter_window,
    "filter_configured": filter_configured,
    "qualifying_payers": qualifying_payers,
    "json_field": json_field_query,
    "parse_printed_date": parse_printed_date,
    "parse_epoch_ms": parse_epoch_ms,
    "parse_iso_day": parse_iso_day,
    "coerce_int": coerce_int_query,
    # joins
    "paying_profiles_semi": paying_profiles_semi,
    "join_metrics_platform": join_metrics_platform,
    "sessions_in_interval": sessions_in_interval,
    "sessions_before_event": sessions_before_event,
    "zero_fill_grid": zero_fill_grid,
    "merge_user_platform_counts": merge_user_platform_counts,
    # aggregations
    "sum_by_system": sum_by_system,
    "rollup_revenue": rollup_revenue,
    "distinct_per_platform": distinct_per_platform,
    "count_by_user": count_by_user,
    "collect_purchases": collect_purchases,
    "count_if_system": count_if_system,
    "reduce_long": reduce_long,
    "safe_ratio": safe_ratio_query,
    # order
    "consecutive_purchases": consecutive_purchases,
    "first_purchase": first_purchase,
    "first_purchase_by_system": first_purchase_by_system,
    # metrics
    "total_revenue": _metric("total_revenue"),
    "active_users": _metric("active_users"),
    "number_sessions": _metric("number_sessions"),
    "sessions_per_user": sessions_per_user_query,
    "paying_users": paying_users,
    "arpu": _metric("arpu", "numerator", "denominator"),
    "avg_revenue_session": _metric("avg_revenue_session", "numerator", "denominator"),
    "lifetime_value": _metric("lifetime_value"),
    "avg_purchases_user": _metric("avg_purchases_user", "numerator", "denominator"),
    "purchases_per_session": _metric("purchases_per_session", "numerator", "denominator"),
    "sessions_first_purchase": _metric("sessions_first_purchase", "numerator", "denominator"),
    "sessions_between_purchases": _metric("sessions_between_purchases", "numerator", "denominator"),
    # runs
    "daily_windows": daily_windows,
    "backfill_revenue_daily": backfill_revenue_daily,
    "tenant_revenue": tenant_revenue,
    "metrics_all": metrics_all,
    "tenant_metrics_all": tenant_metrics_all,
    "metrics_overlapping": metrics_overlapping,
    "metrics_with_missing_fields": metrics_with_missing_fields,
    "stored_metrics": stored_metrics,
    "stored_paying_users": stored_paying_users,
    "stored_sessions_per_user": stored_sessions_per_user,
    "first_purchase_state": first_purchase_state,
    "journeys_from_profiles": journeys_from_profiles,
    "windows_left_closed": windows_left_closed,
    "windows_listed": windows_listed,
    "purchases_in_window": purchases_in_window,
    "platforms_in_order": platforms_in_order,
    "path_safe_names": path_safe_names,
}
