"""The queries again, as plain SQL on the test tables: direct definitions, no shared code."""

from __future__ import annotations

PLATFORM = "CASE event_id % 3 WHEN 0 THEN 'Android' WHEN 1 THEN 'iOS' ELSE 'Web' END"
SYSTEM = "1 + CAST(json_extract(props, '$.k') AS INTEGER) % 3"
SESSION_EVENTS = "event_type IN ('view', 'click', 'signup')"

WEEKS = """SELECT TIMESTAMP '2024-01-01' + INTERVAL (7 * i) DAY AS lower,
    TIMESTAMP '2024-01-01' + INTERVAL (7 * i + 7) DAY AS upper FROM range(5) r(i)"""
DAYS = """SELECT TIMESTAMP '2024-01-01' + INTERVAL (i) DAY AS lower,
    TIMESTAMP '2024-01-01' + INTERVAL (i + 1) DAY AS upper FROM range(30) r(i)"""
WEEK_2 = "SELECT TIMESTAMP '2024-01-08' AS lower, TIMESTAMP '2024-01-15' AS upper"
MONTH = "SELECT TIMESTAMP '2024-01-01' AS lower, TIMESTAMP '2024-01-31' AS upper"

OVERLAPPING = """SELECT TIMESTAMP '2024-01-01' + INTERVAL (6 * i) HOUR AS lower,
    TIMESTAMP '2024-01-01' + INTERVAL (6 * i + 72) HOUR AS upper FROM range(108) r(i)"""

LISTED = """SELECT TIMESTAMP '2024-01-01' + INTERVAL (a) DAY AS lower, TIMESTAMP '2024-01-01' + INTERVAL (b) DAY AS upper
  FROM (VALUES (0, 10), (5, 6), (5, 20), (28, 30)) r(a, b)"""

ONE_APP = {"main": (["Android", "iOS"], [1, 2])}
TWO_APPS = {"app0": (["Android", "iOS"], [1, 2]), "app1": (["Web", "iOS"], [2, 3])}


def base(windows: str, apps: dict = ONE_APP, buyer: str = "user_id") -> str:
    """CTEs: inputs (p, s), windows (w), configured platforms and systems (pl, sy), report
    cells by grain (gt, gp, gs), and the inputs sliced by window (pw, sw)."""
    app = "'main'" if apps is ONE_APP else "'app' || CAST(user_id % 2 AS VARCHAR)"
    pl = ", ".join(f"('{a}', '{p}')" for a, (ps, _) in apps.items() for p in ps)
    sy = ", ".join(f"('{a}', {y})" for a, (_, ys) in apps.items() for y in ys)
    return f"""WITH p AS (
  SELECT {app} AS app, CAST(event_id AS VARCHAR) AS id, CAST({buyer} AS VARCHAR) AS user_id, value AS price,
    ts AS time, {PLATFORM} AS platform, {SYSTEM} AS payment_system
  FROM events WHERE event_type = 'purchase'),
s AS (
  SELECT {app} AS app, CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d%H') AS id,
    CAST(user_id AS VARCHAR) AS user_id, ts AS time, {PLATFORM} AS platform
  FROM events WHERE {SESSION_EVENTS}),
w AS ({windows}),
pl(app, platform) AS (VALUES {pl}),
sy(app, payment_system) AS (VALUES {sy}),
gt AS (SELECT DISTINCT app, lower, upper FROM pl, w),
gp AS (SELECT app, platform, lower, upper FROM pl, w),
gs AS (SELECT pl.app, platform, payment_system, lower, upper FROM pl JOIN sy USING (app), w),
pw AS (SELECT * FROM p JOIN w ON p.time BETWEEN w.lower AND w.upper),
sw AS (SELECT * FROM s JOIN w ON s.time BETWEEN w.lower AND w.upper)"""


# Sums and counts by grain; every later metric is a ratio of two of these.
COUNTS = """,
pp AS (SELECT * FROM pw SEMI JOIN pl USING (app, platform)),
ps AS (SELECT * FROM pp SEMI JOIN sy USING (app, payment_system)),
ss AS (SELECT * FROM sw SEMI JOIN pl USING (app, platform)),
rev_s AS (SELECT app, lower, upper, platform, payment_system, round(sum(price), 6) AS v FROM pp GROUP BY ALL),
rev_p AS (SELECT app, lower, upper, platform, round(coalesce(sum(v), 0), 6) AS v
  FROM gp LEFT JOIN rev_s USING (app, lower, upper, platform) GROUP BY ALL),
rev_t AS (SELECT app, lower, upper, round(sum(v), 6) AS v FROM rev_p GROUP BY ALL),
rev_y AS (SELECT app, lower, upper, platform, payment_system, coalesce(v, 0) AS v
  FROM gs LEFT JOIN rev_s USING (app, lower, upper, platform, payment_system)),
ses_p AS (SELECT app, lower, upper, platform, count(DISTINCT user_id) AS users, count(DISTINCT id) AS ids,
    count(user_id) AS rows
  FROM gp LEFT JOIN ss USING (app, lower, upper, platform) GROUP BY ALL),
ses_t AS (SELECT app, lower, upper, sum(users) AS users, sum(ids) AS ids, sum(rows) AS rows FROM ses_p GROUP BY ALL),
pay AS (SELECT app, lower, upper, user_id, count(*) AS n FROM pw WHERE user_id IS NOT NULL GROUP BY ALL),
pay_t AS (SELECT app, lower, upper, count(user_id) AS users, coalesce(sum(n), 0) AS n,
    coalesce(sum(CASE WHEN n > 1 THEN 1 ELSE 0 END), 0) AS repeats
  FROM gt LEFT JOIN pay USING (app, lower, upper) GROUP BY ALL),
num_y AS (SELECT app, lower, upper, platform, payment_system, count(id) AS n
  FROM gs LEFT JOIN (SELECT * FROM ps WHERE user_id IS NOT NULL) USING (app, lower, upper, platform, payment_system)
  GROUP BY ALL),
num_p AS (SELECT app, lower, upper, platform, count(id) AS n
  FROM gp LEFT JOIN (SELECT * FROM ps WHERE user_id IS NOT NULL) USING (app, lower, upper, platform) GROUP BY ALL)"""

# Sessions up to the first purchase: lifetime history of the users with a configured purchase.
FIRST = """,
mat AS (SELECT DISTINCT app, lower, upper, user_id FROM ps WHERE user_id IS NOT NULL),
f_t AS (SELECT app, user_id, min(time) AS t FROM p GROUP BY ALL),
f_y AS (SELECT p.app, user_id, platform, payment_system, min(time) AS t
  FROM p SEMI JOIN pl USING (app, platform) SEMI JOIN sy USING (app, payment_system) GROUP BY ALL),
fn_t AS (SELECT f_t.app, f_t.user_id, count(s.id) AS n
  FROM f_t LEFT JOIN s ON s.app = f_t.app AND s.user_id = f_t.user_id AND s.time <= f_t.t GROUP BY ALL),
fn_y AS (SELECT f.app, f.user_id, f.platform, f.payment_system, count(s.id) AS n
  FROM f_y f LEFT JOIN s ON s.app = f.app AND s.user_id = f.user_id AND s.platform = f.platform AND s.time <= f.t
  GROUP BY ALL),
first_t AS (SELECT app, lower, upper, coalesce(sum(n), 0) AS n, count(user_id) AS users
  FROM gt LEFT JOIN (SELECT * FROM mat JOIN fn_t USING (app, user_id)) USING (app, lower, upper) GROUP BY ALL),
first_y AS (SELECT app, lower, upper, platform, payment_system, coalesce(sum(n), 0) AS n, count(user_id) AS users
  FROM gs LEFT JOIN (SELECT * FROM mat JOIN fn_y USING (app, user_id))
    USING (app, lower, upper, platform, payment_system) GROUP BY ALL),
first_p AS (SELECT y.app, y.lower, y.upper, platform, sum(y.n) AS n, max(t.users) AS users
  FROM first_y y JOIN first_t t USING (app, lower, upper) GROUP BY ALL)"""

# Sessions between consecutive purchases: every pair against every session of the user.
BETWEEN = """,
pair_t AS (SELECT app, lower, upper, user_id, time,
  lead(time) OVER (PARTITION BY app, lower, upper, user_id ORDER BY time, id) AS nxt FROM pw),
pair_p AS (SELECT app, lower, upper, user_id, platform, time,
  lead(time) OVER (PARTITION BY app, lower, upper, user_id, platform ORDER BY time, id) AS nxt FROM pp),
pair_y AS (SELECT app, lower, upper, user_id, platform, payment_system, time,
  lead(time) OVER (PARTITION BY app, lower, upper, user_id, platform, payment_system ORDER BY time, id) AS nxt
  FROM ps),
n_t AS (SELECT q.app, q.lower, q.upper, q.user_id, q.time, q.nxt, count(s.id) AS n FROM pair_t q
  LEFT JOIN s ON s.app = q.app AND s.user_id = q.user_id AND s.time BETWEEN q.time AND q.nxt
  WHERE q.nxt IS NOT NULL GROUP BY ALL),
n_p AS (SELECT q.app, q.lower, q.upper, q.user_id, q.platform, q.time, q.nxt, count(s.id) AS n FROM pair_p q
  LEFT JOIN s ON s.app = q.app AND s.user_id = q.user_id AND s.platform = q.platform
    AND s.time BETWEEN q.time AND q.nxt
  WHERE q.nxt IS NOT NULL GROUP BY ALL),
n_y AS (SELECT q.app, q.lower, q.upper, q.user_id, q.platform, q.payment_system, q.time, q.nxt, count(s.id) AS n
  FROM pair_y q LEFT JOIN s ON s.app = q.app AND s.user_id = q.user_id AND s.platform = q.platform
    AND s.time BETWEEN q.time AND q.nxt
  WHERE q.nxt IS NOT NULL GROUP BY ALL),
btw AS (
  SELECT app, lower, upper, user_id, '*' AS platform, 0 AS payment_system, n FROM n_t
  UNION ALL SELECT app, lower, upper, user_id, platform, 0, n FROM n_p
  UNION ALL SELECT app, lower, upper, user_id, platform, payment_system, n FROM n_y),
btw_sum AS (SELECT app, lower, upper, platform, payment_system,
  sum(CASE WHEN n > 2 THEN n - 2 ELSE n END) AS n FROM btw GROUP BY ALL)"""


def ratio(n: str, d: str) -> str:
    return f"CASE WHEN {d} > 0 THEN CAST({n} AS DOUBLE) / {d} ELSE 0 END"


CELL = "x.app, x.lower, x.upper"


def _rows(name: str, grain: str, frm: str, value: str, num: str = "NULL", den: str = "NULL") -> str:
    platform = "'*'" if grain == "total" else "x.platform"
    system = "x.payment_system" if grain == "system" else "0"
    return (
        f"SELECT 'acme' AS company, {CELL}, '{name}' AS metric, '{grain}' AS grain, {platform} AS platform,"
        f" CAST({system} AS INTEGER) AS payment_system, round(CAST({value} AS DOUBLE), 6) AS value,"
        f" round(CAST({num} AS DOUBLE), 6) AS numerator, round(CAST({den} AS DOUBLE), 6) AS denominator FROM {frm}"
    )


def _ratio_rows(name: str, grain: str, frm: str, num: str, den: str) -> str:
    return _rows(name, grain, frm, ratio(num, den), num, den)


ON_T, ON_P, ON_Y = (
    "USING (app, lower, upper)",
    "USING (app, lower, upper, platform)",
    "USING (app, lower, upper, platform, payment_system)",
)

LTV_PLATFORM = f"({ratio('x.v', 'd.users')}) * d.rows * 0.7"

METRICS: dict[str, list[str]] = {
    "total_revenue": [
        _rows("total_revenue", "total", "rev_t x", "x.v"),
        _rows("total_revenue", "platform", "rev_p x", "x.v"),
        _rows("total_revenue", "system", "rev_s x", "x.v"),
        _rows("total_revenue", "system", f"gs x ANTI JOIN rev_s {ON_P}", "0"),
    ],
    "active_users": [
        _rows("active_users", "total", "ses_t x", "x.users"),
        _rows("active_users", "platform", "ses_p x", "x.users"),
    ],
    "number_sessions": [
        _rows("number_sessions", "total", "ses_t x", "x.ids"),
        _rows("number_sessions", "platform", "ses_p x", "x.ids"),
    ],
    "sessions_per_user": [
        _rows("sessions_per_user", "total", "ses_t x", "x.rows"),
        _rows("sessions_per_user", "platform", "ses_p x", "x.rows"),
    ],
    "paying_users": [_rows("paying_users", "total", "pay_t x", "x.users")],
    "arpu": [
        _ratio_rows("arpu", "total", f"rev_t x JOIN ses_t d {ON_T}", "x.v", "d.users"),
        _ratio_rows("arpu", "platform", f"rev_p x JOIN ses_p d {ON_P}", "x.v", "d.users"),
        _ratio_rows("arpu", "system", f"rev_y x JOIN ses_p d {ON_P}", "x.v", "d.users"),
    ],
    "avg_revenue_session": [
        _ratio_rows("avg_revenue_session", "total", f"rev_t x JOIN ses_t d {ON_T}", "x.v", "d.ids"),
        _ratio_rows("avg_revenue_session", "platform", f"rev_p x JOIN ses_p d {ON_P}", "x.v", "d.ids"),
        _ratio_rows("avg_revenue_session", "system", f"rev_y x JOIN ses_p d {ON_P}", "x.v", "d.ids"),
    ],
    "lifetime_value": [
        _rows("lifetime_value", "total", f"rev_t x JOIN ses_t d {ON_T}", LTV_PLATFORM),
        _rows("lifetime_value", "platform", f"rev_p x JOIN ses_p d {ON_P}", LTV_PLATFORM),
        _rows(
            "lifetime_value", "system", f"rev_y x JOIN ses_p d {ON_P}", LTV_PLATFORM.replace("0.7", "0.029")
        ),
    ],
    "avg_purchases_user": [
        _ratio_rows("avg_purchases_user", "total", "pay_t x", "x.n", "x.users"),
        _ratio_rows("avg_purchases_user", "platform", f"num_p x JOIN pay_t d {ON_T}", "x.n", "d.users"),
        _ratio_rows("avg_purchases_user", "system", f"num_y x JOIN pay_t d {ON_T}", "x.n", "d.users"),
    ],
    "purchases_per_session": [
        _ratio_rows("purchases_per_session", "total", f"pay_t x JOIN ses_t d {ON_T}", "x.n", "d.ids"),
        _ratio_rows("purchases_per_session", "platform", f"num_p x JOIN ses_p d {ON_P}", "x.n", "d.ids"),
        _ratio_rows("purchases_per_session", "system", f"num_y x JOIN ses_p d {ON_P}", "x.n", "d.ids"),
    ],
    "sessions_first_purchase": [
        _ratio_rows("sessions_first_purchase", "total", "first_t x", "x.n", "x.users"),
        _ratio_rows("sessions_first_purchase", "platform", "first_p x", "x.n", "x.users"),
        _ratio_rows("sessions_first_purchase", "system", "first_y x", "x.n", "x.users"),
    ],
    "sessions_between_purchases": [
        _ratio_rows(
            "sessions_between_purchases",
            "total",
            f"pay_t x LEFT JOIN (SELECT * FROM btw_sum WHERE platform = '*') b {ON_T}",
            "coalesce(b.n, 0)",
            "x.users",
        ),
        _ratio_rows(
            "sessions_between_purchases",
            "platform",
            f"gp x JOIN pay_t d {ON_T} LEFT JOIN (SELECT * FROM btw_sum WHERE payment_system = 0) b {ON_P}",
            "coalesce(b.n, 0)",
            "d.repeats",
        ),
        _ratio_rows(
            "sessions_between_purchases",
            "system",
            f"gs x JOIN pay_t d {ON_T} LEFT JOIN btw_sum b {ON_Y}",
            "coalesce(b.n, 0)",
            "d.repeats",
        ),
    ],
}

VALUE_COLUMNS = "company, app, lower, upper, metric, grain, platform, payment_system, value"


def metrics(
    names: list[str],
    windows: str,
    apps: dict = ONE_APP,
    extra: str = "",
    where: str = "true",
    buyer: str = "user_id",
) -> str:
    needed = COUNTS
    if "sessions_first_purchase" in names:
        needed += FIRST
    if "sessions_between_purchases" in names:
        needed += BETWEEN
    rows = "\nUNION ALL ".join(part for name in names for part in METRICS[name])
    return f"{base(windows, apps, buyer)}{needed}\nSELECT {VALUE_COLUMNS}{extra} FROM (\n{rows}) WHERE {where}"


RATIO = ", numerator, denominator"
IDS = "coalesce(string_agg({}id, ',' ORDER BY {}time, {}id), '')"
IN_WEEK_2 = "lower >= TIMESTAMP '2024-01-08' AND upper <= TIMESTAMP '2024-01-15'"
MS = "date_trunc('milliseconds', ts)"
SECOND = "date_trunc('second', ts)"


def _user_counts(windows: str, source: str) -> str:
    return f"""{base(windows)}{COUNTS},
c AS (SELECT lower, upper, user_id, platform, count(*) AS n FROM {source} GROUP BY ALL)
SELECT lower, upper, user_id, CAST(sum(n) AS BIGINT) AS total,
  string_agg(platform || ':' || CAST(n AS VARCHAR), ',' ORDER BY platform) AS platforms
FROM c GROUP BY lower, upper, user_id"""


def _document() -> str:
    money = "CAST(CAST({} AS DECIMAL(18,4)) AS VARCHAR)"
    names = ["total_revenue", "active_users", "arpu"]
    rows = "\nUNION ALL ".join(part for name in names for part in METRICS[name])
    return f"""{base(WEEKS)}{COUNTS},
v AS ({rows}),
y AS (SELECT lower, metric, platform,
    string_agg(CAST(payment_system AS VARCHAR) || ':' || {money.format('value')}, ';' ORDER BY payment_system) AS t
  FROM v WHERE grain = 'system' GROUP BY ALL),
q AS (SELECT v.lower, v.metric,
    string_agg(v.platform || '=' || {money.format('value')} || '(' || coalesce(y.t, '') || ')', ' '
      ORDER BY v.platform) AS platforms
  FROM v LEFT JOIN y ON v.lower = y.lower AND v.metric = y.metric AND v.platform = y.platform
  WHERE v.grain = 'platform' GROUP BY ALL)
SELECT v.company, v.app, v.lower, v.upper, v.metric, v.value AS result, q.platforms
FROM v JOIN q ON v.lower = q.lower AND v.metric = q.metric WHERE v.grain = 'total'"""


ORACLES: dict[str, str] = {
    "scan_purchases": f"""SELECT 'acme' AS company, 'main' AS app, CAST(event_id AS VARCHAR) AS id,
  CAST(user_id AS VARCHAR) AS user_id, value AS price,
  CASE WHEN event_id % 2 = 0 THEN {MS} ELSE {SECOND} END AS time, {PLATFORM} AS platform,
  {SYSTEM} AS payment_system FROM events WHERE event_type = 'purchase'""",
    "scan_sessions": f"""SELECT 'acme' AS company, 'main' AS app, CAST(event_id AS VARCHAR) AS id,
  CAST(user_id AS VARCHAR) AS user_id, {SECOND} AS time, {PLATFORM} AS platform FROM events WHERE {SESSION_EVENTS}""",
    "profile_unnest": f"""SELECT 'purchase' AS kind, CAST(user_id AS VARCHAR) AS user_id, {MS} AS time,
  {PLATFORM} AS platform, {SYSTEM} AS payment_system FROM events WHERE event_type = 'purchase'
UNION ALL SELECT 'session', CAST(user_id AS VARCHAR), {MS}, {PLATFORM}, 0 FROM events WHERE {SESSION_EVENTS}""",
    "metric_lookup": metrics(["total_revenue"], DAYS, where=IN_WEEK_2),
    "metric_lookup_sum": f"""SELECT company, app, grain, platform, sum(value) AS value, count(*) AS windows
FROM ({metrics(["number_sessions"], DAYS)}) GROUP BY ALL""",
    "tenant_apps": """SELECT DISTINCT 'acme' AS company, 'app' || CAST(user_id % 2 AS VARCHAR) AS app,
  CASE user_id % 2 WHEN 0 THEN 'Android,iOS' ELSE 'Web,iOS' END AS platforms,
  CASE user_id % 2 WHEN 0 THEN '1,2' ELSE '2,3' END AS payment_systems FROM events
UNION ALL VALUES ('acme', 'bare', '', ''), ('acme', 'blank', '', '')""",
    "metric_document": _document(),
    "slice_window_platform": f"{base(WEEKS)}{COUNTS} SELECT lower, upper, id, user_id, time, platform FROM ss",
    "filter_window_containment": metrics(["total_revenue"], DAYS, where=f"grain = 'total' AND {IN_WEEK_2}"),
    "filter_window": f"{base(WEEK_2)} SELECT lower, upper, id, user_id, time FROM pw",
    "filter_configured": f"""{base(MONTH)} SELECT id, platform, payment_system FROM p
WHERE platform IN ('Android', 'iOS') AND payment_system IN (1, 2)""",
    "qualifying_payers": f"{base(WEEKS)}{COUNTS} SELECT DISTINCT lower, upper, user_id FROM ps",
    "json_field": "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events",
    "parse_printed_date": f"SELECT event_id, {SECOND} AS parsed FROM events",
    "parse_epoch_ms": f"SELECT event_id, {MS} AS parsed FROM events",
    "parse_iso_day": "SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events",
    "coerce_int": "SELECT event_id, CAST(trunc(value) AS INTEGER) AS whole FROM events",
    "paying_profiles_semi": f"""{base(WEEKS)}{COUNTS}
SELECT CAST(user_id AS VARCHAR) AS user_id,
  CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS purchases,
  CAST(sum(CASE WHEN {SESSION_EVENTS} THEN 1 ELSE 0 END) AS BIGINT) AS sessions
FROM events WHERE CAST(user_id AS VARCHAR) IN (SELECT user_id FROM ps) GROUP BY 1""",
    "join_metrics_platform": f"""{base(DAYS)}{COUNTS}
SELECT x.lower, x.upper, x.platform, round(CAST(x.v AS DOUBLE), 6) AS revenue, CAST(d.users AS DOUBLE) AS active_users,
  round({ratio('x.v', 'd.users')}, 6) AS ratio FROM rev_p x JOIN ses_p d {ON_P}""",
    "sessions_in_interval": f"""{base(WEEKS)}{COUNTS}{BETWEEN}
SELECT lower, upper, user_id, platform, CAST(payment_system AS INTEGER) AS payment_system, count(*) AS pairs,
  CAST(sum(n) AS BIGINT) AS raw, CAST(sum(CASE WHEN n > 2 THEN n - 2 ELSE n END) AS BIGINT) AS adjusted
FROM btw GROUP BY ALL""",
    "sessions_before_event": f"""{base(WEEKS)}{COUNTS}{FIRST}
SELECT user_id, '*' AS platform, CAST(0 AS INTEGER) AS payment_system, n AS sessions
FROM fn_t SEMI JOIN mat USING (user_id)
UNION ALL SELECT user_id, platform, CAST(payment_system AS INTEGER), n FROM fn_y SEMI JOIN mat USING (user_id)""",
    "zero_fill_grid": f"""{base(DAYS)}{COUNTS}
SELECT lower, upper, platform, CAST(payment_system AS INTEGER) AS payment_system, round(CAST(v AS DOUBLE), 6) AS revenue
FROM rev_y
UNION ALL SELECT lower, upper, platform, 0, round(CAST(v AS DOUBLE), 6) FROM rev_p
UNION ALL SELECT lower, upper, '*', 0, round(CAST(v AS DOUBLE), 6) FROM rev_t""",
    "merge_user_platform_counts": _user_counts(MONTH, "sw"),
    "sum_by_system": f"""{base(MONTH)}{COUNTS}
SELECT platform, payment_system, round(v, 6) AS revenue FROM rev_s""",
    "rollup_revenue": f"""{base(WEEKS)}{COUNTS}
SELECT lower, CASE WHEN grouping(platform) = 1 THEN '*' ELSE platform END AS platform,
  CAST(CASE WHEN grouping(payment_system) = 1 THEN 0 ELSE payment_system END AS INTEGER) AS payment_system,
  round(sum(price), 6) AS revenue
FROM pp GROUP BY GROUPING SETS ((lower, platform, payment_system), (lower, platform), (lower))""",
    "distinct_per_platform": f"""{base(MONTH)}{COUNTS}
SELECT platform, CAST(users AS DOUBLE) AS active_users, CAST(ids AS DOUBLE) AS sessions FROM ses_p""",
    "count_by_user": f"""{base(WEEKS)}{COUNTS}
SELECT lower, platform, user_id, count(*) AS sessions FROM ss GROUP BY ALL""",
    "collect_purchases": f"""{base(MONTH)}
SELECT user_id, CAST(count(*) AS INTEGER) AS n, {IDS.format('', '', '')} AS ids
FROM pw GROUP BY user_id""",
    "count_if_system": f"""{base(WEEKS)}{COUNTS}
SELECT u.lower, u.user_id, pl.platform, count(ps.id) AS n,
  count(CASE WHEN ps.payment_system = 1 THEN 1 END) AS n1,
  count(CASE WHEN ps.payment_system = 2 THEN 1 END) AS n2
FROM pay u CROSS JOIN pl
LEFT JOIN ps ON ps.lower = u.lower AND ps.user_id = u.user_id AND ps.platform = pl.platform
GROUP BY u.lower, u.user_id, pl.platform""",
    "reduce_long": f"""{base(WEEKS)}{COUNTS}
SELECT lower, platform, payment_system, count(*) AS purchases, count(DISTINCT user_id) AS users
FROM ps GROUP BY ALL""",
    "safe_ratio": f"""WITH x AS (SELECT user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day,
  coalesce(sum(CASE WHEN event_type = 'purchase' THEN value END), 0) AS paid,
  sum(CASE WHEN {SESSION_EVENTS} THEN 1 ELSE 0 END) AS n FROM events GROUP BY ALL)
SELECT user_id, day, round({ratio('paid', 'n')}, 6) AS ratio FROM x""",
    "consecutive_purchases": f"""{base(MONTH)}
SELECT * FROM (SELECT user_id, id, time,
    lead(id) OVER (PARTITION BY user_id ORDER BY time, id) AS next_id,
    lead(time) OVER (PARTITION BY user_id ORDER BY time, id) AS next_time FROM pw)
WHERE next_time IS NOT NULL""",
    "first_purchase": f"{base(MONTH)} SELECT user_id, min(time) AS first_time FROM p GROUP BY user_id",
    "first_purchase_by_system": f"""{base(MONTH)}{COUNTS}{FIRST}
SELECT user_id, platform, payment_system, t AS first_time FROM f_y""",
    "sessions_per_user": _user_counts(WEEKS, "ss"),
    "paying_users": f"""{base(WEEKS)}
SELECT lower, upper, user_id, row_number() OVER (PARTITION BY lower, user_id ORDER BY time, id) AS ordinal, id,
  platform, payment_system, platform <> 'Web' AND payment_system < 3 AS on_platform_list
FROM pw""",
    **{
        name: metrics([name], WEEKS)
        for name in ("total_revenue", "active_users", "number_sessions", "lifetime_value")
    },
    **{
        name: metrics([name], WEEKS, extra=RATIO)
        for name in (
            "arpu",
            "avg_revenue_session",
            "avg_purchases_user",
            "purchases_per_session",
            "sessions_first_purchase",
            "sessions_between_purchases",
        )
    },
    "daily_windows": f"""WITH w AS ({DAYS})
SELECT lower, upper, count(*) AS events FROM events JOIN w ON ts BETWEEN lower AND upper GROUP BY ALL""",
    "backfill_revenue_daily": metrics(["total_revenue"], DAYS, where="grain = 'total'"),
    "tenant_revenue": metrics(["total_revenue"], WEEKS, TWO_APPS),
    "metrics_all": metrics(list(METRICS), DAYS),
    "tenant_metrics_all": metrics(list(METRICS), WEEKS, TWO_APPS),
    "metrics_overlapping": metrics(
        ["total_revenue", "active_users", "number_sessions", "paying_users", "purchases_per_session"], OVERLAPPING
    ),
    "stored_metrics": metrics(list(METRICS), WEEKS),
    "stored_paying_users": f"""{base(WEEK_2)}
SELECT lower, upper, user_id, id, time, platform, payment_system FROM pw""",
    "stored_sessions_per_user": _user_counts(WEEKS, "ss"),
    "first_purchase_state": metrics(["sessions_first_purchase"], WEEKS, extra=RATIO),
    "metrics_with_missing_fields": metrics(
        list(METRICS), WEEKS, buyer="CASE WHEN event_id % 7 <> 0 THEN user_id END"
    ),
    # A profile has its times in milliseconds; no two events of a user are closer in the test data.
    "journeys_from_profiles": metrics(
        ["sessions_first_purchase", "sessions_between_purchases"], WEEKS, extra=RATIO
    ),
    "windows_left_closed": f"""WITH w AS ({DAYS})
SELECT lower, upper, count(*) AS events FROM events JOIN w ON ts >= lower AND ts < upper GROUP BY ALL""",
    "windows_listed": f"""{base(LISTED)}
SELECT lower, upper, count(*) AS purchases, round(sum(price), 6) AS revenue FROM pw GROUP BY ALL""",
    "purchases_in_window": f"""{base(WEEK_2)}
SELECT lower, upper, user_id, count(*) AS purchases FROM pw GROUP BY ALL""",
    "platforms_in_order": f"""{base(WEEKS)}{COUNTS}
SELECT x.lower, x.upper, string_agg(p.platform, ',' ORDER BY p.platform) AS platforms, CAST(max(x.ids) AS DOUBLE) AS result
FROM ses_t x JOIN ses_p p USING (app, lower, upper) GROUP BY x.lower, x.upper""",
    "path_safe_names": """SELECT event_id, 'app_' || event_type || '.' || CAST(user_id % 5 AS VARCHAR) AS name FROM events""",
    "distinct_users_by_span": f"""{base(MONTH)},
spans AS ({WEEKS} UNION ALL {MONTH})
SELECT 'acme' AS company, 'main' AS app, spans.lower, spans.upper, coalesce(platform, '*') AS platform,
  count(DISTINCT coalesce(user_id, '')) AS users
FROM s SEMI JOIN pl USING (app, platform) JOIN spans ON time >= spans.lower AND time < spans.upper
GROUP BY GROUPING SETS ((spans.lower, spans.upper, platform), (spans.lower, spans.upper))""",
    "rejected_records": """SELECT 'acme' AS company, 'app' || CAST(user_id % 2 AS VARCHAR) AS app,
  CASE WHEN event_id % 13 = 0 THEN 'record' WHEN event_id % 7 = 0 THEN 'time' WHEN event_id % 11 = 0 THEN 'platform'
    ELSE 'none' END AS reason, count(*) AS n
FROM events WHERE event_type = 'purchase' GROUP BY ALL""",
}
