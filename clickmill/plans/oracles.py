"""The registered queries in ANSI SQL over the star-schema tables, written apart from the plans.

Ratios are taken on integers (cents and counts), so that halves round away from zero exactly.
"""

NOW = "TIMESTAMP '2024-03-26 00:00:00'"
AS_OF = "DATE '2024-03-25'"
CHECK_DAY = "DATE '2024-02-15'"
FIRST_DROP = "DATE '2024-02-20'"
TYPES = "('page_view', 'click', 'add_to_cart', 'purchase', 'cashback_earned', 'refund')"

CLEAN = """
b0 AS (
  SELECT event_id AS n, user_id AS u, ts, event_type AS kind,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k,
         CAST(CAST(ts AS DATE) - DATE '2024-01-01' AS INTEGER) AS di
  FROM events),
b1 AS (
  SELECT *, u * 6 + CASE WHEN k < 50 THEN 0 WHEN k < 75 THEN 1 WHEN k < 88 THEN 2
                         WHEN k < 95 THEN 3 WHEN k < 98 THEN 4 ELSE 5 END AS m FROM b0),
b2 AS (SELECT *, (m * 5) % 84 AS first_day, 1 + m % 4 AS stride FROM b1),
b3 AS (SELECT *, 1 + (m * 11) % (84 - first_day) AS span FROM b2),
b4 AS (SELECT *, CAST(first_day + ((di * span) // 30) // stride * stride AS INTEGER) AS day FROM b3),
b5 AS (
  SELECT *, ts + to_days(day - di) AS happened,
         CASE kind WHEN 'view' THEN 'page_view'
              WHEN 'click' THEN CASE WHEN m % 10 = 0 THEN 'purchase' ELSE 'click' END
              WHEN 'signup' THEN 'add_to_cart'
              WHEN 'purchase' THEN CASE WHEN m % 3 = 1 THEN 'page_view' ELSE 'purchase' END
              ELSE CASE WHEN k % 3 = 0 THEN 'refund' ELSE 'cashback_earned' END END AS type
  FROM b4),
b6 AS (
  SELECT b5.*, p_name, p_type, CAST(p_retailprice AS DECIMAL(12,2)) AS price,
         r_name, n_name, u * 10 + k % 10 AS part_key,
         CASE WHEN type IN ('add_to_cart', 'purchase', 'refund') THEN 1 + n % 5 ELSE 0 END AS qty
  FROM b5
  LEFT JOIN part ON p_partkey = u * 10 + k % 10
  LEFT JOIN (SELECT c_custkey, r_name, n_name FROM customer
             JOIN nation ON c_nationkey = n_nationkey
             JOIN region ON n_regionkey = r_regionkey) ON c_custkey = u * 10 + n % 4),
clean AS (
  SELECT n, 'e' || n AS event_id, 'u' || m AS user_id, type AS event_type, happened AS event_timestamp,
         CAST(happened AS DATE) AS event_date, '/' || type || '/' || part_key AS page_url,
         'p' || part_key AS product_id, p_name AS product_name, p_type AS product_category,
         price AS product_price, CAST(qty AS INTEGER) AS quantity,
         CAST(CASE type WHEN 'purchase' THEN price * qty WHEN 'refund' THEN -price * qty ELSE 0 END
              AS DECIMAL(12,2)) AS revenue,
         CAST(CASE type WHEN 'cashback_earned' THEN (50 + n % 4950) * CAST(0.01 AS DECIMAL(3,2))
                        WHEN 'refund' THEN -(n % 100) * CAST(0.01 AS DECIMAL(3,2)) ELSE 0 END
              AS DECIMAL(12,2)) AS cashback_amount,
         CASE (n + m) % 5 WHEN 3 THEN 'desktop' WHEN 4 THEN 'tablet' ELSE 'mobile' END AS device_type,
         CASE (n * 3 + m) % 4 WHEN 2 THEN 'Safari' WHEN 3 THEN 'Firefox' ELSE 'Chrome' END AS browser,
         r_name AS country, n_name AS city, 's' || m || '-' || day AS session_id,
         CASE n % 4 WHEN 0 THEN 'direct' WHEN 1 THEN 'email' WHEN 2 THEN 'google.com' END AS referrer
  FROM b6)"""

RAW_COLUMNS = (
    "event_id, user_id, event_type, event_timestamp, event_date, page_url, product_id, product_name,"
    " product_category, product_price, quantity, revenue, cashback_amount, device_type, browser,"
    " country, city, session_id, referrer"
)
EVENT_COLUMNS = RAW_COLUMNS.replace("event_date,", "event_date, event_hour,")

DIRTY = (
    CLEAN
    + """,
copies AS (
  SELECT clean.*, event_date AS file_date, c.copy
  FROM clean JOIN (SELECT 0 AS copy UNION ALL SELECT 1 UNION ALL SELECT 2) c
    ON c.copy = 0 OR (c.copy = 1 AND n % 73 = 0) OR (c.copy = 2 AND n % 101 = 0 AND n % 73 <> 0)),
moved AS (
  SELECT *, CASE WHEN n % 89 = 0 THEN event_timestamp + INTERVAL 400 DAY
                 WHEN n % 67 = 0 THEN event_timestamp - INTERVAL 2000 DAY
                 ELSE event_timestamp END + to_hours(CASE WHEN copy = 2 THEN 1 ELSE 0 END) AS happened2
  FROM copies),
dirty AS (
  SELECT n, file_date, event_id,
         CASE WHEN n % 97 <> 0 THEN user_id END AS user_id,
         CASE WHEN n % 79 = 0 THEN '' WHEN n % 71 = 0 THEN 'swipe' ELSE event_type END AS event_type,
         happened2 AS event_timestamp, CAST(happened2 AS DATE) AS event_date, page_url, product_id, product_name,
         product_category, CASE WHEN n % 83 = 0 THEN -product_price ELSE product_price END AS product_price,
         CASE WHEN n % 107 <> 0 THEN quantity END AS quantity,
         CASE WHEN n % 103 <> 0 THEN revenue END AS revenue, cashback_amount,
         CASE WHEN n % 43 <> 0 THEN device_type END AS device_type, browser, country,
         CASE WHEN n % 37 <> 0 THEN city END AS city, session_id, referrer
  FROM moved)"""
)

# Bronze keeps what it can read: text faults are null or 0 here already.
BRONZE = (
    DIRTY
    + f""",
texts AS (
  SELECT dirty.* REPLACE (
           CASE WHEN n % 109 = 0 THEN '  ' ELSE user_id END AS user_id,
           nullif(event_type, '') AS event_type,
           CASE WHEN n % 53 <> 0 THEN event_timestamp END AS event_timestamp,
           CASE WHEN n % 61 = 0 THEN 0 ELSE coalesce(product_price, 0) END AS product_price,
           CASE WHEN n % 59 = 0 THEN 0 ELSE coalesce(quantity, 0) END AS quantity,
           coalesce(revenue, 0) AS revenue,
           CASE WHEN n % 47 <> 0 THEN referrer END AS referrer),
         'events_' || file_date || '.csv' AS source_file
  FROM dirty),
bronze AS (
  SELECT *, {NOW} AS ingested_at,
         concat_ws(',', CASE WHEN user_id IS NULL THEN 'null_user_id' END,
                   CASE WHEN event_type IS NULL THEN 'null_event_type' END,
                   CASE WHEN event_timestamp IS NULL THEN 'null_event_timestamp' END,
                   CASE WHEN trim(user_id) = '' THEN 'blank_user_id' END,
                   CASE WHEN n % 127 = 0 AND n % 59 <> 0 THEN 'overflow_quantity' END) AS reason
  FROM texts)"""
)
BRONZE_OUT = RAW_COLUMNS.replace("product_price", "CAST(product_price AS DOUBLE) AS product_price").replace(
    " revenue", " CAST(revenue AS DOUBLE) AS revenue"
).replace("cashback_amount", "CAST(cashback_amount AS DOUBLE) AS cashback_amount")
BATCH = f"CASE WHEN file_date <= {FIRST_DROP} THEN 'batch_1' ELSE 'batch_2' END AS batch_id"


def _flags(source: str) -> str:
    return f"""
  SELECT *, concat_ws(',', CASE WHEN event_id IS NULL THEN 'null_event_id' END,
                      CASE WHEN user_id IS NULL THEN 'null_user_id' END,
                      CASE WHEN event_type IS NULL THEN 'null_event_type' END,
                      CASE WHEN event_timestamp IS NULL THEN 'null_event_timestamp' END,
                      CASE WHEN event_type NOT IN {TYPES} THEN 'invalid_event_type' END,
                      CASE WHEN event_timestamp > {NOW} THEN 'future_timestamp'
                           WHEN event_timestamp < TIMESTAMP '2020-01-01' THEN 'ancient_timestamp'
                           WHEN event_date NOT BETWEEN DATE '2020-01-01' AND CAST({NOW} AS DATE)
                           THEN 'invalid_event_date' END
                     ) AS quality_flags
  FROM {source}"""


FLAGGED = DIRTY + f""",
flagged AS ({_flags("dirty")})"""


def _silver(where: str = "TRUE", ctes: str = DIRTY, source: str = "dirty") -> str:
    """Silver rows of the source: one per id, flagged, repaired, with defaults."""
    return (
        ctes
        + f""",
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY event_timestamp NULLS FIRST) AS rn
  FROM {source} WHERE {where}),
flagged AS ({_flags("ranked")} WHERE rn = 1),
silver AS (
  SELECT event_id, user_id, event_type, event_timestamp, event_date,
         CAST(hour(event_timestamp) AS INTEGER) AS event_hour, page_url, product_id, product_name,
         product_category,
         coalesce(CASE WHEN event_type <> 'refund' AND product_price < 0 THEN -product_price
                       ELSE product_price END, 0) AS product_price,
         coalesce(quantity, 0) AS quantity, coalesce(revenue, 0) AS revenue,
         coalesce(cashback_amount, 0) AS cashback_amount,
         coalesce(device_type, 'unknown') AS device_type, coalesce(browser, 'unknown') AS browser,
         coalesce(country, 'unknown') AS country, coalesce(city, 'unknown') AS city, session_id,
         referrer, quality_flags = '' AS is_valid, quality_flags, {NOW} AS cleaned_at
  FROM flagged)"""
    )


SILVER = _silver()
SILVER_OUT = BRONZE_OUT.replace("event_date,", "event_date, event_hour,") + ", is_valid, quality_flags, cleaned_at"

_FACT = """
  SELECT *, CAST(dayofweek(event_date) AS INTEGER) AS day_of_week,
         CAST(month(event_date) AS INTEGER) AS event_month, CAST(year(event_date) AS INTEGER) AS event_year,
         dayofweek(event_date) IN (0, 6) AS is_weekend,
         CASE WHEN event_hour BETWEEN 6 AND 11 THEN 'morning' WHEN event_hour BETWEEN 12 AND 14 THEN 'lunch'
              WHEN event_hour BETWEEN 15 AND 18 THEN 'afternoon'
              WHEN event_hour BETWEEN 19 AND 22 THEN 'evening' ELSE 'night' END AS time_of_day,
         revenue > 0 AS is_revenue_event, cashback_amount > 0 AS is_cashback_event"""
FACT_OUT = (
    BRONZE_OUT.replace("event_date,", "event_date, event_hour,")
    + ", day_of_week, event_month, event_year, is_weekend, time_of_day, is_revenue_event, is_cashback_event"
)
FACT = CLEAN + f""",
stg AS (
  SELECT * REPLACE (coalesce(product_price, 0) AS product_price, coalesce(country, 'unknown') AS country,
                    coalesce(city, 'unknown') AS city),
         CAST(hour(event_timestamp) AS INTEGER) AS event_hour FROM clean),
fact AS ({_FACT} FROM stg)"""


def _ratio(num: str, den: str, places: int = 2, factor: int = 100) -> str:
    """`factor * num / den` to `places` digits for integers num >= 0."""
    unit = factor * 10**places
    exact = f"(CAST({num} AS HUGEINT) * {2 * unit} + {den}) // (2 * {den})"
    return f"CASE WHEN {den} > 0 THEN CAST({exact} AS DOUBLE) / {10**places} ELSE 0 END"


def _cents_ratio(cents: str, den: str) -> str:
    """Amount in cents per `den`, to cents."""
    exact = f"(CAST({cents} AS HUGEINT) * 2 + {den}) // (2 * {den})"
    return f"CASE WHEN {den} > 0 THEN CAST({exact} AS DOUBLE) / 100 ELSE 0 END"


def _count_type(t: str, name: str) -> str:
    return f"CAST(count(*) FILTER (event_type = '{t}') AS BIGINT) AS {name}"


def _cents(column: str, t: str, name: str) -> str:
    total = f"sum(CAST({column} * 100 AS BIGINT)) FILTER (event_type = '{t}')"
    return f"CAST(coalesce({total}, 0) AS BIGINT) AS {name}"


KPIS = FACT + f""",
per_day AS (
  SELECT event_date, count(DISTINCT user_id) AS dau, count(DISTINCT session_id) AS daily_sessions,
         count(*) AS total_events, {_count_type("page_view", "page_views")},
         {_count_type("click", "clicks")}, {_count_type("add_to_cart", "add_to_carts")},
         {_count_type("purchase", "purchases")}, {_count_type("cashback_earned", "cashback_events")},
         {_count_type("refund", "refunds")}, {_cents("revenue", "purchase", "rev")},
         {_cents("cashback_amount", "cashback_earned", "cash")}, {_cents("abs(revenue)", "refund", "back")},
         count(DISTINCT user_id) FILTER (event_type = 'purchase') AS purchasing_users,
         count(DISTINCT product_id) FILTER (event_type = 'purchase') AS products_sold,
         count(DISTINCT user_id) FILTER (device_type = 'mobile') AS mobile_users,
         count(DISTINCT user_id) FILTER (device_type = 'desktop') AS desktop_users,
         count(DISTINCT user_id) FILTER (device_type = 'tablet') AS tablet_users
  FROM fact GROUP BY event_date),
weekly AS (
  SELECT d.event_date, count(DISTINCT f.user_id) AS wau
  FROM per_day d JOIN (SELECT DISTINCT user_id, event_date FROM fact) f
    ON f.event_date BETWEEN d.event_date - 6 AND d.event_date
  GROUP BY d.event_date),
kpis AS (
  SELECT event_date, dau, daily_sessions, total_events, page_views, clicks, add_to_carts, purchases,
         cashback_events, refunds, CAST(rev AS DOUBLE) / 100 AS daily_revenue,
         CAST(cash AS DOUBLE) / 100 AS daily_cashback, CAST(back AS DOUBLE) / 100 AS daily_refunds,
         purchasing_users, products_sold, mobile_users, desktop_users, tablet_users,
         {_ratio("purchases", "page_views", 4)} AS conversion_rate,
         {_cents_ratio("rev", "purchases")} AS avg_order_value,
         {_cents_ratio("rev", "dau")} AS revenue_per_user, wau, rev
  FROM per_day JOIN weekly USING (event_date))"""


def _mode(column: str, name: str) -> str:
    return f"""
{name}_top AS (
  SELECT user_id, {column} AS {name} FROM (
    SELECT user_id, {column},
           row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, {column}) AS rn
    FROM fact WHERE {column} IS NOT NULL GROUP BY user_id, {column}) WHERE rn = 1)"""


MODES = FACT + "," + ",".join(
    _mode(c, n)
    for n, c in (
        ("primary_device", "device_type"),
        ("primary_browser", "browser"),
        ("country", "country"),
        ("city", "city"),
    )
)
MODE_JOINS = " ".join(
    f"LEFT JOIN {n}_top USING (user_id)" for n in ("primary_device", "primary_browser", "country", "city")
)
USERS = MODES + f""",
per_user AS (
  SELECT user_id, min(event_date) AS first_seen_date, max(event_date) AS last_seen_date,
         count(DISTINCT event_date) AS active_days, count(*) AS total_events,
         {_count_type("page_view", "page_views")}, {_count_type("click", "clicks")},
         {_count_type("add_to_cart", "cart_additions")}, {_count_type("purchase", "purchases")},
         {_count_type("cashback_earned", "cashback_events")}, {_count_type("refund", "refunds")},
         {_cents("revenue", "purchase", "rev")}, {_cents("cashback_amount", "cashback_earned", "cash")},
         count(DISTINCT session_id) AS total_sessions, count(DISTINCT product_id) AS unique_products_viewed,
         CAST({AS_OF} - min(event_date) AS INTEGER) AS account_age_days,
         CAST({AS_OF} - max(event_date) AS INTEGER) AS days_since_last_active
  FROM fact GROUP BY user_id),
users AS (
  SELECT per_user.* EXCLUDE (rev, cash), CAST(rev AS DOUBLE) / 100 AS total_revenue,
         CAST(cash AS DOUBLE) / 100 AS total_cashback, primary_device, primary_browser,
         country_top.country, city_top.city,
         {_ratio("purchases", "page_views")} AS conversion_rate,
         {_cents_ratio("rev", "purchases")} AS avg_order_value,
         CASE WHEN purchases >= 10 AND active_days >= 15 THEN 'power_user'
              WHEN purchases >= 3 AND active_days >= 5 THEN 'regular'
              WHEN purchases >= 1 THEN 'casual_buyer' WHEN page_views >= 10 THEN 'window_shopper'
              WHEN days_since_last_active > 30 THEN 'churned' ELSE 'new_user' END AS user_segment,
         CASE WHEN account_age_days <= 7 THEN 'new' WHEN days_since_last_active <= 7 THEN 'active'
              WHEN days_since_last_active <= 30 THEN 'at_risk' ELSE 'dormant' END AS lifecycle_stage,
         rev
  FROM per_user {MODE_JOINS})"""

FUNNEL = FACT + f""",
stages AS (
  SELECT * FROM (VALUES (1, 'page_view'), (2, 'click'), (3, 'add_to_cart'), (4, 'purchase'),
                        (5, 'cashback_earned')) AS s(stage_order, stage_name)),
reached AS (
  SELECT s.stage_order, s.stage_name, count(DISTINCT f.user_id) AS unique_users, count(f.event_id) AS total_events
  FROM stages s LEFT JOIN fact f ON f.event_type = s.stage_name GROUP BY ALL),
stepped AS (
  SELECT *, lag(unique_users) OVER (ORDER BY stage_order) AS prev,
         first_value(unique_users) OVER (ORDER BY stage_order) AS top FROM reached),
funnel AS (
  SELECT stage_order, stage_name, unique_users, total_events,
         {_ratio("unique_users", "top")} AS overall_conversion_rate,
         CASE WHEN prev > 0 THEN {_ratio("unique_users", "prev")} ELSE 100 END AS step_conversion_rate,
         coalesce(prev - unique_users, 0) AS dropoff_count,
         sign(coalesce(prev - unique_users, 0))
           * ({_ratio("abs(coalesce(prev - unique_users, 0))", "coalesce(prev, 0)")}) AS dropoff_rate
  FROM stepped)"""

COHORTS = FACT + """,
days AS (SELECT DISTINCT user_id, event_date FROM fact),
firsts AS (SELECT user_id, min(event_date) AS cohort_date FROM fact GROUP BY user_id),
activity AS (
  SELECT user_id, cohort_date, event_date AS activity_date,
         CAST(event_date - cohort_date AS INTEGER) AS days_since_signup
  FROM firsts JOIN days USING (user_id))"""
WINDOWS = {
    **{f"day_{d}": f"days_since_signup = {d}" for d in (0, 1, 3, 7, 14, 30)},
    **{f"week_{w}": f"days_since_signup BETWEEN {7 * w - 6} AND {7 * w}" for w in (1, 2, 3, 4)},
}
RETENTION = COHORTS + f""",
weekly AS (
  SELECT CAST(date_trunc('week', cohort_date) AS DATE) AS cohort_week, count(DISTINCT user_id) AS cohort_size,
         {", ".join(f"count(DISTINCT user_id) FILTER ({w}) AS retained_{n}" for n, w in WINDOWS.items())}
  FROM activity GROUP BY 1),
retention AS (
  SELECT cohort_week, cohort_size, {", ".join(f"retained_{n}" for n in WINDOWS if n[0] == "d" and n != "day_0")},
         {", ".join(f"{_ratio(f'retained_{n}', 'cohort_size')} AS retention_rate_{n}" for n in WINDOWS if n != "day_0")}
  FROM weekly)"""


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select}"


KPI_COLUMNS = "* EXCLUDE (rev)"


def _shares(column: str, name: str) -> str:
    share = _ratio("count(*)", "(SELECT count(*) FROM users)")
    return _with(USERS, f"SELECT {column} AS {name}, count(*) AS users, {share} AS share FROM users GROUP BY {column}")


def _constraint(table: str, source: str, unique=(), not_null=(), accepted=()) -> list[str]:
    def row(column, rule, count):
        return (
            f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{rule}' AS constraint_name,"
            f" CAST(({count}) AS BIGINT) AS failures"
        )

    return (
        [row(c, "not_null", f"SELECT count(*) FROM {source} WHERE {c} IS NULL") for c in not_null]
        + [
            row(c, "accepted_values", f"SELECT count(*) FROM {source} WHERE {c} NOT IN {values}")
            for c, values in accepted
        ]
        + [
            row(
                c,
                "unique",
                f"SELECT count(*) FROM (SELECT {c} FROM {source} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)",
            )
            for c in unique
        ]
    )


def _tail(ctes: str, done: str) -> str:
    """The CTEs of `ctes` after those of `done`."""
    assert ctes.startswith(done)
    return ctes[len(done) :]


_ALL_MARTS = (
    USERS
    + _tail(KPIS, FACT)
    + _tail(FUNNEL, FACT)
    + _tail(RETENTION, FACT).replace("\nweekly AS", "\nweekly_cohorts AS").replace("FROM weekly)", "FROM weekly_cohorts)")
    + _tail(FLAGGED, CLEAN)
)
# What all deliveries together bring, some rows with a day far off.
ARRIVED = BRONZE + """,
arrived AS (
  SELECT * REPLACE (CASE WHEN n % 113 = 0 THEN DATE '9999-12-31' ELSE event_date END AS event_date)
  FROM bronze WHERE reason = '')"""
ARRIVED_FACT = _silver(ctes=ARRIVED, source="arrived") + f""",
fact AS ({_FACT} FROM silver WHERE is_valid)"""
_TYPES = ("event_type", TYPES)
_CONSTRAINTS = (
    _constraint("silver", "flagged", ["event_id"], ["event_id", "user_id", "event_type", "event_timestamp"], [_TYPES])
    + _constraint("stg_events", "stg", ["event_id"], ["event_id"], [_TYPES])
    + _constraint(
        "fact_events", "fact", ["event_id"], ["event_id", "user_id", "event_type", "event_date"],
        [_TYPES, ("time_of_day", "('morning', 'lunch', 'afternoon', 'evening', 'night')")])
    + _constraint(
        "dim_users", "users", ["user_id"], ["user_id"],
        [("user_segment", "('power_user', 'regular', 'casual_buyer', 'window_shopper', 'churned', 'new_user')"),
         ("lifecycle_stage", "('new', 'active', 'at_risk', 'dormant')")])
    + _constraint("daily_kpis", "kpis", ["event_date"], ["event_date", "dau"])
    + _constraint("funnel_analysis", "funnel", [], ["stage_order", "stage_name"])
    + _constraint("retention", "retention", ["cohort_week"], ["cohort_week", "cohort_size"])
)

ORACLES = {
    "bronze_ingest": _with(
        BRONZE,
        f"SELECT {BRONZE_OUT}, ingested_at, source_file, 'batch_1' AS batch_id FROM bronze WHERE reason = ''",
    ),
    "bronze_rejects": _with(
        BRONZE,
        "SELECT source_file, reason AS reject_reason, count(*) AS rejected_rows FROM bronze"
        " WHERE reason <> '' GROUP BY ALL",
    ),
    "bronze_incremental_files": _with(
        BRONZE, f"SELECT {BRONZE_OUT}, ingested_at, {BATCH} FROM bronze WHERE reason = ''"
    ),
    "stream_fact": _with(ARRIVED_FACT, f"SELECT {FACT_OUT} FROM fact"),
    "stream_bronze": _with(BRONZE, f"SELECT {BRONZE_OUT}, {BATCH} FROM bronze WHERE reason = ''"),
    "bronze_malformed_lines": _with(
        BRONZE,
        """SELECT fault, accepted, count(*) AS rows FROM (
  SELECT CASE WHEN n % 131 = 0 THEN 'extra_cells' WHEN n % 137 <> 0 AND n % 139 = 0 THEN 'open_quote' ELSE '' END AS fault,
         n % 131 <> 0 AND (n % 137 = 0 OR n % 139 <> 0) AND (reason = '' OR (n % 137 = 0 AND reason = 'overflow_quantity'))
           AS accepted,
         unnest(CASE WHEN n % 131 <> 0 AND n % 137 <> 0 AND n % 139 = 0 THEN [1, 2] ELSE [1] END)
  FROM bronze) GROUP BY ALL""",
    ),
    "bronze_time_formats": _with(
        BRONZE + """,
spelled AS (
  SELECT *, n % 53 <> 0 AND ((n % 5 = 3 OR n % 5 = 4) AND day(event_timestamp) <= 12
            AND day(event_timestamp) <> month(event_timestamp)) AS unclear
  FROM bronze),
told AS (
  SELECT event_id, n, reason, unclear, event_date,
         CASE WHEN NOT unclear THEN date_trunc(CASE WHEN n % 5 IN (1, 4) THEN 'minute' ELSE 'second' END, event_timestamp) END
           AS event_timestamp
  FROM spelled)""",
        """SELECT DISTINCT event_id, event_timestamp, event_date,
       CASE WHEN unclear THEN concat_ws(',',
         nullif(array_to_string(list_filter(string_split(reason, ','), lambda r: r IN ('null_user_id', 'null_event_type')), ','), ''),
         'null_event_timestamp',
         nullif(array_to_string(list_filter(string_split(reason, ','), lambda r: r IN ('blank_user_id', 'overflow_quantity')), ','), ''),
         'ambiguous_event_timestamp') ELSE reason END AS reject_reason
FROM told""",
    ),
    "dedup_events": _with(
        DIRTY,
        f"SELECT {BRONZE_OUT} FROM (SELECT *, row_number() OVER (PARTITION BY event_id"
        " ORDER BY event_timestamp) AS rn FROM dirty) WHERE rn = 1",
    ),
    "stream_dedup": _with(
        DIRTY,
        "SELECT DISTINCT event_id, user_id, event_type, product_id, session_id, device_type FROM dirty",
    ),
    "silver_flags": _with(
        FLAGGED,
        "SELECT event_id, user_id, event_type, event_timestamp, quality_flags = '' AS is_valid, quality_flags FROM flagged",
    ),
    "silver_price_repair": _with(
        DIRTY,
        "SELECT event_id, event_type, CAST(CASE WHEN event_type <> 'refund' THEN abs(product_price)"
        " ELSE product_price END AS DOUBLE) AS product_price FROM dirty",
    ),
    "silver_clean": _with(SILVER, f"SELECT {SILVER_OUT} FROM silver WHERE is_valid"),
    "silver_quarantine": _with(SILVER, f"SELECT {SILVER_OUT} FROM silver WHERE NOT is_valid"),
    "silver_single_day": _with(
        _silver(f"event_date = {CHECK_DAY}"), f"SELECT {SILVER_OUT} FROM silver WHERE is_valid"
    ),
    "stg_events": _with(SILVER, f"SELECT {SILVER_OUT} FROM silver WHERE is_valid"),
    "fact_events": _with(SILVER, f"SELECT {FACT_OUT} FROM ({_FACT} FROM silver WHERE is_valid)"),
    "fact_incremental": _with(FACT, f"SELECT {FACT_OUT} FROM fact"),
    "daily_run_by_day": _with(ARRIVED_FACT, f"SELECT {FACT_OUT} FROM fact"),
    "daily_kpis_by_day": _with(ARRIVED_FACT + _tail(KPIS, FACT), f"SELECT {KPI_COLUMNS} FROM kpis"),
    "users_by_day": _with(ARRIVED_FACT + _tail(USERS, FACT), "SELECT * EXCLUDE (rev) FROM users"),
    "weekly_estimates_by_day": _with(
        ARRIVED_FACT + _tail(KPIS, FACT), "SELECT event_date, wau, TRUE AS estimate_is_close FROM weekly"
    ),
    "future_rows_by_run": _with(ARRIVED_FACT, f"SELECT {FACT_OUT} FROM fact"),
    "time_of_day_mix": _with(
        FACT,
        "SELECT time_of_day, is_weekend, count(*) AS events, count(*) FILTER (is_revenue_event) AS revenue_events"
        " FROM fact GROUP BY time_of_day, is_weekend",
    ),
    "dim_users": _with(USERS, "SELECT * EXCLUDE (rev) FROM users"),
    "user_modes": _with(
        MODES,
        f"SELECT user_id, primary_device, primary_browser, country_top.country, city_top.city"
        f" FROM (SELECT DISTINCT user_id FROM fact) {MODE_JOINS}",
    ),
    "daily_kpis": _with(KPIS, f"SELECT {KPI_COLUMNS} FROM kpis"),
    "daily_kpis_incremental": _with(KPIS, f"SELECT {KPI_COLUMNS} FROM kpis"),
    "wau_approx": _with(KPIS, "SELECT event_date, wau, TRUE AS estimate_is_close FROM weekly"),
    "wau_rolling": _with(KPIS, "SELECT event_date, wau FROM weekly"),
    "funnel_analysis": _with(FUNNEL, "SELECT * FROM funnel"),
    "cohort_activity": _with(COHORTS, "SELECT * FROM activity"),
    "retention": _with(RETENTION, "SELECT * FROM retention"),
    "retention_flags": _with(
        COHORTS,
        f"SELECT user_id, min(cohort_date) AS cohort_date,"
        f" {', '.join(f'bool_or({w}) AS {n}' for n, w in WINDOWS.items())} FROM activity GROUP BY user_id",
    ),
    "cohort_sizes": _with(RETENTION, "SELECT cohort_week, cohort_size FROM retention"),
    "retention_heatmap": _with(
        RETENTION,
        " UNION ALL ".join(
            f"SELECT cohort_week, '{n[:-2].title() if n[-2] == '_' else n[:-3].title()} {n.split('_')[1]}' AS period,"
            f" retention_rate_{n} AS retention_rate FROM retention"
            for n in WINDOWS
            if n != "day_0"
        ),
    ),
    "date_utils": _with(
        FACT,
        f"""SELECT date_day, CAST(date_trunc('week', date_day) AS DATE) AS week_start,
       CAST(date_trunc('month', date_day) AS DATE) AS month_start,
       CAST(date_day - lo AS INTEGER) AS days_since_first, CAST(dayofweek(date_day) AS INTEGER) AS day_of_week,
       dayofweek(date_day) IN (0, 6) AS is_weekend, rpad(dayname(date_day), 9, ' ') AS day_name,
       {_ratio("CAST(date_day - lo AS INTEGER)", "CAST(dayofweek(date_day) AS INTEGER)", 3, 1)} AS ratio
FROM (SELECT lo, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date_day
      FROM (SELECT min(event_date) AS lo, max(event_date) AS hi FROM fact))""",
    ),
    "date_spine_kpis": _with(
        KPIS,
        "SELECT date_day AS event_date, "
        + ", ".join(
            f"coalesce({c}, 0) AS {c}"
            for c in (
                "dau", "daily_sessions", "total_events", "page_views", "clicks", "add_to_carts",
                "purchases", "cashback_events", "refunds", "daily_revenue", "daily_cashback",
                "daily_refunds", "purchasing_users", "products_sold", "mobile_users", "desktop_users",
                "tablet_users", "conversion_rate", "avg_order_value", "revenue_per_user", "wau",
            )
        )
        + f" FROM (SELECT CAST(unnest(generate_series(DATE '2024-01-01', {AS_OF}, INTERVAL 1 DAY)) AS DATE) AS date_day)"
        " LEFT JOIN kpis ON date_day = event_date",
    ),
    "event_type_dimension": _with(
        FACT,
        """SELECT event_type, count(*) AS total_events, count(*) FILTER (is_revenue_event) AS revenue_events,
       CAST(sum(revenue) AS DOUBLE) AS revenue, description, is_revenue_type, CAST(funnel_order AS INTEGER) AS funnel_order
FROM fact JOIN (VALUES
  ('page_view', 'User viewed a page on the platform', false, 1),
  ('click', 'User clicked on a product or link', false, 2),
  ('add_to_cart', 'User added an item to their shopping cart', false, 3),
  ('purchase', 'User completed a purchase transaction', true, 4),
  ('cashback_earned', 'User received cashback reward for a purchase', false, 5),
  ('refund', 'User requested and received a refund', true, 6)
) AS t(event_type, description, is_revenue_type, funnel_order) USING (event_type)
GROUP BY event_type, description, is_revenue_type, funnel_order""",
    ),
    "dq_constraints": _with(
        _ALL_MARTS, f"SELECT *, failures = 0 AS passed FROM ({' UNION ALL '.join(_CONSTRAINTS)})"
    ),
    "dq_checks": _with(
        FLAGGED,
        f"""SELECT check_name, CAST(value AS DOUBLE) AS value, level, passed FROM (
  SELECT count(*) AS c, count(*) FILTER (event_id IS NULL) AS nulls, count(*) FILTER (quality_flags = '') AS good,
         count(event_id) - count(DISTINCT event_id) + count(*) - count(event_id) AS dup
  FROM flagged WHERE event_date = {CHECK_DAY}) t, LATERAL (VALUES
    ('row_count', CAST(c AS DOUBLE), 'report', c > 0),
    ('null_event_ids', CAST(nulls AS DOUBLE), 'fail', nulls = 0),
    ('valid_ratio', {_ratio("good", "c")}, 'report', true),
    ('duplicate_check', CAST(dup AS DOUBLE), 'warn', dup = 0)) v(check_name, value, level, passed)""",
    ),
    "kpi_cards": _with(
        KPIS,
        """SELECT event_date, dau, wau, daily_revenue, daily_cashback, conversion_rate, dau_change, revenue_change FROM (
  SELECT *, coalesce(dau - lag(dau) OVER w, 0) AS dau_change,
         CAST(coalesce(rev - lag(rev) OVER w, 0) AS DOUBLE) / 100 AS revenue_change
  FROM kpis WINDOW w AS (ORDER BY event_date)) ORDER BY event_date DESC LIMIT 1""",
    ),
    "kpi_trends": _with(
        KPIS, "SELECT event_date, dau, wau, daily_revenue, daily_cashback, conversion_rate FROM kpis"
    ),
    "funnel_report": _with(
        FUNNEL,
        """SELECT stage_order, CASE stage_name WHEN 'page_view' THEN 'Page View' WHEN 'click' THEN 'Click'
         WHEN 'add_to_cart' THEN 'Add To Cart' WHEN 'purchase' THEN 'Purchase' ELSE 'Cashback Earned' END AS stage_label,
       unique_users, overall_conversion_rate AS percent_of_initial, step_conversion_rate, dropoff_count FROM funnel""",
    ),
    "user_segments": _shares("user_segment", "segment"),
    "lifecycle_stages": _shares("lifecycle_stage", "stage"),
    "user_summary": _with(
        USERS,
        f"""SELECT total_users, {_cents_ratio("rev", "total_users")} AS avg_revenue,
       {_ratio("buyers", "total_users", 1)} AS buyer_pct, {_ratio("sessions", "total_users", 1, 1)} AS avg_sessions
FROM (SELECT count(*) AS total_users, sum(rev) AS rev, count(*) FILTER (purchases > 0) AS buyers,
             sum(total_sessions) AS sessions FROM users)""",
    ),
    "revenue_histogram": _with(
        USERS,
        """SELECT bin, users, CAST(lo * 50 + (hi - lo) * (bin - 1) AS DOUBLE) / 5000 AS bin_start,
       CAST(lo * 50 + (hi - lo) * bin AS DOUBLE) / 5000 AS bin_end
FROM (SELECT CAST(CASE WHEN hi = lo THEN 1 ELSE least((rev - lo) * 50 // (hi - lo) + 1, 50) END AS INTEGER) AS bin,
             lo, hi, count(*) AS users
      FROM (SELECT rev FROM users WHERE rev > 0),
           (SELECT min(rev) AS lo, max(rev) AS hi FROM users WHERE rev > 0)
      GROUP BY ALL)""",
    ),
    "event_distribution": _with(
        FACT, "SELECT event_type, event_date, count(*) AS event_count FROM fact GROUP BY event_type, event_date"
    ),
    "event_totals": _with(
        FACT, "SELECT event_type, count(*) AS event_count FROM fact GROUP BY event_type"
    ),
    "device_breakdown": _with(
        KPIS,
        """SELECT event_date, device, users FROM (SELECT * FROM kpis ORDER BY event_date DESC LIMIT 1) t,
     LATERAL (VALUES ('Mobile', mobile_users), ('Desktop', desktop_users), ('Tablet', tablet_users)) v(device, users)""",
    ),
}
