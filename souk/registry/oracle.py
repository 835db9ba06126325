"""The same results in DuckDB SQL, written independently of the Spark expressions.

Averages are rounded half up with integer arithmetic on cents, so that both engines agree on the
last digit.
"""

from __future__ import annotations

from souk.registry import reference_time as now

# fixed values in the queries below: event types, accepted states, topics, table names, reason texts and
# the seed products are the wire format and must be spelled as they are
STAMP = "'%Y-%m-%d %H:%M:%S.%f'"

VIEWS = {
    "v_orders": """
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
               c_name AS customer_name, n_name AS city, o_orderpriority AS category,
               CASE o_orderstatus WHEN 'O' THEN 'placed' WHEN 'P' THEN 'processing' ELSE 'cancelled' END AS status,
               CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount, o_orderdate AS ts
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "v_lines": """
        SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_partkey AS product_id, p_name AS product_name,
               p_brand AS brand, p_type AS category, n_name AS city, CAST(l_quantity AS INT) AS quantity,
               CAST(l_extendedprice AS DECIMAL(12,2)) AS total_amount, o_orderdate AS ts, l_returnflag AS flag
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
             JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey""",
    "v_payments": """
        SELECT CAST(event_id AS VARCHAR) AS payment_id, CAST(event_id AS VARCHAR) AS order_id, user_id,
               CAST(value AS DECIMAL(12,2)) AS amount,
               CASE user_id % 5 WHEN 0 THEN 'UPI' WHEN 1 THEN 'Credit Card' WHEN 2 THEN 'Debit Card'
                    WHEN 3 THEN 'Net Banking' ELSE 'COD' END AS method,
               CASE event_type WHEN 'purchase' THEN 'success' ELSE 'failed' END AS status, ts
        FROM events WHERE event_type IN ('purchase', 'error')""",
    "v_deliveries": """
        SELECT l_orderkey || '-' || l_linenumber AS delivery_id, n_name AS city,
               CASE l_returnflag WHEN 'A' THEN 'dispatched' WHEN 'N' THEN 'in_transit'
                    ELSE 'out_for_delivery' END AS status,
               l_linenumber AS estimated_days, CAST(l_quantity AS INT) % 10 AS actual_days, l_shipdate AS ts
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey""",
    "v_event_orders": """
        SELECT CAST(event_id AS VARCHAR) AS order_id, CAST(user_id AS VARCHAR) AS user_id,
               CASE event_id % 4 WHEN 0 THEN 'Electronics' WHEN 1 THEN 'Clothing' WHEN 2 THEN 'Kitchen'
                    ELSE 'Beauty' END AS category,
               CASE user_id % 5 WHEN 0 THEN 'UPI' WHEN 1 THEN 'Credit Card' WHEN 2 THEN 'Debit Card'
                    WHEN 3 THEN 'Net Banking' ELSE 'COD' END AS method,
               CASE user_id % 3 WHEN 0 THEN 'Mumbai' WHEN 1 THEN 'Delhi' ELSE 'Pune' END AS city,
               CASE event_type WHEN 'error' THEN 'cancelled' ELSE 'placed' END AS status,
               CAST(event_id % 4 AS INT) AS quantity, CAST(value AS DECIMAL(12,2)) AS total_amount, ts
        FROM events""",
    "v_raw": """
        SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id,
               CASE event_type WHEN 'purchase' THEN 'order_placed' WHEN 'error' THEN 'payment_failed'
                    WHEN 'signup' THEN 'payment_success' WHEN 'view' THEN 'cart_abandoned' ELSE event_type END AS event_type,
               event_id AS kafka_offset, ts AS ingested_at
        FROM events""",
    # the event messages: every event is one message of one topic
    "v_messages": """
        SELECT event_id AS id, user_id, value, ts, CAST(value AS DECIMAL(12,2)) AS amount,
               CASE event_type WHEN 'purchase' THEN 'order_placed' WHEN 'view' THEN 'cart_abandoned'
                    WHEN 'signup' THEN 'payment_success' WHEN 'error' THEN 'payment_failed'
                    ELSE CASE event_id % 2 WHEN 0 THEN 'order_shipped' ELSE 'order_delivered' END END AS event_type,
               CASE WHEN event_type IN ('purchase', 'view') THEN 'ecom.orders'
                    WHEN event_type IN ('signup', 'error') THEN 'ecom.payments' ELSE 'ecom.deliveries' END AS topic,
               CASE user_id % 3 WHEN 0 THEN 'Mumbai' WHEN 1 THEN 'Delhi' ELSE 'Pune' END AS city,
               CASE event_id % 4 WHEN 0 THEN 'Electronics' WHEN 1 THEN 'Clothing' WHEN 2 THEN 'Kitchen'
                    ELSE 'Beauty' END AS category,
               CASE user_id % 5 WHEN 0 THEN 'UPI' WHEN 1 THEN 'Credit Card' WHEN 2 THEN 'Debit Card'
                    WHEN 3 THEN 'Net Banking' ELSE 'COD' END AS method
        FROM events""",
}


def sql(views: str, body: str, **ctes: str) -> str:
    """``body`` with the named views (and further CTEs) in front."""
    parts = [f"{v} AS ({VIEWS[v]})" for v in views.split()] + [f"{n} AS ({q})" for n, q in ctes.items()]
    return f"WITH {', '.join(parts)} {body}" if parts else body


def half_up(numerator: str, denominator: str, digits: int = 2) -> str:
    """A non-negative fraction of integers, rounded half up to ``digits``."""
    n, d = f"CAST({numerator} AS HUGEINT)", f"CAST({denominator} AS HUGEINT)"
    return f"((2 * {n} * {10 ** digits} + {d}) // (2 * {d})) / {10.0 ** digits}"


def mean(column: str) -> str:
    """Average of a money column."""
    return half_up(f"SUM({column}) * 100", f"COUNT({column}) * 100")


def stamp(expression: str) -> str:
    return f"strftime({expression}, {STAMP})"


def day(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d')"


SUMMARY = f"""
    SELECT COUNT(*) AS total_orders, CAST(COALESCE(SUM(total_amount), 0) AS DOUBLE) AS total_revenue,
           COUNT(DISTINCT customer_id) AS total_customers, COALESCE({mean('total_amount')}, 0.0) AS average_order_value
    FROM v_orders"""

TOP_PRODUCTS = """
    SELECT product_name, CAST(SUM(quantity) AS BIGINT) AS total_quantity, CAST(SUM(total_amount) AS DOUBLE) AS total_revenue
    FROM v_lines {where} GROUP BY product_name ORDER BY total_revenue DESC, product_name LIMIT 10"""

EVENT_DAYS = "SELECT CAST(ts AS DATE) AS d, SUM(total_amount) AS revenue FROM v_event_orders GROUP BY 1"

FILTERED_DAYS = "SELECT CAST(ts AS DATE) AS d, SUM(total_amount) AS revenue FROM v_event_orders WHERE city = 'Delhi' GROUP BY 1"

# the prediction as one exact fraction: last + i * (late/(n-h) - early/h) / h, all in cents
PREDICTION = dict(
    days=EVENT_DAYS,
    placed="SELECT *, row_number() OVER (ORDER BY d) AS pos, COUNT(*) OVER () AS n FROM days",
    halves="""
        SELECT CAST(n AS HUGEINT) AS n, CAST(n // 2 AS HUGEINT) AS h, MAX(d) AS last_day,
               CAST(arg_max(revenue, d) * 100 AS HUGEINT) AS last_rev,
               CAST(SUM(revenue) FILTER (pos <= n // 2) * 100 AS HUGEINT) AS early,
               CAST(SUM(revenue) FILTER (pos > n // 2) * 100 AS HUGEINT) AS late
        FROM placed GROUP BY n HAVING n >= 3""",
    steps="""
        SELECT last_day + CAST(i AS INT) AS d, (n - h) * h * h AS den,
               last_rev * (n - h) * h * h + i * (late * h - early * (n - h)) AS num
        FROM halves, range(1, 8) t(i)""",
    predicted="SELECT d, CASE WHEN num <= 0 THEN 0.0 ELSE ((2 * num + den) // (2 * den)) / 100.0 END AS predicted FROM steps",
)

WEEKS = f"""
    SELECT category, date_trunc('week', ts) AS week, SUM(total_amount) AS revenue, COUNT(*) AS orders
    FROM v_lines WHERE ts >= TIMESTAMP '{now.ORDERS}' - INTERVAL 90 DAY GROUP BY 1, 2"""

GROWTH = dict(
    weeks=WEEKS,
    ends="""
        SELECT category, COUNT(*) AS n, SUM(revenue) AS total, arg_min(revenue, week) AS a, arg_max(revenue, week) AS z
        FROM weeks GROUP BY category HAVING COUNT(*) >= 2""",
)

ACTIVITY = f"""
    SELECT customer_id, customer_name, COUNT(*) AS n, SUM(total_amount) AS spent,
           date_sub('day', MAX(ts), TIMESTAMP '{now.ORDERS}') AS days
    FROM v_orders GROUP BY 1, 2"""

SEGMENTS = f"""
    SELECT *, CASE WHEN n >= 15 AND spent >= 4000000 THEN 'Champion' WHEN n >= 12 AND spent >= 2000000 THEN 'Loyal'
                   WHEN n >= 8 AND days <= 60 THEN 'Promising' WHEN n = 6 AND days <= 400 THEN 'New'
                   WHEN days > 120 THEN 'At Risk' ELSE 'Regular' END AS segment
    FROM (SELECT customer_id, COUNT(*) AS n, SUM(total_amount) AS spent, MAX(ts) AS last_ts,
                 {mean('total_amount')} AS avg_spent, date_sub('day', MAX(ts), TIMESTAMP '{now.SEGMENTS}') AS days
          FROM v_orders GROUP BY 1)"""


SEGMENTS_OUT = f"""
    SELECT customer_id, n AS total_orders, CAST(spent AS DOUBLE) AS total_spent, avg_spent AS avg_order_value,
           {stamp('last_ts')} AS last_order_date, days AS days_since_last_order, segment FROM segments"""


def daily_gold(rows: str) -> str:
    return f"""
        SELECT CAST(ts AS DATE) AS d, SUM(total_amount) AS revenue, COUNT(*) AS n, COUNT(DISTINCT user_id) AS users,
               {mean('total_amount')} AS aov, mode(category ORDER BY category) AS top
        FROM v_event_orders {rows} GROUP BY 1"""


GOLD_OUT = f"""SELECT {day('d')} AS date_bucket, CAST(revenue AS DOUBLE) AS total_revenue, n AS order_count,
                      users AS unique_customers, aov AS avg_order_value, top AS top_category"""


def sales(period: str) -> dict[str, str]:
    """Orders, payments and most frequent names per period."""

    def top(column: str) -> str:
        return f"""
            SELECT p, {column} AS name FROM (
                SELECT {period} AS p, {column}, row_number() OVER (PARTITION BY {period} ORDER BY COUNT(*) DESC, {column}) AS r
                FROM v_event_orders GROUP BY 1, 2) WHERE r = 1"""

    return dict(
        sold=f"SELECT {period} AS p, COUNT(*) AS n, SUM(total_amount) AS revenue FROM v_event_orders GROUP BY 1",
        best=top("category"),
        place=top("city"),
        paid=f"""SELECT {period} AS p, COUNT(*) FILTER (status = 'success') AS ok,
                        COUNT(*) FILTER (status = 'failed') AS bad FROM v_payments GROUP BY 1""",
        report="""
            SELECT p, COALESCE(n, 0) AS n, COALESCE(revenue, 0) AS revenue, COALESCE(ok, 0) AS ok, COALESCE(bad, 0) AS bad,
                   COALESCE(best.name, 'N/A') AS product, COALESCE(place.name, 'N/A') AS city
            FROM sold FULL JOIN paid USING (p) LEFT JOIN best USING (p) LEFT JOIN place USING (p)""",
    )


DAILY_SALES = f"""
    SELECT {day('p')} AS summary_date, n AS total_orders, CAST(revenue AS DOUBLE) AS total_revenue,
           CASE WHEN n = 0 THEN 0.0 ELSE {half_up('revenue * 100', 'GREATEST(n, 1) * 100')} END AS avg_order_value,
           product AS top_product, city AS top_city, ok AS successful_payments, bad AS failed_payments
    FROM report"""

ANALYSIS = f"""
    SELECT CAST(ts AS DATE) AS d, city, COUNT(*) AS n, COUNT(*) FILTER (status = 'dispatched') AS a,
           COUNT(*) FILTER (status = 'in_transit') AS b, COUNT(*) FILTER (status = 'out_for_delivery') AS c,
           {half_up('SUM(estimated_days)', 'COUNT(*)')} AS avg_days,
           COUNT(*) FILTER (estimated_days <= 2) AS fast, COUNT(*) FILTER (estimated_days >= 6) AS slow
    FROM v_deliveries GROUP BY 1, 2"""

# cents: total of the seven days before, actual; prediction = total * 105 / (100 * days)
FORECAST = dict(
    days=EVENT_DAYS,
    stats="""
        SELECT d, CAST(revenue * 100 AS HUGEINT) AS actual, CAST(COALESCE(SUM(revenue) OVER w, 0) * 100 AS HUGEINT) AS total,
               CAST(GREATEST(COUNT(revenue) OVER w, 1) AS HUGEINT) AS k, COALESCE(stddev_samp(revenue) OVER w, 0) AS sd
        FROM days WINDOW w AS (ORDER BY d RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING)""",
)
FORECAST_OUT = f"""
    SELECT {day('d')} AS forecast_date, {half_up('total * 105', 'k * 10000')} AS predicted_revenue,
           {half_up('total', 'k * 100')} AS avg_last_7_days, CAST(CAST(sd AS DECIMAL(22,2)) AS DOUBLE) AS std_revenue,
           actual / 100.0 AS actual_revenue,
           CASE WHEN actual > 0 THEN
               (10000 - (2 * 100 * ABS(total * 105 - actual * k * 100) + actual * k) // (2 * actual * k)) / 100.0
           ELSE 0.0 END AS accuracy_pct
    FROM stats"""

GRADE = """CASE WHEN failed = 0 THEN 'passed' WHEN failed * 100 < 5 * GREATEST(checked, 1) THEN 'warning'
                ELSE 'failed' END"""
LOG = """SELECT 'check' AS run_id, layer, table_name, check_name, status, CAST(checked AS BIGINT) AS records_checked,
                CAST(failed AS BIGINT) AS records_failed FROM log"""


def graded(layer: str, table: str, checks: dict[str, str], source: str, total: str = "COUNT(*)") -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{name}' AS check_name, {total} AS checked, {failed} AS failed FROM {source}"
        for name, failed in checks.items()
    )
    return f"SELECT '{layer}' AS layer, '{table}' AS table_name, check_name, {GRADE} AS status, checked, failed FROM ({rows})"


KNOWN_TYPES = """('order_placed', 'payment_success', 'payment_failed', 'order_shipped', 'order_delivered',
                  'order_cancelled', 'cart_abandoned')"""
SIX_HOURS = f"TIMESTAMP '{now.EVENTS}' - INTERVAL 6 HOUR"
FRESH = f"""
    SELECT 'bronze' AS layer, 'raw_events' AS table_name, 'data_freshness_30min' AS check_name,
           CASE WHEN COUNT(*) > 0 THEN 'passed' ELSE 'warning' END AS status, COUNT(*) AS checked, 0 AS failed
    FROM v_raw WHERE ingested_at >= TIMESTAMP '{now.EVENTS}' - INTERVAL 30 MINUTE"""
BRONZE_LOG = graded(
    "bronze",
    "raw_events",
    {
        "no_null_event_ids": "COUNT(*) FILTER (event_id IS NULL)",
        "no_null_event_types": "COUNT(*) FILTER (event_type IS NULL)",
        "valid_event_types": f"COUNT(*) FILTER (event_type NOT IN {KNOWN_TYPES})",
    },
    f"(SELECT * FROM v_raw WHERE ingested_at >= {SIX_HOURS})",
) + f" UNION ALL {FRESH}"
RECENT_ORDERS = f"(SELECT * FROM v_event_orders WHERE ts >= {SIX_HOURS})"
ORDER_LOG = (
    graded(
        "silver",
        "orders",
        {
            "no_null_user_id": "COUNT(*) FILTER (user_id IS NULL)",
            "no_negative_amounts": "COUNT(*) FILTER (total_amount < 0)",
            "valid_quantity": "COUNT(*) FILTER (quantity <= 0)",
            "no_future_timestamps": f"COUNT(*) FILTER (ts > TIMESTAMP '{now.EVENTS}')",
        },
        RECENT_ORDERS,
    )
    + " UNION ALL "
    + graded(
        "silver",
        "orders",
        {"no_duplicate_order_ids": "COUNT(*) FILTER (n > 1)"},
        f"(SELECT order_id, COUNT(*) AS n FROM {RECENT_ORDERS} GROUP BY 1)",
    )
)
PAYMENT_LOG = f"""
    SELECT 'silver' AS layer, 'payments' AS table_name, 'payment_failure_rate_check' AS check_name,
           CASE WHEN checked = 0 OR failed * 100 < 30 * checked THEN 'passed' WHEN failed * 100 < 50 * checked THEN 'warning'
                ELSE 'failed' END AS status, checked, failed
    FROM (SELECT COUNT(*) AS checked, COUNT(*) FILTER (status = 'failed') AS failed FROM v_payments WHERE ts >= {SIX_HOURS})"""

ORDER_REASON = """CASE WHEN total_amount <= 0 THEN 'Invalid price — must be > 0'
                       WHEN status NOT IN ('placed', 'confirmed', 'processing') THEN 'Invalid status: ' || status END"""
PAYMENT_REASON = "CASE WHEN amount <= 0 THEN 'Invalid amount — must be > 0' END"
DELIVERY_REASON = "CASE WHEN actual_days <= 0 THEN 'Invalid estimated_days — must be > 0' END"


def refused(view: str, topic: str, key: str, reason: str) -> str:
    return f"""SELECT '{topic}' AS topic, {key}, {reason} AS rejection_reason FROM {view}
               WHERE {reason} IS NOT NULL"""


POSITION = 'CAST(id % 3 AS BIGINT) AS "partition", id AS "offset"'
SILVER_DELIVERY = f"""
    SELECT 'DEL-' || (id // 2) AS delivery_id, 'ORD-' || id AS order_id, 'USR-' || user_id AS user_id,
           CASE id % 2 WHEN 0 THEN 'shipped' ELSE 'delivered' END AS delivery_status, city,
           CAST(id % 5 + 2 AS BIGINT) AS estimated_days, CAST(id % 7 + 1 AS BIGINT) AS actual_days,
           (id % 7 + 1) > (id % 5 + 2) AS is_delayed, {stamp('ts')} AS event_time, {POSITION}
    FROM v_messages WHERE topic = 'ecom.deliveries'"""
SILVER_ORDER_ROWS = "event_type = 'order_placed' AND value > 0 AND id % 4 > 0"
BY_DAY = f"{day('ts')} AS event_date, COUNT(*) AS records"

LINE_KEYS = "order_id, line_no"
LINE_OUT = f"SELECT {LINE_KEYS}, product_id, quantity, CAST(total_amount AS DOUBLE) AS total_amount"
LINE_RANK = "total_amount, product_id, quantity"

# the purchase that the replayed streams deliver last, behind the watermark
ON_TIME = """id <> (SELECT event_id FROM events WHERE event_type = 'purchase' ORDER BY ts, event_id LIMIT 1)"""
CANCELLED_LATER = "event_type = 'order_placed' AND id % 5 = 0"
DELAYED = """COUNT(*) FILTER (actual_days > estimated_days)"""

HOURLY = f"""
    SELECT {stamp("date_trunc('hour', ts)")} AS hour_bucket, category AS product_category,
           CAST(SUM(total_amount) AS DOUBLE) AS total_revenue, COUNT(*) AS order_count,
           {mean('total_amount')} AS avg_order_value
    FROM v_event_orders WHERE status <> 'cancelled' {{period}} GROUP BY date_trunc('hour', ts), category"""
FAILURES = f"""
    SELECT {stamp("date_trunc('hour', ts)")} AS hour_bucket, method AS payment_method, COUNT(*) AS total_attempts,
           COUNT(*) FILTER (status = 'failed') AS failed_count,
           {half_up("100 * COUNT(*) FILTER (status = 'failed')", 'COUNT(*)')} AS failure_rate
    FROM v_payments {{period}} GROUP BY date_trunc('hour', ts), method"""
THROUGHPUT = f"""
    SELECT {stamp("date_trunc('minute', ts)")} AS slot_start, topic, COUNT(*) AS messages
    FROM v_messages GROUP BY date_trunc('minute', ts), topic"""
REFRESHED = (
    f"ts >= date_trunc('hour', TIMESTAMP '{now.REFRESHES[0]}' - INTERVAL 48 HOUR) AND ts <= TIMESTAMP '{now.REFRESHES[1]}'"
)
TWO_DAYS = f"ts >= TIMESTAMP '{now.EVENTS}' - INTERVAL 48 HOUR"

ORACLE: dict[str, str] = {
    # dashboard
    "summary": sql("v_orders", SUMMARY),
    "summary_filtered": sql(
        "v_orders",
        SUMMARY + """ WHERE city = 'NATION_7' AND category = '2-HIGH' AND ts >= TIMESTAMP '1996-01-01'
                      AND ts <= TIMESTAMP '2000-12-31'""",
    ),
    "summary_last_30d": sql(
        "v_orders", SUMMARY + " WHERE ts >= TIMESTAMP '2001-07-03' AND ts < TIMESTAMP '2001-08-03'"
    ),
    "revenue_by_city": sql("v_orders", "SELECT city, CAST(SUM(total_amount) AS DOUBLE) AS revenue FROM v_orders GROUP BY city"),
    "top_cities": sql(
        "v_orders",
        """SELECT city, CAST(SUM(total_amount) AS DOUBLE) AS revenue FROM v_orders GROUP BY city
           ORDER BY revenue DESC, city LIMIT 10""",
    ),
    "category_sales": sql(
        "v_orders", "SELECT category, CAST(SUM(total_amount) AS DOUBLE) AS sales FROM v_orders GROUP BY category"
    ),
    "order_status": sql("v_orders", 'SELECT status, COUNT(*) AS "count" FROM v_orders GROUP BY status'),
    "monthly_revenue": sql(
        "v_orders",
        "SELECT strftime(ts, '%Y-%m') AS month, CAST(SUM(total_amount) AS DOUBLE) AS revenue FROM v_orders GROUP BY 1",
    ),
    "top_products": sql("v_lines", TOP_PRODUCTS.format(where="")),
    "product_name_contains": sql("v_lines", TOP_PRODUCTS.format(where="WHERE contains(lower(product_name), 'red')")),
    "revenue_by_city_in_order": sql(
        "v_orders",
        """SELECT city, CAST(SUM(total_amount) AS DOUBLE) AS revenue,
                  row_number() OVER (ORDER BY SUM(total_amount) DESC, city) AS place FROM v_orders GROUP BY city""",
    ),
    "top_products_in_order": sql(
        "v_lines",
        f"""SELECT *, row_number() OVER (ORDER BY total_revenue DESC, product_name) AS place
            FROM ({TOP_PRODUCTS.format(where='')})""",
    ),
    "top_products_share": sql(
        "v_lines",
        f"""SELECT row_number() OVER (ORDER BY total_revenue DESC, product_name) AS rank, product_name, total_quantity,
                   total_revenue, CAST(floor(100 * total_revenue / MAX(total_revenue) OVER () + 0.5) AS BIGINT) AS share_pct
            FROM ({TOP_PRODUCTS.format(where='')})""",
    ),
    "filter_options": sql(
        "v_orders",
        """SELECT DISTINCT 'city' AS kind, city AS value FROM v_orders
           UNION ALL SELECT DISTINCT 'category', category FROM v_orders""",
    ),
    "daily_revenue_series": sql(
        "v_orders",
        f"""SELECT {day('ts')} AS day, CAST(SUM(total_amount) AS DOUBLE) AS revenue FROM v_orders
            WHERE ts >= TIMESTAMP '{now.ORDERS}' - INTERVAL 90 DAY GROUP BY 1""",
    ),
    "sales_prediction": sql("v_event_orders", f"SELECT {day('d')} AS day, predicted FROM predicted", **PREDICTION),
    "sales_prediction_filtered": sql(
        "v_event_orders", f"SELECT {day('d')} AS day, predicted FROM predicted", **{**PREDICTION, "days": FILTERED_DAYS}
    ),
    "forecast_series": sql(
        "v_event_orders",
        f"""SELECT {day('d')} AS day, CAST(revenue AS DOUBLE) AS revenue, CAST(NULL AS DOUBLE) AS predicted FROM days
            UNION ALL SELECT {day('d')}, NULL, predicted FROM predicted""",
        **PREDICTION,
    ),
    "weekly_category_revenue": sql(
        "v_lines",
        f"SELECT category, {stamp('week')} AS week, CAST(revenue AS DOUBLE) AS revenue, orders FROM weeks",
        weeks=WEEKS,
    ),
    "category_forecast": sql(
        "v_lines",
        f"""SELECT category, CAST(total AS DOUBLE) AS total_revenue,
                   CASE WHEN a > 0 THEN sign(z - a) * {half_up('ABS(z - a) * 10000', 'a * 100', 1)} ELSE 0.0 END AS growth_pct,
                   CASE WHEN a > 0 AND (z - a) * 100 > 5 * a THEN 'rising' WHEN a > 0 AND (z - a) * 100 < -5 * a THEN 'falling'
                        ELSE 'stable' END AS trend FROM ends""",
        **GROWTH,
    ),
    "category_forecast_filtered": sql(
        "v_lines",
        f"""SELECT category, CAST(total AS DOUBLE) AS total_revenue,
                   CASE WHEN a > 0 THEN sign(z - a) * {half_up('ABS(z - a) * 10000', 'a * 100', 1)} ELSE 0.0 END AS growth_pct,
                   CASE WHEN a > 0 AND (z - a) * 100 > 5 * a THEN 'rising' WHEN a > 0 AND (z - a) * 100 < -5 * a THEN 'falling'
                        ELSE 'stable' END AS trend FROM ends""",
        **{**GROWTH, "weeks": WEEKS.replace("GROUP BY", "AND city = 'NATION_7' AND ts >= TIMESTAMP '2000-01-01' GROUP BY")},
    ),
    "category_weekly_nested": sql(
        "v_lines",
        f"""SELECT category, string_agg({day('week')} || '/' || CAST(revenue AS VARCHAR) || '/' || orders, ' ' ORDER BY week) AS weeks
            FROM weeks GROUP BY category HAVING COUNT(*) >= 2""",
        weeks=WEEKS,
    ),
    "inventory_alert": sql(
        "v_lines",
        f"""SELECT product_name, 'brand' AS category, total_sold, n AS order_count, avg_qty_per_order, last_ordered, total_revenue,
                   velocity AS velocity_per_day,
                   CASE WHEN velocity > 2 THEN 'critical' WHEN velocity > 1 THEN 'high' WHEN velocity > 0.5 THEN 'medium'
                        ELSE 'low' END AS risk_level
            FROM (SELECT brand AS product_name, CAST(SUM(quantity) AS BIGINT) AS total_sold, COUNT(*) AS n,
                         {half_up('SUM(quantity)', 'COUNT(*)', 1)} AS avg_qty_per_order, {day('MAX(ts)')} AS last_ordered,
                         CAST(SUM(total_amount) AS DOUBLE) AS total_revenue, {half_up('COUNT(*)', '90')} AS velocity
                  FROM v_lines WHERE ts >= TIMESTAMP '{now.ORDERS}' - INTERVAL 90 DAY GROUP BY brand)
            ORDER BY total_sold DESC, product_name LIMIT 15""",
    ),
    "churn_summary": sql(
        "v_orders",
        """SELECT COUNT(*) FILTER (days <= 10) AS active, COUNT(*) FILTER (days > 10 AND days <= 30) AS at_risk,
                  COUNT(*) FILTER (days > 30) AS churned, COUNT(*) AS total FROM activity""",
        activity=ACTIVITY,
    ),
    "churn_summary_filtered": sql(
        "v_orders",
        """SELECT COUNT(*) FILTER (days <= 10) AS active, COUNT(*) FILTER (days > 10 AND days <= 30) AS at_risk,
                  COUNT(*) FILTER (days > 30) AS churned, COUNT(*) AS total FROM activity""",
        activity=ACTIVITY.replace("GROUP BY", "WHERE city = 'NATION_7' GROUP BY"),
    ),
    "churn_high_value": sql(
        "v_orders",
        """SELECT customer_id, customer_name, n AS total_orders, days AS days_since_last, CAST(spent AS DOUBLE) AS total_spent,
                  'high' AS risk
           FROM activity WHERE days > 30 AND spent > 50000 ORDER BY spent DESC, customer_id, customer_name LIMIT 10""",
        activity=ACTIVITY,
    ),
    # gold
    "hourly_revenue": sql("v_event_orders", HOURLY.format(period=f"AND {TWO_DAYS}")),
    "gold_daily_revenue": sql("v_event_orders", f"{GOLD_OUT} FROM gold", gold=daily_gold("WHERE status <> 'cancelled'")),
    "gold_revenue_by_city": sql(
        "v_event_orders",
        f"""SELECT {day('ts')} AS date_bucket, city, CAST(SUM(total_amount) AS DOUBLE) AS total_revenue, COUNT(*) AS order_count
            FROM v_event_orders WHERE status <> 'cancelled' GROUP BY 1, 2""",
    ),
    "payment_failure_metrics": sql("v_payments", FAILURES.format(period=f"WHERE {TWO_DAYS}")),
    "payment_failure_history": sql("v_payments", FAILURES.format(period="")),
    "delayed_shipments": sql(
        "v_deliveries",
        f"""SELECT {day('ts')} AS date_bucket, city, COUNT(*) FILTER (actual_days > estimated_days) AS delayed_count,
                   COUNT(*) AS total_shipments,
                   {half_up('100 * COUNT(*) FILTER (actual_days > estimated_days)', 'COUNT(*)')} AS delay_rate
            FROM v_deliveries GROUP BY 1, 2""",
    ),
    "customer_metrics": sql(
        "v_event_orders",
        f"""SELECT user_id, COUNT(*) AS total_orders, CAST(SUM(total_amount) AS DOUBLE) AS total_spend,
                   {mean('total_amount')} AS avg_order_value, {day('MIN(ts)')} AS first_order_date, {day('MAX(ts)')} AS last_order_date,
                   date_diff('day', CAST(MAX(ts) AS DATE), DATE '{now.EVENTS}') AS days_since_last_order,
                   mode(category ORDER BY category) AS favourite_category, mode(method ORDER BY method) AS favourite_payment,
                   date_diff('day', CAST(MAX(ts) AS DATE), DATE '{now.EVENTS}') > 30 AS churn_risk_flag
            FROM v_event_orders WHERE status <> 'cancelled' GROUP BY user_id""",
    ),
    "refresh_customer_metrics": sql(
        "v_event_orders",
        f"""SELECT user_id, COUNT(*) AS total_orders, CAST(SUM(total_amount) AS DOUBLE) AS total_spend,
                   {mean('total_amount')} AS avg_order_value, {day('MIN(ts)')} AS first_order_date, {day('MAX(ts)')} AS last_order_date,
                   date_diff('day', CAST(MAX(ts) AS DATE), DATE '{now.EVENTS}') AS days_since_last_order,
                   mode(category ORDER BY category) AS favourite_category, mode(method ORDER BY method) AS favourite_payment,
                   date_diff('day', CAST(MAX(ts) AS DATE), DATE '{now.EVENTS}') > 30 AS churn_risk_flag
            FROM v_event_orders WHERE status <> 'cancelled' GROUP BY user_id""",
    ),
    "churn_risk_count": sql(
        "v_orders",
        f"""SELECT COUNT(*) AS churn_risk_customers FROM (
                SELECT customer_id FROM v_orders WHERE status <> 'cancelled' GROUP BY 1
                HAVING date_diff('day', CAST(MAX(ts) AS DATE), DATE '{now.ORDERS}') > 30)""",
    ),
    # scheduled jobs
    "customer_segments": sql("v_orders", SEGMENTS_OUT, segments=SEGMENTS),
    "segment_summary_in_order": sql(
        "v_orders",
        f"""SELECT segment, COUNT(*) AS customers, {half_up('SUM(spent) * 100', 'COUNT(*) * 100')} AS avg_spent,
                   CAST(SUM(spent) AS DOUBLE) AS total_revenue, row_number() OVER (ORDER BY SUM(spent) DESC, segment) AS place
            FROM segments GROUP BY segment""",
        segments=SEGMENTS,
    ),
    "segment_summary": sql(
        "v_orders",
        f"""SELECT segment, COUNT(*) AS customers, {half_up('SUM(spent) * 100', 'COUNT(*) * 100')} AS avg_spent,
                   CAST(SUM(spent) AS DOUBLE) AS total_revenue FROM segments GROUP BY segment""",
        segments=SEGMENTS,
    ),
    "segmented_customers": sql("v_orders", "SELECT COUNT(DISTINCT customer_id) AS total_customers FROM v_orders"),
    "daily_sales_summary": sql("v_event_orders v_payments", DAILY_SALES, **sales("CAST(ts AS DATE)")),
    "daily_sales_one_day": sql(
        "v_event_orders v_payments", DAILY_SALES + " WHERE p = DATE '2024-01-15'", **sales("CAST(ts AS DATE)")
    ),
    "hourly_stats": sql(
        "v_event_orders v_payments",
        f"""SELECT {day('p')} AS stat_date, CAST(hour(p) AS BIGINT) AS stat_hour, n AS total_orders,
                   CAST(revenue AS DOUBLE) AS total_revenue, ok AS successful_payments, bad AS failed_payments,
                   product AS top_product, city AS top_city FROM report""",
        **sales("date_trunc('hour', ts)"),
    ),
    "delivery_analysis": sql(
        "v_deliveries",
        f"""SELECT {day('d')} AS analysis_date, city, n AS total_deliveries, a AS dispatched_count, b AS in_transit_count,
                   c AS out_for_delivery_count, avg_days AS avg_estimated_days, fast AS fast_deliveries, slow AS slow_deliveries
            FROM analysis""",
        analysis=ANALYSIS,
    ),
    "delivery_insights": sql(
        "v_deliveries",
        f"""SELECT {day('d')} AS analysis_date, MAX(city) FILTER (f = 1) AS fastest_city, MAX(avg_days) FILTER (f = 1) AS fastest_avg_days,
                   MAX(city) FILTER (s = 1) AS slowest_city, MAX(avg_days) FILTER (s = 1) AS slowest_avg_days,
                   CAST(SUM(n) AS BIGINT) AS total_deliveries, CAST(SUM(fast) AS BIGINT) AS fast_deliveries,
                   CAST(SUM(slow) AS BIGINT) AS slow_deliveries,
                   {half_up('SUM(CAST(round(avg_days * 100) AS BIGINT))', 'COUNT(*) * 100')} AS overall_avg_days
            FROM (SELECT *, row_number() OVER (PARTITION BY d ORDER BY avg_days, city) AS f,
                         row_number() OVER (PARTITION BY d ORDER BY avg_days DESC, city) AS s FROM analysis)
            GROUP BY d""",
        analysis=ANALYSIS,
    ),
    "revenue_forecast": sql("v_event_orders", FORECAST_OUT, **FORECAST),
    "revenue_forecast_next_day": sql(
        "v_event_orders",
        FORECAST_OUT,
        days=EVENT_DAYS,
        stats=f"""SELECT DATE '{now.EVENTS}' AS d, CAST(0 AS HUGEINT) AS actual, CAST(COALESCE(SUM(revenue), 0) * 100 AS HUGEINT) AS total,
                         CAST(GREATEST(COUNT(*), 1) AS HUGEINT) AS k, COALESCE(stddev_samp(revenue), 0) AS sd
                  FROM days WHERE d >= DATE '{now.EVENTS}' - INTERVAL 7 DAY AND d < DATE '{now.EVENTS}'""",
    ),
    "forecast_report": sql(
        "v_event_orders",
        """SELECT forecast_date, predicted_revenue AS predicted, actual_revenue AS actual,
                  round(ABS(predicted_revenue - actual_revenue), 2) AS difference
           FROM forecast ORDER BY forecast_date DESC LIMIT 7""",
        **FORECAST,
        forecast=FORECAST_OUT,
    ),
    # events to tables
    "parse_payload": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
    "route_event_types": sql(
        "v_raw",
        """SELECT CASE WHEN event_type IN ('order_placed', 'cart_abandoned') THEN 'ecom.orders'
                       WHEN event_type IN ('payment_success', 'payment_failed') THEN 'ecom.payments' ELSE 'none' END AS route,
                  event_type, COUNT(*) AS events FROM v_raw GROUP BY 1, 2""",
    ),
    "bronze_events": sql(
        "v_messages",
        f"""SELECT 'EVT-' || id AS event_id, event_type, topic AS kafka_topic, CAST(id % 3 AS BIGINT) AS kafka_partition,
                   id AS kafka_offset, {stamp('ts')} AS event_time, 'USR-' || user_id AS payload_user FROM v_messages""",
    ),
    "silver_orders": sql(
        "v_messages",
        f"""SELECT 'ORD-' || id AS order_id, 'EVT-' || id AS event_id, 'USR-' || user_id AS user_id, 'PROD-' || (id % 4) AS product_id,
                   category AS product_category, CAST(id % 4 AS BIGINT) AS quantity, CAST(amount AS DOUBLE) AS unit_price,
                   CAST(amount AS DOUBLE) AS total_amount, method AS payment_method, city, 'placed' AS order_status,
                   {stamp('ts')} AS event_time, TRUE AS is_valid, {POSITION}
            FROM v_messages WHERE {SILVER_ORDER_ROWS}""",
    ),
    "silver_payments": sql(
        "v_messages",
        f"""SELECT 'PAY-' || id AS payment_id, 'ORD-' || id AS order_id, 'USR-' || user_id AS user_id,
                   CAST(amount AS DOUBLE) AS amount, method AS payment_method,
                   CASE event_type WHEN 'payment_success' THEN 'success' ELSE 'failed' END AS payment_status,
                   {stamp('ts')} AS event_time, {POSITION}
            FROM v_messages WHERE topic = 'ecom.payments'""",
    ),
    "silver_deliveries": sql("v_messages", SILVER_DELIVERY),
    "current_deliveries": sql(
        "v_messages",
        """SELECT * EXCLUDE (r) FROM (
               SELECT *, row_number() OVER (PARTITION BY delivery_id ORDER BY event_time DESC) AS r FROM moved) WHERE r = 1""",
        moved=SILVER_DELIVERY,
    ),
    "refused_events": sql(
        "v_messages",
        """SELECT topic, 'EVT-' || id AS event_id, 'quantity violates quantity > 0' AS rejection_reason
           FROM v_messages WHERE event_type = 'order_placed' AND value > 0 AND id % 4 = 0""",
    ),
    "encode_events": sql(
        "v_raw",
        """SELECT CASE WHEN event_type IN ('order_placed', 'cart_abandoned') THEN 'ecom.orders'
                       WHEN event_type IN ('payment_success', 'payment_failed') THEN 'ecom.payments' ELSE 'none' END AS topic,
                  user_id AS key,
                  '{"event_id":"' || event_id || '","event_type":"' || event_type || '","user_id":"' || user_id
                      || '","kafka_offset":' || kafka_offset || '}' AS value
           FROM v_raw""",
    ),
    "schema_contract": sql(
        "v_event_orders",
        f"""SELECT order_id, order_id AS event_id, user_id, 'PROD-' || quantity AS product_id, category AS product_category,
                   CAST(quantity AS BIGINT) AS quantity, CAST(total_amount AS DOUBLE) AS unit_price,
                   CAST(total_amount AS DOUBLE) AS total_amount, method AS payment_method, city, 'placed' AS order_status,
                   {stamp('ts')} AS event_time, {stamp('ts')} AS processed_at, TRUE AS is_valid, {day('ts')} AS event_date
            FROM v_event_orders""",
    ),
    "product_dim": """
        SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name, p_type AS category,
               CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS DOUBLE) AS base_price FROM part
        UNION ALL SELECT * FROM (VALUES
            ('PROD-001', 'Samsung Galaxy S24', 'Electronics', 55000.0::DOUBLE), ('PROD-002', 'Apple AirPods Pro', 'Electronics', 22000.0),
            ('PROD-003', 'Nike Air Max 270', 'Footwear', 8500.0), ('PROD-004', 'Adidas Running T-Shirt', 'Clothing', 1299.0),
            ('PROD-005', 'Prestige Pressure Cooker', 'Kitchen', 2500.0), ('PROD-006', 'boAt Rockerz 450', 'Electronics', 1999.0),
            ('PROD-007', 'Levi Jeans 511', 'Clothing', 3499.0), ('PROD-008', 'Instant Pot Duo', 'Kitchen', 7500.0),
            ('PROD-009', 'Puma Sports Shoes', 'Footwear', 4500.0), ('PROD-010', 'Himalaya Face Wash', 'Beauty', 299.0),
            ('PROD-011', 'Kindle Paperwhite', 'Electronics', 14000.0), ('PROD-012', 'Wildcraft Backpack 45L', 'Accessories', 3200.0))""",
    "dedupe_first": sql(
        "v_lines",
        f"""{LINE_OUT} FROM (SELECT *, row_number() OVER (PARTITION BY {LINE_KEYS} ORDER BY {LINE_RANK}) AS r FROM v_lines)
            WHERE r = 1""",
    ),
    "insert_ignore_orders": sql(
        "v_lines",
        f"""{LINE_OUT} FROM (
                SELECT *, row_number() OVER (PARTITION BY {LINE_KEYS}
                                             ORDER BY CASE flag WHEN 'R' THEN 0 ELSE 1 END, {LINE_RANK}) AS r FROM v_lines)
            WHERE r = 1""",
    ),
    "upsert_daily_revenue": sql(
        "v_event_orders",
        f"""{GOLD_OUT} FROM (SELECT * FROM everything WHERE d < DATE '2024-01-16'
                             UNION ALL SELECT * FROM corrected WHERE d >= DATE '2024-01-16')""",
        everything=daily_gold(""),
        corrected=daily_gold("WHERE status <> 'cancelled'"),
    ),
    # writes that are repeated
    "insert_ignore_across_days": sql(
        "v_messages",
        f"""SELECT 'bronze.raw_events' AS table_name, 'EVT-' || id AS id, {stamp('ts')} AS event_time FROM v_messages
            UNION ALL SELECT 'silver.orders', 'ORD-' || id, {stamp('ts')} FROM v_messages WHERE {SILVER_ORDER_ROWS}
            UNION ALL SELECT 'silver.payments', 'PAY-' || id, {stamp('ts')} FROM v_messages WHERE topic = 'ecom.payments'""",
    ),
    "message_outcomes": sql(
        "v_messages",
        """SELECT id, CASE WHEN id % 50 = 7 THEN 'event_id is null'
                           WHEN event_type = 'order_placed' AND id % 50 = 8 THEN 'Invalid total_amount — not a decimal(12,2)'
                           WHEN event_type = 'order_placed' AND value > 0 AND id % 4 = 0 THEN 'quantity violates quantity > 0'
                           WHEN event_type = 'order_placed' AND value > 0 OR topic <> 'ecom.orders' THEN 'stored'
                           ELSE 'raw' END AS outcome FROM v_messages""",
    ),
    "refresh_hourly_revenue": sql("v_event_orders", HOURLY.format(period=f"AND {REFRESHED}")),
    "refresh_payment_failures": sql("v_payments", FAILURES.format(period=f"WHERE {REFRESHED}")),
    "refresh_delayed_shipments": sql(
        "v_messages",
        f"""SELECT strftime(CAST(event_time AS TIMESTAMP), '%Y-%m-%d') AS date_bucket, city, {DELAYED} AS delayed_count,
                   COUNT(*) AS total_shipments, {half_up(f'100 * {DELAYED}', 'COUNT(*)')} AS delay_rate
            FROM (SELECT *, row_number() OVER (PARTITION BY delivery_id ORDER BY event_time DESC, delivery_status) AS r FROM moved)
            WHERE r = 1 GROUP BY 1, 2""",
        moved=f"{SILVER_DELIVERY} AND ts <= TIMESTAMP '{now.REFRESHES[1]}'",
    ),
    "refresh_city_revenue": sql(
        "v_event_orders",
        f"""SELECT {day('ts')} AS date_bucket, city, CAST(SUM(total_amount) AS DOUBLE) AS total_revenue, COUNT(*) AS order_count
            FROM v_event_orders WHERE ts < DATE '2024-01-16' OR status <> 'cancelled' GROUP BY 1, 2""",
    ),
    "refresh_segments": sql("v_orders", SEGMENTS_OUT, segments=SEGMENTS),
    "gold_with_cancellations": sql(
        "v_messages",
        f"""SELECT {day('CAST(ts AS DATE)')} AS date_bucket, CAST(SUM(amount) AS DOUBLE) AS total_revenue, COUNT(*) AS order_count,
                   COUNT(DISTINCT user_id) AS unique_customers, {mean('amount')} AS avg_order_value,
                   mode(category ORDER BY category) AS top_category
            FROM v_messages WHERE {SILVER_ORDER_ROWS} AND NOT ({CANCELLED_LATER}) GROUP BY CAST(ts AS DATE)""",
    ),
    # validation
    "validated_orders": sql(
        "v_orders",
        f"""SELECT order_id, customer_id, CAST(total_amount AS DOUBLE) AS total_amount, status FROM v_orders
            WHERE {ORDER_REASON} IS NULL""",
    ),
    "validated_payments": sql(
        "v_payments",
        f"SELECT payment_id, CAST(amount AS DOUBLE) AS amount, method, status FROM v_payments WHERE {PAYMENT_REASON} IS NULL",
    ),
    "validated_deliveries": sql(
        "v_deliveries",
        f"""SELECT delivery_id, city, CAST(actual_days AS BIGINT) AS estimated_days, status FROM v_deliveries
            WHERE {DELIVERY_REASON} IS NULL""",
    ),
    "rejected_orders": sql("v_orders", refused("v_orders", "ecom.orders", "order_id", ORDER_REASON)),
    "rejected_payments": sql("v_payments", refused("v_payments", "ecom.payments", "payment_id", PAYMENT_REASON)),
    "rejected_deliveries": sql("v_deliveries", refused("v_deliveries", "ecom.deliveries", "delivery_id", DELIVERY_REASON)),
    "reject_reason_counts": sql(
        "v_orders v_payments v_deliveries",
        f"""SELECT topic, rejection_reason, COUNT(*) AS records FROM (
                {refused('v_orders', 'ecom.orders', 'order_id', ORDER_REASON)}
                UNION ALL {refused('v_payments', 'ecom.payments', 'payment_id', PAYMENT_REASON)}
                UNION ALL {refused('v_deliveries', 'ecom.deliveries', 'delivery_id', DELIVERY_REASON)}) GROUP BY 1, 2""",
    ),
    "check_violations": sql(
        "v_event_orders",
        "SELECT order_id, 'quantity violates quantity > 0' AS rejection_reason FROM v_event_orders WHERE quantity <= 0",
    ),
    # joins
    "orders_without_payment": sql(
        "v_event_orders v_payments",
        f"""SELECT order_id, CAST(total_amount AS DOUBLE) AS total_amount, {stamp('o.ts')} AS "timestamp"
            FROM v_event_orders o LEFT JOIN v_payments p USING (order_id) WHERE payment_id IS NULL""",
    ),
    "orphan_orders": """
        SELECT o_orderkey, o_custkey FROM orders
        WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""",
    "order_payment_join": sql(
        "v_event_orders v_payments",
        """SELECT order_id, CAST(total_amount AS DOUBLE) AS total_amount, o.city, payment_id, CAST(amount AS DOUBLE) AS amount, p.status
           FROM v_event_orders o JOIN v_payments p USING (order_id)""",
    ),
    "apply_cancellations": sql(
        "v_event_orders",
        "SELECT order_id, CAST(total_amount AS DOUBLE) AS total_amount, status AS order_status FROM v_event_orders",
    ),
    "topic_throughput": sql("v_messages", THROUGHPUT),
    # quality
    "dq_bronze": sql("v_raw", LOG, log=BRONZE_LOG),
    "dq_freshness": sql("v_raw", LOG, log=FRESH),
    "dq_silver_orders": sql("v_event_orders", LOG, log=ORDER_LOG),
    "dq_payment_failure": sql("v_payments", LOG, log=PAYMENT_LOG),
    "dq_summary": sql(
        "v_raw v_event_orders v_payments",
        "SELECT status, COUNT(*) AS check_count FROM log GROUP BY status",
        log=f"{BRONZE_LOG} UNION ALL {ORDER_LOG} UNION ALL {PAYMENT_LOG}",
    ),
    "dq_daily_report": sql(
        "v_event_orders v_payments",
        f"""SELECT {day('d')} AS check_date, nulls AS null_values, bad AS negative_amounts, dups AS duplicate_orders,
                   unpaid AS unmatched_payments, {half_up('100 * failed', 'n')} AS payment_fail_rate,
                   CASE WHEN nulls > 0 OR bad > 0 OR dups > 0 OR 100 * failed > 30 * n THEN 'FAILED' ELSE 'PASSED' END AS status
            FROM checked JOIN rates USING (d)""",
        checked="""
            SELECT CAST(o.ts AS DATE) AS d, COUNT(*) FILTER (o.order_id IS NULL OR o.user_id IS NULL OR o.total_amount IS NULL) AS nulls,
                   COUNT(*) FILTER (o.total_amount <= 0 OR o.quantity <= 0) AS bad,
                   COUNT(*) - COUNT(DISTINCT o.order_id) AS dups, COUNT(*) FILTER (p.payment_id IS NULL) AS unpaid
            FROM v_event_orders o LEFT JOIN v_payments p USING (order_id) GROUP BY 1""",
        rates="""SELECT CAST(ts AS DATE) AS d, COUNT(*) AS n, COUNT(*) FILTER (status = 'failed') AS failed
                 FROM v_payments GROUP BY 1""",
    ),
    # streams
    "stream_events_bronze": sql(
        "v_messages",
        f"""SELECT 'EVT-' || id AS event_id, event_type, topic AS kafka_topic, CAST(id % 3 AS BIGINT) AS kafka_partition,
                   id AS kafka_offset, {stamp('ts')} AS event_time FROM v_messages""",
    ),
    "stream_medallion": sql(
        "v_messages",
        f"""SELECT 'bronze.raw_events' AS table_name, {BY_DAY}, CAST(0 AS DOUBLE) AS amount FROM v_messages GROUP BY 2
            UNION ALL SELECT 'silver.orders', {BY_DAY}, CAST(SUM(amount) AS DOUBLE) FROM v_messages WHERE {SILVER_ORDER_ROWS} GROUP BY 2
            UNION ALL SELECT 'silver.payments', {BY_DAY}, CAST(SUM(amount) AS DOUBLE) FROM v_messages
                      WHERE topic = 'ecom.payments' GROUP BY 2
            UNION ALL SELECT 'silver.deliveries', {BY_DAY}, CAST(SUM(id % 7 + 1) AS DOUBLE) FROM v_messages
                      WHERE topic = 'ecom.deliveries' GROUP BY 2""",
    ),
    "stream_validated_orders": sql(
        "v_orders", f"SELECT order_id, COALESCE({ORDER_REASON}, 'accepted') AS outcome FROM v_orders"
    ),
    "stream_validated_payments": sql(
        "v_payments",
        """SELECT payment_id, CASE WHEN amount <= 0 THEN 'Invalid amount — must be > 0'
                                   WHEN user_id % 6 = 5 THEN 'Invalid payment method: EMI' ELSE 'accepted' END AS outcome
           FROM v_payments""",
    ),
    "stream_validated_deliveries": sql(
        "v_deliveries",
        f"""SELECT DISTINCT delivery_id, 'accepted' AS outcome FROM v_deliveries WHERE {DELIVERY_REASON} IS NULL
            UNION ALL SELECT delivery_id, {DELIVERY_REASON} FROM v_deliveries WHERE {DELIVERY_REASON} IS NOT NULL""",
    ),
    "stream_insert_ignore": sql(
        "v_orders",
        f"""SELECT order_id, CAST(total_amount AS DOUBLE) AS total_amount, status, {stamp('ts')} AS "timestamp" FROM v_orders""",
    ),
    "stream_dedupe": sql(
        "v_messages", f"""SELECT id AS event_id, {stamp('ts')} AS event_time, id AS "offset" FROM v_messages WHERE {ON_TIME}"""
    ),
    # a purchase or sign-up is paid (id mod 121) minutes later; the last orders are still open
    "stream_unpaid_orders": f"""
        WITH paid AS (SELECT event_id, ts + to_minutes(event_id % 121) AS paid_at FROM events WHERE event_type IN ('purchase', 'signup')),
             clock AS (SELECT least((SELECT max(ts) FROM events), (SELECT max(paid_at) FROM paid)) - INTERVAL 12 HOUR AS clock_time)
        SELECT CAST(e.event_id AS VARCHAR) AS order_id, CAST(CAST(value AS DECIMAL(12,2)) AS DOUBLE) AS total_amount, {stamp('ts')} AS event_time
        FROM events e, clock
        WHERE ts + INTERVAL 1 HOUR < clock_time
          AND NOT EXISTS (SELECT 1 FROM paid p WHERE p.event_id = e.event_id AND paid_at <= ts + INTERVAL 1 HOUR)""",
    "stream_hourly_revenue": sql("v_event_orders", HOURLY.format(period=f"AND order_{ON_TIME}")),
    "stream_topic_throughput": sql("v_messages", THROUGHPUT.replace("GROUP BY", f"WHERE {ON_TIME} GROUP BY")),
}

# the same rows, kept up to date by deltas
ORACLE["delta_delayed_shipments"] = ORACLE["refresh_delayed_shipments"]
ORACLE["delta_customer_metrics"] = ORACLE["refresh_customer_metrics"]

# the filters of the kept figures, in the order of their numbers
CUBE_FILTERS = (
    "TRUE",
    "city = 'NATION_7'",
    "category = '2-HIGH' AND ts >= TIMESTAMP '1996-01-01'",
    "city = 'NATION_7' AND category = '2-HIGH' AND ts >= TIMESTAMP '1996-01-01' AND ts <= TIMESTAMP '2000-12-31'",
    "ts >= TIMESTAMP '1997-03-05' AND ts < TIMESTAMP '1997-03-21'",
)
CUBE_REPORTS = {
    "city": ("city", "SUM(total_amount)"),
    "category": ("category", "SUM(total_amount)"),
    "status": ("status", "COUNT(*)"),
    "month": ("strftime(ts, '%Y-%m')", "SUM(total_amount)"),
}
ORACLE["cube_reports"] = sql(
    "v_orders",
    " UNION ALL ".join(
        f"""SELECT CAST({k} AS BIGINT) AS "filter", '{name}' AS report, {key} AS "key", CAST({value} AS DOUBLE) AS "value"
            FROM v_orders WHERE {where} GROUP BY 3"""
        for k, where in enumerate(CUBE_FILTERS)
        for name, (key, value) in CUBE_REPORTS.items()
    ),
)
ORACLE["cube_summaries"] = sql(
    "v_orders",
    " UNION ALL ".join(f'SELECT CAST({k} AS BIGINT) AS "filter", * FROM ({SUMMARY} WHERE {where})' for k, where in enumerate(CUBE_FILTERS)),
)

OBSERVED = {
    "no_null_event_ids": "id % 40 = 0",
    "no_null_event_types": "id % 30 = 0",
    "valid_event_types": "id % 30 <> 0 AND id % 7 = 0",
}
ORACLE["stream_observed_checks"] = sql(
    "v_messages",
    " UNION ALL ".join(
        f"""SELECT 'bronze' AS layer, 'raw_events' AS table_name, '{name}' AS check_name, COUNT(*) AS records_checked,
                   COUNT(*) FILTER ({bad}) AS records_failed FROM v_messages"""
        for name, bad in OBSERVED.items()
    ),
)
ORACLE["append_twice"] = sql(
    "v_payments",
    """SELECT method, status, 2 * COUNT(*) AS payments, COUNT(DISTINCT payment_id) AS ids, CAST(2 * SUM(amount) AS DOUBLE) AS amount
       FROM v_payments GROUP BY 1, 2""",
)
ORACLE["audit_log"] = sql(
    "v_raw v_event_orders v_payments",
    f"""SELECT table_name AS subject, check_name AS detail, upper(status) AS status, CAST(2 AS BIGINT) AS entries,
               CAST(2 * failed AS BIGINT) AS failures
        FROM ({BRONZE_LOG} UNION ALL {ORDER_LOG} UNION ALL {PAYMENT_LOG})
        UNION ALL
        SELECT 'day', {day('d')}, CASE WHEN nulls > 0 OR bad > 0 OR dups > 0 OR 100 * failed > 30 * n THEN 'FAILED' ELSE 'PASSED' END,
               CAST(2 AS BIGINT), CAST(2 * (nulls + bad) AS BIGINT)
        FROM checked JOIN rates USING (d)""",
    checked="""
        SELECT CAST(ts AS DATE) AS d, COUNT(*) FILTER (order_id IS NULL OR user_id IS NULL OR total_amount IS NULL) AS nulls,
               COUNT(*) FILTER (total_amount <= 0 OR quantity <= 0) AS bad, COUNT(*) - COUNT(DISTINCT order_id) AS dups
        FROM v_event_orders GROUP BY 1""",
    rates="""SELECT CAST(ts AS DATE) AS d, COUNT(*) AS n, COUNT(*) FILTER (status = 'failed') AS failed FROM v_payments GROUP BY 1""",
)
ORACLE["catch_up_positions"] = sql(
    "v_messages",
    """SELECT topic, CAST(id % 3 AS BIGINT) AS "partition", COUNT(*) AS messages, CAST(SUM(id) AS BIGINT) AS "offsets", MAX(id) AS "last"
       FROM v_messages GROUP BY 1, 2""",
)
ORACLE["revenue_forecast_by_city"] = sql(
    "v_event_orders",
    FORECAST_OUT.replace("SELECT", "SELECT city, category AS product_category,", 1),
    days="SELECT city, category, CAST(ts AS DATE) AS d, SUM(total_amount) AS revenue FROM v_event_orders GROUP BY 1, 2, 3",
    stats=FORECAST["stats"].replace("SELECT d,", "SELECT city, category, d,", 1).replace("(ORDER BY", "(PARTITION BY city, category ORDER BY"),
)
