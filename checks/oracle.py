"""DuckDB equivalents of the registered queries, written independently of the
Spark code and run against the same Parquet tables."""

from __future__ import annotations

import numpy as np

from .roles import with_roles


def pct(num: str, den: str, digits: int = 2) -> str:
    return f"round(100.0::DOUBLE * CAST({num} AS DOUBLE) / nullif(CAST({den} AS DOUBLE), 0), {digits})"


def money(x: str) -> str:
    return f"CAST(round({x}, 2) AS DOUBLE)"


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def avg(x: str, digits: int | None = None) -> str:
    mean = f"CAST(sum({x}) AS DOUBLE) / nullif(count({x}), 0)"
    return f"round({mean}, {digits})" if digits is not None else mean


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def histogram(source: str, column: str, bins: int, cap: str | None = "0.99", digits: int = 6) -> str:
    """``cap`` is a quantile, or None for all values."""
    limit = f"WHERE v <= (SELECT quantile_cont(v, {cap}) FROM raw)" if cap else ""
    return f"""
        WITH raw AS (SELECT CAST({column} AS DOUBLE) AS v FROM {source} WHERE {column} IS NOT NULL),
        kept AS (SELECT v FROM raw {limit}),
        span AS (SELECT min(v) AS lo, max(v) AS hi FROM kept),
        binned AS (SELECT least({bins} - 1, CASE WHEN hi > lo THEN CAST(floor((v - lo) * {bins} / (hi - lo)) AS INTEGER) ELSE 0 END) AS bin,
                          count(*) AS c FROM kept, span GROUP BY 1)
        SELECT CAST(b AS INTEGER) AS bin, round(lo + (hi - lo) / {bins} * b, {digits}) AS lower,
               round(lo + (hi - lo) / {bins} * (b + 1), {digits}) AS upper, coalesce(c, 0) AS n
        FROM span, range({bins}) g(b) LEFT JOIN binned ON bin = b"""


def hexbin(source: str, x: str, y: str) -> str:
    return f"""
        WITH raw AS (SELECT CAST({x} AS DOUBLE) AS x, CAST({y} AS DOUBLE) AS y FROM {source}
                     WHERE {x} IS NOT NULL AND {y} IS NOT NULL),
        kept AS (SELECT x, y FROM raw, (SELECT quantile_cont(x, 0.99) AS cx, quantile_cont(y, 0.99) AS cy FROM raw)
                 WHERE x <= cx AND y <= cy),
        box AS (SELECT min(x) AS x0, (max(x) - min(x)) / 45 AS sx, min(y) AS y0, (max(y) - min(y)) / 25 AS sy FROM kept),
        scaled AS (SELECT (x - x0) / sx AS u, (y - y0) / sy AS v FROM kept, box),
        cells AS (SELECT CASE WHEN a < b THEN round_even(u, 0) ELSE floor(u) + 0.5 END AS i,
                         CASE WHEN a < b THEN round_even(v, 0) ELSE floor(v) + 0.5 END AS j
                  FROM (SELECT u, v, (u - round_even(u, 0)) ** 2 + 3 * (v - round_even(v, 0)) ** 2 AS a,
                               (u - floor(u) - 0.5) ** 2 + 3 * (v - floor(v) - 0.5) ** 2 AS b FROM scaled))
        SELECT round(x0 + i * sx, 4) AS cx, round(y0 + j * sy, 4) AS cy, count(*) AS n
        FROM cells, box GROUP BY i, j, x0, sx, y0, sy"""


def spearman(source: str, x: str, y: str) -> str:
    return f"""
        (SELECT corr(rx, ry) FROM (
            SELECT rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0::DOUBLE AS rx,
                   rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0::DOUBLE AS ry
            FROM (SELECT {x} AS x, {y} AS y FROM {source} WHERE {x} IS NOT NULL AND {y} IS NOT NULL)))"""


def describe(source: str, column: str, percentiles: tuple[float, ...], digits: int) -> str:
    v = dbl(column)
    places = ", ".join(
        f"round(quantile_cont({v}, {q}), {digits}) AS {f'p{q * 100:g}'.replace('.', '_')}" for q in percentiles
    )
    return f"""
        SELECT count({column}) AS count, round(avg({v}), {digits}) AS mean, round(stddev_samp({v}), {digits}) AS std,
               round(min({v}), {digits}) AS min, round(max({v}), {digits}) AS max,
               round(skewness({v}), {digits}) AS skewness, {places}, '{column}' AS "column"
        FROM {source}"""


def error_table(keys: str, group: str | None = None) -> str:
    group = group or keys
    return f"""
        SELECT {keys}, count(*) AS orders, {big('sum(actual)')} AS late_orders, round(avg(actual), 6) AS late_rate,
               count(*) FILTER (WHERE actual = 1 AND predicted = 1) AS true_positives,
               count(*) FILTER (WHERE error_type = 'false_negative') AS false_negatives,
               count(*) FILTER (WHERE error_type = 'false_positive') AS false_positives,
               round(count(*) FILTER (WHERE actual = 1 AND predicted = 1) / nullif(sum(actual), 0), 6) AS recall,
               round(count(*) FILTER (WHERE error_type = 'false_negative') / nullif(sum(actual), 0), 6) AS false_negative_rate
        FROM errors GROUP BY {group}"""


def baseline(prediction: str) -> str:
    return f"""
        SELECT series, CAST(step AS INTEGER) AS step, last_date + CAST(step AS INTEGER) AS date, round({prediction}, 6) AS predicted
        FROM (SELECT series, max(date) AS last_date, avg(value) AS mean FROM event_days GROUP BY 1), range(1, 31) g(step)"""


GRID = ", ".join(f"({float(t)!r}::DOUBLE)" for t in np.arange(0.05, 0.801, 0.01))

THRESHOLDS = f"""
        grid(t) AS (VALUES {GRID}),
        counted AS (SELECT t, count(*) FILTER (WHERE label = 1 AND score >= t) AS tp,
                           count(*) FILTER (WHERE label = 0 AND score >= t) AS fp,
                           count(*) FILTER (WHERE label = 1) AS p
                    FROM grid, scored GROUP BY t),
        rates AS (SELECT t, coalesce(tp / nullif(tp + fp, 0), 0) AS pr, coalesce(tp / nullif(p, 0), 0) AS re FROM counted),
        fscores AS (SELECT round(t, 2) AS threshold, round(pr, 6) AS precision, round(re, 6) AS recall,
                           round(coalesce(2 * pr * re / nullif(pr + re, 0), 0), 6) AS f1,
                           round(coalesce(5 * pr * re / nullif(4 * pr + re, 0), 0), 6) AS f2, pr, re,
                           coalesce(5 * pr * re / nullif(4 * pr + re, 0), 0) AS raw_f2 FROM rates)"""

DELAY_CASE = """CASE WHEN delay <= 0 THEN {} WHEN delay <= 3 THEN {} WHEN delay <= 7 THEN {} WHEN delay IS NOT NULL THEN {} END"""

_delays = "(SELECT order_id, epoch(arrived - promised) / 86400.0::DOUBLE AS delay FROM shipped)"

STAR = "items JOIN eligible USING (order_id) JOIN labelled USING (product_id)"

SQL: dict[str, str] = {}

# --- data quality ---------------------------------------------------------

SQL["b1_table_row_counts"] = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {role}"
    for name, role in {
        "customers": "customers",
        "products": "products",
        "sellers": "sellers",
        "product_category_translation": "translation",
        "geolocation": "nation",
        "orders": "sales_orders",
        "order_items": "items",
        "payments": "payments",
        "reviews": "reviews",
    }.items()
)
SQL["b2_distinct_counts"] = """
    SELECT (SELECT count(DISTINCT order_id) FROM sales_orders) AS distinct_orders,
           (SELECT count(DISTINCT customer_id) FROM customers) AS distinct_customers,
           (SELECT count(DISTINCT customer_unique_id) FROM customers) AS distinct_unique_customers,
           (SELECT count(DISTINCT product_id) FROM products) AS distinct_products,
           (SELECT count(DISTINCT seller_id) FROM sellers) AS distinct_sellers"""
SQL["b3_duplicate_keys"] = """
    SELECT order_id, order_item_id, count(*) AS copies FROM items GROUP BY ALL HAVING count(*) > 1"""
SQL["b3_duplicate_key_summary"] = " UNION ALL ".join(
    f"""SELECT '{name}' AS check_name, count(*) AS duplicate_keys, {big('coalesce(sum(c), 0)')} AS rows_involved
        FROM (SELECT count(*) AS c FROM {role} GROUP BY {keys} HAVING count(*) > 1)"""
    for name, role, keys in (
        ("customers", "customers", "customer_id"),
        ("orders", "sales_orders", "order_id"),
        ("products", "products", "product_id"),
        ("sellers", "sellers", "seller_id"),
        ("order_items", "items", "order_id, order_item_id"),
        ("payments", "payments", "order_id, installments"),
        ("reviews", "reviews", "review_id, order_id"),
    )
)
SQL["b4_null_counts"] = """
    SELECT (SELECT count(*) FILTER (WHERE customer_id IS NULL) FROM sales_orders) AS orders_customer_id_nulls,
           (SELECT count(*) FILTER (WHERE order_id IS NULL) FROM items) AS items_order_id_nulls,
           (SELECT count(*) FILTER (WHERE product_id IS NULL) FROM items) AS items_product_id_nulls,
           (SELECT count(*) FILTER (WHERE seller_id IS NULL) FROM items) AS items_seller_id_nulls,
           (SELECT count(*) FILTER (WHERE order_id IS NULL) FROM payments) AS payments_order_id_nulls,
           (SELECT count(*) FILTER (WHERE order_id IS NULL) FROM reviews) AS reviews_order_id_nulls"""
SQL["b5_orphan_counts"] = """
    SELECT (SELECT count(*) FROM sales_orders ANTI JOIN customers USING (customer_id)) AS orders_without_customer,
           (SELECT count(*) FROM items ANTI JOIN sales_orders USING (order_id)) AS items_without_order,
           (SELECT count(*) FROM items ANTI JOIN products USING (product_id)) AS items_without_product,
           (SELECT count(*) FROM payments ANTI JOIN sales_orders USING (order_id)) AS payments_without_order,
           (SELECT count(*) FROM reviews ANTI JOIN sales_orders USING (order_id)) AS reviews_without_order"""
SQL["b6_range_check"] = """
    SELECT count(*) AS rows, count(*) FILTER (WHERE score NOT BETWEEN 1 AND 5) AS out_of_range,
           count(*) FILTER (WHERE score IS NULL) AS missing FROM reviews"""
SQL["b7_quality_counters"] = """
    SELECT (SELECT count(*) FROM products WHERE product_category_name IS NULL) AS products_missing_category,
           (SELECT count(*) FROM payments WHERE installments = 0) AS zero_installment_payments,
           (SELECT count(*) FROM payments WHERE payment_type = 'N') AS undefined_payment_methods,
           (SELECT count(*) FROM shipped WHERE order_status = 'F' AND arrived IS NULL) AS delivered_missing_timestamp"""


def _profile(name: str, select: str, keys: str, texts: tuple[str, ...], columns: tuple[str, ...]) -> str:
    missing = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in columns)
    variety = " + ".join(f"count(DISTINCT {c})" for c in texts)
    return f"""
        SELECT '{name}' AS dataset, count(*) AS rows, {len(columns)}::BIGINT AS columns,
               count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM ({select}))) AS duplicate_rows,
               count(*) - (SELECT count(*) FROM (SELECT DISTINCT {keys} FROM ({select}))) AS duplicate_business_keys,
               {big(missing)} AS missing_cells, {big(variety)} AS categorical_cardinality FROM ({select})"""


_OCOLS = ("order_id", "customer_unique_id", "order_status", "bought", "arrived", "promised", "value", "plan", "freight",
          "customer_city", "customer_state", "yr", "mo", "month", "dow", "hr", "delivery_days", "promised_days", "delay_days", "late")
SQL["b8_quality_profile"] = " UNION ALL ".join(
    (
        _profile(
            "orders",
            "SELECT *, delay_days > 0 AS late, year(bought) AS yr, month(bought) AS mo, dayname(bought) AS dow, hour(bought) AS hr FROM orders_ds",
            "order_id", ("order_status", "customer_city", "customer_state", "dow"), _OCOLS),
        _profile(
            "items", "SELECT * FROM items_ds", "order_id, order_item_id", ("product_category_name", "category", "order_status"),
            ("order_id", "order_item_id", "product_id", "seller_id", "price", "freight", "product_category_name", "category", "order_status")),
        _profile(
            "reviews", "SELECT * FROM reviews_ds", "review_id, order_id", ("delivery_status",),
            ("review_id", "order_id", "score", "created", "answered", "delivery_status", "delay_days")),
        _profile(
            "customers", "SELECT * FROM spending JOIN latest_place USING (customer_unique_id)", "customer_unique_id",
            ("customer_state", "customer_city"),
            ("customer_unique_id", "first_bought", "last_bought", "orders", "spend", "customer_state", "customer_city")),
    )
)
ANOMALIES = f"""
    SELECT {dbl('min(price)')} AS minimum_item_price, {dbl('max(price)')} AS maximum_item_price,
           count(*) FILTER (WHERE price < 0) AS negative_item_prices, count(*) FILTER (WHERE freight < 0) AS negative_freight_values,
           (SELECT count(*) FROM eligible_ds WHERE delivery_days < 0) AS negative_delivery_durations,
           (SELECT min(bought) FROM eligible_ds) AS purchase_date_min, (SELECT max(bought) FROM eligible_ds) AS purchase_date_max
    FROM items_ds"""
SQL["b9_anomaly_counts"] = ANOMALIES

_FEATURES = (
    "purchase_month purchase_day_of_week purchase_hour customer_zip_region item_value freight_value item_count unique_products"
    " seller_count total_product_weight_g average_product_length_cm average_product_height_cm average_product_width_cm"
    " payment_value payment_installments estimated_delivery_window_days customer_state dominant_product_category"
    " dominant_seller_state same_customer_seller_state payment_type"
).split()
_SOURCES = {
    "orders": "purchase_month purchase_day_of_week purchase_hour estimated_delivery_window_days",
    "customers": "customer_state customer_zip_region",
    "order_items": "item_value freight_value item_count unique_products seller_count",
    "products": "total_product_weight_g average_product_length_cm average_product_height_cm average_product_width_cm dominant_product_category",
    "sellers": "dominant_seller_state",
    "customers, sellers": "same_customer_seller_state",
    "payments": "payment_type payment_value payment_installments",
}
SQL["b13_feature_audit"] = " UNION ALL ".join(
    f"SELECT '{f}' AS feature, '{table}' AS source, count(*) AS rows, count(*) - count({f}) AS nulls, count(DISTINCT {f}) AS distinct_values,"
    " true AS available_at_prediction_time FROM modeling"
    for table, features in _SOURCES.items()
    for f in features.split()
)
_OPEN = {"item_value": 0, "freight_value": 0, "item_count": 1, "unique_products": 1, "seller_count": 1, "total_product_weight_g": 0,
         "average_product_length_cm": 0, "average_product_height_cm": 0, "average_product_width_cm": 0, "payment_value": 0, "payment_installments": 0}
_CLOSED = {"purchase_month": (1, 12), "purchase_day_of_week": (1, 7), "purchase_hour": (0, 23), "customer_zip_region": (0, 99)}
_BROKEN = {name: f"NOT coalesce({name} >= {low}, false)" for name, low in _OPEN.items()}
_BROKEN |= {name: f"NOT coalesce({name} BETWEEN {low} AND {high}, false)" for name, (low, high) in _CLOSED.items()}
_BROKEN["estimated_delivery_window_days"] = "NOT coalesce(estimated_delivery_window_days > 0, false)"
_BROKEN |= {name: f"coalesce(length({name}), 0) < 1" for name in ("customer_state", "dominant_seller_state", "dominant_product_category", "payment_type")}
_BROKEN["same_customer_seller_state"] = "NOT coalesce(same_customer_seller_state IN ('yes', 'no'), false)"
SQL["b14_validate_requests"] = (
    "SELECT order_id, concat_ws(',', "
    + ", ".join(f"CASE WHEN {broken} THEN '{name}' END" for name, broken in sorted(_BROKEN.items()))
    + """) AS reasons FROM (SELECT * REPLACE (purchase_month + 1 AS purchase_month, freight_value - 50 AS freight_value,
            CASE WHEN item_count < 7 THEN payment_value END AS payment_value) FROM modeling)"""
)
SQL["b14_validate_segment_requests"] = """
    SELECT count(*) FILTER (WHERE recency >= 30 AND frequency >= 0 AND monetary >= 0) AS valid,
           count(*) FILTER (WHERE NOT (recency >= 30 AND frequency >= 0 AND monetary >= 0)) AS rejected FROM rfm"""
SQL["b15_describe_stats"] = " UNION ALL ".join(
    describe("rfm", c, (0.25, 0.5, 0.75), 6) for c in ("recency", "frequency", "monetary")
)
SQL["b15_describe_percentiles"] = describe(
    "(SELECT paid AS payment_value FROM payments)", "payment_value", (0.01, 0.05, 0.9, 0.99), 4
)

# --- projections and predicates -------------------------------------------

SQL["c1_eligible_orders"] = "SELECT order_id, customer_id, order_status, bought AS order_purchase_timestamp FROM eligible"
SQL["c2_delivered_orders"] = """
    SELECT order_id, customer_id, order_status, bought AS order_purchase_timestamp, arrived AS order_delivered_customer_date,
           promised AS order_estimated_delivery_date FROM delivered"""
SQL["c3_category_label"] = "SELECT product_id, category FROM labelled"
SQL["c4_delivery_status"] = """
    SELECT order_id, CASE WHEN order_status = 'F' AND arrived IS NOT NULL
        THEN CASE WHEN arrived > promised THEN 'late' ELSE 'on_time_or_early' END END AS delivery_status FROM shipped"""
SQL["c5_delay_band"] = (
    "SELECT order_id, "
    + DELAY_CASE.format("'on_time_or_early'", "'1_to_3_days_late'", "'4_to_7_days_late'", "'more_than_7_days_late'")
    + " AS delay_band, " + DELAY_CASE.format(0, 1, 2, 3) + f" AS band_order FROM {_delays}"
)
SQL["c6_early_ontime_late"] = f"""
    SELECT order_id, CASE WHEN delay < -1 THEN 'early' WHEN delay <= 0 THEN 'on_time' WHEN delay > 0 THEN 'late' END AS punctuality
    FROM {_delays}"""
BAND_CASE = """CASE WHEN {0} <= 1 THEN '1' WHEN {0} <= 3 THEN '2-3' WHEN {0} <= 6 THEN '4-6' WHEN {0} <= 12 THEN '7-12' ELSE '13+' END"""
SQL["c7_installment_band"] = f"""
    SELECT installments * 2 - 1 AS installments, {BAND_CASE.format('(installments * 2 - 1)')} AS band, count(*) AS n
    FROM payments GROUP BY 1, 2"""
SQL["c8_customer_type"] = "SELECT customer_unique_id, CASE WHEN orders > 1 THEN 'Repeat' ELSE 'One-time' END AS customer_type FROM people"
SQL["c9_risk_label"] = """
    SELECT order_id, CASE WHEN score >= 0.55::DOUBLE THEN 'HIGH' WHEN score >= 0.275::DOUBLE THEN 'MEDIUM' ELSE 'LOW' END AS risk_label
    FROM scored"""
SQL["c10_calendar_features"] = """
    SELECT event_id, CAST(year(ts) AS INTEGER) AS purchase_year, CAST(month(ts) AS INTEGER) AS purchase_month,
           CAST(date_trunc('month', ts) AS DATE) AS purchase_year_month, strftime(ts, '%A') AS purchase_day_of_week,
           CAST(hour(ts) AS INTEGER) AS purchase_hour FROM events"""
SQL["c11_duration_features"] = """
    SELECT order_id, delivery_days, promised_days AS estimated_delivery_days, delay_days AS delivery_delay_days,
           delay_days > 0 AS is_late_delivery FROM orders_ds"""
SQL["c12_percentile_cap"] = f"""
    SELECT order_id, order_item_id, product_id, {dbl('price')} AS price, {dbl('freight')} AS freight_value FROM items,
        (SELECT quantile_cont({dbl('price')}, 0.99) AS cp, quantile_cont({dbl('freight')}, 0.99) AS cf FROM items)
    WHERE {dbl('price')} <= cp AND {dbl('freight')} <= cf"""
SQL["c13_min_support"] = "SELECT customer_id, count(*) AS orders FROM sales_orders GROUP BY 1 HAVING count(*) >= 12"
SQL["c14_zip_region"] = "SELECT customer_id, zip_prefix // 1000 AS zip_region FROM customers"
SQL["c15_same_state_flag"] = "SELECT order_id, same_customer_seller_state FROM modeling"

# --- joins ----------------------------------------------------------------

SQL["d1_inner_lookup"] = "SELECT order_id, customer_id, customer_unique_id, customer_state FROM sales_orders JOIN customers USING (customer_id)"
SQL["d2_join_at_grain_inner"] = f"""
    SELECT order_id, {dbl('sum(paid)')} AS order_value, count(*) AS records
    FROM sales_orders JOIN payments USING (order_id) GROUP BY 1"""
SQL["d3_join_at_grain_left"] = f"""
    SELECT order_id, {dbl('coalesce(value, 0)')} AS order_value FROM sales_orders LEFT JOIN order_value USING (order_id)"""
SQL["d4_star_join"] = f"SELECT order_status, category, count(*) AS items, {dbl('sum(price)')} AS price FROM items_ds GROUP BY 1, 2"
SQL["d5_shift_self_join"] = """
    WITH kept AS (SELECT CAST(date_trunc('month', bought) AS DATE) AS m, count(*) AS c FROM sales_orders
                  GROUP BY 1 HAVING month(m) <> 6)
    SELECT a.m AS month, a.c AS orders, b.c AS orders_month_ago, y.c AS orders_year_ago FROM kept a
    LEFT JOIN kept b ON b.m = a.m - INTERVAL 1 MONTH LEFT JOIN kept y ON y.m = a.m - INTERVAL 1 YEAR"""
SQL["d6_with_scalar"] = """
    SELECT order_id, CAST((SELECT CAST(max(bought) AS DATE) FROM sales_orders) - CAST(bought AS DATE) AS INTEGER) AS age_days FROM sales_orders"""
SQL["d7_orphans"] = "SELECT order_id, order_status FROM sales_orders ANTI JOIN payments USING (order_id)"
SQL["d8_join_dominant"] = "SELECT order_id, payment_type AS main_type FROM sales_orders LEFT JOIN main_type USING (order_id)"
SQL["d9_merge_inner"] = """
    SELECT product_id, count(*) AS items, round(sum(score), 4) AS score_sum FROM items JOIN order_score USING (order_id) GROUP BY 1"""
SQL["d10_merge_group_strings"] = """
    SELECT customer_city, CAST(sum(c) AS BIGINT) AS customers,
           string_agg(customer_state, ', ' ORDER BY place) FILTER (WHERE place <= 3) AS top_states
    FROM (SELECT customer_city, customer_state, count(*) AS c,
                 row_number() OVER (PARTITION BY customer_city ORDER BY count(*) DESC, customer_state) AS place
          FROM customers GROUP BY 1, 2) GROUP BY 1"""
SQL["d11_assemble_kpis"] = f"""
    SELECT (SELECT count(*) FROM sales_orders) AS orders, (SELECT {dbl('sum(paid)')} FROM payments) AS paid,
           (SELECT count(DISTINCT customer_unique_id) FROM customers) AS people, (SELECT {avg('score', 6)} FROM reviews) AS score"""
SQL["d12_date_spine"] = """
    SELECT order_status, day AS date, coalesce(c, 0) AS orders
    FROM (SELECT order_status, CAST(unnest(generate_series(min(bought), max(bought), INTERVAL 1 DAY)) AS DATE) AS day FROM sales_orders GROUP BY 1)
    LEFT JOIN (SELECT order_status, CAST(bought AS DATE) AS day, count(*) AS c FROM sales_orders GROUP BY 1, 2) USING (order_status, day)"""

# --- analytical queries ---------------------------------------------------

SQL["e1_business_overview"] = f"""
    WITH valued AS (SELECT order_id, sum(paid) AS v,
                           CAST(sum(installments * paid) AS DOUBLE) / nullif(CAST(sum(paid) AS DOUBLE), 0) AS w
                    FROM payments WHERE order_id IN (SELECT order_id FROM eligible) GROUP BY 1)
    SELECT (SELECT {big('sum(orders)')} FROM people) AS total_orders, (SELECT count(*) FROM people) AS unique_customers,
           (SELECT count(*) FROM products) AS total_products, (SELECT count(*) FROM sellers) AS total_sellers,
           {money('sum(v)')} AS total_revenue, {avg('v', 2)} AS average_order_value,
           round(avg(w), 2) AS average_payment_installments, round(quantile_cont({dbl('v')}, 0.5), 2) AS median_order_value
    FROM valued"""
SQL["e2_status_mix"] = f"""
    SELECT order_status, count(*) AS order_count, {pct('count(*)', 'sum(count(*)) OVER ()')} AS percentage_of_orders
    FROM sales_orders GROUP BY 1"""
MONTHLY = f"""monthly AS (SELECT CAST(date_trunc('month', bought) AS DATE) AS m, count(*) AS c, sum(value) AS rev, {avg('value')} AS aov
                  FROM paid_orders GROUP BY 1)"""
SQL["e3_monthly_sales_growth"] = f"""
    WITH {MONTHLY}
    SELECT a.m AS month, a.c AS orders, {money('a.rev')} AS revenue, round(a.aov, 2) AS average_order_value,
           CASE WHEN a.c >= 100 AND b.c >= 100 THEN {pct('a.rev - b.rev', 'b.rev')} END AS mom_revenue_growth_pct,
           CASE WHEN a.c >= 100 AND y.c >= 100 THEN {pct('a.rev - y.rev', 'y.rev')} END AS yoy_revenue_growth_pct
    FROM monthly a LEFT JOIN monthly b ON b.m = a.m - INTERVAL 1 MONTH LEFT JOIN monthly y ON y.m = a.m - INTERVAL 12 MONTH"""
SQL["e4_top_months"] = f"""
    WITH {MONTHLY} SELECT m AS month, {money('rev')} AS revenue, c AS orders FROM monthly ORDER BY rev DESC, m LIMIT 10"""
SQL["e5_weekday_sales"] = f"""
    SELECT CAST(isodow(bought) AS INTEGER) AS iso_day_of_week, dayname(bought) AS day_name, count(*) AS orders,
           {money('sum(value)')} AS revenue, {avg('value', 2)} AS average_order_value FROM paid_orders GROUP BY 1, 2"""
SQL["e6_repeat_rate"] = f"""
    SELECT count(*) AS unique_customers, {avg('orders', 3)} AS average_orders_per_customer,
           count(*) FILTER (WHERE orders = 1) AS one_time_customers, count(*) FILTER (WHERE orders > 1) AS repeat_customers,
           {pct('count(*) FILTER (WHERE orders > 1)', 'count(*)')} AS repeat_customer_rate_pct FROM people"""
SQL["e7_top_customers"] = f"""
    SELECT customer_unique_id, orders, {money('spend')} AS total_spend, last_bought AS last_order_at
    FROM paid_spending ORDER BY spend DESC, customer_unique_id LIMIT 20"""
SQL["e8_customer_spend_stats"] = f"""
    SELECT {avg('spend', 2)} AS average_customer_spend, round(quantile_cont({dbl('spend')}, 0.5), 2) AS median_customer_spend FROM paid_spending"""
SQL["e9_customers_by_state"] = """
    SELECT customer_state, count(DISTINCT customer_unique_id) AS unique_customers, count(*) AS orders
    FROM eligible JOIN customers USING (customer_id) GROUP BY 1"""
SQL["e10_customers_by_city"] = """
    SELECT customer_city, customer_state, count(DISTINCT customer_unique_id) AS unique_customers, count(*) AS orders
    FROM eligible JOIN customers USING (customer_id) GROUP BY 1, 2 ORDER BY orders DESC, customer_city, customer_state LIMIT 25"""
SQL["e11_rfm_averages"] = f"""
    WITH r AS (SELECT orders, spend, CAST((SELECT CAST(max(bought) AS DATE) + 1 FROM sales_orders) - CAST(last_bought AS DATE) AS INTEGER) AS days
               FROM paid_spending)
    SELECT {avg('days', 2)} AS average_recency_days, {avg('orders', 3)} AS average_frequency, {avg('spend', 2)} AS average_monetary_value FROM r"""
SQL["e12_category_sales"] = f"""
    SELECT category, {money('sum(price)')} AS item_revenue, count(*) AS items_sold, {avg('price', 2)} AS average_product_price,
           count(DISTINCT product_id) AS unique_products, {avg('freight', 2)} AS average_freight_cost FROM {STAR} GROUP BY 1"""
SQL["e13_top_products"] = f"""
    SELECT product_id, category, {money('sum(price)')} AS item_revenue, count(*) AS items_sold
    FROM {STAR} GROUP BY 1, 2 ORDER BY sum(price) DESC, product_id LIMIT 20"""
SQL["e14_category_reviews"] = """
    SELECT category, round(avg(score), 3) AS average_review_score, count(*) AS reviewed_items
    FROM items JOIN labelled USING (product_id) JOIN order_score USING (order_id) GROUP BY 1 HAVING count(*) >= 100"""
SQL["e15_top_sellers"] = f"""
    SELECT seller_id, seller_state, {money('sum(price)')} AS item_revenue, count(DISTINCT order_id) AS orders, count(*) AS items_sold,
           {avg('price', 2)} AS average_item_value
    FROM items JOIN eligible USING (order_id) JOIN sellers USING (seller_id) GROUP BY 1, 2 ORDER BY sum(price) DESC, seller_id LIMIT 25"""
SQL["e16_sellers_by_state"] = "SELECT seller_state, count(*) AS sellers FROM sellers GROUP BY 1"
SQL["e17_revenue_concentration"] = f"""
    WITH r AS (SELECT rev, row_number() OVER (ORDER BY rev DESC, seller_id) AS place, count(*) OVER () AS n, sum(rev) OVER () AS total
               FROM (SELECT seller_id, sum(price) AS rev FROM items JOIN eligible USING (order_id) GROUP BY 1))
    SELECT {pct('sum(rev) FILTER (WHERE place <= 10)', 'max(total)')} AS top_10_revenue_pct,
           {pct('sum(rev) FILTER (WHERE place <= 100)', 'max(total)')} AS top_100_revenue_pct,
           {pct('sum(rev) FILTER (WHERE place <= ceil(n * 0.01::DOUBLE))', 'max(total)')} AS top_1_percent_revenue_pct FROM r"""
_dd = "epoch({} - {}) / 86400.0::DOUBLE"
DAYS, PROMISE, LAG = _dd.format("arrived", "bought"), _dd.format("promised", "bought"), _dd.format("arrived", "promised")
LATE = pct("count(*) FILTER (WHERE late)", "count(*)")
SQL["e18_delivery_summary"] = f"""
    SELECT round(avg({DAYS}), 2) AS average_delivery_days, round(avg({PROMISE}), 2) AS average_estimated_days,
           count(*) FILTER (WHERE {LAG} < -1) AS early_deliveries, count(*) FILTER (WHERE {LAG} BETWEEN -1 AND 0) AS on_time_deliveries,
           count(*) FILTER (WHERE {LAG} > 0) AS late_deliveries, {LATE} AS late_delivery_rate_pct,
           round(avg({LAG}) FILTER (WHERE {LAG} > 0), 2) AS average_late_delay_days
    FROM delivered SEMI JOIN customers USING (customer_id)"""
SQL["e19_delivery_by_state"] = f"""
    SELECT customer_state, count(*) AS delivered_orders, round(avg({DAYS}), 2) AS average_delivery_days, {LATE} AS late_delivery_rate_pct
    FROM delivered JOIN customers USING (customer_id) GROUP BY 1"""
SQL["e20_delivery_by_month"] = f"""
    SELECT CAST(date_trunc('month', bought) AS DATE) AS purchase_month, count(*) AS delivered_orders,
           round(avg({DAYS}), 2) AS average_delivery_days, {LATE} AS late_delivery_rate_pct FROM delivered GROUP BY 1"""
SQL["e21_freight_buckets"] = f"""
    WITH f AS (SELECT order_id, sum(freight) AS f FROM items GROUP BY 1)
    SELECT CAST(CASE WHEN f < 0 THEN 0 WHEN f >= 20000 THEN 6 ELSE floor({dbl('f')} * 5 / 20000) + 1 END AS INTEGER) AS freight_bucket,
           {money('min(f)')} AS minimum_freight, {money('max(f)')} AS maximum_freight, count(*) AS orders,
           round(avg({DAYS}), 2) AS average_delivery_days FROM delivered JOIN f USING (order_id) GROUP BY 1"""
SQL["e22_review_summary"] = f"SELECT {avg('score', 3)} AS average_review_score, count(*) AS reviews FROM reviews"
SQL["e23_review_distribution"] = f"""
    SELECT score AS review_score, count(*) AS reviews, {pct('count(*)', 'sum(count(*)) OVER ()')} AS review_percentage FROM reviews GROUP BY 1"""
SQL["e24_review_by_status"] = f"""
    SELECT CASE WHEN late THEN 'late' ELSE 'on_time_or_early' END AS delivery_status, count(*) AS reviews, {avg('score', 3)} AS average_review_score
    FROM reviews JOIN delivered USING (order_id) GROUP BY 1"""
SQL["e25_seller_reviews"] = """
    SELECT seller_id, count(*) AS reviewed_items, round(avg(score), 3) AS average_review_score
    FROM items JOIN order_score USING (order_id) GROUP BY 1 HAVING count(*) >= 100 ORDER BY average_review_score DESC, seller_id LIMIT 25"""
SQL["e26_review_by_delay_band"] = (
    "SELECT " + DELAY_CASE.format("'on_time_or_early'", "'1_to_3_days_late'", "'4_to_7_days_late'", "'more_than_7_days_late'").replace("delay ", f"({LAG}) ")
    + f" AS delay_band, count(*) AS reviews, {avg('score', 3)} AS average_review_score FROM reviews JOIN delivered USING (order_id) GROUP BY 1"
)
SQL["e27_payment_types"] = f"""
    SELECT payment_type, count(*) AS payment_records, count(DISTINCT order_id) AS orders, {money('sum(paid)')} AS revenue,
           {avg('paid', 2)} AS average_payment_value FROM payments GROUP BY 1"""
SQL["e28_installment_mix"] = f"""
    SELECT installments AS payment_installments, count(*) AS payment_records,
           {pct('count(*)', 'sum(count(*)) OVER ()')} AS payment_percentage, {avg('paid', 2)} AS average_payment_value FROM payments GROUP BY 1"""
SQL["e29_installment_bands"] = f"""
    SELECT {BAND_CASE.format('installments')} AS installment_band, count(*) AS payment_records, {avg('paid', 2)} AS average_payment_value,
           {money('sum(paid)')} AS revenue FROM payments GROUP BY 1"""
SQL["e30_installment_corr"] = f"""
    SELECT {avg('installments', 2)} AS average_installments, round(corr({dbl('paid')}, {dbl('installments')}), 3) AS payment_value_installment_correlation
    FROM payments WHERE payment_type = 'R'"""
SQL["e31_executive_kpis"] = f"""
    SELECT (SELECT {money('sum(value)')} FROM paid_orders) AS revenue, (SELECT count(*) FROM eligible) AS orders,
           (SELECT count(*) FROM people) AS unique_customers, (SELECT {avg('value', 2)} FROM paid_orders) AS average_order_value,
           (SELECT {pct('count(*) FILTER (WHERE orders > 1)', 'count(*)')} FROM people) AS repeat_customer_rate_pct,
           (SELECT {avg('score', 3)} FROM reviews) AS average_review_score, (SELECT {LATE} FROM delivered) AS late_delivery_rate_pct"""
LATE6 = pct("count(*) FILTER (WHERE late)", "count(*)", 6)
SQL["e32_overview"] = f"""
    SELECT (SELECT count(*) FROM eligible) AS total_eligible_orders,
           (SELECT round(coalesce({dbl('sum(value)')}, 0), 6) FROM paid_orders) AS total_revenue,
           (SELECT round(coalesce({avg('value')}, 0), 6) FROM paid_orders) AS average_order_value,
           (SELECT count(*) FROM people) AS unique_customers,
           (SELECT {pct('count(*) FILTER (WHERE orders > 1)', 'count(*)', 6)} FROM people) AS repeat_customer_rate,
           (SELECT round(avg({DAYS}), 6) FROM delivered) AS average_delivery_duration_days, (SELECT {LATE6} FROM delivered) AS late_delivery_rate"""
SQL["e33_monthly_sales"] = f"""
    SELECT CAST(date_trunc('month', bought) AS DATE) AS month, count(*) AS orders, round(coalesce({dbl('sum(value)')}, 0), 6) AS revenue,
           round(coalesce({avg('value')}, 0), 6) AS average_order_value FROM eligible LEFT JOIN order_value USING (order_id) GROUP BY 1"""
SQL["e34_top_categories"] = f"""
    SELECT category, count(*) AS items_sold, {dbl('sum(price)')} AS item_revenue FROM {STAR} GROUP BY 1 ORDER BY sum(price) DESC, category LIMIT 20"""
SQL["e35_monthly_delivery"] = f"""
    SELECT CAST(date_trunc('month', bought) AS DATE) AS month, count(*) AS delivered_orders,
           round(avg({DAYS}), 6) AS average_delivery_days, {LATE6} AS late_delivery_rate FROM delivered GROUP BY 1"""
SQL["e36_customer_type_mix"] = f"""
    WITH t AS (SELECT CASE WHEN orders > 1 THEN 'Repeat' ELSE 'One-time' END AS kind, count(*) AS c, sum(spend) AS rev FROM spending GROUP BY 1)
    SELECT kind AS customer_type, c AS customers, {pct('c', 'sum(c) OVER ()', 6)} AS customer_share, round({dbl('rev')}, 6) AS revenue,
           {pct('rev', 'sum(rev) OVER ()', 6)} AS revenue_share FROM t"""
SQL["e37_orders_dataset"] = f"""
    SELECT order_id, customer_unique_id, order_status, bought AS purchase_timestamp, arrived AS delivered_customer_at,
           promised AS estimated_delivery_at, {dbl('value')} AS order_value, plan AS maximum_installments,
           {dbl('freight')} AS freight_value, customer_city, customer_state FROM orders_ds"""
SQL["e38_items_dataset"] = f"""
    SELECT order_id, order_item_id, product_id, seller_id, {dbl('price')} AS price, {dbl('freight')} AS freight_value,
           product_category_name, category AS category_english, order_status FROM items_ds"""
SQL["e39_reviews_dataset"] = """
    SELECT review_id, order_id, score AS review_score, created AS review_creation_date, answered AS review_answer_timestamp,
           delivery_status, delay_days AS delivery_delay_days FROM reviews_ds"""
SQL["e40_customers_dataset"] = f"""
    SELECT customer_unique_id, first_bought AS first_purchase, last_bought AS last_purchase, orders AS order_count,
           {dbl('spend')} AS total_spend, customer_state, customer_city FROM spending JOIN latest_place USING (customer_unique_id)"""
SQL["e41_rfm_dataset"] = f"""
    SELECT customer_unique_id, first_bought AS first_purchase, last_bought AS last_purchase, recency, frequency,
           {dbl('monetary')} AS monetary, customer_state, customer_city, reference_date FROM rfm"""
SQL["e42_modeling_dataset"] = "SELECT * FROM modeling"
SQL["e43_daily_series"] = f"""
    SELECT date, daily_orders, {dbl('daily_revenue')} AS daily_revenue FROM daily WHERE date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'"""

# --- exploratory tables ---------------------------------------------------

COMPLETE = f"""
    SELECT month AS purchase_year_month, round(coalesce({dbl('sum(value)')}, 0), 6) AS revenue, count(*) AS orders,
           round({avg('value')}, 6) AS average_order_value FROM eligible_ds GROUP BY 1 HAVING count(*) >= 100"""
SQL["f1_monthly_complete"] = COMPLETE
SQL["f2_order_value_histogram"] = histogram("eligible_ds", "value", 60)
SQL["f2_customer_spend_histogram"] = histogram("spending", "spend", 60)
SQL["f2_delivery_days_histogram"] = histogram("delivered_ds", "delivery_days", 55)
SQL["f2_item_price_histogram"] = histogram("(SELECT price FROM items_ds WHERE order_status <> 'P')", "price", 60)
SQL["f2_item_freight_histogram"] = histogram("(SELECT freight FROM items_ds WHERE order_status <> 'P')", "freight", 60)
_SOLD = "(SELECT category AS category_english, price FROM items_ds WHERE order_status <> 'P')"
SQL["f3_top_category_revenue"] = f"""
    SELECT category_english, {dbl('sum(price)')} AS item_revenue FROM {_SOLD} GROUP BY 1 ORDER BY sum(price) DESC, 1 LIMIT 15"""
SQL["f4_top_category_items"] = f"SELECT category_english, count(*) AS items_sold FROM {_SOLD} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15"
_CUST = "spending JOIN latest_place USING (customer_unique_id)"
SQL["f5_top_state_customers"] = f"SELECT customer_state, count(*) AS customers FROM {_CUST} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15"
SQL["f6_top_state_revenue"] = f"SELECT customer_state, {dbl('sum(spend)')} AS revenue FROM {_CUST} GROUP BY 1 ORDER BY sum(spend) DESC, 1 LIMIT 15"
SQL["f7_repeat_mix"] = "SELECT CASE WHEN orders > 1 THEN 'Repeat' ELSE 'One-time' END AS customer_type, count(*) AS customers FROM spending GROUP BY 1"
SQL["f8_order_frequency"] = "SELECT orders AS order_count, count(*) AS customers FROM spending GROUP BY 1"
SQL["f9_late_rate_by_state"] = """
    SELECT customer_state, round(avg(CAST(late AS INTEGER)), 6) AS late_rate, count(*) AS orders FROM delivered_ds GROUP BY 1 HAVING count(*) >= 100"""
SQL["f10_duration_by_state"] = """
    SELECT customer_state, round(avg(delivery_days), 6) AS delivery_days, count(*) AS orders FROM delivered_ds GROUP BY 1 HAVING count(*) >= 100"""
SQL["f11_late_rate_by_month"] = """
    SELECT month AS purchase_year_month, round(avg(CAST(late AS INTEGER)), 6) AS late_rate, count(*) AS orders
    FROM delivered_ds GROUP BY 1 HAVING count(*) >= 100"""
SQL["f12_review_score_counts"] = "SELECT score AS review_score, count(*) AS reviews FROM reviews_ds GROUP BY 1"
SQL["f13_review_by_status"] = """
    SELECT delivery_status, round(avg(score), 6) AS mean, count(score) AS count FROM reviews_ds WHERE delivery_status IS NOT NULL GROUP BY 1"""
SQL["f14_review_by_delay_band"] = (
    "SELECT " + DELAY_CASE.format("'On time/early'", "'1–3 days late'", "'4–7 days late'", "'>7 days late'").replace("delay ", "delay_days ")
    + " AS delay_band, round(avg(score), 6) AS average_review FROM reviews_ds WHERE delay_days IS NOT NULL GROUP BY 1"
)
SQL["f15_hexbin_freight_days"] = hexbin("delivered_ds", "freight", "delivery_days")
SQL["f15_hexbin_value_freight"] = hexbin("eligible_ds", "value", "freight")
SQL["f16_value_by_installments"] = f"""
    SELECT plan AS maximum_installments, round({avg('value')}, 6) AS average_order_value, count(*) AS orders FROM eligible_ds
    WHERE plan IS NOT NULL AND value IS NOT NULL GROUP BY 1 HAVING count(*) >= 20"""
SQL["f17_category_review_extremes"] = """
    WITH c AS (SELECT category AS category_english, round(avg(score), 6) AS average_review, count(*) AS reviewed_items
               FROM items_ds JOIN order_score USING (order_id) WHERE order_status <> 'P' GROUP BY 1 HAVING count(*) >= 100)
    SELECT * FROM (SELECT * FROM c ORDER BY average_review, category_english LIMIT 8)
    UNION SELECT * FROM (SELECT * FROM c ORDER BY average_review DESC, category_english DESC LIMIT 8)"""
_PAIRS = {
    "delay_review": ("reviews_ds", "delay_days", "score"),
    "freight_delivery": ("delivered_ds", dbl("freight"), "delivery_days"),
    "order_freight": ("eligible_ds", dbl("value"), dbl("freight")),
    "order_installments": ("eligible_ds", "value", "plan"),
}
SQL["f19_pearson"] = "SELECT " + ", ".join(
    f"(SELECT round(corr({x}, {y}), 6) FROM {t}) AS {n}_pearson" for n, (t, x, y) in list(_PAIRS.items())[:3]
)
SQL["f20_spearman"] = "SELECT " + ", ".join(
    f"round({spearman(t, x, y)}, 6) AS {n}_spearman" for n, (t, x, y) in _PAIRS.items() if n != "order_freight"
)
SIDES = """
    SELECT CASE WHEN delay_days > 0 THEN 'late' ELSE 'ontime' END AS side, round(avg(score), 6) AS mean, count(*) AS n,
           round(quantile_cont(score, 0.5), 6) AS median FROM reviews_ds WHERE delay_days IS NOT NULL AND score IS NOT NULL GROUP BY 1"""
SQL["f21_late_against_ontime"] = SIDES
SQL["f22_best_month"] = f"SELECT purchase_year_month, revenue, orders FROM ({COMPLETE}) ORDER BY revenue DESC, 1 LIMIT 1"
SQL["f23_state_duration"] = """
    SELECT customer_state, round(avg(delivery_days), 6) AS mean, count(*) AS count, round(quantile_cont(delivery_days, 0.5), 6) AS median
    FROM delivered_ds WHERE customer_state IN ('NATION_1', 'NATION_2', 'NATION_3') GROUP BY 1"""
SQL["f24_top_category"] = SQL["f3_top_category_revenue"].replace("LIMIT 15", "LIMIT 1")
SQL["f25_weekday_means"] = f"""
    SELECT dayname(date) AS weekday, round({avg('daily_orders')}, 6) AS orders, round({avg('daily_revenue')}, 6) AS revenue FROM daily GROUP BY 1"""
SQL["f25_month_sums"] = f"""
    SELECT CAST(date_trunc('month', date) AS DATE) AS month, {big('sum(daily_orders)')} AS daily_orders,
           {dbl('sum(daily_revenue)')} AS daily_revenue FROM daily GROUP BY 1"""
SQL["f25_rolling_means"] = "SELECT date, daily_orders, round(CAST(daily_revenue AS DOUBLE), 6) AS daily_revenue, " + ", ".join(
    f"CASE WHEN row_number() OVER (ORDER BY date) >= {w} THEN round(avg(CAST({c} AS DOUBLE)) OVER (ORDER BY date ROWS {w - 1} PRECEDING), 6) END AS {c}_mean_{w}"
    for c in ("daily_orders", "daily_revenue") for w in (7, 30)
) + " FROM daily"
SQL["f25_spikes"] = "SELECT " + ", ".join(
    f"(SELECT count(*) FROM daily WHERE {c} > (SELECT avg({c}::DOUBLE) + 3 * stddev_samp({c}::DOUBLE) FROM daily)) AS {c}"
    for c in ("daily_orders", "daily_revenue")
)
SQL["f26_weekday_residuals"] = """
    SELECT weekday, round(avg(residual), 6) AS mean, round(stddev_samp(residual), 6) AS std, count(residual) AS count FROM residuals GROUP BY 1"""
SQL["f26_largest_residuals"] = """
    SELECT date, actual, predicted, residual, weekday FROM residuals ORDER BY abs(residual) DESC, date LIMIT 10"""
SQL["f27_rfm_log_histograms"] = " UNION ALL ".join(
    f"SELECT *, '{m}' AS measure FROM ({histogram(f'(SELECT round(ln(1 + {m}::DOUBLE), 9) AS v FROM rfm)', 'v', 60, None, 5)})" for m in ("recency", "frequency", "monetary")
)
SQL["f27_scatter_sample"] = f"""
    SELECT customer_unique_id, recency, {dbl('monetary')} AS monetary FROM rfm
    ORDER BY md5(concat_ws(':', customer_unique_id, '42')), customer_unique_id LIMIT 20000"""
SQL["f28_sample_rows"] = """
    SELECT order_id, customer_id, order_status, bought AS order_purchase_timestamp FROM sales_orders ORDER BY order_id LIMIT 3"""

# --- windows and ranks ----------------------------------------------------

_SELLER = "(SELECT seller_id, sum(price) AS rev FROM items GROUP BY 1)"
SQL["h1_share_of_total"] = f"SELECT seller_id, round({dbl('rev')}, 6) AS revenue, {pct('rev', 'sum(rev) OVER ()', 6)} AS share FROM {_SELLER}"
SQL["h2_global_row_number"] = f"""
    SELECT product_id, {dbl('rev')} AS revenue, row_number() OVER (ORDER BY rev DESC, product_id) AS rank
    FROM (SELECT product_id, sum(price) AS rev FROM items GROUP BY 1)"""
SQL["h3_dominant_value"] = "SELECT order_id, category FROM main_category"
SQL["h4_latest_row"] = """
    SELECT customer_id, order_id, order_status FROM (
        SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY bought DESC, order_id) AS place FROM sales_orders) WHERE place = 1"""
SQL["h5_quantile_bin"] = "SELECT customer_unique_id, CAST(m_score AS INTEGER) AS bin FROM rfm_scored"
_EDGES = """
    WITH q AS (SELECT quantile_cont(item_value, [0.0, 0.25, 0.5, 0.75, 1.0]) AS e FROM modeling),
    edges AS (SELECT list_sort(list_distinct(e)) AS e FROM q),
    banded AS (SELECT m.*, e, least(greatest(len(e) - 1, 1), 1 + len(list_filter(e[2:], lambda x: x < item_value))) AS band FROM {}, edges)"""
SQL["h6_quantile_band"] = _EDGES.format("modeling m") + """
    SELECT order_id, round(item_value, 4) AS item_value, CAST(band AS INTEGER) AS band, round(e[band], 4) AS band_lower,
           round(coalesce(e[band + 1], e[band]), 4) AS band_upper FROM banded"""
SQL["h7_lags"] = "SELECT *, " + ", ".join(
    f"lag(value, {k}) OVER (PARTITION BY series ORDER BY date) AS lag_{k}" for k in (1, 2, 3, 7, 14, 28)
) + " FROM series"


def _rolling(function: str, name: str, width: int, digits: int) -> str:
    window = f"OVER (PARTITION BY series ORDER BY date ROWS BETWEEN {width} PRECEDING AND 1 PRECEDING)"
    return f"CASE WHEN count(value) {window} = {width} THEN round({function}(value) {window}, {digits}) END AS rolling_{name}_{width}"


_ROLLS = ", ".join([_rolling("avg", "mean", w, 6) for w in (7, 14, 28)] + [_rolling("stddev_samp", "std", w, 3) for w in (7, 28)])
SQL["h8_rolling_previous"] = f"SELECT series, date, round(value, 6) AS value, {_ROLLS} FROM series"
SQL["h9_drop_incomplete"] = """
    SELECT series, min(date) + 28 AS first_day, count(*) - 28 AS days FROM series GROUP BY 1"""
_SPLIT = """CASE WHEN place <= floor(n * 0.7::DOUBLE) THEN 'train' WHEN place <= floor(n * 0.85::DOUBLE) THEN 'validation' ELSE 'test' END"""
SQL["h10_temporal_split"] = f"""
    SELECT order_id, {_SPLIT} AS split FROM (
        SELECT order_id, row_number() OVER (ORDER BY bought, order_id) AS place, count(*) OVER () AS n FROM sales_orders)"""
SQL["h10_split_summary"] = f"""
    SELECT {_SPLIT} AS split, count(*) AS rows, min(purchase_timestamp) AS start, max(purchase_timestamp) AS "end",
           {big('sum(is_late_delivery)')} AS late_orders, round(avg(is_late_delivery), 6) AS late_prevalence
    FROM (SELECT *, row_number() OVER (ORDER BY purchase_timestamp, order_id) AS place, count(*) OVER () AS n FROM modeling) GROUP BY 1"""
SQL["h11_expanding_folds"] = """
    WITH d AS (SELECT series, date, row_number() OVER (PARTITION BY series ORDER BY date) AS i, count(*) OVER (PARTITION BY series) AS n FROM series)
    SELECT series, CAST(f AS INTEGER) AS fold, min(date) FILTER (WHERE i <= n - 30 - (4 - f) * 30) AS train_start,
           max(date) FILTER (WHERE i <= n - 30 - (4 - f) * 30) AS train_end,
           min(date) FILTER (WHERE i > n - 30 - (4 - f) * 30) AS validation_start,
           max(date) FILTER (WHERE i <= n - 30 - (3 - f) * 30) AS validation_end
    FROM d, range(1, 4) g(f) GROUP BY 1, 2"""

# --- sort, limit, set operations ------------------------------------------

SQL["i1_top_k"] = f"""
    SELECT order_id, order_item_id, product_id, {dbl('price')} AS price FROM items ORDER BY price DESC, order_id, order_item_id, product_id LIMIT 20"""
SQL["i2_head_tail"] = """
    WITH c AS (SELECT customer_id, count(*) AS orders FROM sales_orders GROUP BY 1)
    SELECT * FROM (SELECT * FROM c ORDER BY orders, customer_id LIMIT 8)
    UNION SELECT * FROM (SELECT * FROM c ORDER BY orders DESC, customer_id DESC LIMIT 8)"""
SQL["i4_sample_exact"] = """
    SELECT order_id, order_status FROM sales_orders ORDER BY md5(concat_ws(':', order_id, '42')), order_id LIMIT 10000"""
SQL["i3_order_by_hidden"] = """
    SELECT order_status, count(*) AS orders FROM sales_orders GROUP BY 1 ORDER BY min({'d': bought, 'o': order_id})"""
SQL["i7_latest_per_key"] = """
    SELECT DISTINCT ON (customer_unique_id) customer_unique_id, order_id, customer_state, customer_city
    FROM sales_orders JOIN customers USING (customer_id) ORDER BY customer_unique_id, bought DESC, order_id"""
SQL["i5_union_all"] = " UNION ALL ".join(
    f"SELECT '{n}' AS source, count(*) AS rows, count(DISTINCT order_id) AS orders FROM {t}"
    for n, t in (("orders", "sales_orders"), ("items", "items"), ("payments", "payments"))
)
SQL["i6_concat_distinct"] = "SELECT order_id FROM items UNION SELECT order_id FROM payments"

# --- classification measures ----------------------------------------------

SQL["k6_classification_metrics"] = """
    WITH c AS (SELECT count(*) FILTER (WHERE label = 0 AND score < 0.55::DOUBLE) AS tn, count(*) FILTER (WHERE label = 0 AND score >= 0.55::DOUBLE) AS fp,
                      count(*) FILTER (WHERE label = 1 AND score < 0.55::DOUBLE) AS fn, count(*) FILTER (WHERE label = 1 AND score >= 0.55::DOUBLE) AS tp FROM scored),
    r AS (SELECT sum(pos / p * (tp / (tp + fp))) AS ap, sum(neg::DOUBLE * (tp - pos / 2)) / (max(p)::DOUBLE * max(n)) AS auc FROM score_sums)
    SELECT round(ap, 6) AS pr_auc, round(auc, 6) AS roc_auc, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall,
           round(2 * tp / (2 * tp + fp + fn), 6) AS f1, round((tp / (tp + fn) + tn / (tn + fp)) / 2, 6) AS balanced_accuracy, tn, fp, fn, tp FROM c, r"""
SQL["k7_threshold_table"] = f"WITH {THRESHOLDS} SELECT threshold, precision, recall, f1, f2 FROM fscores"
SQL["k7_best_threshold"] = f"""
    WITH {THRESHOLDS} SELECT threshold, precision, recall, f1, f2 FROM fscores ORDER BY raw_f2 DESC, pr DESC, threshold LIMIT 1"""
SQL["k9_pr_curve"] = """
    SELECT round(score, 6) AS threshold, round(tp / (tp + fp), 6) AS precision, round(tp / p, 6) AS recall FROM score_sums
    UNION ALL SELECT NULL, 1, 0"""
SQL["k9_roc_curve"] = """
    SELECT round(score, 6) AS threshold, round(fp / n, 6) AS fpr, round(tp / p, 6) AS tpr FROM score_sums UNION ALL SELECT NULL, 0, 0"""
_hist = lambda label: histogram(f"(SELECT score FROM scored WHERE label = {label})", "score", 40, None)
SQL["k9_score_histogram"] = f"SELECT *, 0 AS label FROM ({_hist(0)}) UNION ALL SELECT *, 1 AS label FROM ({_hist(1)})"
SQL["k11_errors_by_state"] = error_table("customer_state")
SQL["k11_errors_by_value_band"] = _EDGES.format("errors m") + error_table(
    "CAST(band AS INTEGER) AS value_band, round(e[band], 4) AS value_band_lower, round(coalesce(e[band + 1], e[band]), 4) AS value_band_upper", "1, 2, 3"
).replace("FROM errors", "FROM banded").replace(", 6)", ", 4)")
SQL["k11_errors_by_category"] = error_table("dominant_product_category")
SQL["k11_errors_by_month"] = error_table("purchase_month")
SQL["k11_error_examples"] = """
    SELECT order_id, purchase_timestamp, customer_state, dominant_product_category, round(item_value, 6) AS item_value, actual, predicted, error_type
    FROM errors WHERE error_type <> 'correct' ORDER BY purchase_timestamp, order_id LIMIT 100"""
SQL["k13_target_distribution"] = "SELECT is_late_delivery, count(*) AS rows FROM modeling GROUP BY 1"

# --- segmentation ---------------------------------------------------------

SQL["l1_rfm_scores"] = """
    SELECT customer_unique_id, CAST(r_score AS INTEGER) AS r_score, CAST(f_score AS INTEGER) AS f_score, CAST(m_score AS INTEGER) AS m_score FROM rfm_scored"""
SQL["l2_rfm_segment"] = "SELECT customer_unique_id, rfm_segment FROM segments"
SQL["l3_rule_distribution"] = f"""
    SELECT rfm_segment, count(*) AS customers, {pct('count(*)', 'sum(count(*)) OVER ()', 6)} AS customer_share FROM segments GROUP BY 1"""
SQL["l9_rule_crosstab"] = """
    SELECT rfm_segment, round(count(*) FILTER (WHERE recency % 2 = 0) / count(*), 6) AS even,
           round(count(*) FILTER (WHERE recency % 2 <> 0) / count(*), 6) AS odd FROM segments GROUP BY 1"""
_RULES = "Champions, Loyal Customers, High Value At Risk, New Customers, Potential Loyalists, Promising, At Risk, Needs Attention, Hibernating".split(", ")
_NUMBERED = f"(SELECT *, CAST(list_position({_RULES!r}, rfm_segment) - 1 AS INTEGER) AS cluster_id FROM segments)"
_MEDIANS = ", ".join(f"quantile_cont({c}::DOUBLE, 0.5) AS median_{c}" for c in ("recency", "frequency", "monetary"))
SQL["l7_rule_profiles"] = f"""
    SELECT cluster_id, customer_count, round(median_recency, 4) AS median_recency, round(median_frequency, 4) AS median_frequency,
           round(median_monetary, 4) AS median_monetary, round(revenue / customer_count, 4) AS mean_monetary, round(revenue, 4) AS total_revenue,
           round(repeaters, 4) AS repeat_customer_rate, round(100.0::DOUBLE * customer_count / sum(customer_count) OVER (), 4) AS customer_percentage,
           round(100.0::DOUBLE * revenue / sum(revenue) OVER (), 4) AS revenue_share
    FROM (SELECT cluster_id, count(*) AS customer_count, {_MEDIANS}, CAST(sum(monetary) AS DOUBLE) AS revenue,
                 avg(CAST(frequency > 1 AS INTEGER)) AS repeaters FROM {_NUMBERED} GROUP BY 1)"""
_SCALED = ", ".join(
    f"round(({c} - min({c}) OVER ()) / coalesce(nullif(max({c}) OVER () - min({c}) OVER (), 0), 1), 6) AS {c}"
    for c in ("median_recency", "median_frequency", "median_monetary")
)
SQL["l12_minmax_profile"] = f"SELECT cluster_id, {_SCALED} FROM (SELECT cluster_id, {_MEDIANS} FROM {_NUMBERED} GROUP BY 1)"

# --- forecasting ----------------------------------------------------------

SQL["m1_make_features"] = (
    "SELECT * FROM (SELECT series, date, "
    + ", ".join(f"round(lag(value, {k}) OVER (PARTITION BY series ORDER BY date), 6) AS lag_{k}" for k in (1, 2, 3, 7, 14, 28))
    + f""", {_ROLLS}, CAST(isodow(date) - 1 AS INTEGER) AS day_of_week, CAST(day(date) AS INTEGER) AS day_of_month,
        CAST(month(date) AS INTEGER) AS month, CAST(quarter(date) AS INTEGER) AS quarter, CAST(weekofyear(date) AS INTEGER) AS week_of_year,
        CASE WHEN isodow(date) >= 6 THEN 1 ELSE 0 END AS is_weekend,
        CAST(date - min(date) OVER (PARTITION BY series) AS INTEGER) AS time_index, round(value, 6) AS target FROM series)
    WHERE lag_28 IS NOT NULL"""
)
_PLAIN = SQL["m1_make_features"]
for _k in (1, 2, 3, 7, 14, 28):
    _PLAIN = _PLAIN.replace(f"round(lag(value, {_k}) OVER (PARTITION BY series ORDER BY date), 6)", f"lag(value, {_k}) OVER (PARTITION BY series ORDER BY date)")
SQL["m4_normal_equations"] = f"""
    SELECT series, feature, count(*) AS days, round(sum(x * target) / sum(x), 2) AS weighted_mean
    FROM (UNPIVOT (SELECT series, target, COLUMNS(* EXCLUDE (series, date, target))::DOUBLE FROM ({_PLAIN}))
          ON COLUMNS(* EXCLUDE (series, target)) INTO NAME feature VALUE x)
    GROUP BY ALL"""
SQL["m2_naive_last_value"] = """
    SELECT series, CAST(step AS INTEGER) AS step, last_date + CAST(step AS INTEGER) AS date, greatest(0, last_value) AS predicted
    FROM (SELECT series, max(date) AS last_date, arg_max(value, date) AS last_value FROM event_days GROUP BY 1), range(1, 31) g(step)"""
SQL["m2_historical_mean"] = baseline("greatest(0, mean)")
SQL["m2_seasonal_naive"] = """
    SELECT s.series, CAST(step AS INTEGER) AS step, last_date + CAST(step AS INTEGER) AS date, greatest(0, e.value) AS predicted
    FROM (SELECT series, max(date) AS last_date FROM event_days GROUP BY 1) s, range(1, 31) g(step)
    JOIN event_days e ON e.series = s.series AND e.date = s.last_date - CAST(6 - (step - 1) % 7 AS INTEGER)"""
SQL["m2_rolling_mean"] = """
    WITH RECURSIVE walk AS (
        SELECT series, 0 AS step, max(date) AS last_date, list(value ORDER BY date)[-7:] AS tail
        FROM event_days GROUP BY 1
        UNION ALL
        SELECT series, step + 1, last_date, list_append(tail[2:], greatest(0, list_sum(tail) / 7)) FROM walk WHERE step < 30)
    SELECT series, CAST(step AS INTEGER) AS step, last_date + CAST(step AS INTEGER) AS date, round(tail[-1], 6) AS predicted
    FROM walk WHERE step > 0"""
SQL["m5_error_metrics"] = """
    SELECT series, model, fold, round(mae, 4) AS mae, round(rmse, 4) AS rmse, round(mape, 4) AS mape, round(smape, 4) AS smape FROM fold_errors"""
SQL["m6_walk_forward"] = "SELECT series, fold, model, step, date, round(actual, 4) AS actual, round(predicted, 4) AS predicted FROM backtest"
SQL["m7_summarize_backtest"] = """
    SELECT series, model, round(mae, 4) AS mae, round(rmse, 4) AS rmse, round(mape, 4) AS mape, round(smape, 4) AS smape FROM fold_summary"""
SQL["m8_choose_model"] = "SELECT series, model FROM chosen"
SQL["m9_holdout_evaluation"] = """
    SELECT series, CAST(horizon AS INTEGER) AS horizon, round(avg(abs(actual - predicted)), 4) AS mae, round(sqrt(avg((actual - predicted) ** 2)), 4) AS rmse,
           round(coalesce(avg(abs((actual - predicted) / nullif(actual, 0))) * 100, 'NaN'::DOUBLE), 4) AS mape,
           round(CASE WHEN count(*) FILTER (WHERE abs(actual) + abs(predicted) = 0) > 0 THEN 'NaN'::DOUBLE
                      ELSE avg(200 * abs(actual - predicted) / nullif(abs(actual) + abs(predicted), 0)) END, 4) AS smape
    FROM (SELECT f.series, step, s.value AS actual, predicted FROM forecasts f JOIN series s ON f.series = s.series AND f.date = s.date
          WHERE fold = 4 AND model = 'SeasonalNaive7'), (VALUES (7), (14), (30)) h(horizon) WHERE step <= horizon GROUP BY 1, 2"""
SQL["m13_fit_artifact"] = """
    SELECT f.series, step, date, round(predicted, 4) AS predicted FROM forecasts f JOIN chosen c ON f.series = c.series AND f.model = c.model WHERE fold = 5 AND step <= 7"""
_BOUNDED = """(SELECT f.series, f.date, f.predicted, greatest(0, f.predicted + q.lo * sqrt(1 + f.step / 7)) AS lo, f.predicted + q.hi * sqrt(1 + f.step / 7) AS hi
    FROM forecasts f JOIN chosen c ON f.series = c.series AND f.model = c.model
    JOIN (SELECT series, model, quantile_cont(actual - predicted, 0.05) AS lo, quantile_cont(actual - predicted, 0.95) AS hi FROM backtest GROUP BY 1, 2) q
      ON q.series = c.series AND q.model = c.model WHERE f.fold = 5)"""
SQL["m12_generate_forecast"] = "SELECT date, " + ", ".join(
    f"round(max({source}) FILTER (WHERE series = 'daily_{short}'), 4) AS {name}"
    for short in ("orders", "revenue")
    for source, name in (("predicted", f"predicted_{short}"), ("lo", f"{short}_lower_bound"), ("hi", f"{short}_upper_bound"))
) + f" FROM {_BOUNDED} GROUP BY 1"
SQL["m10_residual_table"] = "SELECT * FROM residuals"
SQL["m11_interval_quantiles"] = """
    SELECT series, round(quantile_cont(actual - predicted, 0.05), 4) AS lower, round(quantile_cont(actual - predicted, 0.95), 4) AS upper
    FROM backtest WHERE model = 'SeasonalNaive7' GROUP BY 1"""

# --- the long metric table ------------------------------------------------

_S = {"late": "delay_days > 0", "ontime": "delay_days <= 0"}
_LONG = {
    "eligible_orders": ("SELECT count(*) FROM eligible_ds", False),
    "revenue": ("SELECT sum(value) FROM eligible_ds", True),
    "average_order_value": (f"SELECT {avg('value')} FROM eligible_ds", True),
    "unique_customers": ("SELECT count(*) FROM spending", False),
    "repeat_customer_rate_pct": ("SELECT 100 * avg(CAST(orders > 1 AS INTEGER)) FROM spending", True),
    "strongest_complete_month": (f"SELECT strftime(purchase_year_month, '%Y-%m') FROM ({COMPLETE}) ORDER BY revenue DESC LIMIT 1", False),
    "strongest_month_revenue": (f"SELECT max(revenue) FROM ({COMPLETE})", True),
    "strongest_month_orders": (f"SELECT orders FROM ({COMPLETE}) ORDER BY revenue DESC LIMIT 1", False),
    "average_delivery_days": ("SELECT avg(delivery_days) FROM delivered_ds", True),
    "late_delivery_rate_pct": ("SELECT 100 * avg(CAST(late AS INTEGER)) FROM delivered_ds", True),
    "freight_delivery_n": ("SELECT count(*) FROM delivered_ds", False),
    "average_review_score": ("SELECT avg(score) FROM reviews_ds", True),
    **{f"{side}_review_mean": (f"SELECT avg(score) FROM reviews_ds WHERE {cond}", True) for side, cond in _S.items()},
    **{f"{side}_review_median": (f"SELECT quantile_cont(score, 0.5) FROM reviews_ds WHERE {cond}", True) for side, cond in _S.items()},
    **{f"{side}_review_n": (f"SELECT count(*) FROM reviews_ds WHERE {cond}", False) for side, cond in _S.items()},
    "delay_review_n": ("SELECT count(*) FROM reviews_ds WHERE delay_days IS NOT NULL", False),
    **{f"{n}_pearson": (f"SELECT corr({x}, {y}) FROM {t}", True) for n, (t, x, y) in list(_PAIRS.items())[:3]},
    **{f"{n}_spearman": (f"SELECT {spearman(t, x, y)}", True) for n, (t, x, y) in _PAIRS.items() if n != "order_freight"},
    "minimum_item_price": ("SELECT min(price) FROM items_ds", True),
    "maximum_item_price": ("SELECT max(price) FROM items_ds", True),
    "negative_item_prices": ("SELECT count(*) FROM items_ds WHERE price < 0", False),
    "negative_freight_values": ("SELECT count(*) FROM items_ds WHERE freight < 0", False),
    "negative_delivery_durations": ("SELECT count(*) FROM eligible_ds WHERE delivery_days < 0", False),
    "purchase_date_min": ("SELECT min(bought) FROM eligible_ds", False),
    "purchase_date_max": ("SELECT max(bought) FROM eligible_ds", False),
    **{f"nation_{i}_delivery_mean_days": (f"SELECT avg(delivery_days) FROM delivered_ds WHERE customer_state = 'NATION_{i}'", True) for i in (1, 2, 3)},
    "products_missing_category": ("SELECT count(*) FROM products WHERE product_category_name IS NULL", False),
    "zero_installment_payments": ("SELECT count(*) FROM payments WHERE installments = 0", False),
    "undefined_payment_methods": ("SELECT count(*) FROM payments WHERE payment_type = 'N'", False),
    "delivered_missing_timestamp": ("SELECT count(*) FROM shipped WHERE order_status = 'F' AND arrived IS NULL", False),
}
SQL["f18_eda_metrics"] = " UNION ALL ".join(
    f"SELECT '{name}' AS metric, CAST({f'CAST(round(CAST(({sql}) AS DOUBLE), 6) AS DECIMAL(38,6))' if real else f'({sql})'} AS VARCHAR) AS value"
    for name, (sql, real) in _LONG.items()
)

# Training prevalence: the constant probability of the prior model.
SQL["k2_dummy_prior"] = f"""
    WITH parts AS (SELECT order_id, is_late_delivery, {_SPLIT} AS split FROM (
        SELECT *, row_number() OVER (ORDER BY purchase_timestamp, order_id) AS place, count(*) OVER () AS n FROM modeling))
    SELECT order_id, split, round((SELECT avg(is_late_delivery) FROM parts WHERE split = 'train'), 6) AS late_delivery_probability FROM parts"""

# Imputed, standardised and one-hot encoded rows: width and sum of each vector.
_PARTS = f"""(SELECT *, {_SPLIT} AS split FROM (
        SELECT *, row_number() OVER (ORDER BY purchase_timestamp, order_id) AS place, count(*) OVER () AS n FROM modeling))"""
_NUMBERS, _CLASSES = _FEATURES[:16], _FEATURES[16:]
SQL["k1_preprocess"] = f"""
    WITH parts AS {_PARTS},
    middle AS (SELECT {", ".join(f"coalesce(quantile_cont({c}::DOUBLE, 0.5), 0) AS {c}" for c in _NUMBERS)} FROM parts WHERE split = 'train'),
    filled AS (SELECT p.order_id, p.split, {", ".join(f"coalesce(p.{c}::DOUBLE, m.{c}) AS {c}" for c in _NUMBERS)},
        {", ".join(f"coalesce({c}, (SELECT {c} FROM parts WHERE split = 'train' AND {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)) AS {c}" for c in _CLASSES)}
        FROM parts p, middle m),
    moments AS (SELECT {", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _NUMBERS)} FROM filled WHERE split = 'train'),
    seen AS (SELECT {", ".join(f"list(DISTINCT {c}) AS {c}" for c in _CLASSES)} FROM filled WHERE split = 'train')
    SELECT order_id, CAST(16 + {" + ".join(f"len(v.{c})" for c in _CLASSES)} AS INTEGER) AS width,
        round({" + ".join(f"CASE WHEN s_{c} > 0 THEN (f.{c} - m_{c}) / s_{c} ELSE 0 END" for c in _NUMBERS)}
        + {" + ".join(f"CAST(list_contains(v.{c}, f.{c}) AS INTEGER)" for c in _CLASSES)}, 2) AS total
    FROM filled f, moments, seen v"""

ORACLE: dict[str, str] = {name: with_roles(sql) for name, sql in SQL.items()}
