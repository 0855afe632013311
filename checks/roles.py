"""SQL forms of the role tables; every check starts from these."""

import re as _re

ROLES = {
    "customers": """
        SELECT c_custkey AS customer_id, c_custkey // 2 AS customer_unique_id,
               CAST((c_custkey * 7) % 100000 AS INTEGER) AS zip_prefix,
               c_mktsegment AS customer_city, n_name AS customer_state
        FROM customer JOIN nation ON n_nationkey = c_nationkey""",
    "products": """
        SELECT p_partkey AS product_id,
               CASE WHEN p_size < 50 THEN p_type END AS product_category_name,
               p_size * 10 AS weight_g, p_size AS length_cm,
               CASE WHEN p_size % 7 <> 0 THEN p_size * 2 END AS height_cm, p_size * 3 AS width_cm
        FROM part""",
    "translation": """
        SELECT DISTINCT p_type AS product_category_name, lower(p_type) AS english FROM part WHERE p_type < 'P'""",
    "labelled": """
        SELECT product_id, coalesce(english, product_category_name, 'unknown') AS category,
               product_category_name, weight_g, length_cm, height_cm, width_cm
        FROM products LEFT JOIN translation USING (product_category_name)""",
    "sellers": """
        SELECT s_suppkey AS seller_id, n_name AS seller_state
        FROM supplier JOIN nation ON n_nationkey = s_nationkey""",
    "sales_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS order_status,
               o_orderdate AS bought
        FROM orders""",
    "shipped": """
        SELECT s.order_id, s.customer_id, s.order_status, s.bought,
               (SELECT min(l_shipdate) FROM lineitem WHERE l_orderkey = s.order_id AND l_shipdate >= s.bought) AS arrived,
               s.bought + INTERVAL 365 DAY AS promised
        FROM sales_orders s""",
    "items": """
        SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
               l_suppkey AS seller_id, CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
               CAST(l_extendedprice * l_tax AS DECIMAL(18,4)) AS freight
        FROM lineitem""",
    "payments": """
        SELECT l_orderkey AS order_id, l_returnflag AS payment_type, l_linenumber AS installments,
               CAST(l_extendedprice * (1.0::DOUBLE - l_discount) AS DECIMAL(18,4)) AS paid
        FROM lineitem""",
    "reviews": """
        SELECT l_orderkey * 10 + l_linenumber AS review_id, l_orderkey AS order_id,
               1 + CAST(l_quantity AS INTEGER) % 5 AS score,
               l_shipdate AS created, l_shipdate + INTERVAL 2 DAY AS answered
        FROM lineitem""",
    "eligible": "SELECT * FROM sales_orders WHERE order_status <> 'P'",
    "delivered": "SELECT *, arrived > promised AS late FROM shipped WHERE order_status = 'F' AND arrived IS NOT NULL",
    "order_value": "SELECT order_id, sum(paid) AS value, max(installments) AS plan FROM payments GROUP BY order_id",
    "paid_orders": "SELECT * FROM eligible JOIN order_value USING (order_id)",
    "order_score": "SELECT order_id, CAST(sum(score) AS DOUBLE) / count(score) AS score FROM reviews GROUP BY order_id",
    "people": """
        SELECT customer_unique_id, count(*) AS orders
        FROM eligible JOIN customers USING (customer_id) GROUP BY 1""",
    "spending": """
        SELECT customer_unique_id, count(*) AS orders, sum(coalesce(value, 0)) AS spend,
               min(bought) AS first_bought, max(bought) AS last_bought
        FROM eligible JOIN customers USING (customer_id) LEFT JOIN order_value USING (order_id) GROUP BY 1""",
    "paid_spending": """
        SELECT customer_unique_id, count(*) AS orders, sum(value) AS spend, max(bought) AS last_bought
        FROM paid_orders JOIN customers USING (customer_id) GROUP BY 1""",
    "latest_place": """
        SELECT customer_unique_id, customer_state, customer_city FROM (
            SELECT customer_unique_id, customer_state, customer_city,
                   row_number() OVER (PARTITION BY customer_unique_id ORDER BY bought DESC, order_id) AS place
            FROM eligible JOIN customers USING (customer_id)) WHERE place = 1""",
    "rfm": """
        SELECT customer_unique_id, first_bought, last_bought,
               CAST(reference_date - CAST(last_bought AS DATE) AS INTEGER) AS recency,
               CAST(orders AS INTEGER) AS frequency, spend AS monetary, customer_state, customer_city, reference_date
        FROM spending JOIN latest_place USING (customer_unique_id),
             (SELECT CAST(max(bought) AS DATE) + 1 AS reference_date FROM eligible)""",
    "items_ds": """
        SELECT i.*, product_category_name, category, order_status
        FROM items i JOIN sales_orders USING (order_id) JOIN labelled USING (product_id)""",
    "orders_ds": """
        SELECT s.order_id, customer_unique_id, order_status, bought, arrived, promised,
               value, plan, coalesce(charged, 0) AS freight, customer_city, customer_state,
               epoch(arrived - bought) / 86400.0::DOUBLE AS delivery_days,
               epoch(promised - bought) / 86400.0::DOUBLE AS promised_days,
               epoch(arrived - promised) / 86400.0::DOUBLE AS delay_days,
               CAST(date_trunc('month', bought) AS DATE) AS month
        FROM shipped s JOIN customers USING (customer_id) LEFT JOIN order_value USING (order_id)
        LEFT JOIN (SELECT order_id, sum(freight) AS charged FROM items GROUP BY 1) USING (order_id)""",
    "eligible_ds": "SELECT * FROM orders_ds WHERE order_status <> 'P'",
    "delivered_ds": "SELECT *, delay_days > 0 AS late FROM eligible_ds WHERE delivery_days IS NOT NULL",
    "reviews_ds": """
        SELECT r.*, CASE WHEN order_status = 'F' AND arrived IS NOT NULL
                         THEN CASE WHEN arrived > promised THEN 'late' ELSE 'on_time_or_early' END END AS delivery_status,
               CASE WHEN order_status = 'F' AND arrived IS NOT NULL
                    THEN epoch(arrived - promised) / 86400.0::DOUBLE END AS delay_days
        FROM reviews r JOIN shipped USING (order_id)""",
    "basket": """
        SELECT order_id, sum(price) AS item_value, sum(freight) AS freight_value, count(*) AS item_count,
               count(DISTINCT product_id) AS unique_products, count(DISTINCT seller_id) AS seller_count,
               sum(weight_g) AS weight, avg(length_cm) AS len, avg(height_cm) AS hei, avg(width_cm) AS wid
        FROM items JOIN labelled USING (product_id) JOIN sellers USING (seller_id) GROUP BY 1""",
    "main_category": """
        SELECT order_id, category FROM (
            SELECT order_id, category, row_number() OVER (PARTITION BY order_id ORDER BY count(*) DESC, category) AS place
            FROM items JOIN labelled USING (product_id) GROUP BY 1, 2) WHERE place = 1""",
    "main_state": """
        SELECT order_id, seller_state FROM (
            SELECT order_id, seller_state,
                   row_number() OVER (PARTITION BY order_id ORDER BY count(*) DESC, seller_state) AS place
            FROM items JOIN sellers USING (seller_id) GROUP BY 1, 2) WHERE place = 1""",
    "main_type": """
        SELECT order_id, payment_type FROM (
            SELECT order_id, payment_type,
                   row_number() OVER (PARTITION BY order_id ORDER BY sum(paid) DESC, payment_type) AS place
            FROM payments GROUP BY 1, 2) WHERE place = 1""",
    "modeling": """
        SELECT d.order_id, bought AS purchase_timestamp,
               CAST(month(bought) AS INTEGER) AS purchase_month, CAST(isodow(bought) AS INTEGER) AS purchase_day_of_week,
               CAST(hour(bought) AS INTEGER) AS purchase_hour, zip_prefix // 1000 AS customer_zip_region,
               CAST(item_value AS DOUBLE) AS item_value, CAST(freight_value AS DOUBLE) AS freight_value,
               item_count, unique_products, seller_count, CAST(weight AS DOUBLE) AS total_product_weight_g,
               round(len, 6) AS average_product_length_cm, round(hei, 6) AS average_product_height_cm,
               round(wid, 6) AS average_product_width_cm, CAST(value AS DOUBLE) AS payment_value,
               CAST(plan AS INTEGER) AS payment_installments, epoch(promised - bought) / 86400.0::DOUBLE AS estimated_delivery_window_days,
               customer_state, category AS dominant_product_category, seller_state AS dominant_seller_state,
               CASE WHEN customer_state = seller_state THEN 'yes' ELSE 'no' END AS same_customer_seller_state,
               payment_type, CASE WHEN late THEN 1 ELSE 0 END AS is_late_delivery
        FROM delivered d JOIN customers USING (customer_id) JOIN basket USING (order_id)
        LEFT JOIN main_category USING (order_id) LEFT JOIN main_state USING (order_id)
        LEFT JOIN order_value USING (order_id) LEFT JOIN main_type USING (order_id)""",
    "daily": """
        SELECT day AS date, coalesce(n, 0) AS daily_orders, coalesce(revenue, 0) AS daily_revenue
        FROM (SELECT CAST(unnest(generate_series(min(bought), max(bought), INTERVAL 1 DAY)) AS DATE) AS day FROM eligible)
        LEFT JOIN (SELECT CAST(bought AS DATE) AS day, count(*) AS n, sum(coalesce(value, 0)) AS revenue
                   FROM eligible LEFT JOIN order_value USING (order_id) GROUP BY 1) USING (day)""",
    "series": """
        SELECT 'daily_orders' AS series, date, CAST(daily_orders AS DOUBLE) AS value FROM daily
        UNION ALL SELECT 'daily_revenue', date, CAST(daily_revenue AS DOUBLE) FROM daily""",
    "scored": """
        SELECT order_id, bought, CAST(late AS INTEGER) AS label, (order_id * 7919 % 1000) / 1000.0::DOUBLE AS score
        FROM delivered""",
    "score_counts": """
        SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg
        FROM scored GROUP BY 1""",
    "score_sums": """
        SELECT score, pos, neg, CAST(sum(pos) OVER (ORDER BY score DESC) AS BIGINT) AS tp,
               CAST(sum(neg) OVER (ORDER BY score DESC) AS BIGINT) AS fp,
               CAST(sum(pos) OVER () AS BIGINT) AS p, CAST(sum(neg) OVER () AS BIGINT) AS n
        FROM score_counts""",
    "event_days": """
        SELECT series, day AS date, coalesce(v, 0)::DOUBLE AS value
        FROM (SELECT event_type AS series, CAST(unnest(generate_series(CAST(min(ts) AS DATE), CAST(max(ts) AS DATE), INTERVAL 1 DAY)) AS DATE) AS day
              FROM events GROUP BY 1)
        LEFT JOIN (SELECT event_type AS series, CAST(ts AS DATE) AS day, count(*) AS v FROM events GROUP BY 1, 2)
        USING (series, day)""",
    "lagged": """
        SELECT series, date, value, lag(value, 1) OVER w AS lag_1, lag(value, 7) OVER w AS lag_7
        FROM series WINDOW w AS (PARTITION BY series ORDER BY date)""",
    # History before each fold (1-3), before the holdout (4) and in full (5).
    "fold_hist": """
        SELECT series, CAST(f AS INTEGER) AS fold, list(value ORDER BY date) AS v, max(date) AS last_date
        FROM (SELECT *, max(date) OVER (PARTITION BY series) AS final FROM series), range(1, 6) g(f)
        WHERE date < final - CAST(29 + (4 - f) * 30 AS INTEGER) GROUP BY 1, 2""",
    "rolled": """
        WITH RECURSIVE walk AS (
            SELECT series, fold, 0 AS step, last_date, v[-7:] AS tail FROM fold_hist
            UNION ALL
            SELECT series, fold, step + 1, last_date, list_append(tail[2:], greatest(0, list_sum(tail) / 7)) FROM walk WHERE step < 30)
        SELECT series, fold, 'RollingMean7' AS model, CAST(step AS INTEGER) AS step, last_date + CAST(step AS INTEGER) AS date, tail[-1] AS predicted
        FROM walk WHERE step > 0""",
    "forecasts": """
        SELECT series, fold, model, CAST(step AS INTEGER) AS step, last_date + CAST(step AS INTEGER) AS date,
               greatest(0, CASE model WHEN 'NaiveLastValue' THEN v[-1] WHEN 'HistoricalMean' THEN list_avg(v) ELSE v[-7:][(step - 1) % 7 + 1] END) AS predicted
        FROM fold_hist, range(1, 31) g(step), (VALUES ('NaiveLastValue'), ('HistoricalMean'), ('SeasonalNaive7')) m(model)
        UNION ALL SELECT * FROM rolled""",
    "backtest": """
        SELECT f.series, f.fold, f.model, f.step, f.date, s.value AS actual, f.predicted
        FROM forecasts f JOIN series s ON f.series = s.series AND f.date = s.date WHERE f.fold <= 3""",
    "fold_errors": """
        SELECT series, model, fold, avg(abs(actual - predicted)) AS mae, sqrt(avg((actual - predicted) ** 2)) AS rmse,
               coalesce(avg(abs((actual - predicted) / nullif(actual, 0))) * 100, 'NaN'::DOUBLE) AS mape,
               CASE WHEN count(*) FILTER (WHERE abs(actual) + abs(predicted) = 0) > 0 THEN 'NaN'::DOUBLE
                    ELSE avg(200 * abs(actual - predicted) / nullif(abs(actual) + abs(predicted), 0)) END AS smape
        FROM backtest GROUP BY 1, 2, 3""",
    "fold_summary": """
        SELECT series, model, avg(mae) AS mae, avg(rmse) AS rmse,
            coalesce(avg(mape) FILTER (WHERE NOT isnan(mape)), 'NaN'::DOUBLE) AS mape,
            coalesce(avg(smape) FILTER (WHERE NOT isnan(smape)), 'NaN'::DOUBLE) AS smape
        FROM fold_errors GROUP BY 1, 2""",
    "chosen": """
        SELECT series, CASE WHEN (max(mae) FILTER (WHERE model = 'SeasonalNaive7') - min(mae)) / max(mae) FILTER (WHERE model = 'SeasonalNaive7') < 0.01
                        THEN 'SeasonalNaive7' ELSE arg_min(model, mae) END AS model FROM fold_summary GROUP BY 1""",
    "residuals": """
        SELECT date, actual, predicted, actual - predicted AS residual, dayname(date) AS weekday
        FROM backtest WHERE model = 'SeasonalNaive7' AND series = 'daily_orders'""",
    "rfm_scored": """
        SELECT *, 6 - greatest(1, ((r - 1) * 5 + n - 2) // (n - 1)) AS r_score,
               least(greatest(frequency, 1), 5) AS f_score,
               greatest(1, ((m - 1) * 5 + n - 2) // (n - 1)) AS m_score
        FROM (SELECT *, row_number() OVER (ORDER BY recency, customer_unique_id) AS r,
                     row_number() OVER (ORDER BY monetary, customer_unique_id) AS m, count(*) OVER () AS n FROM rfm)""",
    "segments": """
        SELECT *, CASE
            WHEN r_score >= 4 AND f_score >= 3 AND m_score >= 4 THEN 'Champions'
            WHEN r_score >= 3 AND f_score >= 3 THEN 'Loyal Customers'
            WHEN r_score <= 2 AND m_score >= 4 THEN 'High Value At Risk'
            WHEN r_score = 5 AND f_score = 1 THEN 'New Customers'
            WHEN r_score >= 4 AND f_score = 2 THEN 'Potential Loyalists'
            WHEN r_score >= 4 AND m_score >= 3 THEN 'Promising'
            WHEN r_score <= 2 AND f_score >= 2 THEN 'At Risk'
            WHEN r_score = 3 THEN 'Needs Attention'
            WHEN r_score <= 2 THEN 'Hibernating'
            ELSE 'Promising' END AS rfm_segment
        FROM rfm_scored""",
    "errors": """
        SELECT *, CASE WHEN actual = 0 AND predicted = 1 THEN 'false_positive'
                       WHEN actual = 1 AND predicted = 0 THEN 'false_negative' ELSE 'correct' END AS error_type
        FROM (SELECT *, is_late_delivery AS actual,
                     CASE WHEN (order_id * 7919 % 1000) / 1000.0::DOUBLE >= 0.55::DOUBLE THEN 1 ELSE 0 END AS predicted FROM modeling)""",
}


_NAME = _re.compile(r"[a-z_]+")


def with_roles(select: str) -> str:
    """Prefix ``select`` with the role definitions it uses, in definition order."""
    needed: set[str] = set()
    open_texts = [select]
    while open_texts:
        for word in set(_NAME.findall(open_texts.pop())):
            if word in ROLES and word not in needed:
                needed.add(word)
                open_texts.append(ROLES[word])
    if not needed:
        return select
    parts = [f"{name} AS ({ROLES[name].strip()})" for name in ROLES if name in needed]
    lead = "WITH RECURSIVE " if select.lstrip().upper().startswith("WITH RECURSIVE ") else "WITH "
    body = select.lstrip()
    for opener in ("WITH RECURSIVE ", "WITH "):
        if body.upper().startswith(opener):
            return lead + ",\n".join(parts) + ",\n" + body[len(opener):]
    return lead + ",\n".join(parts) + "\n" + body
