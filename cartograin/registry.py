"""Every implemented query by name, bound to the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import expressions as X
from .operators import evaluation, joins, quality, ranking, statistics, timeseries
from .operators.joins import decimals_to_double
from .plans import customers, datasets, delivery, eda, feedback, forecasting, late_delivery, products, sales, segmentation, validation
from .session import checkpointed
from .sources.binding import RULES, Roles, bind

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str) -> Callable[[Callable[[Roles], DataFrame]], Callable[[Roles], DataFrame]]:
    """Register a query over the bound roles; decimals are reported as double."""

    def register(build: Callable[[Roles], DataFrame]) -> Callable[[Roles], DataFrame]:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return decimals_to_double(build(bind(spark, folder)))

        REGISTRY[name] = run
        return build

    return register


def run_suite(spark: SparkSession, folder: str, only: str | None = None) -> dict[str, DataFrame]:
    """All queries in order of letter and number, or the one of the given name or
    inventory id; an unknown name is refused with the list of choices."""

    def place(name: str) -> tuple[str, int, str]:
        first = name.partition("_")[0]
        return first[0], int(first[1:]), name

    ordered = sorted(REGISTRY, key=place)
    chosen = [n for n in ordered if only is None or n == only or n.partition("_")[0] == only.lower()]
    if not chosen:
        raise ValueError(f"no query {only!r}; choices: {', '.join(ordered)}")
    return {name: REGISTRY[name](spark, folder) for name in chosen}


def tables(r: Roles) -> dict[str, DataFrame]:
    return {
        "customers": r.customers,
        "products": r.products,
        "sellers": r.sellers,
        "product_category_translation": r.translation,
        "geolocation": r.geolocation,
        "orders": r.orders,
        "order_items": r.order_items,
        "payments": r.payments,
        "reviews": r.reviews,
    }


def rounded(df: DataFrame, digits: int = 6, **others: int) -> DataFrame:
    """Doubles that depend on the order of addition, cut to stable digits
    (``others`` gives columns with digits of their own)."""
    return df.select(
        *[
            F.round(name, others.get(name, digits)).alias(name) if kind == "double" else F.col(name)
            for name, kind in decimals_to_double(df).dtypes
        ]
    )


# --- data quality ---------------------------------------------------------


@query("b1_table_row_counts")
def _(r):
    return quality.table_row_counts(tables(r))


@query("b2_distinct_counts")
def _(r):
    return validation.key_cardinality(tables(r))


@query("b3_duplicate_keys")
def _(r):
    return quality.duplicate_keys(r.order_items, ["order_id", "order_item_id"])


@query("b3_duplicate_key_summary")
def _(r):
    return validation.key_duplicates(tables(r))


@query("b4_null_counts")
def _(r):
    return validation.relationship_nulls(tables(r))


@query("b5_orphan_counts")
def _(r):
    return validation.relationship_orphans(tables(r))


@query("b6_range_check")
def _(r):
    return quality.range_check(r.reviews, "review_score", 1, 5)


@query("b7_quality_counters")
def _(r):
    return validation.quality_counters(r.products, r.payments, r.shipped_orders, RULES, undefined_type="N")


def orders_ds(r: Roles) -> DataFrame:
    plain = datasets.orders_dataset(r.shipped_orders, r.customers, r.payments, r.order_items)
    return datasets.orders_features(plain)


def items_ds(r: Roles) -> DataFrame:
    return datasets.items_dataset(r.order_items, r.orders, r.products, r.translation)


def reviews_ds(r: Roles) -> DataFrame:
    return datasets.reviews_dataset(r.reviews, r.shipped_orders, RULES)


def customers_ds(r: Roles) -> DataFrame:
    return datasets.customers_dataset(r.orders, r.customers, r.payments, RULES)


def analytical(r: Roles) -> dict[str, DataFrame]:
    return {
        "orders": orders_ds(r),
        "items": items_ds(r),
        "reviews": reviews_ds(r),
        "customers": customers_ds(r),
        "quality": validation.quality_counters(r.products, r.payments, r.shipped_orders, RULES, undefined_type="N"),
    }


@query("b8_quality_profile")
def _(r):
    return validation.dataset_profile(analytical(r))


@query("b9_anomaly_counts")
def _(r):
    return validation.anomaly_counts(orders_ds(r), items_ds(r), RULES)


def _requests(r: Roles) -> DataFrame:
    return modeling(r).select(*late_delivery.FEATURES, late_delivery.KEY)


def modeling(r: Roles) -> DataFrame:
    return late_delivery.modeling_dataset({**tables(r), "orders": r.shipped_orders}, RULES)


@query("b13_feature_audit")
def _(r):
    return late_delivery.feature_audit(modeling(r))


@query("b14_validate_requests")
def _(r):
    """Rejected rows of every kind: the bounds are applied to inputs shifted so
    that some rows break them."""
    shifted = _requests(r).withColumns(
        {
            "purchase_month": F.col("purchase_month") + 1,
            "freight_value": F.col("freight_value") - 50,
            "payment_value": F.when(F.col("item_count") < 7, F.col("payment_value")),
        }
    )
    allowed = [*late_delivery.FEATURES, late_delivery.KEY]
    valid, rejected = quality.split_valid(shifted, validation.delivery_request_rules(state_length=None), allowed)
    columns = ["order_id"]
    return valid.select(*columns, F.lit("").alias("reasons")).unionByName(
        rejected.select(*columns, F.array_join(F.array_sort("reasons"), ",").alias("reasons"))
    )


@query("b14_validate_segment_requests")
def _(r):
    rfm = rfm_dataset(r).select("customer_unique_id", (F.col("recency") - 30).alias("recency"), "frequency", "monetary")
    valid, rejected = quality.split_valid(rfm, validation.segment_request_rules(), rfm.columns)
    return valid.agg(F.count(F.lit(1)).alias("valid")).crossJoin(rejected.agg(F.count(F.lit(1)).alias("rejected")))


@query("b15_describe_stats")
def _(r):
    return rounded(quality.describe_stats(rfm_dataset(r), segmentation.RFM))


@query("b15_describe_percentiles")
def _(r):
    return rounded(quality.describe_stats(r.payments, ["payment_value"], (0.01, 0.05, 0.9, 0.99)), 4)


# --- projections and predicates -------------------------------------------


@query("c1_eligible_orders")
def _(r):
    return r.orders.filter(X.is_eligible(RULES))


@query("c2_delivered_orders")
def _(r):
    return r.shipped_orders.filter(X.is_delivered(RULES))


@query("c3_category_label")
def _(r):
    return products.labelled_products(r.products, r.translation)


@query("c4_delivery_status")
def _(r):
    return r.shipped_orders.select("order_id", X.delivery_status(RULES).alias("delivery_status"))


def _delay(r: Roles) -> DataFrame:
    return r.shipped_orders.withColumn(
        "delay", X.days_between("order_estimated_delivery_date", "order_delivered_customer_date")
    )


@query("c5_delay_band")
def _(r):
    return _delay(r).select(
        "order_id", X.delay_band("delay").alias("delay_band"), X.delay_band_order("delay").alias("band_order")
    )


@query("c6_early_ontime_late")
def _(r):
    return _delay(r).select("order_id", X.punctuality("delay").alias("punctuality"))


@query("c7_installment_band")
def _(r):
    banded = r.payments.withColumn("installments", F.col("payment_installments") * 2 - 1)
    return banded.groupBy("installments", X.installment_band("installments").alias("band")).agg(F.count(F.lit(1)).alias("n"))


@query("c8_customer_type")
def _(r):
    people = sales.orders_per_person(r.orders.filter(X.is_eligible(RULES)), r.customers)
    return people.select("customer_unique_id", X.customer_type("orders").alias("customer_type"))


@query("c9_risk_label")
def _(r):
    return scored_orders(r).select("order_id", X.risk_label("score", 0.55).alias("risk_label"))


@query("c10_calendar_features")
def _(r):
    return r.table("events").select("event_id", *[c.alias(n) for n, c in X.calendar_columns("ts").items()])


@query("c11_duration_features")
def _(r):
    columns = X.duration_columns("order_purchase_timestamp", "order_delivered_customer_date", "order_estimated_delivery_date")
    return r.shipped_orders.select("order_id", *[c.alias(n) for n, c in columns.items()])


@query("c12_percentile_cap")
def _(r):
    capped = statistics.percentile_cap(r.order_items, ["price", "freight_value"], 0.99)
    return capped.select("order_id", "order_item_id", "product_id", "price", "freight_value")


@query("c13_min_support")
def _(r):
    grouped = r.orders.groupBy("customer_id").agg(F.count(F.lit(1)).alias("orders"))
    return grouped.filter(F.col("orders") >= 12)


@query("c14_zip_region")
def _(r):
    return r.customers.select("customer_id", X.zip_region("customer_zip_code_prefix").alias("zip_region"))


@query("c15_same_state_flag")
def _(r):
    return modeling(r).select("order_id", "same_customer_seller_state")


# --- joins ----------------------------------------------------------------


@query("d1_inner_lookup")
def _(r):
    return joins.lookup_join(r.orders, r.customers, "customer_id").select(
        "order_id", "customer_id", "customer_unique_id", "customer_state"
    )


@query("d2_join_at_grain_inner")
def _(r):
    value = {"order_value": F.sum("payment_value"), "records": F.count(F.lit(1))}
    return joins.join_at_grain(r.orders, r.payments, "order_id", value).select("order_id", "order_value", "records")


@query("d3_join_at_grain_left")
def _(r):
    value = {"order_value": F.sum("payment_value")}
    return joins.join_at_grain(r.orders, r.payments, "order_id", value, how="left", fill=0).select("order_id", "order_value")


@query("d4_star_join")
def _(r):
    star = joins.star_join(r.order_items, r.orders, r.products, r.translation)
    return star.groupBy("order_status", X.category_label().alias("category")).agg(
        F.count(F.lit(1)).alias("items"), F.sum("price").alias("price")
    )


@query("d5_shift_self_join")
def _(r):
    monthly = r.orders.groupBy(X.month_start("order_purchase_timestamp").alias("month")).agg(F.count(F.lit(1)).alias("orders"))
    kept = monthly.filter(F.month("month") != 6)
    return joins.shift_self_join(kept, "month", {"_month_ago": 1, "_year_ago": 12}, ["orders"])


@query("d6_with_scalar")
def _(r):
    last = r.orders.agg(F.max("order_purchase_timestamp").cast("date").alias("last_day"))
    return joins.with_scalar(r.orders, last).select(
        "order_id", F.datediff("last_day", F.col("order_purchase_timestamp").cast("date")).alias("age_days")
    )


@query("d7_orphans")
def _(r):
    return joins.orphans(r.orders, r.payments, "order_id").select("order_id", "order_status")


@query("d8_join_dominant")
def _(r):
    weight = F.col("payment_value")
    joined = joins.join_dominant(r.orders, r.payments, "order_id", "payment_type", "main_type", weight)
    return joined.select("order_id", "main_type")


@query("d9_merge_inner")
def _(r):
    scored = joins.lookup_join(r.order_items, products.order_scores(r.reviews), "order_id")
    return scored.groupBy("product_id").agg(F.count(F.lit(1)).alias("items"), F.round(F.sum("order_score"), 4).alias("score_sum"))


@query("d10_merge_group_strings")
def _(r):
    profile = r.customers.groupBy("customer_city").agg(F.count(F.lit(1)).alias("customers"))
    states = statistics.top_values_joined(r.customers, "customer_city", "customer_state", 3, "top_states")
    return profile.join(states, "customer_city")


@query("d11_assemble_kpis")
def _(r):
    return joins.assemble_row(
        r.orders.agg(F.count(F.lit(1)).alias("orders")),
        r.payments.agg(F.sum("payment_value").alias("paid")),
        r.customers.agg(F.countDistinct("customer_unique_id").alias("people")),
        r.reviews.agg(F.round(X.mean("review_score"), 6).alias("score")),
    )


@query("d12_date_spine")
def _(r):
    daily = r.orders.groupBy("order_status", F.col("order_purchase_timestamp").cast("date").alias("date")).agg(
        F.count(F.lit(1)).alias("orders")
    )
    return joins.date_spine(daily, "date", ["orders"], ["order_status"])


# --- analytical queries ---------------------------------------------------


@query("e1_business_overview")
def _(r):
    return sales.business_overview(r.orders, r.customers, r.payments, r.products, r.sellers, RULES)


@query("e2_status_mix")
def _(r):
    return sales.status_mix(r.orders)


@query("e3_monthly_sales_growth")
def _(r):
    return sales.monthly_sales_growth(r.orders, r.payments, RULES)


@query("e4_top_months")
def _(r):
    return sales.top_months(r.orders, r.payments, RULES)


@query("e5_weekday_sales")
def _(r):
    return sales.weekday_sales(r.orders, r.payments, RULES)


@query("e6_repeat_rate")
def _(r):
    return customers.repeat_rate(r.orders, r.customers, RULES)


@query("e7_top_customers")
def _(r):
    return customers.top_customers(r.orders, r.customers, r.payments, RULES)


@query("e8_customer_spend_stats")
def _(r):
    return customers.customer_spend_stats(r.orders, r.customers, r.payments, RULES)


@query("e9_customers_by_state")
def _(r):
    return customers.customers_by_state(r.orders, r.customers, RULES)


@query("e10_customers_by_city")
def _(r):
    return customers.customers_by_city(r.orders, r.customers, RULES)


@query("e11_rfm_averages")
def _(r):
    return customers.rfm_averages(r.orders, r.customers, r.payments, RULES)


@query("e12_category_sales")
def _(r):
    return products.category_sales(r.order_items, r.orders, r.products, r.translation, RULES)


@query("e13_top_products")
def _(r):
    return products.top_products(r.order_items, r.orders, r.products, r.translation, RULES)


@query("e14_category_reviews")
def _(r):
    return products.category_reviews(r.order_items, r.products, r.reviews, r.translation)


@query("e15_top_sellers")
def _(r):
    return products.top_sellers(r.order_items, r.orders, r.sellers, RULES)


@query("e16_sellers_by_state")
def _(r):
    return products.sellers_by_state(r.sellers)


@query("e17_revenue_concentration")
def _(r):
    return products.revenue_concentration(r.order_items, r.orders, RULES)


@query("e18_delivery_summary")
def _(r):
    return delivery.delivery_summary(r.shipped_orders, r.customers, RULES)


@query("e19_delivery_by_state")
def _(r):
    return delivery.delivery_by_state(r.shipped_orders, r.customers, RULES)


@query("e20_delivery_by_month")
def _(r):
    return delivery.delivery_by_month(r.shipped_orders, RULES)


@query("e21_freight_buckets")
def _(r):
    return delivery.freight_buckets(r.shipped_orders, r.order_items, RULES, 0, 20_000, 5)


@query("e22_review_summary")
def _(r):
    return feedback.review_summary(r.reviews)


@query("e23_review_distribution")
def _(r):
    return feedback.review_distribution(r.reviews)


@query("e24_review_by_status")
def _(r):
    return feedback.review_by_status(r.reviews, r.shipped_orders, RULES)


@query("e25_seller_reviews")
def _(r):
    return products.seller_reviews(r.order_items, r.reviews)


@query("e26_review_by_delay_band")
def _(r):
    return feedback.review_by_delay_band(r.reviews, r.shipped_orders, RULES)


@query("e27_payment_types")
def _(r):
    return feedback.payment_types(r.payments)


@query("e28_installment_mix")
def _(r):
    return feedback.installment_mix(r.payments)


@query("e29_installment_bands")
def _(r):
    return feedback.installment_bands(r.payments)


@query("e30_installment_corr")
def _(r):
    return feedback.installment_correlation(r.payments, "R")


@query("e31_executive_kpis")
def _(r):
    return sales.executive_kpis(r.shipped_orders, r.payments, r.customers, r.reviews, RULES)


@query("e32_overview")
def _(r):
    return rounded(sales.overview(r.shipped_orders, r.payments, r.customers, RULES))


@query("e33_monthly_sales")
def _(r):
    return rounded(sales.monthly_sales(r.orders, r.payments, RULES))


@query("e34_top_categories")
def _(r):
    return products.top_categories(r.order_items, r.orders, r.products, r.translation, RULES)


@query("e35_monthly_delivery")
def _(r):
    return rounded(delivery.monthly_delivery(r.shipped_orders, RULES))


@query("e36_customer_type_mix")
def _(r):
    return rounded(customers.customer_type_mix(r.orders, r.customers, r.payments, RULES))


@query("e37_orders_dataset")
def _(r):
    return datasets.orders_dataset(r.shipped_orders, r.customers, r.payments, r.order_items)


@query("e38_items_dataset")
def _(r):
    return datasets.items_dataset(r.order_items, r.orders, r.products, r.translation)


@query("e39_reviews_dataset")
def _(r):
    return datasets.reviews_dataset(r.reviews, r.shipped_orders, RULES)


@query("e40_customers_dataset")
def _(r):
    return datasets.customers_dataset(r.orders, r.customers, r.payments, RULES)


def rfm_dataset(r: Roles) -> DataFrame:
    return customers.rfm_dataset(r.orders, r.customers, r.payments, RULES)


@query("e41_rfm_dataset")
def _(r):
    return rfm_dataset(r)


@query("e42_modeling_dataset")
def _(r):
    return rounded(modeling(r))


def daily(r: Roles) -> DataFrame:
    return datasets.daily_series(r.orders, r.payments, RULES)


@query("e43_daily_series")
def _(r):
    return datasets.daily_series(r.orders, r.payments, RULES, "1996-01-01", "2000-12-31")


# --- exploratory tables ---------------------------------------------------


@query("f1_monthly_complete")
def _(r):
    return rounded(eda.monthly_complete(orders_ds(r), RULES))


def _capped_histogram(frame: DataFrame, column: str, bins: int) -> DataFrame:
    return rounded(statistics.histogram(frame, column, bins, cap=0.99))


@query("f2_order_value_histogram")
def _(r):
    return _capped_histogram(eda.eligible(orders_ds(r), RULES), "order_value", 60)


@query("f2_customer_spend_histogram")
def _(r):
    return _capped_histogram(customers_ds(r), "total_spend", 60)


@query("f2_delivery_days_histogram")
def _(r):
    return _capped_histogram(eda.delivered(orders_ds(r), RULES), "delivery_days", 55)


@query("f2_item_price_histogram")
def _(r):
    return _capped_histogram(eda.eligible(items_ds(r), RULES), "price", 60)


@query("f2_item_freight_histogram")
def _(r):
    return _capped_histogram(eda.eligible(items_ds(r), RULES), "freight_value", 60)


@query("f3_top_category_revenue")
def _(r):
    return eda.top_category_revenue(items_ds(r), RULES)


@query("f4_top_category_items")
def _(r):
    return eda.top_category_items(items_ds(r), RULES)


@query("f5_top_state_customers")
def _(r):
    return eda.top_state_customers(customers_ds(r))


@query("f6_top_state_revenue")
def _(r):
    return eda.top_state_revenue(customers_ds(r))


@query("f7_repeat_mix")
def _(r):
    return eda.repeat_mix(customers_ds(r))


@query("f8_order_frequency")
def _(r):
    return eda.order_frequency(customers_ds(r))


@query("f9_late_rate_by_state")
def _(r):
    return rounded(eda.delivery_rates(orders_ds(r), "customer_state", RULES).select("customer_state", "late_rate", "orders"))


@query("f10_duration_by_state")
def _(r):
    return rounded(eda.delivery_rates(orders_ds(r), "customer_state", RULES).select("customer_state", "delivery_days", "orders"))


@query("f11_late_rate_by_month")
def _(r):
    return rounded(eda.delivery_rates(orders_ds(r), "purchase_year_month", RULES).select("purchase_year_month", "late_rate", "orders"))


@query("f12_review_score_counts")
def _(r):
    return eda.review_score_counts(reviews_ds(r))


@query("f13_review_by_status")
def _(r):
    return rounded(eda.review_by_status(reviews_ds(r)))


@query("f14_review_by_delay_band")
def _(r):
    return rounded(eda.review_by_delay(reviews_ds(r)))


@query("f15_hexbin_freight_days")
def _(r):
    return rounded(eda.freight_against_days(orders_ds(r), RULES), 4)


@query("f15_hexbin_value_freight")
def _(r):
    return rounded(eda.value_against_freight(orders_ds(r), RULES), 4)


@query("f16_value_by_installments")
def _(r):
    return rounded(eda.value_by_installments(orders_ds(r), RULES))


@query("f17_category_review_extremes")
def _(r):
    return eda.category_review_extremes(items_ds(r), reviews_ds(r), RULES)


@query("f18_eda_metrics")
def _(r):
    return eda.eda_metrics(analytical(r), ["NATION_1", "NATION_2", "NATION_3"], RULES)


@query("f19_pearson")
def _(r):
    return rounded(eda.pearson_table(orders_ds(r), reviews_ds(r), RULES))


@query("f20_spearman")
def _(r):
    return rounded(eda.spearman_table(orders_ds(r), reviews_ds(r), RULES))


@query("f21_late_against_ontime")
def _(r):
    return rounded(eda.late_against_ontime(reviews_ds(r)))


@query("f22_best_month")
def _(r):
    return eda.best_month(orders_ds(r), RULES)


@query("f23_state_duration")
def _(r):
    return rounded(eda.state_duration(orders_ds(r), ["NATION_1", "NATION_2", "NATION_3"], RULES))


@query("f24_top_category")
def _(r):
    return eda.top_category(items_ds(r), RULES)


@query("f25_weekday_means")
def _(r):
    return rounded(eda.weekday_means(daily(r)))


@query("f25_month_sums")
def _(r):
    return eda.month_sums(daily(r))


@query("f25_rolling_means")
def _(r):
    return rounded(eda.rolling_means(daily(r)))


@query("f25_spikes")
def _(r):
    return eda.spikes(daily(r))


@query("f26_weekday_residuals")
def _(r):
    return rounded(eda.weekday_residuals(residuals(r)))


@query("f26_largest_residuals")
def _(r):
    return rounded(eda.largest_residuals(residuals(r), 10))


@query("f27_rfm_log_histograms")
def _(r):
    rfm = checkpointed(rfm_dataset(r))
    parts = []
    for measure in segmentation.RFM:
        logs = rfm.select(F.round(F.log1p(F.col(measure).cast("double")), 9).alias("v"))
        parts.append(rounded(statistics.histogram(logs, "v", 60), 5).withColumn("measure", F.lit(measure)))
    return joins.union_all(*parts)


@query("f27_scatter_sample")
def _(r):
    return ranking.sample_exact(rfm_dataset(r), "customer_unique_id", 20_000).select("customer_unique_id", "recency", "monetary")


@query("f28_sample_rows")
def _(r):
    return ranking.top_k(r.orders, ["order_id"], 3)


# --- windows and ranks ----------------------------------------------------


@query("h1_share_of_total")
def _(r):
    revenue = r.order_items.groupBy("seller_id").agg(F.sum("price").alias("revenue"))
    return rounded(ranking.share_of_total(revenue, "revenue", "share"))


@query("h2_global_row_number")
def _(r):
    return ranking.distributed_rank(r.order_items.groupBy("product_id").agg(F.sum("price").alias("revenue")), [F.desc("revenue"), "product_id"])


@query("h3_dominant_value")
def _(r):
    detail = joins.lookup_join(
        r.order_items, products.labelled_products(r.products, r.translation), "product_id"
    )
    return joins.dominant_value(detail, "order_id", "category")


@query("h4_latest_row")
def _(r):
    return joins.latest_row(r.orders, "customer_id", "order_purchase_timestamp", "order_id", ["order_id", "order_status"])


@query("h5_quantile_bin")
def _(r):
    binned = ranking.quantile_bin(rfm_dataset(r), "monetary", 5, "customer_unique_id", "bin")
    return binned.select("customer_unique_id", "bin")


@query("h6_quantile_band")
def _(r):
    values = checkpointed(modeling(r).select("order_id", "item_value"))  # ranked, then banded
    banded = statistics.quantile_band(values, "item_value", 4, "band")
    return rounded(banded, 4)


# Deviations of revenue carry fewer stable digits than its means.
STD_DIGITS = {"rolling_std_7": 3, "rolling_std_28": 3}


def order_series(r: Roles) -> DataFrame:
    return forecasting.to_series(daily(r))


@query("h7_lags")
def _(r):
    return timeseries.lags(order_series(r), ["series"], "date", "value")


@query("h8_rolling_previous")
def _(r):
    return rounded(timeseries.rolling_previous(order_series(r), ["series"], "date", "value"), **STD_DIGITS)


@query("h9_drop_incomplete")
def _(r):
    lagged = timeseries.lags(order_series(r), ["series"], "date", "value", [28])
    return timeseries.drop_incomplete(lagged).groupBy("series").agg(F.min("date").alias("first_day"), F.count(F.lit(1)).alias("days"))


@query("h10_temporal_split")
def _(r):
    return ranking.temporal_split(r.orders, "order_purchase_timestamp", "order_id").select("order_id", "split")


@query("h10_split_summary")
def _(r):
    return rounded(late_delivery.split_summary(late_delivery.split_dataset(checkpointed(modeling(r)))))


@query("h11_expanding_folds")
def _(r):
    return timeseries.expanding_folds(order_series(r), ["series"])


# --- sort, limit, set operations ------------------------------------------


@query("i1_top_k")
def _(r):
    return ranking.top_k(r.order_items.select("order_id", "order_item_id", "product_id", "price"), [F.desc("price"), "order_id", "order_item_id", "product_id"], 20)


@query("i2_head_tail")
def _(r):
    spend = r.orders.groupBy("customer_id").agg(F.count(F.lit(1)).alias("orders"))
    return ranking.head_tail(spend, [F.asc("orders"), F.asc("customer_id")], [F.desc("orders"), F.desc("customer_id")], 8)


@query("i4_sample_exact")
def _(r):
    return ranking.sample_exact(r.orders, "order_id", 10_000).select("order_id", "order_status")


@query("i3_order_by_hidden")
def _(r):
    """All statuses by their first order; the date that decides is not reported."""
    first = r.orders.groupBy("order_status").agg(
        F.count(F.lit(1)).alias("orders"), F.min(F.struct("order_purchase_timestamp", "order_id")).alias("_first")
    )
    return first.orderBy("_first").drop("_first")


@query("i7_latest_per_key")
def _(r):
    """Latest order of every customer with its location."""
    located = joins.lookup_join(r.orders, r.customers, "customer_id")
    return joins.latest_row(
        located, "customer_unique_id", "order_purchase_timestamp", "order_id", ["order_id", "customer_state", "customer_city"]
    )


@query("i5_union_all")
def _(r):
    parts = [
        frame.select(F.lit(name).alias("source"), F.col("order_id"))
        for name, frame in (("orders", r.orders), ("items", r.order_items), ("payments", r.payments))
    ]
    return joins.union_all(*parts).groupBy("source").agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("order_id").alias("orders"))


@query("i6_concat_distinct")
def _(r):
    return joins.union_all(r.order_items.select("order_id"), r.payments.select("order_id"), distinct=True)


# --- classification measures on a fixed score -----------------------------


def scored_orders(r: Roles) -> DataFrame:
    """Delivered orders with the late flag and a score computed from the key."""
    known = r.shipped_orders.filter(X.is_delivered(RULES))
    return known.select(
        "order_id",
        "order_purchase_timestamp",
        X.is_late().cast("int").alias("label"),
        ((F.col("order_id") * 7919 % 1000) / F.lit(1000.0)).alias("score"),
    )


@query("k6_classification_metrics")
def _(r):
    return rounded(evaluation.classification_metrics(scored_orders(r), "label", "score", 0.55))


@query("k7_threshold_table")
def _(r):
    return rounded(evaluation.threshold_table(scored_orders(r), "label", "score"))


@query("k7_best_threshold")
def _(r):
    return rounded(evaluation.best_threshold(evaluation.threshold_table(scored_orders(r), "label", "score")))


@query("k9_pr_curve")
def _(r):
    return rounded(evaluation.pr_curve(scored_orders(r), "label", "score"))


@query("k9_roc_curve")
def _(r):
    return rounded(evaluation.roc_curve(scored_orders(r), "label", "score"))


@query("k9_score_histogram")
def _(r):
    return rounded(evaluation.score_histogram(scored_orders(r), "label", "score"))


def scored_features(r: Roles) -> DataFrame:
    return modeling(r).withColumn("score", (F.col("order_id") * 7919 % 1000) / F.lit(1000.0))


def _errors(r: Roles, name: str) -> DataFrame:
    return rounded(evaluation.grouped_error_analysis(scored_features(r), late_delivery.TARGET, "score", 0.55, (name,))[name])


@query("k11_errors_by_state")
def _(r):
    return _errors(r, "state")


@query("k11_errors_by_value_band")
def _(r):
    return rounded(_errors(r, "value_band"), 4)


@query("k11_errors_by_category")
def _(r):
    return _errors(r, "category")


@query("k11_errors_by_month")
def _(r):
    return _errors(r, "month")


@query("k11_error_examples")
def _(r):
    return _errors(r, "examples")


@query("k13_target_distribution")
def _(r):
    return evaluation.class_counts(modeling(r), late_delivery.TARGET)


# --- segmentation ---------------------------------------------------------


def _segments(r: Roles) -> DataFrame:
    return segmentation.rfm_segment(segmentation.rfm_scores(rfm_dataset(r)))


@query("l1_rfm_scores")
def _(r):
    return segmentation.rfm_scores(rfm_dataset(r)).select("customer_unique_id", "r_score", "f_score", "m_score")


@query("l2_rfm_segment")
def _(r):
    return _segments(r).select("customer_unique_id", "rfm_segment")


@query("l3_rule_distribution")
def _(r):
    return rounded(segmentation.segment_distribution(_segments(r)))


@query("l9_rule_crosstab")
def _(r):
    marked = _segments(r).withColumn("half", F.when(F.col("recency") % 2 == 0, "even").otherwise("odd"))
    return rounded(statistics.crosstab_share(marked, "rfm_segment", "half", ["even", "odd"]))


def rule_clusters(r: Roles) -> DataFrame:
    """Rule segments as clusters, numbered in order of precedence."""
    names = [rule[0] for rule in segmentation.SEGMENT_RULES]
    number = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("rfm_segment")) - 1
    return checkpointed(_segments(r).withColumn("cluster_id", number.cast("int")))


@query("l7_rule_profiles")
def _(r):
    return rounded(segmentation.cluster_profiles(rule_clusters(r)).drop("top_customer_states"), 4)


@query("l12_minmax_profile")
def _(r):
    return rounded(segmentation.minmax_profile(segmentation.cluster_profiles(rule_clusters(r))))


# --- forecasting ----------------------------------------------------------


@query("m1_make_features")
def _(r):
    return rounded(timeseries.make_features(order_series(r), ["series"]), **STD_DIGITS)


def event_days(r: Roles) -> DataFrame:
    return joins.date_spine(r.event_series, "date", ["value"], ["series"])


def _baseline(r: Roles, name: str) -> DataFrame:
    return rounded(forecasting.baseline_forecast(name, forecasting.series_state(event_days(r)), 30))


@query("m2_naive_last_value")
def _(r):
    return _baseline(r, "NaiveLastValue")


@query("m2_historical_mean")
def _(r):
    return _baseline(r, "HistoricalMean")


@query("m2_seasonal_naive")
def _(r):
    return _baseline(r, "SeasonalNaive7")


@query("m2_rolling_mean")
def _(r):
    return _baseline(r, "RollingMean7")


def baseline_backtest(r: Roles) -> DataFrame:
    """Walk-forward predictions of the four baselines on both order series."""
    return checkpointed(forecasting.walk_forward(checkpointed(order_series(r)), ()))


def residuals(r: Roles) -> DataFrame:
    one = baseline_backtest(r).filter((F.col("model") == "SeasonalNaive7") & (F.col("series") == "daily_orders"))
    return evaluation.residual_table(one)


@query("m5_error_metrics")
def _(r):
    return rounded(evaluation.error_metrics(baseline_backtest(r), ["series", "model", "fold"]), 4)


@query("m7_summarize_backtest")
def _(r):
    metrics = evaluation.error_metrics(baseline_backtest(r), ["series", "model", "fold"])
    return rounded(evaluation.summarize_backtest(metrics, ["series", "model"]), 4)


@query("m8_choose_model")
def _(r):
    metrics = evaluation.error_metrics(baseline_backtest(r), ["series", "model", "fold"])
    return evaluation.choose_model(evaluation.summarize_backtest(metrics, ["series", "model"]), ["series"])


@query("m10_residual_table")
def _(r):
    return rounded(residuals(r))


@query("m11_interval_quantiles")
def _(r):
    chosen = baseline_backtest(r).filter(F.col("model") == "SeasonalNaive7")
    return rounded(forecasting.residual_quantiles(chosen), 4)


# --- fitted models: rows only in the SQL comparison -----------------------

def split_rows(r: Roles) -> DataFrame:
    """The split modelling rows, written once: every fit reads them many times.
    The rows are written before as well, since they are ranked and then labelled."""
    return checkpointed(late_delivery.split_dataset(checkpointed(modeling(r))))


def train_rows(split: DataFrame) -> DataFrame:
    return split.filter(F.col("split") == "train")


def fitted(split: DataFrame, name: str):
    return late_delivery.fit_candidates(train_rows(split), names=(name,))[name]


@query("k1_preprocess")
def _(r):
    split = split_rows(r)
    stages = late_delivery.build_preprocessor(train_rows(split), scale_numeric=True)
    vectors = Pipeline(stages=stages).fit(train_rows(split)).transform(split)
    values = vector_to_array("features")
    total = F.aggregate(values, F.lit(0.0), lambda a, v: a + v)
    return rounded(vectors.select("order_id", F.size(values).alias("width"), total.alias("total")), 2)


@query("k2_dummy_prior")
def _(r):
    split = split_rows(r)
    scored = late_delivery.score(fitted(split, "DummyClassifier"), split)
    return rounded(scored.select("order_id", "split", "late_delivery_probability"))


def _compared(r: Roles, name: str) -> DataFrame:
    split = split_rows(r)
    return late_delivery.compare_models({name: fitted(split, name)}, split)


@query("k3_logistic")
def _(r):
    return _compared(r, "LogisticRegression")


@query("k4_random_forest")
def _(r):
    return _compared(r, "RandomForestClassifier")


@query("k5_boosted_trees")
def _(r):
    return _compared(r, "GBTClassifier")


@query("k8_select_model")
def _(r):
    split = split_rows(r)
    models = late_delivery.fit_candidates(train_rows(split))
    return late_delivery.select_model(late_delivery.compare_models(models, split))


@query("k10_permutation_importance")
def _(r):
    split = split_rows(r)
    validation_rows = split.filter(F.col("split") == "validation")
    return late_delivery.permutation_importance(fitted(split, "LogisticRegression"), validation_rows)


@query("k12_predict_late_delivery")
def _(r):
    split = split_rows(r)
    orders = split.drop("split", late_delivery.TARGET)
    predicted = late_delivery.predict_late_delivery(fitted(split, "LogisticRegression"), orders, 0.55)
    return predicted.select("order_id", "late_delivery_probability", "predicted_late_delivery", "risk_label")


def written_rfm(r: Roles) -> DataFrame:
    return checkpointed(rfm_dataset(r))


def clustered(r: Roles, k: int = 3) -> DataFrame:
    prepared = segmentation.prepare(written_rfm(r))
    return segmentation.fit_clusters(prepared, k).transform(prepared.frame).drop("features")


@query("l4_cluster_pipeline")
def _(r):
    return clustered(r).groupBy("cluster_id").agg(F.count(F.lit(1)).alias("customers"))


@query("l5_evaluate_k")
def _(r):
    return segmentation.evaluate_k(written_rfm(r))[0]


@query("l6_select_k")
def _(r):
    results, _ = segmentation.evaluate_k(written_rfm(r))
    return results.filter(F.col("k") == segmentation.select_k(results))


@query("l7_cluster_profiles")
def _(r):
    return segmentation.cluster_profiles(checkpointed(clustered(r)))


@query("l8_cluster_names")
def _(r):
    profiles = segmentation.cluster_profiles(checkpointed(clustered(r)))
    return segmentation.with_cluster_names(profiles, segmentation.cluster_names(profiles)).select("cluster_id", "cluster_name")


@query("l9_rule_by_cluster")
def _(r):
    rows = checkpointed(_segments(r))
    prepared = segmentation.prepare(rows)
    clustered_rows = checkpointed(segmentation.fit_clusters(prepared, 3).transform(prepared.frame).drop("features"))
    names = segmentation.cluster_names(segmentation.cluster_profiles(clustered_rows))
    return segmentation.rule_by_cluster(segmentation.with_cluster_names(clustered_rows, names), list(names.values()))


@query("l10_pca_2d")
def _(r):
    placed, shares = segmentation.pca_2d(segmentation.prepare(written_rfm(r)))
    return placed.withColumn("explained", F.lit(sum(shares)))


@query("l11_predict_segment")
def _(r):
    rfm = written_rfm(r)
    model = segmentation.cluster_pipeline(segmentation.prepare(rfm), 3)
    names = segmentation.cluster_names(segmentation.cluster_profiles(checkpointed(model.transform(rfm).drop("features"))))
    return segmentation.predict_segment(model, rfm, names).select("customer_unique_id", "cluster_id", "cluster_name")


def written_series(r: Roles) -> DataFrame:
    return checkpointed(order_series(r))


def model_backtest(r: Roles) -> DataFrame:
    """Walk-forward predictions of the baselines and the fitted models on both order series."""
    return checkpointed(forecasting.walk_forward(written_series(r)))


@query("m3_recursive_forecast")
def _(r):
    history = written_series(r)
    fits = forecasting.fit_models(history, forecasting.MODELS)
    return rounded(forecasting.model_forecast(fits, forecasting.series_state(history), 30), 6)


@query("m4_candidates")
def _(r):
    history = written_series(r)
    values = forecasting.fitted_values(forecasting.fit_models(history, forecasting.MODELS), history)
    return evaluation.error_metrics(values, ["series", "model"])


@query("m4_normal_equations")
def _(r):
    """What makes a linear fit the best one: its values have the same mean as the target,
    weighted by any feature. SQL takes the target itself."""
    history = written_series(r)
    values = forecasting.fitted_values(forecasting.fit_models(history, ("LinearRegression",)), history)
    rows = timeseries.make_features(history, ["series"]).drop("target").join(values.drop("model"), ["series", "date"])
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("x")) for f in timeseries.FEATURES])
    long = rows.select("series", "predicted", F.explode(pairs).alias("p")).select("series", "predicted", "p.feature", "p.x")
    weighted = F.sum(F.col("x") * F.col("predicted")) / F.sum("x")
    return long.groupBy("series", "feature").agg(F.count(F.lit(1)).alias("days"), F.round(weighted, 2).alias("weighted_mean"))


@query("m6_walk_forward")
def _(r):
    return rounded(baseline_backtest(r), 4)


@query("m6_walk_forward_models")
def _(r):
    return forecasting.backtest_metrics(model_backtest(r))


@query("m8_choose_model_models")
def _(r):
    metrics = forecasting.backtest_metrics(model_backtest(r))
    return evaluation.choose_model(evaluation.summarize_backtest(metrics, ["series", "model"]), ["series"])


@query("m9_holdout_evaluation")
def _(r):
    return rounded(forecasting.holdout_evaluation(written_series(r), "SeasonalNaive7")[0], 4)


@query("m9_holdout_models")
def _(r):
    compared = checkpointed(forecasting.holdout_predictions(written_series(r), forecasting.MODELS))
    return forecasting.holdout_metrics(compared, ["series", "model"])


@query("m12_generate_forecast")
def _(r):
    """Best baseline of each series by backtest, with its own spread."""
    trained = forecasting.train(order_series(r), ("daily_orders", "daily_revenue"), ())
    return rounded(forecasting.wide_forecast(forecasting.generate_forecast(trained.artifacts, trained.spread, 30)), 4)


@query("m13_fit_artifact")
def _(r):
    trained = forecasting.train(order_series(r), ("daily_orders", "daily_revenue"), ())
    return rounded(joins.union_all(*[artifact.forecast(7) for artifact in trained.artifacts.values()]), 4)


def _trained(r: Roles) -> forecasting.TrainedForecast:
    """Chosen among baselines and fitted models, for both order series."""
    return forecasting.train(order_series(r), ("daily_orders", "daily_revenue"))


@query("m10_residual_table_models")
def _(r):
    return rounded(_trained(r).residuals)


@query("m12_generate_forecast_models")
def _(r):
    trained = _trained(r)
    return rounded(forecasting.wide_forecast(forecasting.generate_forecast(trained.artifacts, trained.spread, 30)), 4)


@query("m13_fit_artifact_models")
def _(r):
    return rounded(joins.union_all(*[artifact.forecast(7) for artifact in _trained(r).artifacts.values()]), 4)
