"""Category, product and seller figures at item grain. Item price is the
measure; order payments are never spread over items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import DEFAULT_RULES, StatusRules, category_label, is_eligible, mean, money, percent, ratio
from ..operators.joins import lookup_join, with_scalar
from ..operators.ranking import distributed_rank, top_k


def eligible_items(items: DataFrame, orders: DataFrame, rules: StatusRules = DEFAULT_RULES) -> DataFrame:
    keep = orders.filter(is_eligible(rules)).select("order_id")
    return lookup_join(items, keep, "order_id")


def labelled_products(products: DataFrame, translation: DataFrame) -> DataFrame:
    joined = lookup_join(products, translation, "product_category_name", "left")
    return joined.select("product_id", category_label().alias("category"))


def product_totals(
    items: DataFrame, orders: DataFrame, products: DataFrame, translation: DataFrame, rules: StatusRules = DEFAULT_RULES
) -> DataFrame:
    """One row per sold product. Items are summed per product before the
    catalogue is joined, so a best-seller is one row by then."""
    sold = (
        eligible_items(items, orders, rules)
        .groupBy("product_id")
        .agg(
            F.sum("price").alias("price"),
            F.count("price").alias("priced"),
            F.sum("freight_value").alias("freight"),
            F.count("freight_value").alias("shipped"),
            F.count(F.lit(1)).alias("items_sold"),
        )
    )
    return lookup_join(sold, labelled_products(products, translation), "product_id")


def category_sales(
    items: DataFrame, orders: DataFrame, products: DataFrame, translation: DataFrame, rules: StatusRules = DEFAULT_RULES
) -> DataFrame:
    totals = product_totals(items, orders, products, translation, rules)
    grouped = totals.groupBy("category").agg(
        F.sum("price").alias("revenue"),
        F.sum("items_sold").alias("items_sold"),
        F.round(ratio(F.sum("price"), F.sum("priced")), 2).alias("average_product_price"),
        F.count(F.lit(1)).alias("unique_products"),
        F.round(ratio(F.sum("freight"), F.sum("shipped")), 2).alias("average_freight_cost"),
    )
    return grouped.select(
        "category",
        money(F.col("revenue")).alias("item_revenue"),
        "items_sold",
        "average_product_price",
        "unique_products",
        "average_freight_cost",
    ).orderBy(F.desc("item_revenue"), "category")


def top_products(
    items: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    translation: DataFrame,
    rules: StatusRules = DEFAULT_RULES,
    k: int = 20,
) -> DataFrame:
    totals = product_totals(items, orders, products, translation, rules)
    best = top_k(totals, [F.col("price").desc_nulls_first(), "product_id"], k)
    return best.select("product_id", "category", money(F.col("price")).alias("item_revenue"), "items_sold")


def top_categories(
    items: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    translation: DataFrame,
    rules: StatusRules = DEFAULT_RULES,
    k: int = 20,
) -> DataFrame:
    totals = product_totals(items, orders, products, translation, rules)
    grouped = totals.groupBy("category").agg(
        F.sum("items_sold").alias("items_sold"), F.sum("price").alias("item_revenue")
    )
    best = top_k(grouped, [F.col("item_revenue").desc_nulls_first(), "category"], k)
    return best.withColumn("item_revenue", F.col("item_revenue").cast("double"))


def order_scores(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("order_id").agg(mean("review_score").alias("order_score"))


def reviewed_items(items: DataFrame, reviews: DataFrame, key: str) -> DataFrame:
    """Items per ``key`` that belong to a reviewed order, with the sum of the
    orders' mean scores (a partial average that merges further)."""
    scored = lookup_join(items.select("order_id", key), order_scores(reviews), "order_id")
    return scored.groupBy(key).agg(
        F.count(F.lit(1)).alias("reviewed_items"),
        F.sum("order_score").alias("score_sum"),
        F.count("order_score").alias("scored"),
    )


def category_reviews(
    items: DataFrame, products: DataFrame, reviews: DataFrame, translation: DataFrame, min_items: int = 100
) -> DataFrame:
    per_product = reviewed_items(items, reviews, "product_id")
    labelled = lookup_join(per_product, labelled_products(products, translation), "product_id")
    grouped = labelled.groupBy("category").agg(
        F.sum("reviewed_items").alias("reviewed_items"),
        F.round(ratio(F.sum("score_sum"), F.sum("scored")), 3).alias("average_review_score"),
    )
    kept = grouped.filter(F.col("reviewed_items") >= min_items)
    return kept.select("category", "average_review_score", "reviewed_items").orderBy(
        F.desc("average_review_score"), "category"
    )


def seller_totals(items: DataFrame, orders: DataFrame, rules: StatusRules = DEFAULT_RULES) -> DataFrame:
    """One row per seller; distinct orders come from the (order, seller) pairs
    that the first aggregation leaves."""
    pairs = items.groupBy("order_id", "seller_id").agg(
        F.sum("price").alias("price"), F.count("price").alias("priced"), F.count(F.lit(1)).alias("n")
    )
    keep = orders.filter(is_eligible(rules)).select("order_id")
    return (
        lookup_join(pairs, keep, "order_id")
        .groupBy("seller_id")
        .agg(
            F.sum("price").alias("revenue"),
            F.count(F.lit(1)).alias("orders"),
            F.sum("n").alias("items_sold"),
            F.sum("priced").alias("priced"),
        )
    )


def top_sellers(
    items: DataFrame, orders: DataFrame, sellers: DataFrame, rules: StatusRules = DEFAULT_RULES, k: int = 25
) -> DataFrame:
    known = seller_totals(items, orders, rules).join(sellers.select("seller_id", "seller_state"), "seller_id")
    best = top_k(known, [F.col("revenue").desc_nulls_first(), "seller_id"], k)
    return best.select(
        "seller_id",
        "seller_state",
        money(F.col("revenue")).alias("item_revenue"),
        "orders",
        "items_sold",
        F.round(ratio(F.col("revenue"), F.col("priced")), 2).alias("average_item_value"),
    )


def sellers_by_state(sellers: DataFrame) -> DataFrame:
    return sellers.groupBy("seller_state").agg(F.count(F.lit(1)).alias("sellers")).orderBy(F.desc("sellers"), "seller_state")


def revenue_concentration(
    items: DataFrame,
    orders: DataFrame,
    rules: StatusRules = DEFAULT_RULES,
    top: tuple[int, ...] = (10, 100),
    fraction: float = 0.01,
) -> DataFrame:
    """Share of revenue held by the largest sellers, by count and by fraction."""
    revenue = seller_totals(items, orders, rules).select("seller_id", "revenue")
    ranked = distributed_rank(revenue, [F.col("revenue").desc_nulls_first(), "seller_id"])
    sizes = ranked.agg(F.sum("revenue").alias("_all"), F.count(F.lit(1)).alias("_sellers"))
    placed = with_scalar(ranked, sizes)
    held = [F.sum(F.when(F.col("rank") <= k, F.col("revenue"))).alias(f"_top_{k}") for k in top]
    leading = F.col("rank") <= F.ceil(F.col("_sellers") * F.lit(fraction))
    held.append(F.sum(F.when(leading, F.col("revenue"))).alias("_top_fraction"))
    sums = placed.agg(F.max("_all").alias("_all"), *held)
    name = f"top_{fraction * 100:g}_percent_revenue_pct".replace(".", "_")
    return sums.select(
        *[F.round(percent(F.col(f"_top_{k}"), F.col("_all")), 2).alias(f"top_{k}_revenue_pct") for k in top],
        F.round(percent(F.col("_top_fraction"), F.col("_all")), 2).alias(name),
    )


def seller_reviews(items: DataFrame, reviews: DataFrame, min_items: int = 100, k: int = 25) -> DataFrame:
    per_seller = reviewed_items(items, reviews, "seller_id").filter(F.col("reviewed_items") >= min_items)
    scored = per_seller.withColumn("average", ratio(F.col("score_sum"), F.col("scored")))
    best = scored.select("seller_id", "reviewed_items", F.round("average", 3).alias("average_review_score"))
    return top_k(best, [F.desc("average_review_score"), "seller_id"], k)


