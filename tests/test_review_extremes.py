from conftest import rows

from cartograin.functions.expressions import StatusRules
from cartograin.plans import eda


def test_items_are_not_grouped_by_order_and_category(spark):
    """such groups hold one item each, so a task held nearly all its rows."""
    items = spark.createDataFrame(
        [("o1", "a", "delivered"), ("o1", "a", "delivered"), ("o2", "a", "delivered"), ("o2", "b", "delivered"), ("o3", "b", "canceled")],
        "order_id string, category_english string, order_status string")
    reviews = spark.createDataFrame([("o1", 5), ("o1", 4), ("o2", 1), ("o3", 5)], "order_id string, review_score int")
    found = eda.category_review_extremes(items, reviews, StatusRules(), min_items=1)
    assert rows(found.select("category_english", "average_review", "reviewed_items")) == [("b", 1.0, 1), ("a", 3.333333, 3)]
    plan = found._jdf.queryExecution().toString()
    aggregates = [line for line in plan.splitlines() if "HashAggregate(keys=" in line]
    assert aggregates and not any("order_id" in a.split("functions=")[0] and "category" in a.split("functions=")[0] for a in aggregates)
