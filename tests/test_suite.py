import pytest

from cartograin.plans import datasets
from cartograin.registry import RULES, run_suite, tables
from cartograin.sources.binding import bind

FOLDER = "/root/testdata/sf0.001"


def test_suite_order_and_choices(spark, monkeypatch):
    monkeypatch.setattr("cartograin.registry.REGISTRY", {n: (lambda s, f, n=n: n) for n in ("e10_b", "e2_a", "b1_c", "e2_z")})
    assert list(run_suite(spark, FOLDER)) == ["b1_c", "e2_a", "e2_z", "e10_b"]
    assert list(run_suite(spark, FOLDER, "E2")) == ["e2_a", "e2_z"] and list(run_suite(spark, FOLDER, "e10_b")) == ["e10_b"]
    with pytest.raises(ValueError, match="e10_b"):
        run_suite(spark, FOLDER, "q9")


def test_suite_runs_a_query(spark):
    assert run_suite(spark, FOLDER, "b1")["b1_table_row_counts"].count() > 5


def test_analytical_datasets(spark):
    r = bind(spark, FOLDER)
    found = datasets.load_datasets({**tables(r), "orders": r.shipped_orders}, RULES)
    assert set(found) == {"orders", "items", "reviews", "customers", "quality"}
    assert found["orders"].count() == r.shipped_orders.join(r.customers, "customer_id").count()
    assert found["quality"].count() == 1
