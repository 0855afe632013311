"""A slice of the registered queries against their SQL on the smallest tables."""

import os

import pytest

from cartograin.registry import REGISTRY
from checks.compare import compare, connect
from checks.oracle import ORACLE

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are absent")

NAMES = [
    "b3_duplicate_key_summary", "b5_orphan_counts", "c12_percentile_cap", "d4_star_join", "d5_shift_self_join", "d8_join_dominant",
    "d12_date_spine", "e1_business_overview", "e3_monthly_sales_growth", "e12_category_sales", "e17_revenue_concentration",
    "e21_freight_buckets", "e31_executive_kpis", "e40_customers_dataset", "e42_modeling_dataset", "f15_hexbin_value_freight",
    "f20_spearman", "h5_quantile_bin", "h8_rolling_previous", "k7_threshold_table", "l2_rfm_segment", "m2_rolling_mean",
]


@pytest.fixture(scope="module")
def tables():
    return connect(FOLDER)


@pytest.mark.parametrize("name", NAMES)
def test_same_rows(spark, tables, name):
    assert compare(REGISTRY[name](spark, FOLDER), tables.execute(ORACLE[name])) == []


def test_every_sql_belongs_to_a_query():
    assert set(ORACLE) <= set(REGISTRY) and len(REGISTRY) > 140


@pytest.mark.parametrize("name", ["e12_category_sales", "e38_items_dataset", "e42_modeling_dataset", "h3_dominant_value"])
def test_spread_joins_agree_too(spark, tables, spread, name):
    """No broadcasts: every lookup takes the path for large right sides."""
    assert compare(REGISTRY[name](spark, FOLDER), tables.execute(ORACLE[name])) == []
