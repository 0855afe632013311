"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; one JSON line.

Each query is built and run to completion twice; the second time is reported,
so class loading and code generation are left out.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from cartograin.registry import REGISTRY  # noqa: E402
from cartograin.session import local_session  # noqa: E402

HEADLINE = (
    "b3_duplicate_key_summary",
    "b5_orphan_counts",
    "b8_quality_profile",
    "e1_business_overview",
    "e3_monthly_sales_growth",
    "e5_weekday_sales",
    "e7_top_customers",
    "e11_rfm_averages",
    "e12_category_sales",
    "e14_category_reviews",
    "e15_top_sellers",
    "e17_revenue_concentration",
    "e18_delivery_summary",
    "e26_review_by_delay_band",
    "e27_payment_types",
    "e31_executive_kpis",
    "e37_orders_dataset",
    "e38_items_dataset",
    "e41_rfm_dataset",
    "e42_modeling_dataset",
    "e43_daily_series",
    "f15_hexbin_value_freight",
    "f18_eda_metrics",
    "f20_spearman",
    "h10_temporal_split",
    "k3_logistic",
    "k6_classification_metrics",
    "k11_errors_by_value_band",
    "l2_rfm_segment",
    "m1_make_features",
    "m2_rolling_mean",
)


def run(spark, name: str, folder: str) -> float:
    begin = time.perf_counter()
    REGISTRY[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, shuffle_partitions=cpus)
    seconds = {}
    for name in HEADLINE:
        run(spark, name, folder)
        seconds[name] = round(run(spark, name, folder), 3)
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds_headline_queries",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
