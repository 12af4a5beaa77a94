"""Time the headline queries and print one JSON line.

Each query runs from the given tables to its last row (a no-op sink, so nothing is collected).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from suite.queries import QUERIES  # noqa: E402
from tallyhouse.session import local_session  # noqa: E402

HEADLINE = (
    "monthly_performance",
    "rfm_summary",
    "reorder_matrix",
    "top_margin_products",
    "store_profitability",
    "category_kpis",
    "sales_ytd",
    "mom_sales_growth",
    "sales_measures_by_category",
    "sales_metrics",
    "dim_customers",
    "fact_sales",
    "gold_summary",
    "quality_flags",
    "quality_rule_breakdown_all",
    "line_features",
    "robust_scaling",
    "forest_scores",
    "anomaly_report_kpis",
    "medallion_run",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(int(os.environ.get("BENCH_CPUS", str(os.cpu_count()))))
    names = sys.argv[1:] or HEADLINE
    QUERIES["financial_kpis"](spark, sf_dir).collect()  # start the JVM's and the scan's first use
    seconds: dict[str, float] = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
