"""Benchmark: build the stored tables, then run the headline queries.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_EVENT_LOG (optional folder: Spark event log for stage/task times).
Prints one JSON line. Each query is forced with a no-op write (every row
computed, nothing collected to the driver).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from vendorlens.plans.catalog import catalog_for  # noqa: E402
from vendorlens.plans.registry import queries  # noqa: E402
from vendorlens.session import build_session  # noqa: E402

HEADLINE = [
    "validation_report",
    "risk_band",
    "hhi_exact",
    "monte_carlo_results",
    "dual_sourcing_topn",
    "breach_empirical",
    "vw_vendor_spend",
    "vw_vendor_risk_master",
    "vw_category_hhi",
    "vw_hhi_by_category",
    "vw_single_source",
    "vw_disruption_exposure",
    "vw_kpi_summary",
    "vw_category_concentration",
    "vw_yoy_spend",
    "late_rate_by_shipping_mode",
    "spend_trend_by_tier",
    "histogram",
    "box_stats",
    "correlation_matrix",
    "profile_cardinality",
]


def force(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    extra = {}
    if os.environ.get("BENCH_EVENT_LOG"):
        extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG"]}
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus), driver_memory="12g",
                          extra=extra)
    times: dict[str, float] = {}

    t = time.time()
    cat = catalog_for(spark, sf_dir)
    cat.clean
    times["build_clean"] = time.time() - t

    t = time.time()
    for tbl in ("dim_vendor", "dim_product", "dim_region", "dim_date", "fact"):
        getattr(cat, tbl)
    times["build_star"] = time.time() - t

    t = time.time()
    cat.vendor_risk_scores
    cat.monte_carlo_results
    cat.top12
    times["build_results"] = time.time() - t

    qs = queries()
    for name in HEADLINE:
        t = time.time()
        force(qs[name](spark, sf_dir))
        times[name] = time.time() - t

    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "total_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "sf": float(m.group(1)) if m else None,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
