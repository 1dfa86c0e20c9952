"""Command line: build every stored artifact of a data directory.

    python -m vendorlens build --data /root/testdata/sf0.01 --out <shared folder>

Writes, under --out (shared storage on a cluster):
  validation_report/       one-row JSON (negative spend, lead-time outliers, duplicate ids)
  staging_orders/          the clean items, Parquet partitioned by order year
  staging_orders_csv/      the same with a header row, CSV
  dim_vendor/ dim_product/ dim_region/ dim_date/ fact_orders/
                           Parquet in versions: published when their keys hold
                           (plans/publish.py), the last two versions are kept
  vendor_risk_scores/ monte_carlo_results/ top12_dual_sourcing/ CSV with header
and prints a one-line JSON summary of row counts.
"""

from __future__ import annotations

import argparse
import json
import sys

from .operators import clean as C
from .plans.catalog import catalog_for
from .plans.publish import TableStore, references, unique_key
from .session import build_session
from .sources import files


def build(spark, data: str, out: str, vendor: str, category: str) -> dict:
    cat = catalog_for(spark, data, vendor=vendor, category=category)
    out = out.rstrip("/")
    files.write_report_json(C.validation_report(cat.validated), f"{out}/validation_report")
    files.write_parquet(cat.clean, f"{out}/staging_orders", partition_by=["order_year"])
    files.write_csv(cat.clean, f"{out}/staging_orders_csv")
    counts = {"staging_orders": cat.clean.count()}
    store, dims, keys = TableStore(spark, out), {}, []
    for name, key, of_fact in (("dim_vendor", "vendor_id", "vendor_id"), ("dim_product", "product_id", "product_id"),
                               ("dim_region", "region_id", "region_id"), ("dim_date", "date_id", "order_date")):
        dims[name] = store.publish(name, getattr(cat, name), [unique_key(key)])
        keys.append(references(of_fact, dims[name], key))
        counts[name] = dims[name].count()
    counts["fact_orders"] = store.publish("fact_orders", cat.fact, [unique_key("order_item_id"), *keys]).count()
    for name in (*dims, "fact_orders"):
        store.expire(name)
    for name, df in (("vendor_risk_scores", cat.vendor_risk_scores),
                     ("monte_carlo_results", cat.monte_carlo_results),
                     ("top12_dual_sourcing", cat.top12)):
        files.write_csv(df, f"{out}/{name}")
        counts[name] = df.count()
    return counts


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="vendorlens")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build", help="build and write every artifact")
    b.add_argument("--data", required=True, help="folder with the parquet tables")
    b.add_argument("--out", required=True, help="output folder (shared storage on a cluster)")
    b.add_argument("--vendor", default="supplier", choices=["supplier", "customer"])
    b.add_argument("--category", default="type", choices=["type", "brand"])
    b.add_argument("--master", default=None, help="e.g. local[8]; omit under spark-submit")
    args = ap.parse_args(argv)
    spark = build_session(args.master)
    counts = build(spark, args.data, args.out, args.vendor, args.category)
    print(json.dumps(counts))
    return 0


if __name__ == "__main__":
    sys.exit(main())
