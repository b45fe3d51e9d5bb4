"""Timings of the headline queries: one JSON line.

Every query is planned and run to its last row into Spark's no-op sink, twice; the second run counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from basketmill.operators.relational import product
from basketmill.plans import registry
from basketmill.session import local_session
from basketmill.sources.roles import table

HEADLINE = (
    "filter_project",
    "point_lookup",
    "cross_join",
    "equi_join",
    "lookup_join",
    "three_way_join",
    "theta_join",
    "price_matches",
    "bucket_join",
    "clean_wide",
    "cleaning_report",
    "normalize_orders",
    "normalize_items",
    "not_null_check",
    "check_rules",
    "duplicate_keys",
    "fk_orphans",
    "fd_check",
    "grain_reconcile",
    "surrogate_key",
    "rule_gate_rejected",
    "rule_audit",
    "headline_metrics",
    "delivery_satisfaction",
    "category_repurchase",
    "freight_by_quarter",
    "admin_listing",
    "next_item_id",
    "stock_upsert",
    "stock_allocation",
    "stock_verdict",
    "csv_round_trip",
    "gate_stream_valid",
    "reservation_stream",
    "merged_items",
)


def orders_by_nations(spark, folder):
    """A product of millions of rows, the size class of the published one."""
    return product(
        table(spark, folder, "orders").select("o_orderkey", "o_totalprice"),
        table(spark, folder, "nation").select("n_name"),
    )


def seconds(query, spark, folder) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    registered = registry.queries()
    chosen = {name: registered[name] for name in HEADLINE}
    chosen["orders_by_nations"] = orders_by_nations
    times = {}
    for name, query in chosen.items():
        seconds(query, spark, folder)
        times[name] = round(seconds(query, spark, folder), 3)
    print(
        json.dumps(
            {
                "metric": "total warm time of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
