"""Print condensed physical plans of key operators (AQE off, so every exchange shows).

Usage: python tools/show_plans.py [sf_dir] > docs/PLANS.md
Keeps the operator lines (exchanges, joins, windows, aggregates, scans,
broadcasts) and the scans' pushed filters and read schemas.
"""

from __future__ import annotations

import re
import sys

from pyspark.sql import functions as F

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from strata.operators.keyed import latest_by  # noqa: E402
from strata.operators.star import asof_lookup, daily_sales, unknown_member  # noqa: E402
from strata.plans import medallion as M  # noqa: E402
from strata.plans.catalog import queries  # noqa: E402
from strata.session import get_spark, scratch_path  # noqa: E402
from strata.sinks.partitioned import touched_rows  # noqa: E402
from strata.sources.driver_tables import DriverTables  # noqa: E402

KEEP = re.compile(r"(Exchange|Join|dynamicpruning|Window|WindowGroupLimit|Aggregate|FileScan|Scan|Broadcast|Union|Expand|Filter)")


def condensed(df) -> str:
    plan = df._jdf.queryExecution().executedPlan().toString()
    out = []
    for line in plan.splitlines():
        if not KEEP.search(line):
            continue
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r"\[plan_id=\d+\]", "", line)
        m = re.search(r"PushedFilters: \[[^\]]*\]", line)
        pushed = m.group(0) if m else ""
        line = re.sub(r"(FileScan parquet) \[[^\]]*\].*?(ReadSchema: struct<[^>]*>)?$",
                      lambda mm: f"{mm.group(1)} {pushed} {mm.group(2) or ''}", line)
        out.append(line[:220])
    return "\n".join(out)


def _pruned(spark, L):
    path = scratch_path(spark, "plan_events")
    events = L["silver.order_events"].withColumn("dt", F.to_date("event_time"))
    events.write.partitionBy("dt").parquet(path)
    return touched_rows(path, events.filter("order_id = 'U-7'"), ["dt"])[0]


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("strata-plans", master="local[4]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    dt = DriverTables(spark, sf)
    L = M.build_layers(spark, sf)
    cases = {
        "latest_by: dedup of batch orders (partial WindowGroupLimit before the shuffle)":
            M.batch_orders(dt.orders_raw()),
        "route_events: one scan, one dedup on (event_id, route)": M.route(dt.order_events()).routed,
        "collapse_events / stream_orders: one aggregate, partial before the shuffle":
            queries()["order_collapse"](spark, sf),
        "merge_upsert over arrival windows (time filters pushed into the lineitem scan)":
            queries()["merge_upsert"](spark, sf),
        "asof_lookup: one equi+range join, fact shuffled once (layer tables read from files)":
            asof_lookup(L["silver.orders"].select("order_id", "customer_id", "order_ts"), L["gold.dim_customer"],
                        "customer_id", "order_ts", "customer_sk"),
        "unknown_member: salted left join": unknown_member(L["silver.orders"].select("order_id", "product_id"),
                                                            L["gold.dim_product"], "product_id", "product_sk"),
        "daily_sales mart": daily_sales(L["gold.fact_orders"], L["gold.dim_product"]),
        "partition MERGE's read of its target: pruned by the batch's partitions while it runs": _pruned(spark, L),
        "dq_report: one aggregate per table + two-level duplicates + anti joins": queries()["dq_report"](spark, sf),
        "latest_by on a toy frame": latest_by(spark.range(100).selectExpr("id % 3 AS k", "id AS v"), "k", ["v DESC"]),
    }
    print("# Physical plans (condensed, AQE off so every exchange is visible)\n")
    print(f"Generated by `python tools/show_plans.py {sf}`.\n")
    for title, df in cases.items():
        print(f"## {title}\n\n```\n{condensed(df)}\n```\n")


if __name__ == "__main__":
    main()
