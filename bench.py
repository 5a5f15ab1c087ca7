"""Times the headline jobs and prints one JSON line.

Builds are timed from the raw tables to the written star; reports run on the written star, once to warm up
and then three times (median), as the published report timings are warm.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from aisleframe.session import local_session
from queries import catalog
from queries.stage import DEEP_TABLES, FINE, MID, RISK_TABLES, STAR_TABLES, stage

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
REPORTS = [
    "q1_network_kpis", "q2_region_table", "q4_sales_trend", "q6_footfall_vs_basket", "q13_items_at_risk",
    "q17_promotions_by_family"]
JOBS = ["g8_fact_sales", "g8_fact_sales_by_part", "g14_fact_stockout_risk_end_to_end", "x2_run_p_values",
        "x6_promo_events", "e4_daily_target_allocation", "d3_fact_store_day", "c29_gate"]


def seconds(work) -> float:
    start = time.perf_counter()
    work()
    return time.perf_counter() - start


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = local_session(CPUS, int(CPUS))
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    rates: dict[str, float] = {}
    spark.range(1000).selectExpr("sum(id)").collect()

    def build(grain, names):
        tables = stage(spark, SF_DIR, grain).warehouse
        for name in names:
            tables.table(name)

    times["build_star_nation_brand"] = seconds(lambda: build(MID, [*STAR_TABLES, *RISK_TABLES]))
    times["build_star_supplier_part"] = seconds(lambda: build(FINE, STAR_TABLES))
    times["build_deep_dive"] = seconds(lambda: build(MID, DEEP_TABLES))
    queries = catalog.queries()
    for key in JOBS:
        times[key] = seconds(lambda: drain(queries[key](spark, SF_DIR)))
    sales = stage(spark, SF_DIR, MID).t("sales").count()
    series = stage(spark, SF_DIR, MID).t("series").count()
    rates["baseline_rows_per_sec"] = sales / times["g8_fact_sales"]
    rates["stockout_series_rows_per_sec"] = series / times["g14_fact_stockout_risk_end_to_end"]
    for key in REPORTS:
        queries[key](spark, SF_DIR).collect()
        times[key] = statistics.median(seconds(lambda: queries[key](spark, SF_DIR).collect()) for _ in range(RUNS))
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1], "cpus": CPUS,
        "rates": {k: round(v) for k, v in rates.items()}}))
    spark.stop()


if __name__ == "__main__":
    sys.exit(main())
