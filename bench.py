"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores, ``BENCH_RUNS`` how
often each query runs (the best time counts). Results go to the ``noop`` sink,
so every row is computed and none reaches the driver.
"""

import json
import os
import time

import pyspark
from pyspark.sql import Observation, functions as F

from starloom.session import build_session
from starloom.slate import load_all

QUERIES = [
    "top_parts_revenue",
    "revenue_part_nation_month",
    "star_cube_cell",
    "drill_segment",
    "grouping_sets_sales",
    "cube_sales",
    "union_sales",
    "ssb_one_dim",
    "ssb_two_dim",
    "ssb_drill",
    "ssb_same_dist",
    "fact_sales",
    "customer_balance",
    "actor_info",
    "event_phase_range",
    "event_period_rows",
    "avg_views_between_signups",
    "songplays_relational",
    "songplays_lake",
    "users_upsert",
    "last_write_wins",
    "document_words",
    "label_lookup",
    "access_log_fields",
    "station_traffic",
    "immigration_fact",
    "dq_report",
]


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench",
        f"local[{cores}]",
        **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": cores, "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, _ = load_all()
    # Start-up cost (class loading, first code generation) is not a query's.
    queries["top_nations_revenue"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds, rows = {}, {}
    for name in QUERIES:
        times = []
        for _ in range(runs):
            started, counted = time.perf_counter(), Observation()
            result = queries[name](spark, folder).observe(counted, F.count(F.lit(1)).alias("rows"))
            result.write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - started)
            rows[name] = counted.get["rows"]
        seconds[name] = round(min(times), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rows": rows,
                "sf": os.path.basename(folder.rstrip("/")),
                "cores": int(cores),
                "spark": pyspark.__version__,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
