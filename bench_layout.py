"""Same queries over different table layouts: CSV or Parquet, sorted or not, bucketed or not, split or single gzip file.

Tables are written to ``LAYOUT_DIR`` (a new folder below it per run); input
comes from ``BENCH_SF_DIR``. Prints one JSON line.
"""

import json
import os
import time
import uuid

from pyspark.sql import functions as F

from starloom.functions.dates import date_key
from starloom.functions.money import hundredths
from starloom.operators.layout import shuffle_count, write_bucketed, write_sorted
from starloom.operators.writes import write_csv
from starloom.plans import ssb
from starloom.session import build_session, read_table
from starloom.sources.files import stage_csv

RANGE = "l_shipdate >= '1998-01-01' and l_shipdate < '1998-04-01' and l_returnflag = 'A'"


def seconds(df):
    best = None
    for _ in range(3):
        started = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        taken = time.perf_counter() - started
        best = taken if best is None else min(best, taken)
    return round(best, 3)


def main():
    source = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    folder = f"{os.environ.get('LAYOUT_DIR', '/tmp')}/layout-{uuid.uuid4().hex}"
    spark = build_session(
        "layouts",
        f"local[{cores}]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": cores,
            "spark.sql.warehouse.dir": f"{folder}/warehouse",
            # Show the layouts, not the broadcast of small tables.
            "spark.sql.autoBroadcastJoinThreshold": "-1",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    lines, part = read_table(spark, source, "lineitem"), read_table(spark, source, "part")
    write_csv(lines, f"{folder}/csv", sep=";")
    write_csv(lines.repartition(int(cores)), f"{folder}/split", sep=";", compression="gzip")
    write_csv(lines.coalesce(1), f"{folder}/single", sep=";", compression="gzip")
    write_sorted(lines, f"{folder}/sorted", "l_shipdate")
    forms = {
        "csv": stage_csv(spark, f"{folder}/csv", lines.schema, sep=";"),
        "parquet": lines,
        "parquet_sorted": spark.read.parquet(f"{folder}/sorted"),
    }
    times = {}
    for name, df in forms.items():
        times[f"filter_{name}"] = seconds(df.where(RANGE).select("l_orderkey", "l_shipdate", "l_quantity"))
        times[f"average_{name}"] = seconds(df.groupBy("l_returnflag").agg(F.avg("l_quantity")))
    for name in ("split", "single"):
        times[f"load_gzip_{name}"] = seconds(stage_csv(spark, f"{folder}/{name}", lines.schema, sep=";"))

    plain = lines.join(part, lines.l_partkey == part.p_partkey).groupBy("p_partkey").agg(F.sum("l_quantity"))
    line_table = write_bucketed(lines, "line_buckets", int(cores), "l_partkey")
    part_table = write_bucketed(part, "part_buckets", int(cores), "p_partkey")
    bucketed = (
        line_table.join(part_table, line_table.l_partkey == part_table.p_partkey)
        .groupBy("p_partkey")
        .agg(F.sum("l_quantity"))
    )
    times["join_plain"], times["join_bucketed"] = seconds(plain), seconds(bucketed)
    shuffles = {"join_plain": shuffle_count(plain), "join_bucketed": shuffle_count(bucketed)}

    # Benchmark queries with the line table laid out by date or by part, or not at all.
    days = ssb.date_table(lines, "l_shipdate")
    layouts = {"plain": (lines, part), "sorted": (forms["parquet_sorted"], part), "bucketed": (line_table, part_table)}
    for name, (line_form, part_form) in layouts.items():
        order_lines = line_form.select(
            date_key("l_shipdate").alias("lo_orderdate"),
            F.col("l_partkey").alias("lo_partkey"),
            F.col("l_quantity").alias("lo_quantity"),
            hundredths("l_extendedprice").alias("lo_extendedprice"),
            hundredths("l_discount").alias("lo_discount"),
        )
        one, same = ssb.one_dimension(order_lines, days, 1997, (1, 3), 24), ssb.same_distribution(order_lines, part_form)
        times[f"one_dim_{name}"], times[f"same_dist_{name}"] = seconds(one), seconds(same)
        shuffles[f"same_dist_{name}"] = shuffle_count(same)
    print(json.dumps({"metric": "layouts", "unit": "sec", "queries": times, "shuffles": shuffles, "cores": int(cores)}))
    spark.stop()


if __name__ == "__main__":
    main()
