"""Time the headline queries and print one JSON line.

BENCH_SF_DIR   directory of parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS     threads of the local session (default 8)
BENCH_RUNS     timed runs per query after one warm-up; the median counts (default 5)
BENCH_COMPARE  0: leave out the same results written as one job or join per number, which are
               otherwise timed in turn with ours
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from basketry.plans import catalog  # noqa: E402
from basketry.sources.dataset import load_dataset  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "5"))

HEADLINE = (
    "daily_sales",
    "customer_behavior",
    "segment_summary",
    "payment_mix",
    "basic_statistics",
    "summary_report",
    "missing_values",
    "monthly_sales",
    "daily_history_mean",
    "order_day_window",
    "amount_histogram",
    "amount_center",
    "product_sales",
    "top_products_revenue",
    "top_customers",
    "order_item_totals",
    "order_documents",
    "exploded_items",
    "sales_forecast",
    "model_evaluation",
)


def sink(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


# The same results in the usual step-by-step style, as a yardstick.


def daily_sales_stepwise(spark: SparkSession) -> None:
    dated = catalog.delivered(load_dataset(spark, SF_DIR)).withColumn("d", F.to_date("date"))
    day = Window.partitionBy("d")
    counts = dated.groupBy("d").agg(F.count("*").alias("n"), F.count_distinct("customer_id").alias("c"))
    amounts = dated.select(
        F.col("d").alias("d2"), F.sum("total_amount").over(day).alias("s"), F.avg("total_amount").over(day).alias("a")
    ).distinct()
    sink(counts.join(amounts, F.col("d") == F.col("d2"), "left").drop("d2"))


def customer_behavior_stepwise(spark: SparkSession) -> None:
    dated = catalog.delivered(load_dataset(spark, SF_DIR)).withColumn("d", F.to_date("date"))
    counts = dated.groupBy("customer_id").agg(F.count("*").alias("n"), F.count_distinct("d").alias("days"))
    spend = dated.groupBy("customer_id").agg(F.sum("total_amount").alias("s"), F.avg("total_amount").alias("a"))
    sink(counts.join(spend, "customer_id", "left"))


def missing_values_stepwise(spark: SparkSession) -> None:
    customers = load_dataset(spark, SF_DIR).customers
    customers.count()
    for column in customers.columns:
        customers.filter(F.col(column).isNull()).count()


def basic_statistics_stepwise(spark: SparkSession) -> None:
    d = load_dataset(spark, SF_DIR)
    done = catalog.delivered(d)
    for df in (d.orders, done, d.customers, d.products):
        df.count()
    done.agg(F.sum("total_amount")).collect()
    done.agg(F.avg("total_amount")).collect()


STEPWISE = {
    "daily_sales": daily_sales_stepwise,
    "customer_behavior": customer_behavior_stepwise,
    "missing_values": missing_values_stepwise,
    "basic_statistics": basic_statistics_stepwise,
}


def median_times(*runs) -> list[float]:
    """Median seconds of each run; runs take turns, so that a slow moment meets all of them."""
    times: list[list[float]] = [[] for _ in runs]
    for run in runs:
        run()
    for _ in range(RUNS):
        for run, taken in zip(runs, times):
            start = time.perf_counter()
            run()
            taken.append(time.perf_counter() - start)
    return [round(statistics.median(t), 4) for t in times]


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("basketry-bench")
        .config("spark.sql.shuffle.partitions", str(CPUS))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    for k in HEADLINE:  # compile and warm up everything before anything is timed
        sink(catalog.QUERIES[k](spark, SF_DIR))
    own = {k: (lambda k=k: sink(catalog.QUERIES[k](spark, SF_DIR))) for k in HEADLINE}
    compare = os.environ.get("BENCH_COMPARE", "1") == "1"
    stepwise = {k: (lambda f=f: f(spark)) for k, f in STEPWISE.items() if compare}
    times = {k: median_times(run, *([stepwise[k]] if k in stepwise else [])) for k, run in own.items()}
    queries = {k: t[0] for k, t in times.items()}
    report = {
        "metric": "headline_queries_total",
        "value": round(sum(queries.values()), 3),
        "unit": "sec",
        "queries": queries,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }
    if compare:
        report["compare"] = {k: {"stepwise": times[k][1], "ours": times[k][0]} for k in stepwise}
    spark.stop()
    print(json.dumps(report))


if __name__ == "__main__":
    main()
