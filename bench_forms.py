"""Time the plain wording of an operation against the one the library uses.

Prints one JSON line per pair. Same data, same result, BENCH_SF_DIR and
BENCH_CPUS as in bench.py. ``hot key`` pairs run on line items whose vehicle is
the same for a third of the rows.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import Window
from pyspark.sql import functions as F

import bench
from forecourt.fixed_values import MONTHS
from forecourt.operators import cumulative
from forecourt.operators.calendar import calendar_window
from forecourt.operators.change import exclude_keys
from forecourt.operators.ranking import sequence_numbers
from forecourt.operators.reconcile import reconcile_sets
from workload import sales, standins  # noqa: F401
from workload.registry import QUERIES


def forms(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    snap, cal = standins.snapshots(spark, sf_dir), standins.calendar(spark, sf_dir)
    days = calendar_window(cal, standins.AS_OF, base_year=standins.BASE_YEAR)

    def union_branches():
        wide = cumulative.wide_month_sum(snap)
        parts = [wide.join(days, wide.sales_through_dt == days.sales_thru_dt)
                 .where(f"rpt_mth_nbr >= {i}").select("rpt_dt", F.lit(i).alias("n"), m)
                 for i, m in enumerate(MONTHS, 1)]
        all_months = parts[0]
        for part in parts[1:]:
            all_months = all_months.union(part)
        return all_months.distinct()

    yield "12 branches / one pass", union_branches, lambda: cumulative.mtd_by_month_category(
        snap, days)

    yield ("fleet fact: 48 branches / one pass", lambda: plain_fact(spark, sf_dir),
           lambda: QUERIES["fleet_fact_publish"](spark, sf_dir))

    dated = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", F.to_date("o_orderdate").alias("d"))
    reports = dated.groupBy("d").agg(F.count("*").alias("n"))

    def or_join():
        p = reports.toDF("pd", "pn")
        mon = F.dayofweek("d") == 2
        return dated.join(p, (mon & (F.col("pd") == F.date_sub("d", 2)))
                          | (~mon & (F.col("pd") == F.date_sub("d", 1))), "left")

    def key_join():
        from forecourt.functions.dates import previous_report_date
        p = reports.toDF("pd", "pn")
        return dated.join(p, previous_report_date(F.col("d")) == F.col("pd"), "left")

    yield "OR join / computed key", or_join, key_join

    keys = lines.select("l_orderkey", "l_suppkey", "l_linenumber")
    seen = keys.where("l_linenumber = 1")

    def not_in():
        keys.createOrReplaceTempView("k")
        seen.createOrReplaceTempView("s")
        return spark.sql("SELECT * FROM k WHERE l_orderkey || '|' || l_suppkey NOT IN "
                         "(SELECT l_orderkey || '|' || l_suppkey FROM s)")

    yield "NOT IN on joined text / anti join", not_in, lambda: exclude_keys(
        keys, seen, ["l_orderkey", "l_suppkey"])

    a, b = lines.where("l_discount < 0.06"), lines.where("l_discount > 0.02")
    yield ("two EXCEPT ALL / one aggregation",
           lambda: a.exceptAll(b).withColumn("s", F.lit("l")).union(
               b.exceptAll(a).withColumn("s", F.lit("r"))),
           lambda: reconcile_sets(a, b))

    rows = lines.select(
        F.expr("IF(l_returnflag = 'R', 0L, l_partkey)").alias("veh"), "l_orderkey", "l_linenumber",
        F.to_date("l_shipdate").alias("d"), F.monotonically_increasing_id().alias("id"))
    window = Window.partitionBy("veh").orderBy("d", "id")

    yield ("hot key: row_number per key / numbered in pieces",
           lambda: rows.withColumn("n", F.row_number().over(window)),
           lambda: sequence_numbers(rows, ["veh"], ["d", "id"], [F.col("d")], "n"))


def plain_fact(spark, sf_dir):
    """The fleet fact from four frames of twelve branches each and a join on six keys."""
    snap, cal = standins.snapshots(spark, sf_dir), standins.calendar(spark, sf_dir)
    names = ["rpt_dt", "sales_thru_dt", "rpt_mth_nbr", "rpt_mth_abbr_txt"]
    sums = [F.sum(m).alias(m) for m in MONTHS]

    def stack(parts):
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.union(part)
        return whole.distinct()

    def named(df, i):
        return df.withColumn("sales_mth_cat_nbr", F.lit(i)).withColumn(
            "sales_mth_cat", F.lit(MONTHS[i - 1].title()))

    daily, mtd = [], []
    for mode, base in (("historical", standins.BASE_YEAR), ("incremental", None)):
        days = calendar_window(cal, standins.AS_OF, mode, base_year=base)
        now = snap.join(days, F.col("sales_through_dt") == F.col("sales_thru_dt")).groupBy(
            *names).agg(*sums)
        closed = F.col("sales_through_dt").isin(F.date_sub("curr_yr_start_dt", 1),
                                                F.date_sub("prior_yr_start_dt", 1))
        before = (snap.withColumn("jan_", F.col("jan"))
                  .join(days, F.col("sales_through_dt") == F.date_sub("sales_thru_dt", 1))
                  .withColumn("jan", F.when(closed, 0).otherwise(F.col("jan_")))
                  .groupBy(*names).agg(*sums).select(
                      F.col("rpt_dt").alias("p_dt"), *[F.col(m).alias(f"p_{m}") for m in MONTHS]))
        monday = F.date_format("rpt_dt", "EEE") == "Mon"
        either = ((monday & (F.col("p_dt") == F.date_sub("rpt_dt", 2)))
                  | (~monday & (F.col("p_dt") == F.date_sub("rpt_dt", 1))))
        daily.append(stack([
            named(now.where(F.col("rpt_mth_nbr") == i).join(before, either, "left")
                  .groupBy(*names).agg(F.sum(F.col(m) - F.col(f"p_{m}")).alias("daily")), i)
            for i, m in enumerate(MONTHS, 1)]))
        mtd.append(stack([named(now.select(*names, F.col(m).alias("mtd")), i)
                          for i, m in enumerate(MONTHS, 1)]).where(
            "rpt_mth_nbr >= sales_mth_cat_nbr"))
    return daily[0].union(daily[1]).join(
        mtd[0].union(mtd[1]), [*names, "sales_mth_cat_nbr", "sales_mth_cat"])


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = bench.session(os.environ.get("BENCH_CPUS", "8"))
    for name, plain, ours in forms(spark, sf_dir):
        seconds = []
        for make in (plain, ours):
            times = []
            for _ in range(2):
                start = time.perf_counter()
                bench.run(make())
                times.append(time.perf_counter() - start)
            seconds.append(round(times[-1], 2))
        print(json.dumps({"pair": name, "plain": seconds[0], "library": seconds[1]}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
