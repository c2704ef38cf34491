"""The test tables in the shape of the feeds, in Spark and in SQL.

Snapshot: one "model" per order priority; its month columns hold the orders
counted so far in each month of the year. Calendar: the days with orders.
Deliveries: line items that were not returned, part = vehicle, supplier =
dealer. Retired-out events: returned line items.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.fixed_values import MONTHS
from forecourt.session import materialize
from workload.registry import table

# All order days lie before it; the newest one is the day before.
AS_OF = dt.date(2001, 8, 2)
# The sales year after the first one, so that the history starts with the data.
BASE_YEAR = 1996
# All event files are dated before it.
EVENTS_AS_OF = dt.date(2001, 12, 1)
STAMP = "2024-01-01"

# The order priorities.
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def stamp():
    return F.lit(STAMP).cast("date").cast("timestamp")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn("order_dt", F.to_date("o_orderdate"))


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """model_nm, jan..dec, rpt_dt, sales_through_dt."""
    # one row per day leaves the map side; the models become rows afterwards
    counts = ", ".join(f"named_struct('model_nm', '{p}', 'cnt', count_if(o_orderpriority = '{p}'))"
                       for p in PRIORITIES)
    daily = (orders(spark, sf_dir).groupBy("order_dt").agg(F.expr(f"array({counts}) AS models"))
             .selectExpr("order_dt", "inline(models)"))
    so_far = ("OVER (PARTITION BY model_nm, year(order_dt) ORDER BY order_dt "
              "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
    # a staging table in its own right, so the queries that read it several times
    # do not count the orders each time
    return materialize(daily.selectExpr(
        "model_nm", *[f"CAST(sum(IF(month(order_dt) = {i}, cnt, 0)) {so_far} AS INT) AS {m}"
                      for i, m in enumerate(MONTHS, 1)],
        "date_add(order_dt, 1) AS rpt_dt", "order_dt AS sales_through_dt"), "snapshots")


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per day with orders; a dimension table, so it is written once."""
    days = orders(spark, sf_dir).selectExpr("order_dt AS sales_thru_dt").distinct()
    return materialize(days.selectExpr(
        "sales_thru_dt", "trunc(sales_thru_dt, 'month') AS curr_mth_start_dt",
        "trunc(sales_thru_dt, 'year') AS curr_yr_start_dt",
        "trunc(add_months(sales_thru_dt, -12), 'year') AS prior_yr_start_dt",
        "add_months(sales_thru_dt, -12) AS prior_year_current_day_dt", "'US' AS iso_ctry_cd"),
        "calendar")


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") != "R")
    return line.select(
        F.col("l_partkey").alias("veh_id_nbr"), F.col("l_suppkey").alias("biz_assoc_id"),
        F.to_date("l_shipdate").alias("orig_proc_dt"),
        F.year("l_shipdate").alias("model_yr"),
        F.when(F.col("l_linestatus") == "F", 11).otherwise(48).alias("sell_src_cd"),
        F.col("l_returnflag").alias("veh_prod_rpt_model_cd"),
        F.lit("US").alias("ntl_cd"), F.lit(25).alias("kpi_type_cd"),
        F.lit(1).alias("veh_deliv_cnt"))


def retired_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R")
    ship = F.to_date("l_shipdate")
    return line.select(
        F.col("l_partkey").alias("vin"),
        F.trunc(ship, "quarter").alias("outdate"),
        F.date_add(ship, 1).alias("todaydate"),
        F.when(F.col("l_linestatus") == "F", 30).otherwise(60).alias("daysinservice"),
        (F.floor(F.col("l_quantity") / 25) * 1000).cast("int").alias("outmile"),
        F.col("l_linenumber").cast("string").alias("outtype"),
        F.when(F.col("l_quantity") > 45, "Loan60").otherwise("None").alias("loangreaterthan60"))


SNAPSHOT_SQL = """
days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders),
models AS (SELECT DISTINCT o_orderpriority AS model_nm FROM orders),
cnt AS (SELECT CAST(o_orderdate AS DATE) AS d, o_orderpriority AS model_nm, count(*) AS c
        FROM orders GROUP BY 1, 2),
dense AS (SELECT days.d, models.model_nm, coalesce(cnt.c, 0) AS c
          FROM days CROSS JOIN models
          LEFT JOIN cnt ON cnt.d = days.d AND cnt.model_nm = models.model_nm),
snap AS (SELECT model_nm, d + 1 AS rpt_dt, d AS sales_through_dt, """ + ", ".join(
    f"CAST(sum(CASE WHEN month(d) = {i} THEN c ELSE 0 END) OVER w AS BIGINT) AS \"{m}\""
    for i, m in enumerate(MONTHS, 1)) + """
         FROM dense WINDOW w AS (PARTITION BY model_nm, year(d) ORDER BY d)),
wide AS (SELECT rpt_dt, sales_through_dt, """ + ", ".join(
    f'CAST(sum("{m}") AS BIGINT) AS "{m}"' for m in MONTHS) + """
         FROM snap GROUP BY 1, 2),
cal AS (SELECT d AS sales_thru_dt, CAST(date_trunc('month', d) AS DATE) AS curr_mth_start_dt,
               CAST(date_trunc('year', d) AS DATE) AS curr_yr_start_dt,
               CAST(date_trunc('year', d) - INTERVAL 1 YEAR AS DATE) AS prior_yr_start_dt,
               CAST(d - INTERVAL 1 YEAR AS DATE) AS prior_year_current_day_dt,
               CAST(month(d) AS BIGINT) AS rpt_mth_nbr
        FROM days)"""


def month_name(number: str) -> str:
    """Label of a month number in SQL; labels are added last, joins use the numbers."""
    return f"strftime(make_date(2000, CAST({number} AS INTEGER), 1), '%b')"


def month_case(number: str, prefix: str = "") -> str:
    """The month column with a number, as a CASE."""
    branches = " ".join(f'WHEN {i} THEN {prefix}"{m}"' for i, m in enumerate(MONTHS, 1))
    return f"CASE {number} {branches} END"


DELIVERIES_SQL = """
deliv AS (SELECT l_partkey AS veh, l_suppkey AS dealer, CAST(l_shipdate AS DATE) AS proc,
                 CAST(year(l_shipdate) AS BIGINT) AS model_yr,
                 CASE WHEN l_linestatus = 'F' THEN 11 ELSE 48 END AS src, l_returnflag AS model
          FROM lineitem WHERE l_returnflag <> 'R'),
pairs AS (SELECT * EXCLUDE rn FROM (
            SELECT *, row_number() OVER (PARTITION BY veh, dealer
                                         ORDER BY proc, model_yr, src, model) AS rn FROM deliv)
          WHERE rn = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY veh ORDER BY proc, dealer) AS in_nbr,
                  row_number() OVER (PARTITION BY veh ORDER BY proc DESC, dealer DESC) AS out_nbr
           FROM pairs)"""

EVENTS_SQL = """
ev AS (SELECT l_partkey AS vin, CAST(date_trunc('quarter', l_shipdate) AS DATE) AS outdate,
              CAST(l_shipdate AS DATE) + 1 AS today,
              CASE WHEN l_linestatus = 'F' THEN 30 ELSE 60 END AS days,
              CAST(floor(l_quantity / 25) * 1000 AS BIGINT) AS miles,
              CAST(l_linenumber AS VARCHAR) AS outtype,
              CASE WHEN l_quantity > 45 THEN 'Loan60' ELSE 'None' END AS loan
       FROM lineitem WHERE l_returnflag = 'R')"""
