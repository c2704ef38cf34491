"""De-duplication, ranking and attribution of vehicle events."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.operators import attribution, ranking
from forecourt.plans.courtesy import courtesy_fact
from forecourt.plans.fleet import hist_inc_union
from workload.registry import query, table
from workload.standins import (DELIVERIES_SQL, EVENTS_AS_OF, EVENTS_SQL, STAMP, calendar,
                               deliveries, orders, retired_events, stamp)

NEW_ON = dt.date(2001, 10, 17)


@query("""
WITH r AS (SELECT l_partkey, l_suppkey, CAST(l_shipdate AS DATE) AS ship_dt, l_orderkey,
                  CAST(l_linenumber AS BIGINT) AS l_linenumber,
                  row_number() OVER (PARTITION BY l_partkey, l_suppkey
                      ORDER BY l_shipdate DESC, l_linenumber, l_orderkey) AS rn
           FROM lineitem)
SELECT * EXCLUDE rn FROM r WHERE rn = 1""")
def dedup_keep_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey", F.to_date("l_shipdate").alias("ship_dt"), "l_orderkey",
        "l_linenumber")
    return ranking.keep_latest(rows, ["l_partkey", "l_suppkey"], ["ship_dt"])


@query("WITH " + DELIVERIES_SQL + " SELECT veh, dealer, proc, model_yr, CAST(src AS BIGINT) AS src,"
       " model FROM pairs")
def first_per_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _owners(spark, sf_dir).toDF("veh", "dealer", "proc", "model_yr", "src", "model")


def _owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    sold = deliveries(spark, sf_dir).select(
        "veh_id_nbr", "biz_assoc_id", "orig_proc_dt", *attribution.OWNER_COLUMNS[2:])
    return attribution.first_per_pair(sold)


@query("WITH " + DELIVERIES_SQL + """
SELECT veh AS veh_id_nbr, dealer AS biz_assoc_id, proc AS orig_proc_dt,
       in_nbr AS in_dlr_num, out_nbr AS out_dlr_num FROM ranked""")
def owner_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    owners = _owners(spark, sf_dir).select("veh_id_nbr", "biz_assoc_id", "orig_proc_dt")
    return attribution.owner_sequence(owners)


@query("""
WITH e AS (SELECT DISTINCT event_id, user_id, event_type, ts FROM events)
SELECT event_id, user_id, event_type,
       row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq_asc,
       row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS seq_desc
FROM e""")
def event_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    return attribution.event_sequence(rows, "user_id", ["ts", "event_id"],
                                      [F.date_trunc("minute", "ts")]).drop("ts")


@query("""
SELECT user_id, coalesce(arg_min(value, (ts, event_id)) FILTER (WHERE event_type <> 'error'), -1)
       AS first_value FROM events GROUP BY user_id""")
def first_non_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").withColumn(
        "first_value", F.when(F.col("event_type") != "error", F.col("value")))
    return ranking.first_non_null(rows, ["user_id"], "first_value", ["ts", "event_id"]).fillna(
        -1.0, subset=["first_value"])


def _attribution_sql(rank: str) -> str:
    return "WITH " + DELIVERIES_SQL + "," + EVENTS_SQL + f"""
SELECT vin, outdate, today, CAST(miles AS BIGINT) AS miles, outtype, dealer, proc
FROM ev JOIN ranked ON veh = vin AND {rank} = 1 AND outdate > proc"""


def _attributed(spark: SparkSession, sf_dir: str, which: str) -> DataFrame:
    rows = attribution.attribute_events(retired_events(spark, sf_dir), _owners(spark, sf_dir), which)
    return rows.select("vin", "outdate", F.col("todaydate").alias("today"),
                       F.col("outmile").alias("miles"), "outtype",
                       F.col("biz_assoc_id").alias("dealer"), F.col("orig_proc_dt").alias("proc"))


@query(_attribution_sql("in_nbr"))
def owner_attribution_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _attributed(spark, sf_dir, "first")


@query(_attribution_sql("out_nbr"))
def owner_attribution_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _attributed(spark, sf_dir, "last")


LATEST_SQL = """
latest AS (SELECT * EXCLUDE rn FROM (
             SELECT *, row_number() OVER (PARTITION BY vin, outdate, days, miles
                        ORDER BY today DESC, loan, outtype) AS rn FROM ev)
           WHERE rn = 1 AND today < DATE '""" + str(EVENTS_AS_OF) + """')"""
FIRST_SEEN_SQL = """
seen AS (SELECT * EXCLUDE rn FROM (
             SELECT *, row_number() OVER (PARTITION BY vin, outdate, days, miles
                        ORDER BY today, loan, outtype) AS rn FROM ev)
         WHERE rn = 1)"""
# the earliest event per vehicle; ties as in the library: out date, days, miles, type, loan
HISTORY_SQL = "WITH " + DELIVERIES_SQL + "," + EVENTS_SQL + "," + LATEST_SQL + """,
in_rows AS (SELECT *, row_number() OVER (PARTITION BY vin
                ORDER BY today, outdate, days, miles, outtype, loan) AS n
            FROM latest JOIN ranked ON veh = vin AND in_nbr = 1 AND outdate > proc),
out_rows AS (SELECT * FROM latest JOIN ranked ON veh = vin AND out_nbr = 1 AND outdate > proc),
history AS (
    SELECT vin, today, proc, outdate, dealer, days, miles, outtype, src, model, model_yr, loan
    FROM in_rows WHERE n = 1
    UNION
    SELECT vin, today, proc, outdate, dealer, days, miles, outtype, src, model, model_yr, loan
    FROM out_rows o
    WHERE NOT EXISTS (SELECT 1 FROM in_rows i WHERE i.n = 1 AND i.vin = o.vin
                      AND i.dealer = o.dealer AND i.today = o.today)
      AND NOT EXISTS (SELECT 1 FROM in_rows i WHERE i.n = 1 AND i.vin = o.vin
                      AND i.outdate = o.outdate AND i.today = o.today))"""
PUBLISHED_SQL = """
SELECT vin AS veh_id_nbr, today AS file_dt, proc AS in_svc_dt, outdate AS out_svc_dt,
       dealer AS biz_assoc_id, CAST(days AS BIGINT) AS day_in_svc_cnt,
       CAST(miles AS BIGINT) AS out_svc_mil_cnt, outtype AS out_svc_type_cd,
       CAST(src AS BIGINT) AS sell_src_cd, model AS veh_prod_rpt_model_cd, model_yr,
       loan AS loan_great_than_60_day_cd,
       CASE src WHEN 11 THEN 'Buick' WHEN 48 THEN 'GMC' END AS sell_src_desc"""


@query(HISTORY_SQL + PUBLISHED_SQL + " FROM history")
def event_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attribution.event_history(retired_events(spark, sf_dir), _owners(spark, sf_dir),
                                     EVENTS_AS_OF)


def new_events_sql(day: str) -> str:
    return "WITH " + DELIVERIES_SQL + "," + EVENTS_SQL + "," + FIRST_SEEN_SQL + PUBLISHED_SQL + f"""
FROM seen JOIN ranked ON veh = vin AND out_nbr = 1 AND outdate > proc
WHERE today = DATE '{day}'"""


@query(new_events_sql(str(NEW_ON)))
def new_rows_today(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attribution.new_events(retired_events(spark, sf_dir), _owners(spark, sf_dir), NEW_ON)


@query("""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_dt FROM orders""")
def hist_inc_union_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = orders(spark, sf_dir).select("o_orderkey", "order_dt")
    cut = F.col("order_dt") <= "1999-12-31"
    return hist_inc_union(rows.where(cut), rows.where(~cut).select("order_dt", "o_orderkey"))


PUBLISH_AS_OF = dt.date(2001, 8, 2)
PUBLISH_SINCE = dt.date(1995, 1, 1)


@query(HISTORY_SQL.replace(str(EVENTS_AS_OF), str(PUBLISH_AS_OF))
       .replace("WHERE l_returnflag <> 'R'),",
                f"WHERE l_returnflag <> 'R' AND CAST(l_shipdate AS DATE) BETWEEN "
                f"DATE '{PUBLISH_SINCE}' AND DATE '{PUBLISH_AS_OF}' - 1 AND "
                f"EXISTS (SELECT 1 FROM orders WHERE CAST(o_orderdate AS DATE) = "
                f"DATE '{PUBLISH_AS_OF}' - 1)),")
       + "," + FIRST_SEEN_SQL + """,
todays AS (SELECT DISTINCT vin, today, proc, outdate, dealer, days, miles, outtype, src, model,
                  model_yr, loan
           FROM seen JOIN ranked ON veh = vin AND out_nbr = 1 AND outdate > proc
           WHERE today = DATE '""" + str(PUBLISH_AS_OF) + """'),
rows_ AS (SELECT * FROM history UNION ALL SELECT * FROM todays)""" + PUBLISHED_SQL.replace(
           "SELECT vin AS veh_id_nbr", "SELECT CAST(vin AS VARCHAR) AS veh_id_nbr") + f""",
       '171749' AS src_sys_id,
       vin || '|' || today || '|' || outdate || '|171749' AS src_sys_uniq_prim_key_val,
       'veh_id_nbr|file_dt|out_svc_dt|src_sys_id' AS src_sys_uniq_prim_key_col_val,
       CAST(1 AS BIGINT) AS meas_cnt, 'N' AS dw_anom_flg, DATE '{STAMP}' AS dw_mod_dt,
       'courtesy-fact' AS dw_job_id, 'I' AS src_sys_iud_cd
FROM rows_""")
def courtesy_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = courtesy_fact(retired_events(spark, sf_dir), deliveries(spark, sf_dir),
                         calendar(spark, sf_dir), PUBLISH_AS_OF, PUBLISH_SINCE, "courtesy-fact",
                         stamp())
    return fact.withColumn("dw_mod_dt", F.to_date("dw_mod_ts")).drop("dw_mod_ts")
