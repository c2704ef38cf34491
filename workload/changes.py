"""Change feeds, enrichment, objectives, audit columns, target shape."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, IntegerType, LongType, StringType

from forecourt.functions.text import code_label, yes_no
from forecourt.operators.audit import conform, conform_positional, with_audit
from forecourt.operators.change import change_feed, exclude_keys, latest_slice
from forecourt.operators.enrich import apply_overrides, enrich_left
from forecourt.operators.objectives import objective_sheets
from forecourt.plans.forecast import forecast_feed, system_message_feed
from forecourt.plans.staging import objective_stage_rows
from forecourt.plans.targets import DEALER_FORECAST
from forecourt.session import materialize
from forecourt.sources.feeds import columns
from workload.registry import query, table
from workload.standins import STAMP, orders, stamp

INT, LONG, TEXT, DATE = IntegerType(), LongType(), StringType(), DateType()


@query("""
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS line_nbr, CAST(l_quantity AS BIGINT) AS qty,
       CAST(CAST(l_extendedprice AS DECIMAL(14, 2)) AS DOUBLE) AS price,
       CAST(l_shipdate AS DATE) AS ship_dt, CAST(l_suppkey AS VARCHAR) AS dealer
FROM lineitem""")
def conform_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    # by position first (new names and types), then by name to the target order
    source = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate")
    named = conform_positional(source, columns(
        ("dealer", TEXT), ("L_ORDERKEY", LONG), ("line_nbr", INT), ("qty", INT),
        ("price", DecimalType(14, 2)), ("ship_dt", DATE)))
    return conform(named, columns(
        ("l_orderkey", LONG), ("line_nbr", INT), ("qty", INT), ("price", DecimalType(14, 2)),
        ("ship_dt", DATE), ("dealer", TEXT)))


@query("""
SELECT event_id, user_id, CAST(ts AS DATE) AS load_dt FROM events
WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)""")
def latest_slice_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(
        "event_id", "user_id", F.to_date("ts").alias("load_dt"))
    return latest_slice(rows, "load_dt")


@query("""
SELECT p_partkey, p_brand, CASE p_brand WHEN 'Brand#1' THEN 'TXX' WHEN 'Brand#2' THEN 'EXV'
       WHEN 'Brand#3' THEN 'SAP' ELSE p_type END AS p_type FROM part""")
def code_overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    return apply_overrides(part, "p_brand", "p_type",
                           {"Brand#1": "TXX", "Brand#2": "EXV", "Brand#3": "SAP"})


@query("""
SELECT o_orderkey, coalesce(CASE o_orderpriority WHEN '1-URGENT' THEN 'now'
       WHEN '2-HIGH' THEN 'soon' WHEN '3-MEDIUM' THEN 'later' END, 'none') AS label
FROM orders""")
def code_label_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = code_label(F.col("o_orderpriority"),
                       {"1-URGENT": "now", "2-HIGH": "soon", "3-MEDIUM": "later"})
    return table(spark, sf_dir, "orders").select("o_orderkey", label.alias("label")).fillna(
        "none", subset=["label"])


@query("""
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey,
       coalesce(p_name, '-') AS p_name, coalesce(s_name, '-') AS s_name,
       CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS returned
FROM lineitem
LEFT JOIN (SELECT DISTINCT p_partkey, p_name FROM part WHERE p_size > 5) ON p_partkey = l_partkey
LEFT JOIN (SELECT DISTINCT s_suppkey, s_name FROM supplier) ON s_suppkey = l_suppkey""")
def enrich_left_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        yes_no(F.col("l_returnflag"), "R").alias("returned"))
    part = table(spark, sf_dir, "part").where("p_size > 5").select("p_partkey", "p_name")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return enrich_left(lines, [(part, {"l_partkey": "p_partkey"}),
                               (supplier, {"l_suppkey": "s_suppkey"})]).fillna(
        "-", subset=["p_name", "s_name"])


@query("""
SELECT l_orderkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber FROM lineitem a
WHERE NOT EXISTS (SELECT 1 FROM lineitem b WHERE b.l_linenumber = 1
                  AND b.l_orderkey = a.l_orderkey AND b.l_suppkey = a.l_suppkey)""")
def exclude_seen_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber")
    return exclude_keys(lines, lines.where("l_linenumber = 1"), ["l_orderkey", "l_suppkey"])


# published: the orders before 2000; new: those since 1997, moved to another status
OLD_NEW_SQL = """
WITH o AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS order_dt, o_orderstatus
           FROM orders),
old AS (SELECT * FROM o WHERE order_dt < DATE '2000-01-01'),
new AS (SELECT o_orderkey, o_custkey, order_dt,
               CASE WHEN order_dt < DATE '1998-07-01' THEN 'F' ELSE o_orderstatus END
                   AS o_orderstatus
        FROM o WHERE order_dt >= DATE '1997-01-01')
"""


def _old_new(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    src = orders(spark, sf_dir).select("o_orderkey", "o_custkey", "order_dt", "o_orderstatus")
    new = src.where(F.col("order_dt") >= "1997-01-01").withColumn(
        "o_orderstatus", F.when(F.col("order_dt") < "1998-07-01", "F")
        .otherwise(F.col("o_orderstatus")))
    return src.where(F.col("order_dt") < "2000-01-01"), new


@query(OLD_NEW_SQL + """
SELECT new.*, CASE WHEN o_orderkey IN (SELECT o_orderkey FROM old) THEN 'U' ELSE 'I' END
       AS src_sys_iud_cd FROM new
UNION ALL
SELECT old.*, 'D' AS src_sys_iud_cd FROM old
WHERE o_orderkey NOT IN (SELECT o_orderkey FROM new)""")
def change_feed_iud(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _old_new(spark, sf_dir)
    return change_feed(new, old, ["o_orderkey"])


@query(OLD_NEW_SQL + """
SELECT new.*, CASE WHEN o_orderkey IN (SELECT o_orderkey FROM old) THEN 'U' ELSE 'I' END
       AS src_sys_iud_cd FROM new
WHERE NOT EXISTS (SELECT 1 FROM old WHERE old.o_orderkey = new.o_orderkey
                  AND old.o_orderstatus = new.o_orderstatus)
UNION ALL
SELECT old.*, 'D' AS src_sys_iud_cd FROM old
WHERE o_orderkey NOT IN (SELECT o_orderkey FROM new)""")
def change_feed_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _old_new(spark, sf_dir)
    return change_feed(new, old, ["o_orderkey"], compare_cols=["o_orderstatus"])


@query(f"""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_dt, '171749' AS src_sys_id,
       o_orderkey || '|' || CAST(o_orderdate AS DATE) || '|171749' AS src_sys_uniq_prim_key_val,
       'o_orderkey|order_dt|src_sys_id' AS src_sys_uniq_prim_key_col_val,
       CAST(1 AS BIGINT) AS meas_cnt, 'N' AS dw_anom_flg, DATE '{STAMP}' AS dw_mod_dt,
       'orders-job' AS dw_job_id, 'I' AS src_sys_iud_cd
FROM orders""")
def audit_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = orders(spark, sf_dir).select("o_orderkey", "order_dt")
    audited = with_audit(rows, ["o_orderkey", "order_dt"], "171749", "orders-job", stamp())
    return audited.withColumn("dw_mod_dt", F.to_date("dw_mod_ts")).drop("dw_mod_ts")


# two sheets: customers (small business) and suppliers (dealer fleet); a negative
# balance stands for a missing dealer code
SHEETS_SQL = """
sheets AS (
    SELECT 'small_business' AS sheet, c_custkey AS bac, c_name AS dealer, c_mktsegment AS model,
           'C' || c_nationkey AS isas, CAST(floor(c_acctbal) AS BIGINT) AS objective,
           CAST(floor(c_acctbal / 2) AS BIGINT) AS unadjusted_objective,
           CASE WHEN c_acctbal > 5000 THEN 'X' ELSE '' END AS zero_dealer_adjusted
    FROM customer WHERE c_acctbal >= 0
    UNION ALL
    SELECT 'dealer_fleet', s_suppkey, s_name,
           CASE WHEN s_nationkey < 5 THEN 'Trax' WHEN s_nationkey < 10 THEN 'Savana Cutaway'
                ELSE 'Other' END,
           CASE WHEN s_nationkey < 5 THEN 'TXX' WHEN s_nationkey < 10 THEN 'SAP'
                ELSE 'S' || s_nationkey END, CAST(floor(s_acctbal) AS BIGINT),
           CAST(floor(s_acctbal / 2) AS BIGINT),
           CASE WHEN s_acctbal > 5000 THEN 'X' ELSE '' END
    FROM supplier WHERE s_acctbal >= 0),
stacked AS (
    SELECT bac, dealer, model, isas, zero_dealer_adjusted,
           CASE sheet WHEN 'small_business' THEN 711 ELSE 714 END AS kpi, objective FROM sheets
    UNION ALL
    SELECT bac, dealer, model, isas, zero_dealer_adjusted,
           CASE sheet WHEN 'small_business' THEN 716 ELSE 715 END, unadjusted_objective
    FROM sheets)"""


def _sheets(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    def sheet(df, key, name, model, nation, balance, mark):
        return df.select(
            F.when(F.col(balance) >= 0, F.col(key)).alias("bac"), F.col(name).alias("dealer"),
            model.alias("model"), F.concat(F.lit(mark), F.col(nation)).alias("isas"),
            F.floor(F.col(balance)).cast("int").alias("objective"),
            F.floor(F.col(balance) / 2).cast("int").alias("unadjusted_objective"),
            F.when(F.col(balance) > 5000, "X").otherwise("").alias("zero_dealer_adjusted"))

    nation = F.col("s_nationkey")
    fleet_model = (F.when(nation < 5, "Trax").when(nation < 10, "Savana Cutaway")
                   .otherwise("Other"))
    return {
        "small_business": sheet(table(spark, sf_dir, "customer"), "c_custkey", "c_name",
                                F.col("c_mktsegment"), "c_nationkey", "c_acctbal", "C"),
        "dealer_fleet": sheet(table(spark, sf_dir, "supplier"), "s_suppkey", "s_name",
                              fleet_model, "s_nationkey", "s_acctbal", "S")}


PROCESS_DATE = dt.date(2023, 6, 1)


@query("WITH " + SHEETS_SQL + f"""
SELECT bac, dealer, model, isas, zero_dealer_adjusted, CAST(kpi AS BIGINT) AS kpi_type_code,
       objective, DATE '{PROCESS_DATE}' AS process_date FROM stacked""")
def objective_sheets_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return objective_sheets(_sheets(spark, sf_dir), PROCESS_DATE)


# the model dimension is the parts of a nation-like code, the KPI types a row per code
FORECAST_SQL = "WITH " + SHEETS_SQL + """,
modl AS (SELECT DISTINCT 'C' || n_nationkey AS isas, 11 AS src, n_nationkey AS code,
                n_name AS descr FROM nation WHERE n_regionkey < 4),
kpis AS (SELECT DISTINCT 711 + r_regionkey AS kpi, 'm' || r_regionkey AS short, r_name AS long
         FROM region),
rows_ AS (SELECT s.bac, s.kpi, s.isas, s.objective, zero_dealer_adjusted AS x, m.src, m.code,
                 m.descr, k.short, k.long
          FROM stacked s LEFT JOIN modl m ON m.isas = s.isas LEFT JOIN kpis k ON k.kpi = s.kpi),
feed AS (SELECT *, CASE WHEN kpi >= 714 THEN 'U' ELSE 'I' END AS iud FROM rows_
         UNION ALL
         SELECT 1000000000 + bac, kpi, isas, objective, x, src, code, descr, short, long, 'D'
         FROM rows_ WHERE kpi >= 714)"""


@query(FORECAST_SQL + f"""
SELECT DATE '{PROCESS_DATE}' AS frcst_rpt_dt, 'US' AS iso_ctry_cd, bac AS biz_assoc_cd,
       CAST(coalesce(src, -1) AS BIGINT) AS sell_src_cd,
       CAST(coalesce(code, -1) AS BIGINT) AS frcst_model_cd, DATE '{STAMP}' AS data_upd_dt,
       CAST(kpi AS BIGINT) AS kpi_type_cd, '335' AS src_sys_id,
       CASE WHEN x = 'X' THEN 'Y' ELSE 'N' END AS zero_adj_flg, objective AS frcst_cnt,
       coalesce(descr, '-') AS frcst_model_desc, isas AS isas_brand_cd,
       coalesce(short, '-') AS kpi_metric_short_desc, coalesce(long, '-') AS kpi_metric_long_desc,
       iud AS src_sys_iud_cd
FROM feed""")
def forecast_feed_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = objective_stage_rows(_sheets(spark, sf_dir), PROCESS_DATE, "stage", stamp())
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    models = nation.where("n_regionkey < 4").select(
        F.concat(F.lit("C"), "n_nationkey").alias("isas_brand_cd"), F.lit(11).alias("sell_src"),
        F.col("n_nationkey").alias("fcst_modl_cd"), F.col("n_name").alias("fcst_modl_desc"))
    kpis = region.select(
        (F.col("r_regionkey") + 711).alias("kpi_type_cd"),
        F.concat(F.lit("m"), "r_regionkey").alias("metric_short_desc"),
        F.col("r_name").alias("metric_long_desc"))

    def feed(rows, published, written):
        return forecast_feed(rows, models, kpis, published, PROCESS_DATE, "forecast", written)

    # published before: the dealer-fleet sets and small-business unadjusted, plus dealers
    # that are gone now
    known = stage.where(F.col("kpi_type_code") >= 714)
    gone = known.withColumn("bac", F.col("bac") + 1_000_000_000)
    nothing = spark.createDataFrame([], DEALER_FORECAST)
    # published by an earlier run, whose stamp is no part of the key
    before = feed(known.unionByName(gone), nothing, stamp() - F.expr("INTERVAL 40 DAYS"))
    rows = feed(stage, materialize(before, "published"), stamp())
    return (rows.withColumn("data_upd_dt", F.to_date("data_upd_dt"))
            .drop("dw_mod_ts", "dw_job_id", "dw_anom_flg", "meas_cnt", "src_sys_uniq_prim_key_val",
                  "src_sys_uniq_prim_key_col_val")
            .fillna(-1, subset=["sell_src_cd", "frcst_model_cd"])
            .fillna("-", subset=["frcst_model_desc", "kpi_metric_short_desc",
                                 "kpi_metric_long_desc"]))


# messages: one per conversation turn; loads by role, the users' load being the newest
MESSAGES_SQL = """
WITH m AS (SELECT DISTINCT 'US' AS ntl_cd, 'SYS' AS sys_cd, role AS sys_desc,
                  conv_id || '-' || turn AS id, text AS msg,
                  DATE '2023-05-25' + CAST(turn AS INTEGER) AS eff,
                  CASE role WHEN 'user' THEN DATE '2023-06-02' ELSE DATE '2023-06-01' END AS upd
           FROM conversations),
stage AS (SELECT * FROM m WHERE eff >= DATE '2023-05-26'),
new AS (SELECT * FROM stage WHERE upd = (SELECT max(upd) FROM stage)),
old AS (SELECT * FROM stage WHERE eff < DATE '2023-05-28')
"""


@query(MESSAGES_SQL + """
SELECT ntl_cd, sys_cd, sys_desc, id AS sys_msg_identity, '171749' AS src_sys_id, msg AS msg_txt,
       eff AS eff_dt, upd AS last_upd_dt,
       CASE WHEN EXISTS (SELECT 1 FROM old WHERE old.id = new.id AND old.sys_desc = new.sys_desc)
            THEN 'U' ELSE 'I' END AS src_sys_iud_cd
FROM new
UNION ALL
SELECT ntl_cd, sys_cd, sys_desc, id, '171749', msg, eff, upd, 'D' FROM old
WHERE NOT EXISTS (SELECT 1 FROM new WHERE old.id = new.id AND old.sys_desc = new.sys_desc)""")
def system_message_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = table(spark, sf_dir, "conversations").select(
        F.lit("US").alias("ntl_cd"), F.lit("SYS").alias("sys_cd"), F.col("role").alias("sys_desc"),
        F.concat_ws("-", "conv_id", "turn").alias("sys_msg_identity"),
        F.col("text").alias("msg_txt"),
        F.date_add(F.lit("2023-05-25").cast("date"), F.col("turn").cast("int")).alias("eff_dt"),
        F.lit("2030-01-01").cast("date").alias("exp_dt"), F.lit("info").alias("msg_type"),
        F.lit("usr").alias("last_upd_usr_identity"),
        F.when(F.col("role") == "user", F.lit("2023-06-02")).otherwise(F.lit("2023-06-01"))
        .cast("date").alias("last_upd_dt")).distinct()
    published = with_audit(stage.where(F.col("eff_dt") < "2023-05-28"),
                           ["sys_msg_identity"], "171749", "messages", stamp())
    feed = system_message_feed(stage, published, dt.date(2023, 5, 26), "messages", stamp())
    return feed.select("ntl_cd", "sys_cd", "sys_desc", "sys_msg_identity", "src_sys_id", "msg_txt",
                       "eff_dt", "last_upd_dt", "src_sys_iud_cd")
