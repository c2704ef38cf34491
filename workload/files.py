"""Feeds as real files: rejects, headers, dated files, arrivals, published tables.

Every query writes a whole table as files of a feed, some with planted faults, and
loads them with the library; the SQL says what must arrive.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, LongType, StringType

from forecourt.functions.dates import within_days
from forecourt.fixed_values import MONTHS
from forecourt.operators.catalog import name_views, publish_table, read_table
from forecourt.operators.load import (append, overwrite, replace_partitions, stored_rows,
                                      verify_write)
from forecourt.operators.objectives import hierarchy_reconcile, objective_sheets
from forecourt.operators.reconcile import BUCKETS, reconcile_sets
from forecourt.plans import staging
from forecourt.session import fresh_path
from forecourt.sources import feeds
from forecourt.sources.delimited import FAULTS_COLUMN, read_by_header, read_delimited
from forecourt.streaming.ingest import read_batches
from workload.changes import PROCESS_DATE, SHEETS_SQL
from workload.registry import query, table
from workload.standins import deliveries, orders, retired_events, snapshots

TEXT, LONG, DATE, MONEY = StringType(), LongType(), DateType(), DecimalType(18, 2)
ORDER = feeds.columns(("o_orderkey", LONG), ("o_custkey", LONG), ("order_dt", DATE),
                      ("price", MONEY))


def files_by(lines: DataFrame, by: str, name: str, order: str | None = None) -> str:
    """Write text lines (value) as one file per value of ``by``, in a folder each."""
    path = fresh_path(lines.sparkSession, name)
    dealt = lines.repartition(by)
    if order:
        dealt = dealt.sortWithinPartitions(by, order)
    dealt.select(by, "value").write.partitionBy(by).text(path)
    return path


def _money(name: str) -> Column:
    return F.col(name).cast(MONEY).cast("string")


# --- rejects -------------------------------------------------------------

# by customer: 0 loses two fields, 1 has two more, 2 has a month 13, 3 a word for a number
FAULT_SQL = """CASE o_custkey % 9 WHEN 0 THEN 'too few fields' WHEN 1 THEN 'too many fields'
     WHEN 2 THEN 'order_dt' WHEN 3 THEN 'price' ELSE 'none' END"""


@query(f"""
SELECT CASE WHEN o_custkey % 9 = 3 THEN NULL
            ELSE CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS DOUBLE) END AS price, o_orderkey,
       {FAULT_SQL} AS fault
FROM orders WHERE o_custkey % 9 > 1
UNION ALL
SELECT CASE WHEN o_custkey % 9 = 0 THEN NULL
            ELSE CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS DOUBLE) END, o_orderkey,
       {FAULT_SQL} FROM orders WHERE o_custkey % 9 <= 1""")
def src_delimited_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("o_custkey") % 9
    day = F.when(kind == 2, "13/45/1999").otherwise(F.date_format("order_dt", "MM/dd/yyyy"))
    price = F.when(kind == 3, "many").otherwise(_money("o_totalprice"))
    lines = orders(spark, sf_dir).select(
        F.when(kind == 0, F.concat_ws("~", "o_orderkey", "o_custkey"))
        .when(kind == 1, F.concat_ws("~", "o_orderkey", "o_custkey", day, price, F.lit(""),
                                     F.lit("more")))
        .otherwise(F.concat_ws("~", "o_orderkey", "o_custkey", day, price, F.lit("   ")))
        .alias("value"))
    path = fresh_path(spark, "faulty")
    lines.write.text(path)
    good, bad = read_delimited(spark, path, ORDER, "~", date_formats=("MM/dd/yyyy",),
                               rejects=True, trailing=1)
    return (good.select("o_orderkey", "price", F.lit("none").alias("fault")).unionByName(
        bad.select(F.col("o_orderkey").cast("long"), F.col("price").try_cast(MONEY),
                   F.array_join(FAULTS_COLUMN, ",").alias("fault"))))


# --- headers -------------------------------------------------------------

@query("""
SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS order_dt,
       CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS DOUBLE) AS price, 'none' AS fault
FROM orders WHERE o_custkey % 3 < 2
UNION ALL
SELECT NULL, NULL, NULL, NULL, 'no header with the declared columns'
FROM (SELECT 1 FROM orders WHERE o_custkey % 3 = 2 UNION ALL SELECT 1)""")
def src_headers_in_any_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two orders of columns, one with a column more, and a file with an unknown header,
    which is a line like others there."""
    path = fresh_path(spark, "headed")
    src = orders(spark, sf_dir).withColumns(
        {"order_dt": F.date_format("order_dt", "M/d/yyyy"), "price": _money("o_totalprice")})
    shapes = {0: ["o_orderkey", "o_custkey", "order_dt", "price"],
              1: ["price", "order_dt", "o_orderpriority", "o_custkey", "o_orderkey"],
              2: ["o_orderkey", "o_custkey", "o_orderstatus"]}
    for part, names in shapes.items():
        (src.where(F.col("o_custkey") % 3 == part).coalesce(1).select(*names)
         .toDF(*[f"tbl.{n.upper()}" for n in names])
         .write.mode("append").option("header", True).csv(path))
    good, bad = read_by_header(spark, path, ORDER, date_formats=("M/d/yyyy",), rejects=True)
    none = bad.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in ORDER.fields],
                      F.array_join(FAULTS_COLUMN, ",").alias("fault"))
    return good.withColumn("fault", F.lit("none")).unionByName(none)


@query("WITH " + SHEETS_SQL + f"""
SELECT bac, dealer, model, isas, nullif(zero_dealer_adjusted, '') AS zero_dealer_adjusted,
       CAST(kpi AS BIGINT) AS kpi_type_code, objective, DATE '{PROCESS_DATE}' AS process_date
FROM stacked""")
def objective_sheet_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sheet exports with line breaks in their headers, the second in another column order."""
    def export(df, prefix, key, name, model, nation, balance, turned):
        cells = [("BAC", F.when(F.col(balance) >= 0, F.col(key))), ("Dealer", F.col(name)),
                 ("Region", F.lit("R")), ("City", F.lit('a "quoted", name')),
                 ("State", F.lit("S")), ("Model", model), ("ISAS", nation),
                 (f"{prefix}\nAverage\nRecent\nSales", F.lit("1.25")),
                 (f"{prefix}\nAverage\nSeasonal Sales", F.lit("2.5")),
                 ("Share of\nSales", F.lit("3%")),
                 (f"{prefix} \nUnadjusted Objective", F.floor(F.col(balance) / 2)),
                 (f"{prefix}\nObjective", F.floor(balance)),
                 ("Share of\nNational Objective", F.lit("4%")),
                 ("Zero\nDealer\nAdjusted", F.when(F.col(balance) > 5000, "X")),
                 ("MOR\nAdjusted", F.lit("")), ("BE\nDealer", F.lit("")), ("Notes", F.lit("n"))]
        path = fresh_path(spark, f"sheet-{prefix}")
        columns = cells[::-1] if turned else cells
        (df.select(*[c.cast("string").alias(n) for n, c in columns]).write
         .option("header", True).option("escape", '"').csv(path))
        return path

    nation = F.col("s_nationkey")
    fleet_model = (F.when(nation < 5, "Trax").when(nation < 10, "Savana Cutaway")
                   .otherwise("Other"))
    small = export(table(spark, sf_dir, "customer"), "SB", "c_custkey", "c_name",
                   F.col("c_mktsegment"), F.concat(F.lit("C"), "c_nationkey"), "c_acctbal", False)
    fleet = export(table(spark, sf_dir, "supplier"), "DF", "s_suppkey", "s_name", fleet_model,
                   F.concat(F.lit("S"), "s_nationkey"), "s_acctbal", True)
    sheets = {"small_business": feeds.read_objective_sheet(spark, small, "SB"),
              "dealer_fleet": feeds.read_objective_sheet(spark, fleet, "DF")}
    return objective_sheets(sheets, PROCESS_DATE).select(
        "bac", "dealer", "model", "isas", "zero_dealer_adjusted", "kpi_type_code", "objective",
        "process_date")


OUTLOOK_SQL = """
WITH o AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS m, o_custkey % 40 AS t
           FROM orders)
SELECT 'US' AS ntl_cd, t AS veh_type_grp_cd, m AS eff_mnth_dt, 100 * t AS indy_outlk_qty,
       CAST(t + 0.5 AS DOUBLE) AS indy_seasnly_adj_annl_nbr FROM o"""


def _outlook_files(spark: SparkSession, sf_dir: str, rows: DataFrame, turned: bool) -> str:
    """Half of the months as spreadsheet days, the others as dates; every row twice."""
    serial = F.datediff("m", F.lit("1899-12-30").cast("date")).cast("string")
    month = F.when(F.month("m") % 2 == 0, serial).otherwise(F.date_format("m", "M/d/yyyy"))
    cells = {"NTL_CD": F.lit("US"), "VEH_TYPE_GRP_CD": F.col("t"), "EFF_MNTH_DT": month,
             "INDY_OUTLK_QTY": F.col("t") * 100, "INDY_SEASNLY_ADJ_ANNL_NBR": F.col("t") + 0.5,
             "LAST_UPDT_USR_ID": F.lit("someone "), "LAST_UPDT_DT": F.lit("2/7/2024")}
    names = list(cells)[::-1] if turned else list(cells)
    path = fresh_path(spark, "outlook")
    (rows.unionAll(rows).select(*[cells[n].cast("string").alias(n) for n in names])
     .write.option("header", True).csv(path))
    return path


def _outlook_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders(spark, sf_dir).select(
        F.trunc("order_dt", "month").alias("m"), (F.col("o_custkey") % 40).alias("t")).distinct()


OUTLOOK = ["ntl_cd", "veh_type_grp_cd", "eff_mnth_dt", "indy_outlk_qty",
           "indy_seasnly_adj_annl_nbr"]


@query(OUTLOOK_SQL)
def outlook_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _outlook_files(spark, sf_dir, _outlook_rows(spark, sf_dir), False)
    return feeds.read_industry_outlook(spark, path).select(*OUTLOOK)


@query(OUTLOOK_SQL)
def outlook_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first load, then one that repeats some of its months and is loaded twice."""
    rows, out = _outlook_rows(spark, sf_dir), fresh_path(spark, "outlook-staged")
    first = rows.where(F.col("m") < "1998-01-01")
    for part, turned in ((first, False), (rows.where(F.col("m") >= "1997-06-01"), True)):
        path = _outlook_files(spark, sf_dir, part, turned)
        staging.stage_new_industry_outlook(spark, path, out)
    staging.stage_new_industry_outlook(spark, path, out)
    return spark.read.parquet(out).select(*OUTLOOK)


# --- feeds without a reader query so far -----------------------------------

@query("""
SELECT 'Land' AS country, 'Retail' AS channel, CAST(o_orderdate AS DATE) AS sales_dt,
       strftime(o_orderdate, '%Y/%m') AS sales_mth, o_custkey AS sales_cnt,
       o_orderpriority AS model, o_orderstatus AS brand FROM orders""")
def regional_sales_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = {0: F.lit("Land"), 1: F.lit("Firm"), 3: F.lit("Retail"),
              4: F.date_format("order_dt", "yyyy/MM/dd"), 5: F.date_format("order_dt", "yyyy/MM"),
              6: F.col("o_custkey").cast("string"), 11: F.col("o_orderpriority"),
              12: F.col("o_orderstatus"), 13: F.lit("Car"), 14: F.lit("Seg")}
    path = fresh_path(spark, "regional")
    orders(spark, sf_dir).select(F.concat_ws("|", *[
        values.get(i, F.lit("")) for i in range(feeds.REGIONAL_FIELDS)])).write.text(path)
    return feeds.read_regional_sales(spark, path).select(
        "country", "channel", "sales_dt", "sales_mth", "sales_cnt", "model", "brand")


@query("""
WITH d AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1)
SELECT d AS sales_date_through, n AS daily_count,
       CAST(sum(n) OVER (PARTITION BY date_trunc('month', d) ORDER BY d) AS BIGINT)
           AS month_to_date_count,
       CAST((n % 200) / 1000.0 - 0.1 AS DOUBLE) AS track_percentage,
       CAST((n % 300) / 1000.0 AS DOUBLE) AS prior_year_percentage FROM d""")
def selling_date_track_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = orders(spark, sf_dir).groupBy("order_dt").agg(F.count("*").alias("n"))

    def percent(tenths: Column) -> Column:
        number = F.abs(tenths / 10).cast("decimal(6,1)").cast("string")
        return F.concat(F.when(tenths < 0, "-").otherwise("+"), number, F.lit("%"))

    path = fresh_path(spark, "track")
    (daily.selectExpr("*", "sum(n) OVER (PARTITION BY trunc(order_dt, 'month') "
                      "ORDER BY order_dt) AS so_far")
     .select(F.date_format("order_dt", "yyyy/MM/dd").alias("SALES_DATE_THROUGH"),
             F.col("n").alias("DAILY_COUNT"), F.col("so_far").alias("MONTH_TO_DATE_COUNT"),
             percent(F.col("n") % 200 - 100).alias("TRACK_PERCENTAGE"),
             percent(F.col("n") % 300).alias("PRIOR_YEAR_PERCENTAGE"))
     .write.option("header", True).option("sep", "|").csv(path))
    return feeds.read_selling_date_track(spark, path)


@query("""
SELECT 'US' AS sales_grp_cd, CAST(o_orderdate AS DATE) AS frcst_dt, o_custkey AS sell_src_cd,
       CAST(CASE WHEN o_orderstatus = 'F' THEN -1 ELSE 777 END AS BIGINT) AS kpi_cd,
       CAST(CAST(o_totalprice AS DECIMAL(14, 2)) AS DOUBLE) AS kpi_val FROM orders""")
def org_forecast_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = {f.name: F.lit("") for f in feeds.ORG_FORECAST.fields} | {
        "sales_grp_cd": F.lit("US"), "frcst_dt": F.date_format("order_dt", "M/d/yyyy"),
        "sell_src_cd": F.col("o_custkey").cast("string"),
        "kpi_cd": F.when(F.col("o_orderstatus") == "F", "NULL").otherwise("777"),
        "kpi_val": F.col("o_totalprice").cast("decimal(14,2)").cast("string"),
        "src_sys_last_upd_ts": F.lit("NULL")}
    path = fresh_path(spark, "org-forecast")
    (orders(spark, sf_dir).select(*[c.alias(f"frcst.{n}") for n, c in cells.items()])
     .write.option("header", True).csv(path))
    return feeds.read_org_forecast(spark, path).select(
        "sales_grp_cd", "frcst_dt", "sell_src_cd", "kpi_cd", "kpi_val").fillna(-1, ["kpi_cd"])


# the last report of every month as a file of its own, dated by its folder's name
SNAPSHOT_FILES_SQL = """
WITH days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders),
ends AS (SELECT max(d) AS d FROM days GROUP BY date_trunc('month', d)),
models AS (SELECT DISTINCT o_orderpriority AS m FROM orders)
SELECT m AS model_nm, ends.d + 1 AS rpt_dt, ends.d AS sales_through_dt,
       (SELECT count(*) FROM orders WHERE o_orderpriority = m AND CAST(o_orderdate AS DATE) <= ends.d
        AND year(o_orderdate) = year(ends.d) AND month(o_orderdate) = month(ends.d)) AS month_cnt
FROM ends CROSS JOIN models"""


@query(SNAPSHOT_FILES_SQL)
def snapshot_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    snap = snapshots(spark, sf_dir)
    last = snap.groupBy(F.trunc("sales_through_dt", "month").alias("m")).agg(
        F.max("sales_through_dt").alias("sales_through_dt")).drop("m")
    cells = [F.concat(F.lit(" "), F.lpad(F.col(m).cast("string"), 6, "0")) for m in MONTHS]
    lines = snap.join(last, "sales_through_dt").select(
        F.date_format("rpt_dt", "'SNAPSHOT_'yyyyMMdd").alias("file"),
        F.concat_ws("~", F.rpad("model_nm", 30, " "), *cells, F.lit("   ")).alias("value"))
    path = files_by(lines, "file", "snapshot-files")
    got = feeds.read_model_snapshots(spark, f"{path}/*", pattern=r"(\d{8})/[^/]*$")
    count = F.element_at(F.array(*MONTHS), F.month("sales_through_dt"))
    return got.select("model_nm", "rpt_dt", "sales_through_dt", count.alias("month_cnt"))


# --- arrivals ------------------------------------------------------------

@query("""
SELECT CAST(l_partkey AS VARCHAR) AS vin, CAST(l_shipdate AS DATE) + 1 AS todaydate,
       CAST(CASE WHEN l_linestatus = 'F' THEN 30 ELSE 60 END AS BIGINT) AS daysinservice,
       CASE l_suppkey % 5 WHEN 0 THEN 'too few fields' WHEN 1 THEN 'outdate' ELSE 'none' END AS fault
FROM lineitem WHERE l_returnflag = 'R' AND l_suppkey % 5 > 0
UNION ALL
SELECT CAST(l_partkey AS VARCHAR), NULL, NULL, 'too few fields'
FROM lineitem WHERE l_returnflag = 'R' AND l_suppkey % 5 = 0""")
def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that arrive between two runs, lines at fault, loaded files moved away."""
    kind = F.col("l_suppkey") % 5
    line = table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R")
    ship = F.to_date("l_shipdate")
    day = F.when(kind == 1, "99/99/2000").otherwise(
        F.date_format(F.trunc(ship, "quarter"), "MM/dd/yyyy"))
    whole = F.concat_ws("|", "l_partkey", day, F.lit("1000"),
                        F.date_format(F.date_add(ship, 1), "MM/dd/yyyy"), "l_linenumber",
                        F.when(F.col("l_linestatus") == "F", "30").otherwise("60"),
                        F.lit("N/A"), F.lit("true"))
    lines = line.select("l_linenumber", F.when(kind == 0, F.concat_ws("|", "l_partkey", day))
                        .otherwise(whole).alias("value"))
    folder, out, bad, state, archive = (fresh_path(spark, n) for n in (
        "arrivals", "staged", "rejects", "state", "archive"))
    later = F.col("l_linenumber") > 3
    for part in (lines.where(~later), lines.where(later)):
        part.select("value").write.mode("append").text(folder)
        for _ in range(2):  # the second run finds no new file
            staging.stage_new_retired_events(spark, folder, out, state, "part-*", bad,
                                             archive).awaitTermination()
    good = read_batches(spark, out).select("vin", "todaydate", "daysinservice",
                                           F.lit("none").alias("fault"))
    at_fault = read_batches(spark, bad)
    return good.unionByName(at_fault.select(
        "vin", F.try_to_date("todaydate", "MM/dd/yyyy").alias("todaydate"),
        F.col("daysinservice").try_cast("int"), F.array_join(FAULTS_COLUMN, ",").alias("fault")))


@query("""
SELECT CAST(11 + o_custkey % 3 AS BIGINT) AS sell_src_cd, substr(o_orderpriority, 3, 3) AS brand_cd,
       CAST(o_orderdate AS DATE) AS rpt_dt, o_custkey AS obj_cnt,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS file_date FROM orders""")
def stream_objectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file a month with its date in the header record, half of them arriving later."""
    src = orders(spark, sf_dir).withColumn("month", F.trunc("order_dt", "month"))
    detail = src.select("month", F.concat(
        F.lit("00"), (F.lit(11) + F.col("o_custkey") % 3).cast("string"),
        F.substring("o_orderpriority", 3, 3), F.date_format("order_dt", "MMddyyyy"),
        F.lpad(F.col("o_custkey").cast("string"), 7, "0")).alias("value"))
    header = src.select("month").distinct().select(
        "month", F.date_format("month", "'HDR NAT 'MM/dd/yyyy' OBJ'").alias("value"))
    lines = detail.unionByName(header)
    out, state = fresh_path(spark, "objectives"), fresh_path(spark, "state")
    folder = fresh_path(spark, "objective-files")
    for early in (True, False):
        part = lines.where((F.col("month") < "1998-06-01") == early)
        part = part.repartition("month").sortWithinPartitions("month", F.desc("value"))
        part.write.partitionBy("month").mode("append").text(folder)
        staging.stage_new_objectives(spark, folder, out, state, "NAT", "part-*").awaitTermination()
    return read_batches(spark, out)


# --- tables ---------------------------------------------------------------

@query("""
SELECT o_orderkey, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS quarter,
       CASE WHEN date_trunc('quarter', o_orderdate) IN (DATE '1996-01-01', DATE '1998-04-01')
            THEN 'reloaded' ELSE 'first' END AS load FROM orders""")
def partition_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "by-quarter")
    src = orders(spark, sf_dir).select("o_orderkey", F.trunc("order_dt", "quarter").alias("quarter"))
    overwrite(src.withColumn("load", F.lit("first")), path, ["quarter"])
    again = src.where(F.col("quarter").isin("1996-01-01", "1998-04-01")).withColumn(
        "load", F.lit("reloaded"))
    for _ in range(2):  # the same load again changes nothing
        replace_partitions(again, path, ["quarter"])
    return spark.read.parquet(path)


@query("""
SELECT o_orderkey, o_custkey, CAST(CASE WHEN o_custkey % 2 = 0 THEN 2 ELSE 1 END AS BIGINT) AS version
FROM orders WHERE o_custkey % 4 <> 3""")
def published_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish, read by name, and publish what was made from the table itself."""
    name, path = f"orders_{uuid.uuid4().hex}", fresh_path(spark, "published")
    src = orders(spark, sf_dir).select("o_orderkey", "o_custkey", F.lit(1).alias("version"))
    publish_table(src, name, path)
    name_views({f"{name}_kept": read_table(spark, name).where("o_custkey % 4 <> 3")})
    changed = spark.sql(f"SELECT o_orderkey, o_custkey, IF(o_custkey % 2 = 0, version + 1, version) "
                        f"AS version FROM {name}_kept")
    publish_table(changed, name, path)
    return read_table(spark, name)


@query("""
WITH o AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders)
SELECT *, CASE WHEN o_custkey % 500 = 0 THEN 'left_only' ELSE 'right_only' END AS side,
       CAST(1 AS BIGINT) AS copies
FROM o WHERE o_custkey % 500 IN (0, 1)""")
def reconcile_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two written tables, one without some rows and with others twice."""
    src = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    paths = [fresh_path(spark, n) for n in ("left", "right")]
    overwrite(src, paths[0])
    twice = src.where("o_custkey % 500 = 1")
    overwrite(src.where("o_custkey % 500 <> 0").unionAll(twice), paths[1])
    left, right = (spark.read.parquet(p) for p in paths)
    return reconcile_sets(left, right, BUCKETS)


@query("""
SELECT 'first' AS load, count(*) AS rows FROM orders WHERE o_orderdate < DATE '1998-01-01'
UNION ALL SELECT 'second', count(*) FROM orders WHERE o_orderdate >= DATE '1998-01-01'
UNION ALL SELECT 'table', count(*) FROM orders""")
def write_verified(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, src = fresh_path(spark, "verified"), orders(spark, sf_dir).select("o_orderkey", "order_dt")
    first = verify_write(spark, path, overwrite(src.where("order_dt < '1998-01-01'"), path))
    second = append(src.where("order_dt >= '1998-01-01'"), path)
    verify_write(spark, path, first + second)
    return spark.createDataFrame([("first", first), ("second", second),
                                  ("table", stored_rows(spark, path))], "load string, rows long")


# --- the rest of the inventory ---------------------------------------------

@query("""
SELECT l_partkey AS veh_id_nbr, CAST(l_shipdate AS DATE) AS orig_proc_dt,
       CAST(date_diff('day', CAST(l_shipdate AS DATE), DATE '1998-01-01') AS BIGINT) AS days_before
FROM lineitem WHERE l_returnflag <> 'R' AND CAST(l_shipdate AS DATE) < DATE '1998-06-01'
  AND date_diff('day', CAST(l_shipdate AS DATE), DATE '1998-01-01') < 365""")
def owner_look_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivery records of less than 365 days before a year's start, none from later on."""
    start, today = (F.lit(d).cast("date") for d in ("1998-01-01", "1998-06-01"))
    rows = deliveries(spark, sf_dir).where(
        within_days(F.col("orig_proc_dt"), start, 365) & (F.col("orig_proc_dt") < today))
    return rows.select("veh_id_nbr", "orig_proc_dt",
                       F.datediff(start, "orig_proc_dt").alias("days_before"))


@query("""
WITH l AS (SELECT o_orderpriority AS brand_cd, CAST(date_trunc('month', o_orderdate) AS DATE) AS rpt_dt,
                  o_custkey % 5 AS region_cd, o_custkey % 20 AS sec_cd, o_custkey AS obj_cnt
           FROM orders),
nat AS (SELECT brand_cd, rpt_dt, CAST(sum(obj_cnt) AS BIGINT) AS n FROM l GROUP BY ALL),
reg AS (SELECT brand_cd, rpt_dt, CAST(sum(obj_cnt) AS BIGINT) AS n FROM l
        WHERE region_cd <> 3 OR month(rpt_dt) <> 5 GROUP BY ALL),
sec AS (SELECT brand_cd, rpt_dt, CAST(sum(obj_cnt) AS BIGINT) AS n FROM l GROUP BY ALL),
pairs AS (SELECT 'NAT' AS upper_level, 'REG' AS lower_level, brand_cd, rpt_dt, nat.n AS upper_cnt,
                coalesce(reg.n, 0) AS lower_cnt FROM nat LEFT JOIN reg USING (brand_cd, rpt_dt)
         UNION ALL
         SELECT 'REG', 'SEC', brand_cd, rpt_dt, coalesce(reg.n, 0), sec.n
         FROM sec LEFT JOIN reg USING (brand_cd, rpt_dt))
SELECT * FROM pairs WHERE upper_cnt <> lower_cnt""")
def hierarchy_reconcile_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objectives of a nation against its regions and those against their sections."""
    lines = orders(spark, sf_dir).select(
        F.col("o_orderpriority").alias("brand_cd"), F.trunc("order_dt", "month").alias("rpt_dt"),
        (F.col("o_custkey") % 5).alias("region_cd"), (F.col("o_custkey") % 20).alias("sec_cd"),
        F.col("o_custkey").alias("obj_cnt"))
    lost = (F.col("region_cd") == 3) & (F.month("rpt_dt") == 5)
    return hierarchy_reconcile({"NAT": lines, "REG": lines.where(~lost), "SEC": lines},
                               ["brand_cd", "rpt_dt"], "obj_cnt")
