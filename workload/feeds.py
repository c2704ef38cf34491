"""Sources, sinks and load control.

The feed queries write a whole table as a feed into the shared folder and read
it back with the library's reader; the SQL is the table itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DateType, DecimalType, IntegerType, LongType, StringType)

from forecourt.functions.dates import excel_serial_date, is_load_day
from forecourt.functions.text import percent_parse
from forecourt.operators.load import append_if_new, new_files, overwrite, shift_file_date
from forecourt.operators.reconcile import reconcile_counts, reconcile_sets
from forecourt.session import fresh_path
from forecourt.sources import feeds
from forecourt.sources.delimited import (FILE_COLUMN, convert_columns, read_delimited, read_headed)
from forecourt.sources.file_dates import report_dates, with_file_date, with_header_date
from forecourt.sources.fixed_width import (Field, FixedWidthLayout, parse_fixed_width,
                                           read_text_feed)
from forecourt.sources.layouts import LAYOUTS
from forecourt.streaming.ingest import ingest_new_files, stream_delimited
from workload.registry import query, table
from workload.standins import orders, retired_events

TEXT, INT, LONG, DATE = StringType(), IntegerType(), LongType(), DateType()
MONEY = DecimalType(18, 2)


def write_lines(lines: DataFrame, name: str) -> str:
    path = fresh_path(lines.sparkSession, name)
    lines.write.text(path)
    return path


@query("""
SELECT p_partkey, p_name, p_brand, p_type, CAST(p_size AS BIGINT) AS p_size,
       CAST(CAST(p_retailprice AS DECIMAL(18, 2)) AS DOUBLE) AS p_retailprice
FROM part""")
def src_delimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    lines = part.select(F.concat_ws(
        "~", F.col("p_partkey"), F.rpad("p_name", 30, " "), "p_brand", "p_type",
        F.concat(F.lit(" "), F.lpad(F.col("p_size").cast("string"), 6, "0")),
        F.col("p_retailprice").cast(MONEY), F.lit("   ")))
    schema = feeds.columns(("p_partkey", LONG), ("p_name", TEXT), ("p_brand", TEXT),
                           ("p_type", TEXT), ("p_size", INT), ("p_retailprice", MONEY))
    return read_delimited(spark, write_lines(lines, "part"), schema, sep="~")


@query("""
SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate,
       CASE WHEN o_orderstatus = 'P' THEN 'none' ELSE o_orderstatus END AS o_orderstatus,
       CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS DOUBLE) AS o_totalprice, o_orderpriority
FROM orders""")
def src_csv_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "orders")
    src = table(spark, sf_dir, "orders")
    (src.select(
        "o_orderkey", "o_custkey", F.date_format("o_orderdate", "M/d/yyyy").alias("o_orderdate"),
        F.when(F.col("o_orderstatus") == "P", "NULL").otherwise(F.col("o_orderstatus"))
        .alias("o_orderstatus"), F.col("o_totalprice").cast(MONEY).alias("o_totalprice"),
        "o_orderpriority")
     .toDF(*[f"sales.{c}" for c in ("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus",
                                    "o_totalprice", "o_orderpriority")])
     .write.option("header", True).csv(path))
    schema = feeds.columns(("o_orderkey", LONG), ("o_custkey", LONG), ("o_orderdate", DATE),
                           ("o_orderstatus", TEXT), ("o_totalprice", MONEY),
                           ("o_orderpriority", TEXT))
    back = read_headed(spark, path, schema, date_formats=("M/d/yyyy",))
    return back.fillna("none", subset=["o_orderstatus"])


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_dt FROM orders")
def excel_serial_date_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    serial = F.datediff("order_dt", F.lit("1899-12-30").cast("date")).cast("string")
    return orders(spark, sf_dir).select("o_orderkey", excel_serial_date(serial).alias("order_dt"))


LINE_LAYOUT = FixedWidthLayout("LINE", (
    Field("l_orderkey", 4, 12, LONG), Field("l_partkey", 16, 12, LONG),
    Field("l_suppkey", 28, 12, LONG), Field("l_linenumber", 40, 2, INT),
    Field("l_returnflag", 42, 1, TEXT), Field("l_shipdate", 43, 8, DATE),
    Field("l_quantity", 51, 7, INT)))


def render(layout: FixedWidthLayout, values: dict) -> F.Column:
    """A line of the layout; gaps are zeros."""
    parts, end = [], 1
    for f in layout.fields:
        if f.start > end:
            parts.append(F.lit("0" * (f.start - end)))
        text = values[f.name]
        if f.dtype == DATE:
            parts.append(F.date_format(text, f.date_format))
        elif f.dtype == TEXT:
            parts.append(F.rpad(text, f.length, " "))
        else:
            parts.append(F.lpad(text.cast("string"), f.length, "0"))
        end = f.start + f.length
    return F.concat(*parts)


@query("""
SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
       l_returnflag, CAST(l_shipdate AS DATE) AS l_shipdate,
       CAST(l_quantity AS BIGINT) AS l_quantity
FROM lineitem""")
def fixed_width_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem")
    values = {f.name: F.col(f.name) for f in LINE_LAYOUT.fields}
    values["l_quantity"] = F.col("l_quantity").cast("int")
    headers = line.agg(F.date_format(F.max("l_shipdate"), "MM/dd/yyyy").alias("day")).select(
        F.format_string("HDR LIN %s", "day"))
    lines = line.select(render(LINE_LAYOUT, values)).union(headers)
    return parse_fixed_width(read_text_feed(spark, write_lines(lines, "line")), LINE_LAYOUT)


FEED_TYPES = ("BAC", "REG", "ZON", "ARE", "NAT", "SEC", "GMM")


@query("""
WITH lines AS (
    SELECT o_custkey, lpad(CAST(o_custkey % 90 AS VARCHAR), 2, '0') AS region_cd,
           lpad(CAST(o_custkey % 77 AS VARCHAR), 2, '0') AS sec_cd,
           lpad(CAST(o_custkey % 1013 AS VARCHAR), 4, '0') AS zone_cd,
           lpad(CAST(o_custkey % 911 AS VARCHAR), 4, '0') AS area_cd,
           CASE o_orderstatus WHEN 'F' THEN 11 WHEN 'O' THEN 12 ELSE 13 END AS sell_src_cd,
           substr(o_orderpriority, 3, 3) AS brand_cd, CAST(o_orderdate AS DATE) AS rpt_dt,
           CAST(floor(o_totalprice / 100) AS BIGINT) AS obj_cnt
    FROM orders),
feeds(feed) AS (VALUES ('BAC'), ('REG'), ('ZON'), ('ARE'), ('NAT'), ('SEC')),
coded AS (
    SELECT feed, CASE WHEN feed = 'BAC' THEN CAST(o_custkey % 999983 AS VARCHAR) ELSE '' END AS biz_cd,
           CASE WHEN feed IN ('REG', 'ZON', 'ARE', 'SEC') THEN region_cd ELSE '' END AS region_cd,
           CASE WHEN feed IN ('ZON', 'ARE', 'SEC') THEN sec_cd ELSE '' END AS sec_cd,
           CASE WHEN feed IN ('ZON', 'ARE') THEN zone_cd ELSE '' END AS zone_cd,
           CASE WHEN feed = 'ARE' THEN area_cd ELSE '' END AS area_cd,
           CAST(sell_src_cd AS VARCHAR) AS sell_src_cd, brand_cd, CAST(rpt_dt AS VARCHAR) AS rpt_dt,
           obj_cnt
    FROM lines CROSS JOIN feeds
    UNION ALL
    SELECT 'GMM', zone_cd, region_cd, sec_cd, area_cd, zone_cd, region_cd || sec_cd, area_cd,
           zone_cd || ' ' || area_cd, CAST(sec_cd || region_cd AS BIGINT)
    FROM lines)
SELECT feed, biz_cd, region_cd, sec_cd, zone_cd, area_cd, sell_src_cd, brand_cd, rpt_dt,
       count(*) AS line_cnt, CAST(sum(obj_cnt) AS BIGINT) AS obj_cnt
FROM coded GROUP BY ALL""")
def fixed_width_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every field of every layout; the codes differ from order to order."""
    def code(divisor, width):
        return F.lpad((F.col("o_custkey") % divisor).cast("string"), width, "0")

    src = orders(spark, sf_dir)
    region, sec, zone, area = code(90, 2), code(77, 2), code(1013, 4), code(911, 4)
    values = {
        "biz_assoc_id": F.col("o_custkey") % 999983, "region_cd": region, "sec_cd": sec,
        "zone_cd": zone, "area_cd": area,
        "sell_src_cd": F.when(F.col("o_orderstatus") == "F", 11)
        .when(F.col("o_orderstatus") == "O", 12).otherwise(13),
        "brand_cd": F.substring("o_orderpriority", 3, 3), "rpt_dt": F.col("order_dt"),
        "obj_cnt": F.floor(F.col("o_totalprice") / 100)}
    ten = [region, sec, area, zone, F.concat(region, sec), area, zone, area, F.concat(sec, region),
           zone]
    values |= {f"col{i}": v for i, v in enumerate(ten, 1)}
    names = ("biz_cd", "region_cd", "sec_cd", "zone_cd", "area_cd", "sell_src_cd", "brand_cd",
             "rpt_dt")
    # the layout differs per type, so each type is a feed (and a scan) of its own
    stacked = None
    for kind in FEED_TYPES:
        lines = src.select(render(LAYOUTS[kind], values).alias("value"))
        got = parse_fixed_width(lines, LAYOUTS[kind])
        if kind == "GMM":
            got = got.select(
                F.col("col10").alias("biz_cd"), F.col("col1").alias("region_cd"),
                F.col("col2").alias("sec_cd"), F.col("col3").alias("zone_cd"),
                F.col("col4").alias("area_cd"), F.col("col5").alias("sell_src_cd"),
                F.col("col6").alias("brand_cd"),
                F.concat_ws(" ", "col7", "col8").alias("rpt_dt"),
                F.col("col9").cast("long").alias("obj_cnt"))
        got = got.withColumnsRenamed({"biz_assoc_id": "biz_cd"})
        one = got.select(F.lit(kind).alias("feed"), *[
            F.col(n).cast("string").alias(n) if n in got.columns else F.lit("").alias(n)
            for n in names], F.col("obj_cnt").cast("long"))
        stacked = one if stacked is None else stacked.unionByName(one)
    return stacked.groupBy("feed", *names).agg(
        F.count("*").alias("line_cnt"), F.sum("obj_cnt").alias("obj_cnt"))


@query("""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS file_date, CAST(o_orderdate AS DATE) AS rpt_dt,
       CAST(o_orderdate AS DATE) - 1 AS sales_through_dt
FROM orders""")
def file_date_from_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = orders(spark, sf_dir).select("o_orderkey", F.concat(
        F.lit("/feeds/in/SNAPSHOT_"), F.date_format("order_dt", "yyyyMMdd"), F.lit(".txt"))
        .alias(FILE_COLUMN))
    return report_dates(with_file_date(named)).drop(FILE_COLUMN)


@query("""
SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS file_date FROM orders""")
def file_date_from_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = orders(spark, sf_dir).withColumn("month", F.trunc("order_dt", "month"))
    path = F.date_format("month", "'/feeds/DAY_'yyyyMM'.txt'").alias(FILE_COLUMN)
    detail = src.select(F.col("o_orderkey").cast("string").alias("value"), path)
    header = src.select("month").distinct().select(
        F.date_format("month", "'HDR ORD 'MM/dd/yyyy' OBJ'").alias("value"), path)
    dated = with_header_date(detail.unionByName(header))
    return dated.select(F.col("value").cast("long").alias("o_orderkey"), "file_date")


@query("""
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
       CAST(CAST(l_discount AS DECIMAL(12, 6)) AS DOUBLE) AS discount,
       CAST(-CAST(l_tax AS DECIMAL(12, 6)) AS DOUBLE) AS tax
FROM lineitem""")
def percent_parse_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    def percent(name, sign):
        number = (F.col(name).cast("decimal(12,3)") * 100).cast("decimal(12,1)")
        return F.concat(F.lit(sign), number.cast("string"), F.lit("%"))

    # a negative zero would not compare equal
    tax = percent_parse(percent("l_tax", "-"))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", percent_parse(percent("l_discount", "+")).alias("discount"),
        tax.alias("tax"))


@query("""
SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS order_dt, o_orderpriority FROM orders""")
def sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "orders")
    src = orders(spark, sf_dir).select("o_orderkey", "o_custkey", "order_dt", "o_orderpriority")
    overwrite(src, path, ["o_orderpriority"])
    overwrite(src, path, ["o_orderpriority"])  # replaces, does not add
    return spark.read.parquet(path)


GUARD_SQL = """
WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_dt FROM orders),
old AS (SELECT * FROM o WHERE order_dt < DATE '1999-01-01'),
incoming AS (SELECT * FROM o WHERE order_dt >= DATE '1997-07-01')
SELECT 'old' AS load, * FROM old
UNION ALL
SELECT 'incoming' AS load, * FROM incoming i """


def _guarded(spark: SparkSession, sf_dir: str, granularity: str) -> DataFrame:
    path = fresh_path(spark, "guard")
    src = orders(spark, sf_dir).select("o_orderkey", "order_dt")
    old = src.where(F.col("order_dt") < "1999-01-01").withColumn("load", F.lit("old"))
    incoming = src.where(F.col("order_dt") >= "1997-07-01").withColumn("load", F.lit("incoming"))
    append_if_new(old, path, ["order_dt"])
    append_if_new(incoming, path, ["order_dt"], granularity)
    append_if_new(incoming, path, ["order_dt"], granularity)  # adds nothing
    return spark.read.parquet(path)


@query(GUARD_SQL + "WHERE NOT EXISTS (SELECT 1 FROM old WHERE old.order_dt = i.order_dt)")
def append_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _guarded(spark, sf_dir, "key")


@query(GUARD_SQL + """WHERE NOT EXISTS (
    SELECT 1 FROM old JOIN incoming USING (order_dt))""")
def append_guard_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _guarded(spark, sf_dir, "load")


@query("""
WITH o AS (SELECT o_orderstatus, o_orderpriority, CAST(o_orderdate AS DATE) AS order_dt,
                  o_totalprice > 250000 AS big FROM orders),
a AS (SELECT o_orderstatus, o_orderpriority, order_dt FROM o WHERE big OR order_dt < DATE '1998-01-01'),
b AS (SELECT o_orderstatus, o_orderpriority, order_dt FROM o WHERE NOT big OR order_dt < DATE '1998-01-01'),
l AS (SELECT * FROM a EXCEPT ALL SELECT * FROM b),
r AS (SELECT * FROM b EXCEPT ALL SELECT * FROM a)
SELECT o_orderstatus, o_orderpriority, order_dt, 'left_only' AS side, count(*) AS copies
FROM l GROUP BY ALL
UNION ALL
SELECT o_orderstatus, o_orderpriority, order_dt, 'right_only' AS side, count(*) AS copies
FROM r GROUP BY ALL""")
def reconcile_sets_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = orders(spark, sf_dir)
    early, big = F.col("order_dt") < "1998-01-01", F.col("o_totalprice") > 250000
    cols = ["o_orderstatus", "o_orderpriority", "order_dt"]
    return reconcile_sets(src.where(big | early).select(*cols), src.where(~big | early).select(*cols))


@query("""
SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS ship_month,
       count(*) FILTER (WHERE l_returnflag = 'A') AS left_rows,
       count(*) FILTER (WHERE l_returnflag <> 'A') AS right_rows
FROM lineitem GROUP BY 1 HAVING left_rows <> right_rows""")
def reconcile_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = table(spark, sf_dir, "lineitem").withColumn(
        "ship_month", F.trunc(F.to_date("l_shipdate"), "month"))
    added = F.col("l_returnflag") == "A"
    return reconcile_counts(src.where(added), src.where(~added), ["ship_month"])


@query("""
WITH f AS (SELECT page_id, url, regexp_replace(url, '^https?://(www\\.)?', '') AS file_name FROM pages)
SELECT page_id, file_name FROM f
WHERE file_name NOT IN (SELECT file_name FROM f WHERE url LIKE 'https://%')""")
def file_ledger_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "pages").select(
        "page_id", F.regexp_replace("url", r"^https?://(www\.)?", "").alias("file_name"), "url")
    loaded = files.where(F.col("url").startswith("https://"))
    return new_files(files, loaded).drop("url")


@query("""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_dt FROM orders
WHERE isodow(CAST(o_orderdate AS DATE)) <> 1""")
def load_day_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders(spark, sf_dir).where(is_load_day(F.col("order_dt"))).select(
        "o_orderkey", "order_dt")


@query("""
SELECT o_orderkey, CAST(o_orderdate AS DATE) + 1 AS file_date FROM orders""")
def shift_file_date_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shift_file_date(orders(spark, sf_dir).select(
        "o_orderkey", F.col("order_dt").alias("file_date")))


@query("""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS file_date, CAST(o_orderdate AS DATE) AS rpt_dt,
       CAST(o_orderdate AS DATE) - 1 AS sales_through_dt FROM orders""")
def report_dates_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report_dates(orders(spark, sf_dir).select(
        "o_orderkey", F.col("order_dt").alias("file_date")))


EVENT_LINES_SQL = """
SELECT CAST(l_partkey AS VARCHAR) AS vin,
       CAST(date_trunc('quarter', l_shipdate) AS DATE) AS outdate,
       CAST(floor(l_quantity / 25) * 1000 AS BIGINT) AS outmile,
       CAST(l_shipdate AS DATE) + 1 AS todaydate, CAST(l_linenumber AS VARCHAR) AS outtype,
       CAST(CASE WHEN l_linestatus = 'F' THEN 30 ELSE 60 END AS BIGINT) AS daysinservice,
       CASE WHEN l_quantity > 45 THEN 'Loan60' ELSE 'none' END AS loangreaterthan60
FROM lineitem WHERE l_returnflag = 'R'"""


def _event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retired_events(spark, sf_dir).select(F.concat_ws(
        "|", "vin", F.date_format("outdate", "MM/dd/yyyy"), "outmile",
        F.date_format("todaydate", "MM/dd/yyyy"), "outtype", "daysinservice",
        F.when(F.col("loangreaterthan60") == "None", "N/A")
        .otherwise(F.col("loangreaterthan60")), F.lit("true")))


@query(EVENT_LINES_SQL)
def src_retired_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_lines(_event_lines(spark, sf_dir), "events")
    return feeds.read_retired_events(spark, path).fillna("none", subset=["loangreaterthan60"])


@query(EVENT_LINES_SQL)
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_lines(_event_lines(spark, sf_dir), "arrivals")
    out, state = fresh_path(spark, "staged"), fresh_path(spark, "state")
    for _ in range(2):  # the second run finds no new file
        stream = stream_delimited(spark, path, feeds.RETIRED_EVENTS, "|", "part-*")
        ingest_new_files(stream, lambda landed: convert_columns(
            landed.drop(FILE_COLUMN), feeds.RETIRED_EVENTS, ("", "N/A"), ("MM/dd/yyyy",)),
            out, state).awaitTermination()
    return spark.read.parquet(out).fillna("none", subset=["loangreaterthan60"])
