"""The declared feeds: schema, separator and date formats of each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DateType, DecimalType, IntegerType, LongType, StringType,
                               StructField, StructType, TimestampType)

from forecourt.fixed_values import MONTHS
from forecourt.functions.dates import excel_serial_date, parse_date
from forecourt.functions.text import null_if, percent_parse
from forecourt.sources.delimited import (FILE_COLUMN, convert, land_delimited, read_by_header,
                                         read_delimited)
from forecourt.sources.file_dates import FILE_DATE, report_dates, with_file_date
from forecourt.sources.fixed_width import parse_fixed_width, read_text_feed
from forecourt.sources.layouts import LAYOUTS


def columns(*fields: tuple) -> StructType:
    return StructType([StructField(name, dtype) for name, dtype in fields])


TEXT, INT, LONG = StringType(), IntegerType(), LongType()
DATE, STAMP = DateType(), TimestampType()

MODEL_SNAPSHOT = columns(("model_nm", TEXT), *[(m, INT) for m in MONTHS])

RETIRED_EVENTS = columns(
    ("vin", TEXT), ("outdate", DATE), ("outmile", INT), ("todaydate", DATE),
    ("outtype", TEXT), ("daysinservice", INT), ("loangreaterthan60", TEXT))

SYSTEM_MESSAGES = columns(
    ("ntl_cd", TEXT), ("sys_cd", TEXT), ("sys_desc", TEXT), ("sys_msg_sa_id", INT),
    ("msg_txt", TEXT), ("efctv_dt", DATE), ("exprtn_dt", DATE), ("message_type", TEXT),
    ("last_updt_usr_id", TEXT), ("last_updt_dt", DATE))

INDUSTRY_OUTLOOK = columns(
    ("ntl_cd", TEXT), ("veh_type_grp_cd", INT), ("eff_mnth_dt", DATE), ("indy_outlk_qty", INT),
    ("indy_seasnly_adj_annl_nbr", DecimalType(12, 4)), ("last_updt_usr_id", TEXT),
    ("last_updt_dt", DATE))

ORG_FORECAST = columns(
    ("sales_grp_cd", TEXT), ("frcst_dt", DATE), ("mktg_org_type_nbr", INT),
    *[(f"mktg_org_lvl_{i}_cd", TEXT) for i in range(1, 7)],
    ("sell_src_cd", INT), ("kpi_cd", INT), ("frcst_model_cd", INT),
    ("kpi_val", DecimalType(14, 5)), ("src_sys_last_upd_usr_id", TEXT),
    ("src_sys_last_upd_ts", STAMP))

SELLING_DATE_TRACK = columns(
    ("sales_date_through", DATE), ("daily_count", INT), ("month_to_date_count", INT),
    ("track_percentage", TEXT), ("prior_year_percentage", TEXT))

# position -> column of the 33-field regional feed; the others are empty
REGIONAL_SALES = {0: ("country", TEXT), 1: ("company", TEXT), 3: ("channel", TEXT),
                  4: ("sales_dt", DATE), 5: ("sales_mth", TEXT), 6: ("sales_cnt", INT),
                  11: ("model", TEXT), 12: ("brand", TEXT), 13: ("vehicle_class", TEXT),
                  14: ("segment", TEXT)}
REGIONAL_FIELDS = 33

OBJECTIVE_SHEET = columns(
    ("bac", LONG), ("dealer", TEXT), ("region", TEXT), ("city", TEXT), ("state", TEXT),
    ("model", TEXT), ("isas", TEXT), ("average_recent_sales", DecimalType(8, 2)),
    ("average_seasonal_sales", DecimalType(8, 2)), ("share_of_sales", TEXT),
    ("unadjusted_objective", INT), ("objective", INT), ("share_of_national_objective", TEXT),
    ("zero_dealer_adjusted", TEXT), ("mor_adjusted", TEXT), ("be_dealer", TEXT))


# a separator and a blank end the lines of snapshots, a flag those of some event files
SNAPSHOT_TRAILING = EVENTS_TRAILING = 1
EVENT_NULLS, EVENT_DATES = ("", "N/A"), ("MM/dd/yyyy",)


def read_model_snapshots(spark: SparkSession, path, undated: bool = False,
                         pattern: str = FILE_DATE) -> DataFrame:
    """Daily ``~`` files, dated by their name, with report and sales-through date.

    ``pattern`` finds the date in a file's path.
    ``undated`` gives the rows of files whose name has no date instead, with the file.
    """
    feed = with_file_date(read_delimited(spark, path, MODEL_SNAPSHOT, sep="~", with_file=True),
                          pattern)
    if undated:
        return feed.where(F.col("file_date").isNull()).drop("file_date")
    return report_dates(feed.dropna(subset=["file_date"])).drop(FILE_COLUMN, "file_date")


def read_retired_events(spark: SparkSession, path, rejects: bool = False):
    """Pipe files of retired-out vehicles; an eighth column is dropped.

    ``rejects`` as in ``read_delimited``.
    """
    return read_delimited(spark, path, RETIRED_EVENTS, sep="|", null_tokens=EVENT_NULLS,
                          date_formats=EVENT_DATES, rejects=rejects, trailing=EVENTS_TRAILING)


def read_system_messages(spark: SparkSession, path, rejects: bool = False):
    """System messages, columns by each file's header; dates come as ``yyyy-MM-dd`` or
    ``M/d/yyyy``."""
    return read_by_header(spark, path, SYSTEM_MESSAGES, null_tokens=("",),
                          date_formats=("yyyy-MM-dd", "M/d/yyyy"), rejects=rejects)


def read_industry_outlook(spark: SparkSession, path) -> DataFrame:
    """Industry outlook, columns by each file's header; the month comes as a spreadsheet
    serial day or a date.

    Full copies and rows without a month are dropped.
    """
    formats = ("M/d/yyyy", "yyyy-MM-dd")
    month = null_if(F.col("eff_mnth_dt"))
    month = F.coalesce(excel_serial_date(month), parse_date(month, *formats))
    feed = read_by_header(spark, path, INDUSTRY_OUTLOOK, null_tokens=("",), date_formats=formats,
                          readers={"eff_mnth_dt": month})
    return feed.distinct().dropna(subset=["eff_mnth_dt"])


def read_org_forecast(spark: SparkSession, path) -> DataFrame:
    """Org forecast with ``table.column`` headers and ``NULL`` marks."""
    return read_by_header(spark, path, ORG_FORECAST, date_formats=("M/d/yyyy",))


def read_selling_date_track(spark: SparkSession, path) -> DataFrame:
    """Selling-date track; percentages become fractions."""
    feed = read_by_header(spark, path, SELLING_DATE_TRACK, sep="|",
                          date_formats=("yyyy/MM/dd",))
    return feed.withColumns({c: percent_parse(F.col(c))
                             for c in ("track_percentage", "prior_year_percentage")})


def read_regional_sales(spark: SparkSession, path) -> DataFrame:
    """Regional daily sales: the used fields of a 33-field pipe feed."""
    every = columns(*[(f"f{i}", TEXT) for i in range(REGIONAL_FIELDS)])
    landed = land_delimited(spark, path, every, sep="|")
    return landed.select(*[
        convert(null_if(F.col(f"f{i}")), dtype, ("yyyy/MM/dd",)).alias(name)
        for i, (name, dtype) in REGIONAL_SALES.items()])


def read_objectives(spark: SparkSession, path, feed_type: str) -> DataFrame:
    """Fixed-width objectives of one feed type."""
    return parse_fixed_width(read_text_feed(spark, path), LAYOUTS[feed_type])


def read_objective_sheet(spark: SparkSession, path, prefix: str) -> DataFrame:
    """One sheet of the objective workbook, exported as CSV.

    Headers hold line breaks and some start with the sheet's prefix (``SB``, ``DF``).
    Columns are taken by the names in each file's header, less that prefix, so exports
    may order them differently; other columns are dropped.
    """
    raw = (spark.read.option("header", True).option("multiLine", True)
           .option("inferSchema", False).csv(path))
    if not any(c.upper().startswith(prefix.upper()) for c in raw.columns):
        raise ValueError(f"not a {prefix} objective sheet: {path}")
    return read_by_header(spark, path, OBJECTIVE_SHEET, null_tokens=("",), multi_line=True,
                          prefix=prefix)
