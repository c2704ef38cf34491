"""Daily and month-to-date sales from cumulative wide-month snapshots.

A snapshot holds, per report date and model, one column per month with the
count accumulated in that month so far. Every function sums the models away
first, so what is joined afterwards is one row per report date.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecourt.fixed_values import MONTH_LABELS, MONTHS
from forecourt.functions.dates import previous_report_date, sales_through

CALENDAR_COLUMNS = ("sales_thru_dt", "rpt_mth_nbr", "rpt_mth_abbr_txt")

# Twelve columns at a time are written as one SQL expression each: the plan is
# the same as with column objects and takes a fraction of the time to build.
MONTH_SUMS = [f"sum({m}) AS {m}" for m in MONTHS]
MONTH_CELLS = ", ".join(f"named_struct('month_nbr', {i}, 'month_abbr', '{label}', 'value', {m})"
                        for i, (m, label) in enumerate(zip(MONTHS, MONTH_LABELS), 1))


def wide_month_sum(snapshots: DataFrame,
                   by: Sequence[str] = ("rpt_dt", "sales_through_dt")) -> DataFrame:
    """Sum the twelve month columns over the models."""
    return snapshots.groupBy(*by).agg(*[F.expr(e) for e in MONTH_SUMS])


def unpivot_months(df: DataFrame, ids: Sequence[str], value: str = "value") -> DataFrame:
    """Twelve month columns to twelve rows in one pass over the input."""
    cells = F.expr(f"inline(array({MONTH_CELLS}))").alias("month_nbr", "month_abbr", value)
    return df.select(*ids, cells)


def month_value(month: str) -> Column:
    """The month column whose number an SQL expression gives, in a wide row."""
    return F.expr(f"element_at(array({', '.join(MONTHS)}), {month})")


def year_reset_sum(snapshots: DataFrame, calendar: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Month sums seen from the following selling day, per report date.

    The snapshot that runs through the day before a selling day is the base
    that day's sales are counted from. Where it runs through the last day of a
    prior sales year its January count belongs to that year and counts as 0.
    ``by`` names calendar columns that keep several windows apart.
    """
    days = calendar.select(*by, *CALENDAR_COLUMNS, "curr_yr_start_dt", "prior_yr_start_dt")
    closed = ("sales_through_dt IN (date_sub(curr_yr_start_dt, 1), "
              "date_sub(prior_yr_start_dt, 1))")
    # the models go first: one row per report date meets the calendar
    joined = wide_month_sum(snapshots).join(
        days, F.expr("sales_through_dt = date_sub(sales_thru_dt, 1)"), "inner")
    january = F.expr(f"sum(CASE WHEN {closed} THEN 0 ELSE jan END) AS jan")
    return joined.groupBy("rpt_dt", *by, *CALENDAR_COLUMNS).agg(
        january, *[F.expr(e) for e in MONTH_SUMS[1:]])


def daily_from_mtd_shift(snapshots: DataFrame, calendar: DataFrame,
                         look_back: Mapping[int, int] | None = None,
                         by: Sequence[str] = ()) -> DataFrame:
    """Daily sales of the report month: its count now minus its count before.

    ``calendar`` comes from ``calendar_window``. "Before" is the snapshot of the
    previous report date (see ``previous_report_date``); without one the result
    is null. The count now is the month-to-date value and comes along.
    """
    now = covered_days(snapshots, calendar, by).select(
        "rpt_dt", *by, *CALENDAR_COLUMNS, month_value("rpt_mth_nbr").alias("__now"),
        previous_report_date(F.col("rpt_dt"), look_back).alias("__previous"))
    marks = [f"__b{i}" for i in range(len(by))]
    before = unpivot_months(year_reset_sum(snapshots, calendar, by), ["rpt_dt", *by], "__then")
    before = before.select("rpt_dt", *by, "month_nbr", "__then").toDF(
        "__rpt_dt", *marks, "__month", "__then")
    same = ["__previous = __rpt_dt", "rpt_mth_nbr = __month",
            *[f"{b} = {m}" for b, m in zip(by, marks, strict=True)]]
    joined = now.join(before, F.expr(" AND ".join(same)), "left")
    return (joined.groupBy("rpt_dt", *by, *CALENDAR_COLUMNS)
            .agg(F.expr("sum(__now - __then) AS daily_sales"),
                 F.expr("max(__now) AS mtd_sales"))
            .selectExpr("*", "rpt_mth_abbr_txt AS sales_mth_cat",
                        "rpt_mth_nbr AS sales_mth_cat_nbr"))


def covered_days(snapshots: DataFrame, calendar: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Wide month sums of the report dates whose sales-through day is in the calendar."""
    return wide_month_sum(snapshots).join(
        calendar.select(*by, *CALENDAR_COLUMNS),
        F.expr("sales_through_dt = sales_thru_dt"), "inner")


def mtd_by_month_category(snapshots: DataFrame, calendar: DataFrame,
                          by: Sequence[str] = ()) -> DataFrame:
    """Month-to-date sales for every month up to the report month."""
    long = unpivot_months(covered_days(snapshots, calendar, by),
                          ["rpt_dt", *by, *CALENDAR_COLUMNS], "mtd_sales")
    return (long.where("rpt_mth_nbr >= month_nbr")
            .withColumnsRenamed({"month_nbr": "sales_mth_cat_nbr",
                                 "month_abbr": "sales_mth_cat"}))


MERGE_KEYS = ("rpt_dt", "sales_thru_dt", "rpt_mth_nbr", "rpt_mth_abbr_txt",
              "sales_mth_cat", "sales_mth_cat_nbr")
MEASURES = ("CAST(daily_sales AS INT) AS day_sales_cnt",
            "CAST(mtd_sales AS INT) AS mth_to_dt_sales_cnt")


def daily_mtd_merge(daily: DataFrame, mtd: DataFrame,
                    keys: Sequence[str] = MERGE_KEYS) -> DataFrame:
    """Daily and month-to-date measures side by side, whole numbers."""
    daily = daily.select(*keys, "daily_sales")
    return daily.join(mtd, list(keys), "inner").selectExpr(*keys, *MEASURES)


def month_column_pick(df: DataFrame, month_start: str = "curr_mth_start_dt",
                      report_date: str = "rpt_dt", name: str = "mtd_sales") -> DataFrame:
    """Month-to-date count of the sales month of a wide row.

    On the first day of the sales month the report still closes the month
    before (December in January), so the previous column is taken.
    """
    month = f"month({month_start})"
    number = (f"CASE WHEN {report_date} <> {month_start} THEN {month} "
              f"WHEN {month} = 1 THEN 12 ELSE {month} - 1 END")
    return df.withColumn(name, month_value(number))


def daily_from_mtd_lag(snapshots: DataFrame, calendar: DataFrame,
                       partition: Sequence[str] = ()) -> DataFrame:
    """Daily sales as the change against the report before, whatever its date.

    The first day of a month starts from zero and counts as its own
    month-to-date value, except in January where it counts 0. The first
    report has no value. One row per partition and report date enters the
    window, so it is as long as the history in days.
    """
    sums = wide_month_sum(snapshots, [*partition, "rpt_dt"])
    days = calendar.select(F.col("sales_thru_dt").alias("__day"), "curr_mth_start_dt")
    joined = sums.join(days, sales_through(F.col("rpt_dt")) == F.col("__day"), "inner")
    picked = month_column_pick(joined)
    window = Window.partitionBy(*partition).orderBy("rpt_dt")
    start, mtd = F.col("curr_mth_start_dt"), F.col("mtd_sales")
    opens = F.col("__day") == start
    daily = (F.when(opens & (F.month(start) == 1), F.lit(0))
             .when(opens, mtd)
             .otherwise(mtd - F.lag("mtd_sales").over(window)))
    return picked.select(*partition, "rpt_dt", F.col("__day").alias("sales_thru_dt"),
                         "curr_mth_start_dt", daily.alias("day_sales_cnt"),
                         mtd.alias("mth_to_dt_sales_cnt"))
