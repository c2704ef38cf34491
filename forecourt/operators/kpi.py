"""Month- and year-to-date KPIs for every report date at once.

Input is one wide row per report date with the calendar columns joined on
(``calendar_spine``); nothing is fetched row by row.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.fixed_values import MONTHS
from forecourt.operators.calendar import calendar_enrich, fill_forward_calendar
from forecourt.operators.cumulative import month_value, wide_month_sum

SPINE_COLUMNS = ("curr_mth_start_dt", "prior_year_current_day_dt")


def calendar_spine(snapshots: DataFrame, calendar: DataFrame, as_of: dt.date,
                   columns: Sequence[str] = SPINE_COLUMNS) -> DataFrame:
    """One wide row per day up to ``as_of``, gaps filled, with calendar columns."""
    sums = wide_month_sum(snapshots)
    filled = fill_forward_calendar(sums, "rpt_dt", ["sales_through_dt", *MONTHS], as_of)
    return calendar_enrich(filled, calendar, columns, through="sales_through_dt")


def _through_month(date: str) -> Column:
    return F.expr(" + ".join(f"CASE WHEN month({date}) >= {i} THEN coalesce({m}, 0) ELSE 0 END"
                             for i, m in enumerate(MONTHS, 1)))


def mtd_as_of(days: DataFrame) -> DataFrame:
    """Month-to-date sales per report date; 0 on January's first selling day."""
    start = F.col("curr_mth_start_dt")
    opens_year = (F.col("sales_through_dt") == start) & (F.month(start) == 1)
    return days.select("rpt_dt", F.when(opens_year, F.lit(0)).otherwise(
        month_value("month(curr_mth_start_dt)")).alias("mtd_sales"))


def _ytd_with_prior_date(days: DataFrame) -> DataFrame:
    return days.select("rpt_dt", F.date_add("prior_year_current_day_dt", 1).alias("prior_rpt_dt"),
                       _through_month("rpt_dt").alias("ytd_sales"))


def _both_years(days: DataFrame) -> DataFrame:
    current = _ytd_with_prior_date(days)
    prior = current.select(F.col("rpt_dt").alias("__rpt_dt"),
                           F.col("ytd_sales").alias("prior_ytd_sales"))
    return (current.join(prior, F.col("prior_rpt_dt") == F.col("__rpt_dt"), "left")
            .drop("__rpt_dt"))


def ytd(days: DataFrame) -> DataFrame:
    """Sum of January up to the report date's month; missing months count 0."""
    return _ytd_with_prior_date(days).select("rpt_dt", "ytd_sales")


def prior_ytd(days: DataFrame) -> DataFrame:
    """Year-to-date sales of the report one year before.

    That report is dated the day after the calendar's prior-year day. Null
    when there is none.
    """
    return _both_years(days).select("rpt_dt", "prior_rpt_dt", "prior_ytd_sales")


def ytd_variance(days: DataFrame) -> DataFrame:
    """Year-to-date minus prior year-to-date."""
    return _both_years(days).select(
        "rpt_dt", "ytd_sales", "prior_ytd_sales",
        (F.col("ytd_sales") - F.col("prior_ytd_sales")).alias("variance"))


def ytd_pct_change(days: DataFrame) -> DataFrame:
    """Change against the prior year as a fraction of it; null when it is 0."""
    change = F.col("ytd_sales") - F.col("prior_ytd_sales")
    return _both_years(days).select(
        "rpt_dt", F.try_divide(change, F.col("prior_ytd_sales")).alias("percent_change"))
