"""Fleet sales fact: daily and month-to-date counts per report date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.functions.dates import month_label
from forecourt.operators.audit import conform, with_audit
from forecourt.operators.calendar import calendar_window
from forecourt.operators.cumulative import (MEASURES, MERGE_KEYS, daily_from_mtd_lag,
                                            daily_from_mtd_shift, daily_mtd_merge,
                                            mtd_by_month_category)
from forecourt.plans.targets import FLEET_FACT, FLEET_LAG_FACT

SOURCE_ID = "171749"


def hist_inc_union(historical: DataFrame, incremental: DataFrame) -> DataFrame:
    """Stack two runs whose days do not overlap, columns by name."""
    return historical.unionByName(incremental)


def run_days(calendar: DataFrame, as_of: dt.date, country: str = "US",
             base_year: int | None = None) -> DataFrame:
    """Calendar days of the historical and the incremental run, told apart by ``run``.

    The newest day only sees its own window, as in a run of its own.
    """
    past = calendar_window(calendar, as_of, "historical", country, base_year)
    newest = calendar_window(calendar, as_of, "incremental", country)
    return hist_inc_union(past.selectExpr("*", "'historical' AS run"),
                          newest.selectExpr("*", "'incremental' AS run"))


def daily_and_mtd(snapshots: DataFrame, calendar: DataFrame, as_of: dt.date,
                  country: str = "US", base_year: int | None = None) -> DataFrame:
    """Daily and month-to-date measures, history and newest day, from two frames."""
    days = run_days(calendar, as_of, country, base_year)
    return daily_mtd_merge(daily_from_mtd_shift(snapshots, days, by=["run"]).drop("run"),
                           mtd_by_month_category(snapshots, days, ["run"]).drop("run"))


def fleet_fact(snapshots: DataFrame, calendar: DataFrame, as_of: dt.date, job_id: str,
               mod_ts: Column, source_id: str = SOURCE_ID, country: str = "US",
               base_year: int | None = None) -> DataFrame:
    """The published fact, one row per report date.

    Merging the daily with the month-to-date frame keeps the report month only,
    and that month's count is at hand where its daily value is computed. So the
    fact equals ``daily_and_mtd`` without the second frame and the join.
    """
    days = run_days(calendar, as_of, country, base_year)
    rows = daily_from_mtd_shift(snapshots, days, by=["run"]).selectExpr(*MERGE_KEYS, *MEASURES)
    audited = with_audit(rows, ["rpt_dt", "sales_thru_dt", "sales_mth_cat_nbr"], source_id,
                         job_id, mod_ts)
    return conform(audited, FLEET_FACT)


def fleet_lag_fact(snapshots: DataFrame, calendar: DataFrame, job_id: str, mod_ts: Column,
                   source_id: str = SOURCE_ID) -> DataFrame:
    """The fact built from the report before, whatever its date; one row per report date."""
    rows = daily_from_mtd_lag(snapshots, calendar).withColumns({
        "rpt_mth_nbr": F.month("curr_mth_start_dt"),
        "rpt_mth_abbr_txt": month_label(F.col("curr_mth_start_dt"))})
    return conform(with_audit(rows, ["rpt_dt", "sales_thru_dt"], source_id, job_id, mod_ts),
                   FLEET_LAG_FACT)
