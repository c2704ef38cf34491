"""Sales calendar: which days a run covers, and joining them to snapshots."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forecourt.functions.dates import month_label


def with_month(calendar: DataFrame) -> DataFrame:
    """Add the number and label of the sales month."""
    start = F.col("curr_mth_start_dt")
    return calendar.withColumns({
        "rpt_mth_nbr": F.month(start),
        "rpt_mth_abbr_txt": month_label(start),
    })


def calendar_window(calendar: DataFrame, as_of: dt.date, mode: str = "historical",
                    country: str = "US", base_year: int | None = None) -> DataFrame:
    """The selling days one run covers, with month number and label.

    ``incremental`` is the one day before ``as_of``. ``historical`` ends two
    days before it and starts at a prior-year start: that of the sales year
    ``base_year``, or of the latest selling day covered. The bound is a scalar
    subquery, evaluated once, so no join with a range is needed.
    """
    days = calendar.where(F.col("iso_ctry_cd") == country)
    day = F.col("sales_thru_dt")
    if mode == "incremental":
        return with_month(days.where(day == F.lit(as_of - dt.timedelta(days=1))))
    if mode != "historical":
        raise ValueError("mode must be 'historical' or 'incremental'")
    last = F.lit(as_of - dt.timedelta(days=2))
    if base_year is None:
        start = days.where(day <= last).agg(F.max_by("prior_yr_start_dt", "sales_thru_dt"))
    else:
        year = (F.col("curr_yr_start_dt") >= F.lit(dt.date(base_year, 1, 1))) & (
            F.col("curr_yr_start_dt") <= F.lit(dt.date(base_year, 12, 31)))
        start = days.where(year).agg(F.min("prior_yr_start_dt"))
    return with_month(days.where((day <= last) & (day >= start.scalar())))


def calendar_gate(df: DataFrame, calendar: DataFrame, as_of: dt.date,
                  country: str = "US") -> DataFrame:
    """All rows if the day before ``as_of`` is a selling day of the country, else none."""
    day = calendar.where((F.col("iso_ctry_cd") == country) & (
        F.col("sales_thru_dt") == F.lit(as_of - dt.timedelta(days=1))))
    return df.where(day.select("sales_thru_dt").exists())


def calendar_enrich(df: DataFrame, calendar: DataFrame, columns: Mapping[str, str] | Sequence[str],
                    report_date: str = "rpt_dt", through: str | None = None,
                    country: str | None = None) -> DataFrame:
    """Join rows to the calendar day they cover and add calendar columns.

    The day is ``through`` if given, else the day before ``report_date``.
    Report days without a calendar row are dropped (inner join); a day with several
    rows keeps them all. ``country`` takes the calendar of one country. Whether the
    calendar is broadcast is Spark's own decision by its size.
    """
    names = dict(columns) if isinstance(columns, Mapping) else {c: c for c in columns}
    day = F.col(through) if through else F.date_sub(F.col(report_date), 1)
    if country is not None:
        calendar = calendar.where(F.col("iso_ctry_cd") == country)
    days = calendar.select(F.col("sales_thru_dt").alias("__day"),
                           *[F.col(c).alias(name) for c, name in names.items()])
    return df.join(days, day == F.col("__day"), "inner").drop("__day")


def fill_forward_calendar(df: DataFrame, date_col: str, value_cols: Sequence[str],
                          end: dt.date, start: dt.date | None = None,
                          partition: Sequence[str] = ()) -> DataFrame:
    """One row per day up to ``end``, carrying the last known values forward.

    The days run from ``start`` or, per partition, from its first date. Input
    is one row per partition and date, so a window never holds more rows than
    there are days. ``is_filled`` marks the added days. A partition that begins after
    ``end`` has no days; a value known before ``start`` is carried into it.
    """
    known = F.min(date_col)
    first = F.least(F.lit(start), known) if start else known
    rows = df.select(*partition, F.col(date_col).alias("__have"), *value_cols)
    spine = (df.groupBy(*partition)
             .agg(first.alias("__first"), known.alias("__known"))
             .where(F.greatest("__first", "__known") <= F.lit(end))
             .withColumn("__days", F.expr(f"sequence(__first, DATE '{end}')"))
             .select(*partition, F.explode("__days").alias(date_col)))
    marks = {p: f"__p{i}" for i, p in enumerate(partition)}
    rows = rows.withColumnsRenamed(marks)
    match = F.col(date_col) == F.col("__have")
    for p, mark in marks.items():
        match = match & F.col(p).eqNullSafe(F.col(mark))
    joined = spine.join(rows, match, "left")
    window = Window.partitionBy(*partition).orderBy(date_col).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    filled = {c: F.last(c, ignorenulls=True).over(window) for c in value_cols}
    days = joined.withColumns(filled)
    if start:
        days = days.where(F.col(date_col) >= F.lit(start))
    return (days
            .select(*partition, date_col, *value_cols,
                    F.col("__have").isNull().alias("is_filled")))
