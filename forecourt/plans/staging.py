"""Staging loads: read a feed, convert it, append it once."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.functions.dates import loads_on
from forecourt.operators.load import append_if_new, overwrite, verify_write
from forecourt.operators.objectives import objective_sheets
from forecourt.sources import feeds
from forecourt.sources.delimited import (FAULTS_COLUMN, FILE_COLUMN, convert_columns,
                                         with_faults)
from forecourt.sources.file_dates import with_header_date
from forecourt.sources.fixed_width import parse_fixed_width, rejected_lines
from forecourt.sources.layouts import LAYOUTS
from forecourt.streaming.ingest import (ingest_batches, ingest_new_files, stream_delimited,
                                        stream_lines)


def stage_model_snapshots(spark: SparkSession, path, out: str, as_of: dt.date) -> int:
    """Append snapshot files whose report dates are new; nothing on a day without a load.

    The table is laid out by report date, and only the folders from the least to the
    greatest incoming date are looked up. Files without a date in their name are left
    out (``read_model_snapshots`` with ``undated`` lists them).
    """
    if not loads_on(as_of):
        return 0
    return append_if_new(feeds.read_model_snapshots(spark, path), out, ["rpt_dt"],
                         partition_by=["rpt_dt"])


def stage_retired_events(spark: SparkSession, path, out: str) -> int:
    """Replace the event staging table from all files of the feed."""
    return overwrite(feeds.read_retired_events(spark, path), out)


def stage_new_retired_events(spark: SparkSession, folder: str, out: str, checkpoint: str,
                             glob: str = "*", rejects: str | None = None,
                             archive: str | None = None):
    """Append the event files that arrived since the last run.

    Without ``rejects`` what does not fit is null. With it, lines at fault go to that
    table instead, and both tables are read with ``read_batches``. ``archive`` is where
    loaded files move.
    """
    def parse(landed: DataFrame) -> DataFrame:
        return convert_columns(landed, feeds.RETIRED_EVENTS, feeds.EVENT_NULLS,
                               feeds.EVENT_DATES)

    def split(landed: DataFrame) -> dict[str, DataFrame]:
        checked = with_faults(landed, feeds.RETIRED_EVENTS, "|", feeds.EVENTS_TRAILING,
                              feeds.EVENT_NULLS, feeds.EVENT_DATES)
        fits = F.size(FAULTS_COLUMN) == 0
        return {out: parse(checked.where(fits)), rejects: checked.where(~fits)}

    stream = stream_delimited(spark, folder, feeds.RETIRED_EVENTS, "|", glob, archive,
                              line=rejects is not None, trailing=feeds.EVENTS_TRAILING)
    if rejects is None:
        return ingest_new_files(stream, parse, out, checkpoint)
    return ingest_batches(stream, split, checkpoint)


def stage_objectives(spark: SparkSession, path, out: str, feed_type: str) -> int:
    """Replace the staging table of one objective feed."""
    return overwrite(feeds.read_objectives(spark, path, feed_type), out)


def stage_new_objectives(spark: SparkSession, folder: str, out: str, checkpoint: str,
                         feed_type: str, glob: str = "*", rejects: str | None = None,
                         archive: str | None = None):
    """Append the objective files of one type that arrived since the last run, each with
    the date of its header record as ``file_date``. Read with ``read_batches``.

    With ``rejects`` lines at fault go to that table instead of becoming nulls.
    """
    layout = LAYOUTS[feed_type]

    def split(lines: DataFrame) -> dict[str, DataFrame]:
        # a file is never dealt over batches, so its header is among its lines
        dated = with_header_date(lines)
        if rejects is None:
            return {out: parse_fixed_width(dated, layout, keep=["file_date"])}
        bad = rejected_lines(dated, layout)
        good = rejected_lines(dated, layout, fitting=True)
        return {out: parse_fixed_width(good, layout, keep=["file_date"]), rejects: bad}

    return ingest_batches(stream_lines(spark, folder, glob, archive), split, checkpoint)


def stage_reference_feed(read: Callable[[SparkSession, str], DataFrame], spark: SparkSession,
                         path, out: str) -> int:
    """Replace the staging table of a small feed (messages, outlook, org forecast) and
    check that it holds what was written."""
    return verify_write(spark, out, overwrite(read(spark, path), out))


def stage_new_industry_outlook(spark: SparkSession, path, out: str) -> int:
    """Append outlook rows of months that are not staged yet."""
    return append_if_new(feeds.read_industry_outlook(spark, path), out, ["eff_mnth_dt"], "key")


def objective_stage_rows(sheets: dict[str, DataFrame], process_date: dt.date, job_id: str,
                         mod_ts: Column) -> DataFrame:
    """Stacked objectives with the audit columns of the staging table."""
    return objective_sheets(sheets, process_date).withColumns({
        "meas_cnt": F.lit(1), "dw_anom_flg": F.lit("U"), "dw_mod_ts": mod_ts,
        "src_sys_iud_cd": F.lit("I"), "dw_job_id": F.lit(job_id)})


def stage_objective_sheets(spark: SparkSession, small_business, dealer_fleet, out: str,
                           process_date: dt.date, job_id: str, mod_ts: Column) -> int:
    """Append the two exported sheets of an objective workbook, once for a process date."""
    sheets = {"small_business": feeds.read_objective_sheet(spark, small_business, "SB"),
              "dealer_fleet": feeds.read_objective_sheet(spark, dealer_fleet, "DF")}
    return append_if_new(objective_stage_rows(sheets, process_date, job_id, mod_ts), out,
                         ["process_date"])
