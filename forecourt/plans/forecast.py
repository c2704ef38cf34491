"""Change feeds of the dealer forecast and of the system messages."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.functions.text import yes_no
from forecourt.operators.audit import conform, with_audit
from forecourt.operators.change import change_feed, latest_slice
from forecourt.operators.enrich import enrich_left
from forecourt.plans.targets import DEALER_FORECAST, SYSTEM_MESSAGE
from forecourt.session import materialize

# the load time is payload: a row that is loaded again is the same row
FORECAST_KEYS = ["biz_assoc_cd", "iso_ctry_cd", "frcst_model_cd", "frcst_rpt_dt", "kpi_type_cd",
                 "sell_src_cd"]
MESSAGE_KEYS = ["ntl_cd", "sys_cd", "sys_desc", "sys_msg_identity"]


def enrich_objectives(stage: DataFrame, models: DataFrame, kpi_types: DataFrame,
                      country: str = "US") -> DataFrame:
    """Stacked objectives with model and KPI descriptions, in forecast names."""
    model = models.select("isas_brand_cd", F.col("sell_src").alias("sell_src_cd"),
                          F.col("fcst_modl_cd").alias("frcst_model_cd"),
                          F.col("fcst_modl_desc").alias("frcst_model_desc"))
    kpi = kpi_types.select(F.col("kpi_type_cd").alias("__kpi"),
                           F.col("metric_short_desc").alias("kpi_metric_short_desc"),
                           F.col("metric_long_desc").alias("kpi_metric_long_desc"))
    rows = stage.select(
        F.col("process_date").alias("frcst_rpt_dt"), F.lit(country).alias("iso_ctry_cd"),
        F.col("bac").alias("biz_assoc_cd"), F.col("dw_mod_ts").alias("data_upd_dt"),
        F.col("kpi_type_code").alias("kpi_type_cd"),
        yes_no(F.col("zero_dealer_adjusted")).alias("zero_adj_flg"),
        F.col("objective").alias("frcst_cnt"), F.col("isas").alias("isas_brand_cd"))
    return enrich_left(rows, [(model, {"isas_brand_cd": "isas_brand_cd"}),
                              (kpi, {"kpi_type_cd": "__kpi"})])


def forecast_feed(stage: DataFrame, models: DataFrame, kpi_types: DataFrame,
                  published: DataFrame, report_date: dt.date, job_id: str, mod_ts: Column,
                  source_id: str = "335", country: str = "US") -> DataFrame:
    """I/U/D rows of the dealer forecast of one report date.

    Both sides are limited to ``report_date``; a key part that found no model is
    null on both sides and matches itself. The new rows are written to the
    shared folder once, since the comparison reads them several times.
    """
    day = F.col("frcst_rpt_dt") == F.lit(report_date)
    rows = enrich_objectives(stage, models, kpi_types, country).where(day)
    new = materialize(conform(with_audit(rows, FORECAST_KEYS, source_id, job_id, mod_ts),
                              DEALER_FORECAST), "forecast")
    old = conform(published.where(day), DEALER_FORECAST)
    return conform(change_feed(new, old, [*FORECAST_KEYS, "src_sys_id"]), DEALER_FORECAST)


def system_message_feed(stage: DataFrame, published: DataFrame, since: dt.date, job_id: str,
                        mod_ts: Column, source_id: str = "171749") -> DataFrame:
    """I/U/D rows of the messages in effect since a day, from the newest load."""
    in_effect = F.col("eff_dt") >= F.lit(since)
    rows = latest_slice(stage.where(in_effect), "last_upd_dt")
    new = conform(with_audit(rows, MESSAGE_KEYS, source_id, job_id, mod_ts), SYSTEM_MESSAGE)
    old = conform(published.where(in_effect), SYSTEM_MESSAGE)
    return conform(change_feed(new, old, [*MESSAGE_KEYS, "src_sys_id"]), SYSTEM_MESSAGE)
