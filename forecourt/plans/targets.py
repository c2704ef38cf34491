"""Target schemas of the published tables."""

from __future__ import annotations

from pyspark.sql.types import (DateType, IntegerType, LongType, StringType, StructType,
                               TimestampType)

from forecourt.sources.feeds import columns

TEXT, INT, LONG, DATE, STAMP = (StringType(), IntegerType(), LongType(), DateType(),
                                TimestampType())


def published(keys: list[tuple], payload: list[tuple]) -> StructType:
    """Key columns, source id, payload and the other audit columns."""
    return columns(*keys, ("src_sys_id", TEXT), *payload,
                   ("src_sys_uniq_prim_key_val", TEXT), ("src_sys_uniq_prim_key_col_val", TEXT),
                   ("meas_cnt", INT), ("dw_anom_flg", TEXT), ("dw_mod_ts", STAMP),
                   ("dw_job_id", TEXT), ("src_sys_iud_cd", TEXT))


FLEET_FACT = published(
    [("rpt_dt", DATE), ("sales_thru_dt", DATE), ("sales_mth_cat_nbr", INT)],
    [("sales_mth_cat", TEXT), ("day_sales_cnt", INT), ("mth_to_dt_sales_cnt", INT),
     ("rpt_mth_nbr", INT), ("rpt_mth_abbr_txt", TEXT)])

FLEET_LAG_FACT = published(
    [("rpt_dt", DATE), ("sales_thru_dt", DATE)],
    [("day_sales_cnt", INT), ("mth_to_dt_sales_cnt", INT), ("rpt_mth_nbr", INT),
     ("rpt_mth_abbr_txt", TEXT)])

COURTESY_FACT = published(
    [("veh_id_nbr", TEXT), ("file_dt", DATE), ("out_svc_dt", DATE)],
    [("in_svc_dt", DATE), ("biz_assoc_id", LONG), ("day_in_svc_cnt", INT),
     ("out_svc_mil_cnt", INT), ("sell_src_cd", INT), ("sell_src_desc", TEXT),
     ("veh_prod_rpt_model_cd", TEXT), ("model_yr", INT), ("out_svc_type_cd", TEXT),
     ("loan_great_than_60_day_cd", TEXT)])

DEALER_FORECAST = published(
    [("frcst_rpt_dt", DATE), ("iso_ctry_cd", TEXT), ("biz_assoc_cd", LONG),
     ("sell_src_cd", INT), ("frcst_model_cd", INT), ("data_upd_dt", STAMP),
     ("kpi_type_cd", INT)],
    [("zero_adj_flg", TEXT), ("frcst_cnt", INT), ("frcst_model_desc", TEXT),
     ("isas_brand_cd", TEXT), ("kpi_metric_short_desc", TEXT), ("kpi_metric_long_desc", TEXT)])

SYSTEM_MESSAGE = published(
    [("ntl_cd", TEXT), ("sys_cd", TEXT), ("sys_desc", TEXT), ("sys_msg_identity", TEXT)],
    [("msg_txt", TEXT), ("eff_dt", DATE), ("exp_dt", DATE), ("msg_type", TEXT),
     ("last_upd_usr_identity", TEXT), ("last_upd_dt", DATE)])
