"""Calendar, cumulative snapshots and KPIs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.fixed_values import MONTHS
from forecourt.functions.dates import is_load_day
from forecourt.operators import cumulative, kpi
from forecourt.operators.calendar import (calendar_enrich, calendar_gate, calendar_window,
                                          fill_forward_calendar)
from forecourt.plans.fleet import daily_and_mtd, fleet_fact, fleet_lag_fact
from workload.registry import query
from workload.standins import (AS_OF, BASE_YEAR, SNAPSHOT_SQL, STAMP, calendar, month_case,
                               month_name, orders, snapshots, stamp)

WITH = "WITH " + SNAPSHOT_SQL
LAST_DAY = "DATE '2001-07-31'"   # two days before AS_OF
NEWEST_DAY = "DATE '2001-08-01'"  # the day before AS_OF
DAYS_SQL = """
hist AS (SELECT * FROM cal WHERE sales_thru_dt <= """ + LAST_DAY + """ AND sales_thru_dt >=
         (SELECT min(prior_yr_start_dt) FROM cal WHERE year(curr_yr_start_dt) = 1996)),
inc AS (SELECT * FROM cal WHERE sales_thru_dt = """ + NEWEST_DAY + ")"


def window(spark: SparkSession, sf_dir: str, mode: str = "historical") -> DataFrame:
    base = BASE_YEAR if mode == "historical" else None
    return calendar_window(calendar(spark, sf_dir), AS_OF, mode, base_year=base)


@query(WITH + """
SELECT o_orderkey, o.d + 1 AS rpt_dt, curr_mth_start_dt AS month_start, prior_yr_start_dt
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders) o
JOIN cal ON cal.sales_thru_dt = o.d""")
def calendar_enrich_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = orders(spark, sf_dir).select("o_orderkey", F.date_add("order_dt", 1).alias("rpt_dt"))
    return calendar_enrich(rows, calendar(spark, sf_dir), {
        "curr_mth_start_dt": "month_start", "prior_yr_start_dt": "prior_yr_start_dt"})


WINDOW_SQL = f"""SELECT sales_thru_dt, curr_mth_start_dt, curr_yr_start_dt, prior_yr_start_dt,
       rpt_mth_nbr, {month_name('rpt_mth_nbr')} AS rpt_mth_abbr_txt, '{{bound}}' AS bound
FROM cal WHERE """


@query(WITH + WINDOW_SQL.format(bound="prior year") + f"""
sales_thru_dt <= {LAST_DAY} AND sales_thru_dt >= (
    SELECT arg_max(prior_yr_start_dt, sales_thru_dt) FROM cal WHERE sales_thru_dt <= {LAST_DAY})
UNION ALL """ + WINDOW_SQL.format(bound="base year") + f"""
sales_thru_dt <= {LAST_DAY} AND sales_thru_dt >= DATE '1995-01-01'
UNION ALL """ + WINDOW_SQL.format(bound="newest") + f" sales_thru_dt = {NEWEST_DAY}")
def calendar_window_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = calendar(spark, sf_dir)
    frames = [calendar_window(days, AS_OF).withColumn("bound", F.lit("prior year")),
              calendar_window(days, AS_OF, base_year=BASE_YEAR)
              .withColumn("bound", F.lit("base year")),
              calendar_window(days, AS_OF, "incremental").withColumn("bound", F.lit("newest"))]
    return frames[0].unionByName(frames[1]).unionByName(frames[2]).drop(
        "iso_ctry_cd", "prior_year_current_day_dt")


@query(WITH + """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_dt FROM orders
WHERE EXISTS (SELECT 1 FROM cal WHERE sales_thru_dt = """ + NEWEST_DAY + ")")
def calendar_gate_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar_gate(orders(spark, sf_dir).select("o_orderkey", "order_dt"),
                         calendar(spark, sf_dir), AS_OF)


@query(WITH + "SELECT * FROM wide")
def wide_month_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cumulative.wide_month_sum(snapshots(spark, sf_dir))


def flagged(df: DataFrame, *names: str) -> DataFrame:
    """Nulls as -1, and a column that tells them from a real -1."""
    return df.withColumns({f"no_{n}": F.col(n).isNull() for n in names}).fillna(-1, subset=names)


RESET_SQL = """
reset AS (SELECT s.rpt_dt, h.sales_thru_dt, h.rpt_mth_nbr,
       CAST(sum(CASE WHEN s.sales_through_dt IN (h.curr_yr_start_dt - 1, h.prior_yr_start_dt - 1)
                     THEN 0 ELSE s."jan" END) AS BIGINT) AS "jan", """ + ", ".join(
    f'CAST(sum(s."{m}") AS BIGINT) AS "{m}"' for m in MONTHS[1:]) + """
   FROM snap s JOIN {days} h ON s.sales_through_dt = h.sales_thru_dt - 1 GROUP BY 1, 2, 3)"""


@query(WITH + "," + DAYS_SQL + "," + RESET_SQL.format(days="hist")
       + f" SELECT *, {month_name('rpt_mth_nbr')} AS rpt_mth_abbr_txt FROM reset")
def year_reset_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cumulative.year_reset_sum(snapshots(spark, sf_dir), window(spark, sf_dir))


@query(WITH + " UNION ALL ".join(
    f" SELECT model_nm, rpt_dt, CAST({i} AS BIGINT) AS month_nbr, '{m.title()}' AS month_abbr, "
    f'"{m}" AS sales FROM snap' for i, m in enumerate(MONTHS, 1)))
def unpivot_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cumulative.unpivot_months(snapshots(spark, sf_dir), ["model_nm", "rpt_dt"], "sales")


def shift_sql(days: str) -> str:
    """Daily sales by look-back over the days of a CTE.

    Both sides have one row per report date, so there is nothing to sum.
    """
    return f"""
    SELECT f.rpt_dt, f.sales_thru_dt, f.rpt_mth_nbr, f.rpt_mth_nbr AS sales_mth_cat_nbr,
           CAST({month_case('f.rpt_mth_nbr', 'f.')} - {month_case('f.rpt_mth_nbr', 'p.')}
                AS BIGINT) AS daily_sales
    FROM (SELECT *, sales_through_dt AS sales_thru_dt,
                 CAST(month(sales_through_dt) AS BIGINT) AS rpt_mth_nbr
          FROM wide WHERE sales_through_dt IN (SELECT sales_thru_dt FROM {days})) f
    LEFT JOIN reset_{days} p
      ON (isodow(f.rpt_dt) = 1 AND p.rpt_dt = f.rpt_dt - 2)
      OR (isodow(f.rpt_dt) <> 1 AND p.rpt_dt = f.rpt_dt - 1)"""


# The base of a window from the summed days. ``year_reset_sum`` is checked against the
# sum over the models and the columns of the calendar; here the calendar only filters,
# since columns taken from its side of a join now and then end in an internal error of
# DuckDB ("dictionary caching").
BASE_SQL = """
reset_{days} AS (SELECT * EXCLUDE "jan",
       CASE WHEN sales_through_dt = date_trunc('year', sales_through_dt + 1) - INTERVAL 1 DAY
            THEN 0 ELSE "jan" END AS "jan"
   FROM wide WHERE sales_through_dt + 1 IN (SELECT sales_thru_dt FROM {days}))"""
SHIFT_WITH = (WITH + "," + DAYS_SQL + "," + BASE_SQL.format(days="hist") + ","
              + BASE_SQL.format(days="inc"))


LABELS = f"""{month_name('rpt_mth_nbr')} AS rpt_mth_abbr_txt,
       {month_name('sales_mth_cat_nbr')} AS sales_mth_cat"""


@query(SHIFT_WITH + f"""
SELECT rpt_dt, sales_thru_dt, rpt_mth_nbr, sales_mth_cat_nbr, {LABELS},
       CAST(coalesce(daily_sales, -1) AS BIGINT) AS daily_sales, daily_sales IS NULL AS no_base
FROM (""" + shift_sql("hist") + ")")
def daily_from_mtd_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = cumulative.daily_from_mtd_shift(snapshots(spark, sf_dir), window(spark, sf_dir))
    return (daily.drop("mtd_sales").withColumn("no_base", F.col("daily_sales").isNull())
            .fillna(-1, subset=["daily_sales"]))


PICK_SQL = """
report_cal AS (SELECT sales_thru_dt, CAST(date_trunc('month', sales_thru_dt + 1) AS DATE) AS start
               FROM cal)"""


@query(WITH + "," + PICK_SQL + f"""
SELECT rpt_dt, start AS curr_mth_start_dt,
       CASE WHEN rpt_dt = start
            THEN {month_case('CASE month(start) WHEN 1 THEN 12 ELSE month(start) - 1 END')}
            ELSE {month_case('month(start)')} END AS mtd_sales
FROM wide JOIN report_cal ON sales_through_dt = report_cal.sales_thru_dt""")
def month_column_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a calendar whose month starts with the report, so the first report closes the month before
    days = calendar(spark, sf_dir).withColumn(
        "curr_mth_start_dt", F.trunc(F.date_add("sales_thru_dt", 1), "month"))
    rows = calendar_enrich(cumulative.wide_month_sum(snapshots(spark, sf_dir)), days,
                           ["curr_mth_start_dt"])
    return cumulative.month_column_pick(rows).select("rpt_dt", "curr_mth_start_dt", "mtd_sales")


LAG_SQL = f"""
picked AS (SELECT rpt_dt, sales_thru_dt, curr_mth_start_dt, {month_case('rpt_mth_nbr')} AS mtd
           FROM wide JOIN cal ON cal.sales_thru_dt = wide.rpt_dt - 1),
lagged AS (SELECT *, lag(mtd) OVER (ORDER BY rpt_dt) AS prev FROM picked),
lag_daily AS (SELECT rpt_dt, sales_thru_dt, curr_mth_start_dt,
    CASE WHEN sales_thru_dt = curr_mth_start_dt AND month(curr_mth_start_dt) = 1 THEN 0
         WHEN sales_thru_dt = curr_mth_start_dt THEN mtd
         ELSE mtd - prev END AS day_sales_cnt, mtd AS mth_to_dt_sales_cnt FROM lagged)"""


@query(WITH + "," + LAG_SQL + """
SELECT rpt_dt, sales_thru_dt, curr_mth_start_dt, mth_to_dt_sales_cnt,
       CAST(coalesce(day_sales_cnt, -1) AS BIGINT) AS day_sales_cnt,
       day_sales_cnt IS NULL AS no_day_sales_cnt FROM lag_daily""")
def daily_from_mtd_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flagged(cumulative.daily_from_mtd_lag(
        snapshots(spark, sf_dir), calendar(spark, sf_dir)), "day_sales_cnt")


def mtd_sql(days: str) -> str:
    """Month-to-date sales per category over the days of a CTE, a branch per month."""
    return " UNION ALL ".join(
        f"""SELECT rpt_dt, sales_through_dt AS sales_thru_dt,
                   CAST(month(sales_through_dt) AS BIGINT) AS rpt_mth_nbr,
                   CAST({i} AS BIGINT) AS sales_mth_cat_nbr, "{m}" AS mtd_sales
            FROM wide WHERE sales_through_dt IN (SELECT sales_thru_dt FROM {days})
            AND month(sales_through_dt) >= {i}""" for i, m in enumerate(MONTHS, 1))


@query(WITH + "," + DAYS_SQL + f" SELECT *, {LABELS} FROM (" + mtd_sql("hist") + ")")
def mtd_by_month_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cumulative.mtd_by_month_category(snapshots(spark, sf_dir), window(spark, sf_dir))


MERGE_SQL = (SHIFT_WITH + ", daily AS (" + shift_sql("hist") + " UNION ALL " + shift_sql("inc")
             + "), mtd AS (" + mtd_sql("hist") + " UNION ALL " + mtd_sql("inc") + ")")
MERGE_KEYS = "rpt_dt, sales_thru_dt, rpt_mth_nbr, sales_mth_cat_nbr"


@query(MERGE_SQL + f"""
SELECT {MERGE_KEYS}, {LABELS}, CAST(coalesce(daily_sales, -1) AS BIGINT) AS day_sales_cnt,
       daily_sales IS NULL AS no_day_sales_cnt,
       CAST(mtd_sales AS BIGINT) AS mth_to_dt_sales_cnt
FROM daily JOIN mtd USING ({MERGE_KEYS})""")
def daily_mtd_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flagged(daily_and_mtd(snapshots(spark, sf_dir), calendar(spark, sf_dir), AS_OF,
                                 base_year=BASE_YEAR), "day_sales_cnt")


@query(MERGE_SQL + f"""
SELECT {MERGE_KEYS}, {LABELS}, CAST(coalesce(daily_sales, -1) AS BIGINT) AS day_sales_cnt,
       daily_sales IS NULL AS no_day_sales_cnt,
       CAST(mtd_sales AS BIGINT) AS mth_to_dt_sales_cnt, '171749' AS src_sys_id,
       rpt_dt || '|' || sales_thru_dt || '|' || sales_mth_cat_nbr || '|171749'
           AS src_sys_uniq_prim_key_val,
       'rpt_dt|sales_thru_dt|sales_mth_cat_nbr|src_sys_id' AS src_sys_uniq_prim_key_col_val,
       CAST(1 AS BIGINT) AS meas_cnt, 'N' AS dw_anom_flg, DATE '{STAMP}' AS dw_mod_dt,
       'fleet-fact' AS dw_job_id, 'I' AS src_sys_iud_cd
FROM daily JOIN mtd USING ({MERGE_KEYS})""")
def fleet_fact_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = fleet_fact(snapshots(spark, sf_dir), calendar(spark, sf_dir), AS_OF, "fleet-fact",
                      stamp(), base_year=BASE_YEAR)
    return flagged(fact.withColumn("dw_mod_dt", F.to_date("dw_mod_ts")).drop("dw_mod_ts"),
                   "day_sales_cnt")


@query(WITH + "," + LAG_SQL + f"""
SELECT rpt_dt, l.sales_thru_dt, mth_to_dt_sales_cnt, rpt_mth_nbr,
       {month_name('rpt_mth_nbr')} AS rpt_mth_abbr_txt,
       CAST(coalesce(day_sales_cnt, -1) AS BIGINT) AS day_sales_cnt,
       day_sales_cnt IS NULL AS no_day_sales_cnt, '315' AS src_sys_id,
       rpt_dt || '|' || l.sales_thru_dt || '|315' AS src_sys_uniq_prim_key_val,
       'rpt_dt|sales_thru_dt|src_sys_id' AS src_sys_uniq_prim_key_col_val,
       CAST(1 AS BIGINT) AS meas_cnt, 'N' AS dw_anom_flg, DATE '{STAMP}' AS dw_mod_dt,
       'fleet-lag' AS dw_job_id, 'I' AS src_sys_iud_cd
FROM lag_daily l JOIN cal ON cal.sales_thru_dt = l.sales_thru_dt""")
def fleet_lag_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = fleet_lag_fact(snapshots(spark, sf_dir), calendar(spark, sf_dir), "fleet-lag",
                          stamp(), source_id="315")
    return flagged(fact.withColumn("dw_mod_dt", F.to_date("dw_mod_ts")).drop("dw_mod_ts"),
                   "day_sales_cnt")


FILLED_SQL = f"""
loaded AS (SELECT * FROM wide WHERE isodow(rpt_dt) <> 1),
spine AS (SELECT CAST(unnest(generate_series((SELECT min(rpt_dt) FROM loaded), DATE '{AS_OF}',
                                             INTERVAL 1 DAY)) AS DATE) AS rpt_dt),
filled AS (SELECT s.rpt_dt, """ + ", ".join(
    f'last_value("{c}" IGNORE NULLS) OVER w AS "{c}"' for c in ("sales_through_dt", *MONTHS)
) + """, l.rpt_dt IS NULL AS is_filled FROM spine s LEFT JOIN loaded l ON l.rpt_dt = s.rpt_dt
   WINDOW w AS (ORDER BY s.rpt_dt ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


def loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots without the Monday reports."""
    return snapshots(spark, sf_dir).where(is_load_day(F.col("rpt_dt")))


@query(WITH + "," + FILLED_SQL + " SELECT * FROM filled")
def calendar_spine_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = cumulative.wide_month_sum(loaded(spark, sf_dir))
    return fill_forward_calendar(sums, "rpt_dt", ["sales_through_dt", *MONTHS], AS_OF)


def _ytd_sum(date: str, prefix: str = "") -> str:
    return " + ".join(f'CASE WHEN month({date}) >= {i} THEN coalesce({prefix}"{m}", 0) ELSE 0 END'
                      for i, m in enumerate(MONTHS, 1))


KPI_SQL = FILLED_SQL + f""",
kpi AS (SELECT f.*, c.curr_mth_start_dt, c.prior_year_current_day_dt + 1 AS prior_rpt_dt,
               {_ytd_sum('f.rpt_dt')} AS ytd_sales
        FROM filled f JOIN cal c ON c.sales_thru_dt = f.sales_through_dt),
both_years AS (SELECT k.*, p.ytd_sales AS prior_ytd_sales
               FROM kpi k LEFT JOIN kpi p ON p.rpt_dt = k.prior_rpt_dt)"""


def _spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.calendar_spine(loaded(spark, sf_dir), calendar(spark, sf_dir), AS_OF)


@query(WITH + "," + KPI_SQL + f"""
SELECT rpt_dt, CAST(CASE WHEN sales_through_dt = curr_mth_start_dt
                          AND month(curr_mth_start_dt) = 1 THEN 0
                    ELSE {month_case('month(curr_mth_start_dt)')} END AS BIGINT) AS mtd_sales
FROM kpi""")
def mtd_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.mtd_as_of(_spine(spark, sf_dir))


@query(WITH + "," + KPI_SQL + " SELECT rpt_dt, CAST(ytd_sales AS BIGINT) AS ytd_sales FROM kpi")
def ytd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.ytd(_spine(spark, sf_dir))


@query(WITH + "," + KPI_SQL + """
SELECT rpt_dt, prior_rpt_dt, CAST(coalesce(prior_ytd_sales, -1) AS BIGINT) AS prior_ytd_sales,
       prior_ytd_sales IS NULL AS no_prior_ytd_sales
FROM both_years""")
def prior_ytd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flagged(kpi.prior_ytd(_spine(spark, sf_dir)), "prior_ytd_sales")


@query(WITH + "," + KPI_SQL + """
SELECT rpt_dt, CAST(ytd_sales AS BIGINT) AS ytd_sales,
       CAST(coalesce(prior_ytd_sales, -1) AS BIGINT) AS prior_ytd_sales,
       prior_ytd_sales IS NULL AS no_prior_ytd_sales,
       CAST(coalesce(ytd_sales - prior_ytd_sales, -1) AS BIGINT) AS variance,
       ytd_sales - prior_ytd_sales IS NULL AS no_variance
FROM both_years""")
def ytd_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flagged(kpi.ytd_variance(_spine(spark, sf_dir)), "prior_ytd_sales", "variance")


@query(WITH + "," + KPI_SQL + """
SELECT rpt_dt, CASE WHEN coalesce(prior_ytd_sales, 0) = 0 THEN -1.0
                    ELSE round((ytd_sales - prior_ytd_sales) / CAST(prior_ytd_sales AS DOUBLE), 9)
               END AS percent_change, coalesce(prior_ytd_sales, 0) = 0 AS no_percent_change
FROM both_years""")
def ytd_pct_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    change = kpi.ytd_pct_change(_spine(spark, sf_dir))
    return flagged(change.select("rpt_dt", F.round("percent_change", 9).alias("percent_change")),
                   "percent_change")
