import datetime as dt
from collections import defaultdict

import pytest

from conftest import plan_of, rows
from forecourt.fixed_values import MONTHS
from forecourt.functions.dates import loads_on
from forecourt.operators import cumulative, kpi
from forecourt.operators.calendar import (calendar_gate, calendar_window, fill_forward_calendar)
from forecourt.plans.fleet import daily_and_mtd, fleet_fact

D = dt.date
SNAP = "model_nm string, " + ", ".join(f"{m} int" for m in MONTHS) + \
       ", rpt_dt date, sales_through_dt date"
CAL = ("sales_thru_dt date, curr_mth_start_dt date, curr_yr_start_dt date, "
       "prior_yr_start_dt date, prior_year_current_day_dt date, iso_ctry_cd string")


def wide(model, rpt, **months):
    return (model, *[months.get(m, 0) for m in MONTHS], rpt, rpt - dt.timedelta(days=1))


def cal_row(d, country="US"):
    return (d, d.replace(day=1), D(d.year, 1, 1), D(d.year - 1, 1, 1), d.replace(year=d.year - 1),
            country)


@pytest.fixture
def calendar(spark):
    days = [D(2022, 11, 1) + dt.timedelta(days=i) for i in range(150)]
    return spark.createDataFrame([cal_row(d) for d in days if d.day != 29]
                                 + [cal_row(D(2023, 1, 5), "CA")], CAL)


def by_date(df, value):
    return {r["rpt_dt"]: r[value] for r in df.collect()}


def test_monday_looks_back_two_days(spark, calendar):
    # 2023-02-13 is a Monday; the Sunday report is there but must not be used
    snap = spark.createDataFrame([
        wide("a", D(2023, 2, 11), feb=10), wide("b", D(2023, 2, 11), feb=1),
        wide("a", D(2023, 2, 12), feb=17), wide("a", D(2023, 2, 13), feb=30),
        wide("a", D(2023, 2, 14), feb=31)], SNAP)
    days = calendar_window(calendar, D(2023, 3, 1))
    got = by_date(cumulative.daily_from_mtd_shift(snap, days), "daily_sales")
    assert got == {D(2023, 2, 11): None, D(2023, 2, 12): 17 - 11, D(2023, 2, 13): 30 - 11,
                   D(2023, 2, 14): 1}


def test_january_starts_from_zero(spark, calendar):
    # the report of Jan 1 (through Dec 31) still shows last January
    snap = spark.createDataFrame([
        wide("a", D(2023, 1, 1), jan=500, dec=70), wide("a", D(2023, 1, 2), jan=4, dec=70),
        wide("a", D(2023, 1, 3), jan=9, dec=71)], SNAP)
    days = calendar_window(calendar, D(2023, 3, 1))
    got = by_date(cumulative.daily_from_mtd_shift(snap, days), "daily_sales")
    # Jan 2 is a Monday: it looks for the report of Dec 31, which is not there
    assert got[D(2023, 1, 2)] is None
    got = by_date(cumulative.daily_from_mtd_shift(snap, days, look_back={}), "daily_sales")
    assert got[D(2023, 1, 2)] == 4
    assert got[D(2023, 1, 3)] == 5


def test_other_months_do_not_reset(spark, calendar):
    snap = spark.createDataFrame([
        wide("a", D(2023, 1, 1), jan=500, feb=8), wide("a", D(2023, 1, 2), jan=1, feb=9)], SNAP)
    got = rows(cumulative.year_reset_sum(snap, calendar_window(calendar, D(2023, 3, 1)))
               .select("rpt_dt", "jan", "feb"))
    assert got == [(D(2023, 1, 1), 0, 8), (D(2023, 1, 2), 1, 9)]


def test_newest_day_sees_its_own_window_only(spark, calendar):
    # as of a Tuesday the newest report is Monday's... and its base is out of the window
    snap = spark.createDataFrame([
        wide("a", D(2023, 2, 11), feb=10), wide("a", D(2023, 2, 12), feb=17),
        wide("a", D(2023, 2, 13), feb=30)], SNAP)
    got = by_date(daily_and_mtd(snap, calendar, D(2023, 2, 13)), "day_sales_cnt")
    assert got == {D(2023, 2, 11): None, D(2023, 2, 12): 7, D(2023, 2, 13): None}


def test_fact_equals_merge_of_both_frames(spark, calendar):
    snap = spark.createDataFrame(
        [wide("a", D(2023, 1, 10) + dt.timedelta(days=i), jan=i * i, feb=2 * i, mar=i)
         for i in range(60)], SNAP)
    from pyspark.sql import functions as F
    stamp = F.lit("2024-01-01").cast("timestamp")
    merged = daily_and_mtd(snap, calendar, D(2023, 3, 15))
    fact = fleet_fact(snap, calendar, D(2023, 3, 15), "job", stamp)
    assert rows(merged.select(*sorted(merged.columns))) == rows(fact.select(*sorted(merged.columns)))


def test_window_bounds(spark, calendar):
    history = rows(calendar_window(calendar, D(2023, 2, 2)).select("sales_thru_dt"))
    assert history[0] == (D(2022, 11, 1),) and history[-1] == (D(2023, 1, 31),)
    assert rows(calendar_window(calendar, D(2023, 2, 2), "incremental").select(
        "sales_thru_dt", "rpt_mth_nbr", "rpt_mth_abbr_txt")) == [(D(2023, 2, 1), 2, "Feb")]


def test_window_bound_when_the_last_day_is_no_selling_day(spark, calendar):
    # Jan 29 is missing; the bound comes from the day before it
    assert calendar_window(calendar, D(2023, 1, 31)).count() > 0


def test_window_of_one_country(spark, calendar):
    days = calendar_window(calendar, D(2023, 2, 2))
    assert days.where("sales_thru_dt = date'2023-01-05'").count() == 1


def test_gate(spark, calendar, frame):
    df = frame([(1,), (2,)], "x int")
    assert calendar_gate(df, calendar, D(2023, 1, 29)).count() == 2
    assert calendar_gate(df, calendar, D(2023, 1, 30)).count() == 0
    assert calendar_gate(df, calendar, D(2023, 1, 6), country="MX").count() == 0


def test_shift_and_lag_agree_inside_a_month_without_gaps(spark, calendar):
    snap = spark.createDataFrame(
        [wide("a", D(2023, 3, 1) + dt.timedelta(days=i), mar=3 * i + i * i) for i in range(25)],
        SNAP)
    shift = by_date(cumulative.daily_from_mtd_shift(
        snap, calendar_window(calendar, D(2023, 3, 30)), look_back={}), "daily_sales")
    lag = by_date(cumulative.daily_from_mtd_lag(snap, calendar), "day_sales_cnt")
    inside = [d for d in lag if D(2023, 3, 3) <= d]
    assert inside and all(shift[d] == lag[d] for d in inside)


def test_daily_adds_up_to_the_last_month_to_date(spark, calendar):
    counts = [5, 0, 7, 11, 2, 9, 4, 0, 0, 13]
    total, snap = 0, []
    for i, c in enumerate(counts):
        total += c
        snap.append(wide("a", D(2023, 3, 2) + dt.timedelta(days=i), mar=total))
    got = cumulative.daily_from_mtd_lag(spark.createDataFrame(snap, SNAP), calendar)
    assert sum(r["day_sales_cnt"] for r in got.collect()) == total


def test_lag_per_partition(spark, calendar):
    snap = spark.createDataFrame(
        [wide(m, D(2023, 3, 2 + i), mar=k * (i + 1)) for m, k in (("a", 1), ("b", 10))
         for i in range(3)], SNAP)
    got = cumulative.daily_from_mtd_lag(snap, calendar, ["model_nm"])
    assert {(r["model_nm"], r["day_sales_cnt"]) for r in got.collect()} == {("a", 1), ("b", 10)}


def test_month_pick_wraps_at_the_year(spark):
    df = spark.createDataFrame(
        [("a", *range(1, 13), D(2023, 1, 1), D(2023, 1, 1)),
         ("b", *range(1, 13), D(2023, 1, 2), D(2023, 1, 1)),
         ("c", *range(1, 13), D(2023, 5, 1), D(2023, 5, 1))],
        "k string, " + ", ".join(f"{m} int" for m in MONTHS)
        + ", rpt_dt date, curr_mth_start_dt date")
    assert rows(cumulative.month_column_pick(df).select("k", "mtd_sales")) == [
        ("a", 12), ("b", 1), ("c", 4)]


def test_unpivot_is_one_scan_without_shuffle(spark, tmp_path):
    path = str(tmp_path / "snap")
    spark.createDataFrame([wide("a", D(2023, 1, 10), jan=1)], SNAP).write.parquet(path)
    df = cumulative.unpivot_months(spark.read.parquet(path), ["rpt_dt"])
    assert df.count() == 12
    plan = plan_of(df)
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


def test_look_back_is_an_equality_join(spark, calendar):
    snap = spark.createDataFrame([wide("a", D(2023, 2, 11), feb=10)], SNAP)
    plan = plan_of(cumulative.daily_from_mtd_shift(snap, calendar_window(calendar, D(2023, 3, 1))))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_fill_forward(frame):
    df = frame([("a", D(2023, 1, 1), 5, None), ("a", D(2023, 1, 4), None, 7),
                ("b", D(2023, 1, 3), 1, 1)], "k string, d date, x int, y int")
    filled = fill_forward_calendar(df, "d", ["x", "y"], D(2023, 1, 5), partition=["k"])
    assert rows(filled) == [
        ("a", D(2023, 1, 1), 5, None, False), ("a", D(2023, 1, 2), 5, None, True),
        ("a", D(2023, 1, 3), 5, None, True), ("a", D(2023, 1, 4), 5, 7, False),
        ("a", D(2023, 1, 5), 5, 7, True), ("b", D(2023, 1, 3), 1, 1, False),
        ("b", D(2023, 1, 4), 1, 1, True), ("b", D(2023, 1, 5), 1, 1, True)]
    again = fill_forward_calendar(filled.drop("is_filled"), "d", ["x", "y"], D(2023, 1, 5),
                                  partition=["k"])
    assert rows(again.drop("is_filled")) == rows(filled.drop("is_filled"))


def test_ytd_family(spark, calendar):
    months = "jan int, feb int"
    days = spark.createDataFrame(
        [(D(2022, 2, 11), D(2022, 2, 10), D(2022, 2, 1), D(2021, 2, 10), 100, 20),
         (D(2023, 2, 11), D(2023, 2, 10), D(2023, 2, 1), D(2022, 2, 10), 150, None),
         (D(2023, 1, 2), D(2023, 1, 1), D(2023, 1, 1), D(2022, 1, 1), 7, 9)],
        "rpt_dt date, sales_through_dt date, curr_mth_start_dt date, "
        "prior_year_current_day_dt date, " + months)
    for m in MONTHS[2:]:
        days = days.selectExpr("*", f"0 AS {m}")
    assert by_date(kpi.ytd(days), "ytd_sales") == {
        D(2022, 2, 11): 120, D(2023, 2, 11): 150, D(2023, 1, 2): 7}
    assert by_date(kpi.prior_ytd(days), "prior_ytd_sales")[D(2023, 2, 11)] == 120
    assert by_date(kpi.ytd_variance(days), "variance")[D(2023, 2, 11)] == 30
    assert by_date(kpi.ytd_pct_change(days), "percent_change")[D(2023, 2, 11)] == 0.25
    assert by_date(kpi.mtd_as_of(days), "mtd_sales")[D(2023, 1, 2)] == 0


def test_pct_change_without_prior_sales_is_null(spark):
    days = spark.createDataFrame(
        [(D(2022, 2, 11), D(2021, 2, 10), 0), (D(2023, 2, 11), D(2022, 2, 10), 5)],
        "rpt_dt date, prior_year_current_day_dt date, jan int")
    for m in MONTHS[1:]:
        days = days.selectExpr("*", f"0 AS {m}")
    assert set(by_date(kpi.ytd_pct_change(days), "percent_change").values()) == {None}


def test_no_load_on_monday():
    assert not loads_on(D(2023, 2, 13))
    assert loads_on(D(2023, 2, 12)) and loads_on(D(2023, 2, 14))
    counts = defaultdict(int)
    for i in range(14):
        counts[loads_on(D(2023, 2, 1) + dt.timedelta(days=i))] += 1
    assert counts == {True: 12, False: 2}


def test_calendar_join_keeps_every_day_and_row(frame):
    from forecourt.operators.calendar import calendar_enrich
    days = [D(1899, 5, 2), D(2000, 5, 2), D(2101, 5, 2)]
    calendar = frame([(d, i, "US") for i, d in enumerate(days)] + [
        (days[1], 7, "US"), (days[1], 8, "CA")], "sales_thru_dt date, x int, iso_ctry_cd string")
    df = frame([(d + dt.timedelta(days=1),) for d in days], "rpt_dt date")
    got = calendar_enrich(df, calendar, ["x"], country="US")
    assert [r[0] for r in rows(got.select("x"))] == [0, 1, 2, 7]


def test_spine_neither_runs_backwards_nor_forgets(frame):
    from forecourt.operators.calendar import fill_forward_calendar
    df = frame([("a", D(2023, 1, 9), 1), ("b", D(2023, 1, 1), 2)], "p string, d date, v int")
    late = fill_forward_calendar(df, "d", ["v"], D(2023, 1, 5), partition=["p"])
    assert {r.p for r in late.collect()} == {"b"} and late.count() == 5
    begun = fill_forward_calendar(df, "d", ["v"], D(2023, 1, 5), D(2023, 1, 3), ["p"])
    assert [(r.p, r.d.day, r.v) for r in begun.orderBy("p", "d").collect()] == [
        ("b", 3, 2), ("b", 4, 2), ("b", 5, 2)]


def test_serials_and_percentages(frame):
    from forecourt.functions.dates import excel_serial_date
    from forecourt.functions.text import percent_parse
    df = frame([("45017", "+.5%"), ("20230401", "5")], "s string, p string")
    got = df.select(excel_serial_date(df.s), percent_parse(df.p)).collect()
    assert got[0][0] == D(2023, 4, 1) and float(got[0][1]) == 0.005
    assert tuple(got[1]) == (None, None)


def test_audit_stamp_is_a_wall_clock(spark):
    from forecourt.functions.dates import zone_timestamp
    r = spark.range(1).select(zone_timestamp("America/Detroit").alias("t"),
                              zone_timestamp("UTC").alias("u")).first()
    assert dt.timedelta(hours=4) <= r["u"] - r["t"] <= dt.timedelta(hours=5)
