import datetime as dt
import os
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import plan_of, rows
from forecourt.functions.dates import excel_serial_date
from forecourt.functions.text import code_label, percent_parse, plain_header, yes_no
from forecourt.plans import staging
from forecourt.sources import feeds
from forecourt.sources.delimited import read_delimited
from forecourt.sources.file_dates import with_header_date
from forecourt.sources.fixed_width import (land_text, parse_fixed_width, read_text_feed,
                                           rejected_lines)
from forecourt.sources.layouts import LAYOUTS
from forecourt.streaming.ingest import read_batches
from workload.feeds import render

D = dt.date


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return path


def snapshot_line(name, *values):
    cells = [f" {v:06d}" if v >= 0 else f"-{-v:06d}" for v in values]
    return "~".join([name.ljust(30), *cells, "   "]) + "\n"


def test_model_snapshots(spark, tmp_path):
    put(tmp_path, "SNAPSHOT_20230502.txt", snapshot_line("CAR X", *range(1, 12), -84))
    put(tmp_path, "SNAPSHOT_20230503.txt", snapshot_line("CAR X", *[7] * 12))
    got = feeds.read_model_snapshots(spark, str(tmp_path / "SNAPSHOT_*.txt"))
    assert rows(got.select("model_nm", "jan", "dec", "rpt_dt", "sales_through_dt")) == [
        ("CAR X", 1, -84, D(2023, 5, 2), D(2023, 5, 1)),
        ("CAR X", 7, 7, D(2023, 5, 3), D(2023, 5, 2))]


def test_snapshot_staging_is_idempotent(spark, tmp_path):
    path = put(tmp_path / "in", "SNAPSHOT_20230502.txt", snapshot_line("CAR X", *range(12)))
    out = str(tmp_path / "out")
    tuesday, monday = D(2023, 5, 2), D(2023, 5, 1)
    assert staging.stage_model_snapshots(spark, path, out, monday) == 0
    assert staging.stage_model_snapshots(spark, path, out, tuesday) == 1
    assert staging.stage_model_snapshots(spark, path, out, tuesday) == 0


def test_a_file_without_a_date_blocks_no_other(spark, tmp_path):
    put(tmp_path / "in", "SNAPSHOT_new.txt", snapshot_line("CAR Y", *range(12)))
    folder, out, day = str(tmp_path / "in"), str(tmp_path / "out"), D(2023, 5, 2)
    assert staging.stage_model_snapshots(spark, folder, out, day) == 0
    put(tmp_path / "in", "SNAPSHOT_20230502.txt", snapshot_line("CAR X", *range(12)))
    assert staging.stage_model_snapshots(spark, folder, out, day) == 1
    undated = feeds.read_model_snapshots(spark, folder, undated=True)
    assert rows(undated.select("model_nm", "dec")) == [("CAR Y", 11)]


EVENT_LINE = "V{0}|01/0{0}/2023|1200|12/15/2023||45|N/A"


def test_retired_events(spark, tmp_path):
    put(tmp_path, "a.txt", EVENT_LINE.format(1) + "\n" + EVENT_LINE.format(2) + "|true")
    got = feeds.read_retired_events(spark, str(tmp_path))
    assert rows(got) == [
        ("V1", D(2023, 1, 1), 1200, D(2023, 12, 15), None, 45, None),
        ("V2", D(2023, 1, 2), 1200, D(2023, 12, 15), None, 45, None)]


def test_each_new_file_is_loaded_once(spark, tmp_path):
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    put(folder, "E_1.txt", EVENT_LINE.format(1) + "\n")
    put(folder, "other.csv", "x\n")

    def load():
        staging.stage_new_retired_events(spark, folder, out, state, "E_*").awaitTermination()
        return spark.read.parquet(out).count()

    assert load() == 1 and load() == 1
    put(folder, "E_2.txt", EVENT_LINE.format(2) + "\n")
    assert load() == 2


def test_bad_values_are_null_or_rejected(spark, tmp_path):
    path = put(tmp_path, "f.txt", "1|02/30/2023|x\n2|02/28/2023|7\n3\n\n")
    schema = feeds.columns(("k", feeds.LONG), ("d", feeds.DATE), ("n", feeds.INT))
    plain = read_delimited(spark, path, schema, "|", date_formats=("MM/dd/yyyy",))
    assert rows(plain) == [(1, None, None), (2, D(2023, 2, 28), 7), (3, None, None)]
    good, bad = read_delimited(spark, path, schema, "|", date_formats=("MM/dd/yyyy",),
                               rejects=True)
    assert rows(good.select("k")) == [(2,)]
    assert [(r["k"], r["rejected_columns"]) for r in bad.collect()] == [
        ("1", ["d", "n"]), ("3", ["too few fields"])]


def test_industry_outlook_takes_serial_days(spark, tmp_path):
    path = put(tmp_path, "o.csv", "\ufeffNTL_CD,VEH_TYPE_GRP_CD,EFF_MNTH_DT,INDY_OUTLK_QTY,"
               "INDY_SEASNLY_ADJ_ANNL_NBR,LAST_UPDT_USR_ID,LAST_UPDT_DT\n"
               "US,1,45017,1001,3,Someone ,2/7/2024\n"
               "US,1,45017,1001,3,Someone ,2/7/2024\n"
               "US,2,11/1/2023,5,12.3,Someone,2/7/2024\nUS,3,,5,1,Someone,2/7/2024\n")
    got = feeds.read_industry_outlook(spark, path)
    assert rows(got) == [
        ("US", 1, D(2023, 4, 1), 1001, Decimal("3.0000"), "Someone", D(2024, 2, 7)),
        ("US", 2, D(2023, 11, 1), 5, Decimal("12.3000"), "Someone", D(2024, 2, 7))]


def test_system_messages_in_both_date_formats(spark, tmp_path):
    head = ("NTL_CD,SYS_CD,SYS_DESC,SYS_MSG_SA_ID,MSG_TXT,EFCTV_DT,"
            "EXPRTN_DT,MESSAGE_TYPE,LAST_UPDT_USR_ID,LAST_UPDT_DT\n")
    path = put(tmp_path, "m.csv", head + 'US,S,d,1,"a, b",5/3/2023,2023-12-31,T,u,12/1/2023\n')
    got = feeds.read_system_messages(spark, path)
    assert rows(got) == [("US", "S", "d", 1, "a, b", D(2023, 5, 3), D(2023, 12, 31), "T", "u",
                          D(2023, 12, 1))]


def test_org_forecast_headers_and_null_marks(spark, tmp_path):
    names = feeds.ORG_FORECAST.fieldNames()
    path = put(tmp_path, "f.csv", ",".join(f"tbl.{n}" for n in names)
               + "\nUS,2/1/2024,1,0,,,,,,777,NULL,4,55,NOBODY,NULL\n")
    r = feeds.read_org_forecast(spark, path).first()
    assert (r["frcst_dt"], r["kpi_cd"], r["kpi_val"], r["mktg_org_lvl_2_cd"]) == (
        D(2024, 2, 1), None, Decimal("55.00000"), None)
    assert r["src_sys_last_upd_ts"] is None


def test_selling_date_track(spark, tmp_path):
    path = put(tmp_path, "t.txt", "SALES_DATE_THROUGH|DAILY_COUNT|MONTH_TO_DATE_COUNT|"
               "TRACK_PERCENTAGE|PRIOR_YEAR_PERCENTAGE\n\n2024/05/31|120|3456|-7.5%|+12.1%\n")
    assert rows(feeds.read_selling_date_track(spark, path)) == [
        (D(2024, 5, 31), 120, 3456, Decimal("-0.075000"), Decimal("0.121000"))]


def test_regional_sales(spark, tmp_path):
    line = "|".join(["Land", "Firm", "", "Retail", "2023/12/01", "2023/12", "9"] + [""] * 4
                    + ["Mod", "Br", "Car", "Seg"] + [""] * 18)
    path = put(tmp_path, "r.txt", line + "\n")
    assert rows(feeds.read_regional_sales(spark, path)) == [
        ("Land", "Firm", "Retail", D(2023, 12, 1), "2023/12", 9, "Mod", "Br", "Car", "Seg")]


def sheet_text(prefix, bac):
    heads = ["BAC", "Dealer", "Region", "City", "State", "Model", "ISAS",
             f"{prefix}\nAverage\nRecent\nSales", f"{prefix}\nAverage\nSeasonal Sales",
             "Share of\nSales", f"{prefix} \nUnadjusted Objective", f"{prefix}\nObjective",
             "Share of\nNational Objective", "Zero\nDealer\nAdjusted", "MOR\nAdjusted",
             "BE\nDealer", "Notes"]
    values = [bac, "Dealer", "R", "City", "ST", "Trax", "T", "1.25", "2.5", "3%", "11", "12",
              "4%", "X", "", "", "n"]
    return ",".join(f'"{h}"' for h in heads) + "\n" + ",".join(values) + "\n"


def test_objective_sheets_from_exports(spark, tmp_path):
    sb = put(tmp_path, "sb.csv", sheet_text("SB", "101") + sheet_text("SB", "").split("\n")[-2] + "\n")
    df = put(tmp_path, "df.csv", sheet_text("DF", "202"))
    out = str(tmp_path / "out")
    n = staging.stage_objective_sheets(spark, sb, df, out, D(2023, 6, 1), "job",
                                       F.lit("2024-01-01").cast("timestamp"))
    assert n == 4
    assert staging.stage_objective_sheets(spark, sb, df, out, D(2023, 6, 1), "job",
                                          F.lit("2024-01-02").cast("timestamp")) == 0
    got = spark.read.parquet(out).select("bac", "isas", "kpi_type_code", "objective",
                                         "average_recent_sales", "dw_anom_flg")
    assert rows(got) == [
        (101, "T", 711, 12, Decimal("1.25"), "U"), (101, "T", 716, 11, Decimal("1.25"), "U"),
        (202, "TXX", 714, 12, Decimal("1.25"), "U"), (202, "TXX", 715, 11, Decimal("1.25"), "U")]
    with pytest.raises(ValueError, match="not a DF objective sheet"):
        feeds.read_objective_sheet(spark, sb, "DF")


# --- fixed width ----------------------------------------------------------

def test_region_feed(spark, tmp_path):
    path = put(tmp_path, "FEED_REG_20240502.txt",
               "HDR REG 05/02/2024 OBJECTIVE   \n0000000003412QZ3050220240000815\n0000\n")
    lines = read_text_feed(spark, path)
    assert rows(parse_fixed_width(lines, LAYOUTS["REG"])) == [
        ("34", 12, "QZ3", D(2024, 5, 2), 815), (None, None, None, None, None)]
    bad = rejected_lines(lines, LAYOUTS["REG"]).collect()
    assert [(r["value"], r["rejected_columns"]) for r in bad] == [("0000", ["line too short"])]


def test_header_only_file(spark, tmp_path):
    path = put(tmp_path, "FEED_NAT_20240502.txt", "HDR NAT 05/02/2024 OBJ \n")
    assert feeds.read_objectives(spark, path, "NAT").isEmpty()


def test_header_dates_belong_to_their_file(spark, tmp_path):
    put(tmp_path, "a.txt", "HDR NAT 05/02/2024 OBJ \n0011QX1050220240001234\n")
    put(tmp_path, "b.txt", "HDR NAT 06/03/2024 OBJ \n0012QY2060320240000099\n")
    put(tmp_path, "c.txt", "0012QY2070420240000001\n")
    dated = with_header_date(land_text(spark, str(tmp_path)))
    got = parse_fixed_width(dated, LAYOUTS["NAT"], keep=["file_date"])
    assert rows(got) == [
        (11, "QX1", D(2024, 5, 2), 1234, D(2024, 5, 2)),
        (12, "QY2", D(2024, 6, 3), 99, D(2024, 6, 3)), (12, "QY2", D(2024, 7, 4), 1, None)]


def test_lines_are_not_dealt_by_file_to_get_its_date(spark, tmp_path):
    put(tmp_path, "a.txt", "HDR NAT 05/02/2024 OBJ \n" + "0011QX1050220240001234\n" * 50)
    put(tmp_path, "b.txt", "0012QY2070420240000001\n")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dated = with_header_date(land_text(spark, str(tmp_path)))
        assert "SortMergeJoin" not in plan_of(dated)
        assert rows(dated.groupBy("file_date").count()) == [(D(2024, 5, 2), 50), (None, 1)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


values = {
    "biz_assoc_id": st.integers(0, 999999), "region_cd": st.from_regex(r"\A[0-9]{2}\Z"),
    "sec_cd": st.from_regex(r"\A[0-9]{2}\Z"), "zone_cd": st.from_regex(r"\A[0-9]{4}\Z"),
    "area_cd": st.from_regex(r"\A[0-9]{4}\Z"), "sell_src_cd": st.sampled_from([11, 12, 13, 48]),
    "brand_cd": st.from_regex(r"\A[A-Z0-9]{3}\Z"),
    "rpt_dt": st.dates(D(2000, 1, 1), D(2049, 12, 31)), "obj_cnt": st.integers(0, 9999999)}


@pytest.mark.parametrize("name", [n for n in LAYOUTS if n != "GMM"])
@settings(max_examples=3, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.data())
def test_parse_undoes_render(spark, name, data):
    layout = LAYOUTS[name]
    made = data.draw(st.lists(st.tuples(*[values[f.name] for f in layout.fields]),
                              min_size=1, max_size=5))
    df = spark.createDataFrame(made, layout.schema)
    lines = df.select(render(layout, {f.name: F.col(f.name) for f in layout.fields}).alias("value"))
    assert rows(parse_fixed_width(lines, layout)) == rows(df)
    assert rejected_lines(lines, layout).isEmpty()


@pytest.mark.parametrize(("name", "line", "want"), [
    ("BAC", "0000011582312QX105022024000123499", (115823, 12, "QX1", D(2024, 5, 2), 1234)),
    ("ZON", "000000000070021041213QX1050220240000056", ("07", "21", "0412", 13, "QX1",
                                                        D(2024, 5, 2), 56)),
    ("ARE", "0000000000700210412003313QX1050220240000056",
     ("07", "21", "0412", "0033", 13, "QX1", D(2024, 5, 2), 56)),
    ("SEC", "00000000034002111QX3050220240000815", ("34", "21", 11, "QX3", D(2024, 5, 2), 815)),
    ("GMM", "000000000AB00CD0001000200030004000500060007000899",
     ("AB", "CD", "0001", "0002", "0003", "0004", "0005", "0006", "0007", "0008"))])
def test_literal_lines(spark, name, line, want):
    """Lines written out by hand, so that a wrong start position shows."""
    got = parse_fixed_width(spark.createDataFrame([(line,)], "value string"), LAYOUTS[name])
    assert tuple(got.first()) == want


def test_undocumented_layout_is_ten_texts(spark):
    line = "".join(chr(65 + i % 26) for i in range(48))
    got = parse_fixed_width(spark.createDataFrame([(line,)], "value string"), LAYOUTS["GMM"])
    assert len(got.columns) == 10 and got.first()["col1"] == line[9:11]


def test_objective_staging(spark, tmp_path):
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    path = put(folder, "FEED_NAT_20240502.txt", "HDR NAT 05/02/2024 OBJ \n0011QX1050220240001234\n")
    assert staging.stage_objectives(spark, path, str(tmp_path / "his"), "NAT") == 1
    for _ in range(2):
        staging.stage_new_objectives(spark, folder, out, state, "NAT", "FEED_NAT_*").awaitTermination()
    assert rows(read_batches(spark, out)) == [(11, "QX1", D(2024, 5, 2), 1234, D(2024, 5, 2))]


def test_expressions(frame):
    df = frame([("45017", "+4.1%", 11), ("x", "4.1", 99), (None, "-10%", None)],
               "serial string, pct string, code int")
    got = df.select(excel_serial_date(F.col("serial")), percent_parse(F.col("pct")),
                    code_label(F.col("code"), {11: "a"}), yes_no(F.col("serial"), "x"))
    assert [tuple(r) for r in got.collect()] == [
        (D(2023, 4, 1), Decimal("0.041000"), "a", "N"), (None, None, None, "Y"),
        (None, Decimal("-0.100000"), None, "N")]
    assert plain_header("tbl.Kpi_Cd") == "kpi_cd"
    assert plain_header("SB\nAverage\nRecent\nSales") == "sb_average_recent_sales"
