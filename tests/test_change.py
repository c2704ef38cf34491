import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType

from conftest import plan_of, rows
from forecourt.operators.audit import conform, conform_positional, with_audit
from forecourt.operators.change import change_feed, exclude_keys, latest_slice
from forecourt.operators.enrich import apply_overrides, enrich_left
from forecourt.operators.load import (append_if_new, new_files, overwrite, overwrite_table,
                                      rows_to_append, shift_file_date, stored_rows, verify_write)
from forecourt.operators.objectives import objective_sheets
from forecourt.operators.reconcile import reconcile_counts, reconcile_sets, same_rows

D = dt.date


def feed(new, old, **options):
    return rows(change_feed(new, old, ["k", "j"], **options))


def test_change_feed(frame):
    schema = "k int, j string, v int"
    new = frame([(1, "a", 1), (2, "a", 5), (3, None, 7), (3, None, 8)], schema)
    old = frame([(2, "a", 2), (2, "a", 3), (3, None, 7), (4, "a", 9), (4, "a", 9)], schema)
    assert feed(new, old) == [
        (1, "a", 1, "I"), (2, "a", 5, "U"), (3, None, 7, "U"), (3, None, 8, "U"),
        (4, "a", 9, "D"), (4, "a", 9, "D")]
    assert feed(new, old, compare_cols=["v"]) == [
        (1, "a", 1, "I"), (2, "a", 5, "U"), (3, None, 8, "U"), (4, "a", 9, "D"), (4, "a", 9, "D")]
    plain = feed(new, old, null_safe=False)
    assert (3, None, 7, "I") in plain and (3, None, 7, "D") in plain


pairs = st.lists(st.tuples(st.integers(0, 5), st.sampled_from(["a", "b", None]),
                           st.integers(0, 2)), max_size=12)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(pairs, pairs)
def test_feed_takes_old_to_new(frame, new, old):
    schema = "k int, j string, v int"
    got = feed(frame(new, schema), frame(old, schema))
    new_keys, old_keys = {r[:2] for r in new}, {r[:2] for r in old}
    kept = [r[:3] for r in got if r[3] in "IU"]
    assert sorted(kept, key=str) == sorted(new, key=str)
    assert {r[:2] for r in got if r[3] == "I"} == new_keys - old_keys
    assert {r[:2] for r in got if r[3] == "U"} == new_keys & old_keys
    assert {r[:2] for r in got if r[3] == "D"} == old_keys - new_keys


def test_exclude_keys_does_not_join_text(frame):
    df = frame([("1", "12"), ("11", "2"), ("1", None)], "a string, b string")
    seen = frame([("1", "12"), (None, "2")], "a string, b string")
    assert rows(exclude_keys(df, seen, ["a", "b"])) == [("1", None), ("11", "2")]
    assert "NestedLoop" not in plan_of(exclude_keys(df, seen, ["a", "b"]))


def test_latest_slice(frame):
    df = frame([(1, D(2023, 1, 1)), (2, D(2023, 1, 2)), (3, D(2023, 1, 2)), (4, None)],
               "k int, d date")
    assert [r[0] for r in rows(latest_slice(df, "d"))] == [2, 3]


def test_enrich_and_overrides(frame):
    df = frame([(1, "x"), (2, "y"), (None, "x")], "id int, c string")
    dim = frame([(1, "one"), (1, "one"), (3, "three")], "key int, name string")
    assert rows(enrich_left(df, [(dim, {"id": "key"})])) == [
        (1, "x", "one"), (2, "y", None), (None, "x", None)]
    assert rows(apply_overrides(df, "c", "c", {"x": "z"})) == [(1, "z"), (2, "y"), (None, "z")]


@pytest.mark.parametrize("size", ["-1", "10MB"])
def test_enrich_is_the_same_with_and_without_broadcast(spark, frame, size):
    df = frame([(1, i) for i in range(50)] + [(None, i) for i in range(30)] + [(2, 1)],
               "id int, v int")
    dim = frame([(1, "one"), (3, "three")], "DIM_KEY int, name string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)
    try:
        got = enrich_left(df, [(dim, {"id": "dim_key"})])
        assert got.columns == ["id", "v", "name"]
        assert rows(got.groupBy("id", "name").count()) == [
            (1, "one", 50), (2, None, 1), (None, None, 30)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("null_safe", [True, False])
def test_feed_with_compare_and_null_keys_loses_no_row(frame, null_safe):
    new = old = frame([(None, 1), (1, 1)], "k int, v int")
    feed = change_feed(new, old, ["k"], compare_cols=["v"], null_safe=null_safe)
    assert rows(feed) == ([] if null_safe else [(None, 1, "D"), (None, 1, "I")])


def test_a_reload_of_the_forecast_is_an_update():
    from forecourt.plans.forecast import FORECAST_KEYS
    assert "data_upd_dt" not in FORECAST_KEYS


def test_reconcile_counts_copies(frame):
    a = frame([(1, None), (1, None), (2, "b")], "k int, v string")
    b = frame([(1, None), (2, "b"), (3, "c")], "k int, v string")
    assert rows(reconcile_sets(a, b)) == [(1, None, "left_only", 1), (3, "c", "right_only", 1)]
    assert same_rows(a, a) and not same_rows(a, b)
    assert rows(reconcile_counts(a, b, ["k"])) == [(1, 2, 1), (3, 0, 1)]
    assert reconcile_counts(a, b).isEmpty()


def test_audit(frame):
    df = frame([(1, D(2023, 1, 1)), (2, None)], "k int, d date")
    got = with_audit(df, ["k", "d"], "171749", "job", F.lit("2024-01-01").cast("timestamp"))
    assert [r["src_sys_uniq_prim_key_val"] for r in got.orderBy("k").collect()] == [
        "1|2023-01-01|171749", None]
    assert got.first()["src_sys_uniq_prim_key_col_val"] == "k|d|src_sys_id"


TARGET = StructType([StructField("d", DateType()), StructField("K", IntegerType())])


def test_conform(frame):
    df = frame([("5", "2023-01-01", "x")], "k string, D string, extra string")
    got = conform(df, TARGET)
    assert got.columns == ["d", "K"] and rows(got) == [(D(2023, 1, 1), 5)]
    with pytest.raises(ValueError, match="missing"):
        conform(df.drop("D"), TARGET)
    with pytest.raises(ValueError, match="3 columns for 2"):
        conform_positional(df, TARGET)
    swapped = conform_positional(df.select("D", "k"), TARGET)
    assert rows(swapped) == [(D(2023, 1, 1), 5)]


def test_append_once(frame, tmp_path):
    path = str(tmp_path / "t")
    a = frame([(1, D(2023, 1, 1)), (2, D(2023, 1, 2))], "k int, d date")
    b = frame([(3, D(2023, 1, 2)), (4, D(2023, 1, 3))], "k int, d date")
    assert append_if_new(a, path, ["d"]) == 2
    assert append_if_new(a, path, ["d"]) == 0
    assert append_if_new(b, path, ["d"]) == 0
    assert append_if_new(b, path, ["d"], "key") == 1
    assert append_if_new(b, path, ["d"], "key") == 0
    assert rows(a.sparkSession.read.parquet(path).select("k")) == [(1,), (2,), (4,)]


def test_overwrite_and_verify(frame, tmp_path, spark):
    path = str(tmp_path / "t")
    df = frame([(1, "a"), (2, "b")], "k int, v string")
    assert overwrite(df, path) == 2 and overwrite(df, path, ["v"]) == 2
    assert verify_write(spark, path, 2) == 2
    with pytest.raises(ValueError, match="holds 2 rows, 1 were written"):
        verify_write(spark, path, 1)
    assert stored_rows(spark, str(tmp_path / "none")) == 0
    assert overwrite_table(df, "sink_check", str(tmp_path / "ext")) == 2
    assert overwrite_table(df.where("k = 1"), "sink_check", str(tmp_path / "ext")) == 1
    assert rows(spark.read.table("sink_check")) == [(1, "a")]
    spark.sql("DROP TABLE sink_check")


def test_files_and_dates(frame):
    files = frame([("a",), ("b",)], "file_name string")
    assert rows(new_files(files, frame([("a",)], "file_name string"))) == [("b",)]
    df = frame([(D(2023, 2, 28),)], "file_date date")
    assert rows(shift_file_date(df)) == [(D(2023, 3, 1),)]


def test_objectives(frame):
    schema = "bac int, model string, isas string, unadjusted_objective int, objective int"
    sheets = {"small_business": frame([(1, "Trax", "ZZZ", 5, 6), (None, "m", "i", 1, 1)], schema),
              "dealer_fleet": frame([(2, "Trax", "ZZZ", 7, 8)], schema)}
    got = objective_sheets(sheets, D(2023, 6, 1))
    assert rows(got.select("bac", "isas", "kpi_type_code", "objective")) == [
        (1, "ZZZ", 711, 6), (1, "ZZZ", 716, 5), (2, "TXX", 714, 8), (2, "TXX", 715, 7)]


def test_only_folders_that_can_match_are_looked_up(spark, frame, day, tmp_path):
    path = str(tmp_path / "parts")
    old = frame([(1, day("2024-01-01")), (2, day("2024-01-02")), (3, None)], "k int, d date")
    assert append_if_new(old, path, ["d"], partition_by=["d"]) == 3
    new = frame([(4, day("2024-01-02")), (5, day("2024-01-03"))], "k int, d date")
    left = rows_to_append(new, spark.read.parquet(path), ["d"], "key")
    filters = plan_of(left).split("PartitionFilters: [")[1].split("]")[0]
    assert "subquery" in filters
    assert [r.k for r in left.collect()] == [5]
    undated = frame([(6, None), (7, day("2024-01-04"))], "k int, d date")
    assert [r.k for r in rows_to_append(undated, spark.read.parquet(path), ["d"], "key")
            .collect()] == [7]
    assert append_if_new(frame([(8, None)], "k int, d date"), path, ["d"], "key") == 0
