"""Rejects, headers, arrivals, partition reloads, fingerprints and published tables."""

import datetime as dt
import os
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import plan_of, rows
from forecourt.operators import load
from forecourt.operators.catalog import publish_table, read_table
from forecourt.operators.load import append_if_new, overwrite, replace_partitions, stored_rows
from forecourt.operators.objectives import hierarchy_reconcile
from forecourt.operators.reconcile import fingerprint, reconcile_sets, same_rows
from forecourt.plans import staging
from forecourt.sources import feeds
from forecourt.sources.delimited import land_by_header, read_by_header, read_delimited
from forecourt.streaming.ingest import ingest_batches, read_batches, stream_lines
from test_sources import put

D = dt.date
FEED = feeds.columns(("k", feeds.LONG), ("v", feeds.TEXT), ("d", feeds.DATE))


# --- rejects -------------------------------------------------------------

def test_short_long_and_badly_typed_lines_are_rejected(spark, tmp_path):
    path = put(tmp_path, "f.txt", "1~a~2024-05-01\n2~b\n3~c~2024-05-03~x~y\nx~d~2024-05-04\n"
               '5~e~\n6~"f~g"~2024-05-06\n7~h~2024-05-07~\n\n')
    good, bad = read_delimited(spark, path, FEED, "~", rejects=True, trailing=1)
    assert rows(good) == [(1, "a", D(2024, 5, 1)), (5, "e", None), (6, "f~g", D(2024, 5, 6)),
                          (7, "h", D(2024, 5, 7))]
    assert sorted((r["k"], *r["rejected_columns"]) for r in bad.collect()) == [
        ("2", "too few fields"), ("3", "too many fields"), ("x", "k")]
    assert {r["line"] for r in bad.collect()} >= {"2~b", "3~c~2024-05-03~x~y"}


def test_rows_and_rejects_come_from_one_read(spark, tmp_path):
    path = put(tmp_path, "f.txt", "1~a~2024-05-01\n2~b\n")
    good, bad = read_delimited(spark, path, FEED, "~", rejects=True)
    os.remove(path)  # nothing is read from the feed any more
    assert good.count() == 1 and bad.count() == 1
    assert "FileScan csv" not in plan_of(good) + plan_of(bad)


def test_retired_events_with_or_without_the_flag(spark, tmp_path):
    line = "V{}|01/02/2023|1200|12/15/2023||45|N/A"
    put(tmp_path, "a.txt", line.format(1) + "\n" + line.format(2) + "|true\nV3|01/02/2023\n")
    good, bad = feeds.read_retired_events(spark, str(tmp_path), rejects=True)
    assert rows(good.select("vin")) == [("V1",), ("V2",)]
    assert rows(bad.select("vin")) == [("V3",)]


# --- headers -------------------------------------------------------------

def test_files_of_one_read_may_order_their_columns(spark, tmp_path):
    put(tmp_path, "a.csv", "﻿K,t.V,D\n1,one,2024-05-01\n")
    put(tmp_path, "b.csv", 'D,other,V,K\n\n2024-05-02,x,"two, ""quoted""",2\nbad,x,three,3\n')
    got = read_by_header(spark, str(tmp_path), FEED)
    assert rows(got) == [(1, "one", D(2024, 5, 1)), (2, 'two, "quoted"', D(2024, 5, 2)),
                         (3, "three", None)]


def test_unknown_headers_and_faulty_lines_are_rejected(spark, tmp_path):
    put(tmp_path, "a.csv", "k,v,d\n1,one,2024-05-01\n2,two\n3,three,2024-05-03,more\nx,y,z\n")
    put(tmp_path, "b.csv", "k,v,day\n4,four,2024-05-04\n")
    put(tmp_path, "c.csv", "k,v,d\n5,five,2024-05-05\nv,k,d\nsix,6,2024-05-06\n")
    good, bad = read_by_header(spark, str(tmp_path), FEED, rejects=True)
    assert rows(good) == [(1, "one", D(2024, 5, 1))]
    faults = Counter(f for r in bad.collect() for f in r["rejected_columns"])
    assert faults == {"too few fields": 1, "too many fields": 1, "k": 1, "d": 1,
                      "no header with the declared columns": 2, "different headers": 2}
    with pytest.raises(PySparkException, match="no header with the declared columns"):
        read_by_header(spark, str(tmp_path / "b.csv"), FEED).collect()


def test_rows_are_not_dealt_by_file_to_get_its_header(spark, tmp_path):
    lines = "".join(f"{i},v{i},2024-05-01\n" for i in range(300)) + "x,y,z\n"
    put(tmp_path, "a.csv", "k,v,d\n" + lines)
    put(tmp_path, "b.csv", "other\n")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = land_by_header(spark, str(tmp_path), FEED)
        assert "SortMergeJoin" not in plan_of(got)
        assert Counter(len(r["rejected_columns"]) for r in got.collect()) == {0: 300, 1: 1, 2: 1}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rows_and_rejects_are_written_unsorted(spark, tmp_path):
    put(tmp_path, "a.csv", "k,v,d\n1,one,2024-05-01\nx,y,z\n2,two,2024-05-02\n")
    good, bad = read_by_header(spark, str(tmp_path), FEED, rejects=True)
    assert rows(good) == [(1, "one", D(2024, 5, 1)), (2, "two", D(2024, 5, 2))]
    assert rows(bad.select("k")) == [("x",)]
    # Spark sorts the rows of a task by the folder they go to
    assert not [f for f in [*good.inputFiles(), *bad.inputFiles()] if "fits=" in f]


def test_messages_with_another_column_order(spark, tmp_path):
    names = feeds.SYSTEM_MESSAGES.fieldNames()
    values = dict(zip(names, ["US", "S", "d", "1", "hi", "5/3/2023", "2023-12-31", "T", "u",
                              "12/1/2023"], strict=True))
    for i, order in enumerate((names, names[::-1])):
        put(tmp_path, f"{i}.csv", ",".join(order) + "\n" + ",".join(values[n] for n in order) + "\n")
    got = feeds.read_system_messages(spark, str(tmp_path)).collect()
    assert len(got) == 2 and got[0] == got[1] and got[0]["efctv_dt"] == D(2023, 5, 3)


# --- arrivals --------------------------------------------------------------

LINE = "V{}|01/02/2023|1200|12/15/2023||45|N/A\n"


def test_faulty_lines_of_new_files_go_to_the_rejects(spark, tmp_path):
    folder, out, bad, state, archive = (
        str(tmp_path / n) for n in ("in", "out", "bad", "state", "archive"))

    def run():
        staging.stage_new_retired_events(spark, folder, out, state, "E_*", bad,
                                         archive).awaitTermination()
        return rows(read_batches(spark, out).select("vin"))

    put(folder, "E_1.txt", LINE.format(1) + "V2|01/02/2023\n" + LINE.format(3).replace("1200", "x"))
    assert run() == [("V1",)] and run() == [("V1",)]
    faults = read_batches(spark, bad).select("vin", F.array_join("rejected_columns", ","))
    assert rows(faults) == [("V2", "too few fields"), ("V3", "outmile")]
    put(folder, "E_2.txt", LINE.format(4))
    assert run() == [("V1",), ("V4",)]
    moved = [f for _, _, names in os.walk(archive) for f in names if f.startswith("E_")]
    assert "E_1.txt" in moved and not os.path.exists(os.path.join(folder, "E_1.txt"))


def test_a_batch_that_failed_half_way_is_completed_without_doubles(spark, tmp_path):
    folder, state = str(tmp_path / "in"), str(tmp_path / "state")
    first, second = str(tmp_path / "first"), str(tmp_path / "second")
    put(folder, "a.txt", "1\n2\n")
    broken = [True]

    def split(batch):
        stop = F.raise_error(F.lit("disk gone")) if broken[0] else F.col("value")
        return {first: batch.select("value"), second: batch.select(stop.cast("string").alias("v"))}

    with pytest.raises(PySparkException):
        ingest_batches(stream_lines(spark, folder), split, state).awaitTermination()
    assert read_batches(spark, first).count() == 2  # the first table was written
    broken[0] = False
    for _ in range(2):
        ingest_batches(stream_lines(spark, folder), split, state).awaitTermination()
    assert rows(read_batches(spark, first)) == [("1",), ("2",)]
    assert rows(read_batches(spark, second)) == [("1",), ("2",)]


def test_objective_files_keep_the_date_of_their_header(spark, tmp_path):
    folder, out, bad, state = (str(tmp_path / n) for n in ("in", "out", "bad", "state"))
    put(folder, "FEED_NAT_1.txt", "HDR NAT 05/02/2024 OBJ \n0011QX1050220240001234\n00\n")
    put(folder, "FEED_NAT_2.txt", "HDR NAT 06/03/2024 OBJ \n0012QY2060320240000099\n")
    for late in (False, True):
        if late:
            put(folder, "FEED_NAT_3.txt", "0012QY2070420240000001\n")
        staging.stage_new_objectives(spark, folder, out, state, "NAT", "FEED_NAT_*",
                                     bad).awaitTermination()
    assert rows(read_batches(spark, out).select("obj_cnt", "file_date")) == [
        (1, None), (1234, D(2024, 5, 2)), (99, D(2024, 6, 3))]
    assert rows(read_batches(spark, bad).select("value")) == [("00",)]


# --- loads ---------------------------------------------------------------

def days(frame, *pairs):
    return frame([(v, D(2024, 5, d)) for v, d in pairs], "v string, d date")


def test_only_the_folders_of_a_load_are_replaced(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    overwrite(days(frame, *[(f"old{i}", i) for i in range(1, 11)]), path, ["d"])
    kept = {d: os.listdir(os.path.join(path, f"d=2024-05-{d:02d}")) for d in (1, 10)}
    new = days(frame, ("new3", 3), ("more3", 3), ("new7", 7))
    assert replace_partitions(new, path, ["d"]) == 3
    assert replace_partitions(new, path, ["d"]) == 3
    got = rows(spark.read.parquet(path).select("v"))
    assert got == sorted([(f"old{i}",) for i in (1, 2, 4, 5, 6, 8, 9, 10)]
                         + [("new3",), ("more3",), ("new7",)])
    assert {d: os.listdir(os.path.join(path, f"d=2024-05-{d:02d}")) for d in (1, 10)} == kept
    with pytest.raises(ValueError):
        replace_partitions(new, path, [])


def test_a_guard_reads_no_data_column_of_its_table(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    overwrite(days(frame, ("a", 1), ("b", 2)), path, ["d"])
    left = load.rows_to_append(days(frame, ("c", 2), ("d", 3)), spark.read.parquet(path), ["d"],
                               "key")
    scans = [p for p in plan_of(left).split("FileScan parquet")[1:]]
    assert scans and all("ReadSchema: struct<>" in s for s in scans)
    assert [r.v for r in left.collect()] == ["d"]


def test_a_load_is_evaluated_once(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    overwrite(days(frame, ("a", 1)), path, ["d"])
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def once(v):
        seen.add(1)
        return v

    load_ = days(frame, ("b", 2), ("c", 3)).withColumn("v", once("v"))
    assert append_if_new(load_, path, ["d"], partition_by=["d"]) == 2
    assert seen.value == 2


def test_row_counts_come_from_the_footers(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    overwrite(days(frame, ("a", 1), ("b", 2)), path)
    assert stored_rows(spark, path) == 2
    assert "ReadSchema: struct<>" in plan_of(spark.read.parquet(path).select())


# --- fingerprints ------------------------------------------------------------

cells = st.tuples(st.one_of(st.none(), st.integers(0, 2)), st.one_of(st.none(), st.sampled_from("ab")))


@settings(max_examples=8, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(left=st.lists(cells, max_size=12), right=st.lists(cells, max_size=12))
def test_fingerprints_find_what_counting_finds(spark, left, right):
    a, b = (spark.createDataFrame(side, "n int, s string") for side in (left, right))
    want = Counter(left)
    want.subtract(Counter(right))
    expected = sorted(((*k, "left_only" if n > 0 else "right_only", abs(n))
                       for k, n in want.items() if n), key=str)
    for buckets in (0, 1, 7):
        assert sorted((tuple(r) for r in reconcile_sets(a, b, buckets).collect()),
                      key=str) == expected
    assert same_rows(a, a.orderBy("n"), 4)


def test_fingerprints_of_parts_add_up(spark):
    df = spark.range(5000).select(F.col("id"), (F.col("id") % 7).cast("string").alias("s"))
    names = fingerprint(df, 8).columns
    parts = fingerprint(df.where("id < 999"), 8).unionByName(fingerprint(df.where("id >= 999"), 8))
    whole = parts.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in names if c != "bucket"])
    assert rows(whole) == rows(fingerprint(df, 8))


def test_equal_tables_leave_no_rows_to_compare(spark, tmp_path):
    """Only one small row per bucket and task is shuffled, whatever the tables hold."""
    path = str(tmp_path / "t")
    spark.range(20_000).selectExpr("id", "uuid() AS text").write.parquet(path)
    a, b = spark.read.parquet(path), spark.read.parquet(path)
    differ = reconcile_sets(a, b, 16)
    assert differ.count() == 0
    tasks = a.rdd.getNumPartitions() + b.rdd.getNumPartitions()
    assert fingerprint(a, 16).count() == 16 and tasks * 16 < 1000


# --- tables by name ------------------------------------------------------------

def test_a_table_made_from_itself(spark, frame, tmp_path):
    name, path = "published_here", str(tmp_path / "table")
    assert publish_table(frame([(1, "a"), (2, "b")], "k int, v string"), name, path) == 2
    old = read_table(spark, name)
    assert publish_table(old.where("k = 2").withColumn("v", F.upper("v")), name, path) == 1
    assert rows(read_table(spark, name)) == [(2, "B")]
    assert rows(old) == [(1, "a"), (2, "b")]  # whoever read before goes on
    failing = read_table(spark, name).withColumn("v", F.raise_error(F.lit("x")).cast("string"))
    with pytest.raises(PySparkException):
        publish_table(failing, name, path)
    assert rows(read_table(spark, name)) == [(2, "B")]
    assert publish_table(frame([(3,)], "other int"), name, path) == 1
    assert read_table(spark, name).columns == ["other"]
    spark.sql(f"DROP TABLE {name}")


def test_levels_that_do_not_add_up(frame):
    schema = "b string, r int, n int"
    levels = {"NAT": frame([("x", None, 10), ("y", None, 5)], schema),
              "REG": frame([("x", 1, 4), ("x", 2, 6), ("y", 1, 4)], schema),
              "SEC": frame([("x", 1, 10), ("z", 1, 1)], schema)}
    assert rows(hierarchy_reconcile(levels, ["b"], "n")) == [
        ("y", "NAT", "REG", 5, 4), ("y", "REG", "SEC", 4, 0), ("z", "REG", "SEC", 0, 1)]
