import datetime as dt
import random

import pytest

from conftest import plan_of, rows
from forecourt.operators import attribution, ranking
from forecourt.operators import skew
from pyspark.sql import functions as F

D = dt.date


def test_keep_latest_compares_keys_by_column(frame):
    df = frame([("1", "12", 1), ("11", "2", 2), ("1", None, 3), ("1", None, 4), (None, "1", 5)],
               "a string, b string, t int")
    assert rows(ranking.keep_latest(df, ["a", "b"], ["t"])) == [
        ("1", "12", 1), ("1", None, 4), ("11", "2", 2), (None, "1", 5)]


def test_ties_do_not_depend_on_distribution(frame):
    data = [(k, 1, random.random()) for k in range(5) for _ in range(40)]
    expected = None
    for n in (1, 3, 7):
        random.shuffle(data)
        got = rows(ranking.keep_first(frame(data, "k int, t int, v double").repartition(n),
                                      ["k"], ["t"]))
        expected = expected or got
        assert got == expected


def test_one_row_per_key_is_cut_before_the_shuffle(frame):
    plan = plan_of(ranking.keep_latest(frame([(1, 2)], "k int, t int"), ["k"], ["t"]))
    before_shuffle = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in before_shuffle


def test_first_and_last(frame):
    df = frame([(1, 5, "x"), (1, 3, "y"), (1, 9, "z"), (2, 1, "w")], "k int, t int, v string")
    got = ranking.first_and_last(df, ["k"], ["t"], ["v"])
    assert rows(got.select("k", "first.v", "last.v")) == [(1, "y", "z"), (2, "w", "w")]


def test_first_non_null(frame):
    df = frame([(1, 1, None), (1, 2, 8), (1, 3, 9), (2, 1, None)], "k int, t int, v int")
    assert rows(ranking.first_non_null(df, ["k"], "v", ["t"])) == [(1, 8), (2, None)]


@pytest.mark.parametrize("partitions", [1, 6])
def test_sequence_numbers_of_a_hot_key(frame, partitions):
    # a third of the rows and the null key share the same pieces as the others
    data = [(1 if i % 3 == 0 else i % 50, i) for i in range(3000)] + [(None, i) for i in range(40)]
    random.shuffle(data)
    df = frame(data, "k int, t int").repartition(partitions)
    got = ranking.sequence_numbers(df, ["k"], ["t"], [F.expr("t div 100")], "n", reverse="m")
    seen = {}
    for r in got.collect():
        seen.setdefault(r["k"], []).append((r["t"], r["n"], r["m"]))
    assert sum(map(len, seen.values())) == len(data)
    for numbered in seen.values():
        size = len(numbered)
        assert [(n, m) for _, n, m in sorted(numbered)] == [
            (i + 1, size - i) for i in range(size)]


def test_sequence_numbers_moves_the_rows_once(frame):
    df = frame([(i % 3, i) for i in range(100)], "k int, t int")
    spark = df.sparkSession
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(ranking.sequence_numbers(df, ["k"], ["t"], [F.expr("t div 10")]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # rows: one shuffle by piece; sizes: one to count, one per key, one to meet the rows
    assert plan.count("Exchange hashpartitioning") <= 4
    assert "__piece" in plan[plan.rindex("Window ["):]


def lookup_cases(frame):
    left = frame([(1, f"r{i}") for i in range(300)] + [(i, "x") for i in range(2, 40)]
                 + [(None, f"n{i}") for i in range(50)], "k int, v string")
    right = frame([(i, i * 10) for i in range(0, 30)] + [(None, -1)], "id int, w int")
    return left, right


@pytest.mark.parametrize("null_safe", [True, False])
@pytest.mark.parametrize("how", skew.JOIN_KINDS)
def test_lookup_join_with_hot_keys_equals_plain_join(frame, monkeypatch, how, null_safe):
    left, right = lookup_cases(frame)
    renamed = right.toDF("id", "w")
    cond = F.col("k").eqNullSafe(F.col("id")) if null_safe else F.col("k") == F.col("id")
    expected = rows(left.join(renamed, cond, how).drop("id"))
    monkeypatch.setattr(skew, "HOT_ROWS", 20)  # key 1 and null are hot now
    hot = skew.hot_keys(left, ["k"])
    assert rows(hot) == [(1, 15), (None, 3)]
    got = skew.lookup_join(left, right, {"k": "id"}, how, null_safe=null_safe)
    assert rows(got) == expected


def test_hot_rows_are_dealt_over_tasks(frame, monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 20)
    left, right = lookup_cases(frame)
    spark = left.sparkSession
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = skew.lookup_join(left, right, {"k": "id"}, hot=skew.hot_keys(left, ["k"]))
        assert "SortMergeJoin" in plan_of(got)
        spread = (got.where("k = 1").withColumn("p", F.spark_partition_id())
                  .groupBy("p").count().collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(spread) == 4 and max(r["count"] for r in spread) < 200


def test_hot_list_has_a_bound(frame, monkeypatch):
    monkeypatch.setattr(skew, "HOT_KEYS", 3)
    df = frame([(k,) for k in range(10) for _ in range(5 + k)], "k int")
    assert rows(skew.hot_keys(df, ["k"], rows=4).select("k")) == [(7,), (8,), (9,)]


# --- attribution ---------------------------------------------------------

EVENT = ("vin string, outdate date, todaydate date, daysinservice int, outmile int, "
         "outtype string, loangreaterthan60 string")
OWNER = ("veh_id_nbr string, biz_assoc_id bigint, orig_proc_dt date, model_yr int, "
         "sell_src_cd int, veh_prod_rpt_model_cd string")


def ev(vin, out, today, days=30, miles=100):
    return (vin, D.fromisoformat(out), D.fromisoformat(today), days, miles, "T", None)


def own(vin, dealer, proc):
    return (vin, dealer, D.fromisoformat(proc), 2023, 11, "M")


def short(df):
    return rows(df.select("veh_id_nbr", "file_dt", "out_svc_dt", "biz_assoc_id"))


def test_first_event_goes_to_the_first_dealer_the_others_to_the_last(frame):
    events = frame([ev("A", "2023-03-01", "2023-03-02"), ev("A", "2023-05-01", "2023-05-02")], EVENT)
    owners = frame([own("A", 1, "2023-01-01"), own("A", 2, "2023-02-01")], OWNER)
    assert short(attribution.event_history(events, owners, D(2023, 6, 1))) == [
        ("A", D(2023, 3, 2), D(2023, 3, 1), 1), ("A", D(2023, 5, 2), D(2023, 5, 1), 2)]


def test_events_before_the_dealers_record_do_not_count(frame):
    events = frame([ev("A", "2023-01-01", "2023-03-02"), ev("B", "2023-03-01", "2023-03-02")], EVENT)
    owners = frame([own("A", 1, "2023-01-01")], OWNER)
    assert short(attribution.event_history(events, owners, D(2023, 6, 1))) == []


def test_copies_count_once_with_the_latest_file(frame):
    events = frame([ev("A", "2023-03-01", "2023-03-02"), ev("A", "2023-03-01", "2023-03-09")], EVENT)
    owners = frame([own("A", 1, "2023-01-01")], OWNER)
    assert short(attribution.event_history(events, owners, D(2023, 6, 1))) == [
        ("A", D(2023, 3, 9), D(2023, 3, 1), 1)]


def test_same_file_and_dealer_as_the_first_event_is_left_out(frame):
    # one dealer: the second event of the same file repeats it, that of another file does not
    events = frame([ev("A", "2023-03-01", "2023-03-02"), ev("A", "2023-03-03", "2023-03-02"),
                    ev("A", "2023-04-01", "2023-04-02")], EVENT)
    owners = frame([own("A", 1, "2023-01-01")], OWNER)
    assert short(attribution.event_history(events, owners, D(2023, 6, 1))) == [
        ("A", D(2023, 3, 2), D(2023, 3, 1), 1), ("A", D(2023, 4, 2), D(2023, 4, 1), 1)]


def test_new_events_are_those_first_seen_today(frame):
    today = "2023-06-01"
    events = frame([ev("A", "2023-03-01", today), ev("B", "2023-03-01", today),
                    ev("B", "2023-03-01", "2023-05-01"), ev("A", "2023-03-01", today),
                    ev("A", "2023-03-01", "2023-07-01")], EVENT)
    owners = frame([own("A", 1, "2023-01-01"), own("A", 2, "2023-02-01"),
                    own("B", 3, "2023-01-01")], OWNER)
    assert short(attribution.new_events(events, owners, D(2023, 6, 1))) == [
        ("A", D(2023, 6, 1), D(2023, 3, 1), 2)]


def test_owner_sequence(frame):
    owners = frame([own("A", 1, "2023-01-01"), own("A", 2, "2023-02-01"), own("A", 3, "2023-02-01"),
                    own("B", 9, "2023-01-01")], OWNER).select(
        "veh_id_nbr", "biz_assoc_id", "orig_proc_dt")
    got = attribution.owner_sequence(owners).drop("orig_proc_dt")
    assert rows(got) == [("A", 1, 1, 3), ("A", 2, 2, 2), ("A", 3, 3, 1), ("B", 9, 1, 1)]


def test_delivered_filters(frame):
    schema = OWNER + ", ntl_cd string, kpi_type_cd int, veh_deliv_cnt int"
    base = own("A", 1, "2023-01-01")
    df = frame([base + ("US", 25, 1), base + ("US", 95, 1), base + ("CA", 25, 1),
                base + ("US", 26, 1), base + ("US", 25, -1), own("A", 1, "2020-12-31") + ("US", 25, 1),
                base[:4] + (99, "M", "US", 25, 1)], schema)
    assert attribution.delivered(df, D(2021, 1, 1), D(2023, 6, 1)).count() == 2


def test_delivery_filters_reach_the_scan(spark, frame, tmp_path):
    path = str(tmp_path / "deliveries")
    schema = OWNER + ", ntl_cd string, kpi_type_cd int, veh_deliv_cnt int, unused string"
    frame([own("A", 1, "2023-01-01") + ("US", 25, 1, "x")], schema).write.parquet(path)
    sold = attribution.delivered(spark.read.parquet(path), D(2021, 1, 1), D(2023, 6, 1))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = plan_of(attribution.ends(attribution.first_per_pair(
            sold.select("veh_id_nbr", "biz_assoc_id", "orig_proc_dt"))))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    for column in ("orig_proc_dt,", "kpi_type_cd,", "veh_deliv_cnt,"):
        assert column in scan[scan.index("PushedFilters"):]
    assert "unused" not in scan and "model_yr" not in scan


def test_history_and_increment_share_one_pass(frame):
    """Events are reduced and given their owners once, for both halves: what is read
    afterwards is the written table."""
    events = frame([ev("A", "2023-03-01", "2023-03-02"), ev("A", "2023-05-01", "2023-06-01")], EVENT)
    owners = frame([own("A", 1, "2023-01-01")], OWNER)
    both = attribution.attributed(events, owners, D(2023, 6, 1))
    plan = plan_of(both)
    assert "Scan ExistingRDD" not in plan and "LocalTableScan" not in plan
    assert plan.count("Exchange hashpartitioning") <= 2
    apart = attribution.event_history(events, owners, D(2023, 6, 1)).unionByName(
        attribution.new_events(events, owners, D(2023, 6, 1)))
    assert rows(both) == rows(apart) and both.count() == 2


def test_dealt_vehicles_give_the_same_history(frame):
    random.seed(5)
    events = frame([ev(v, f"2023-03-{random.randint(1, 28):02d}", f"2023-04-{random.randint(1, 28):02d}")
                    for v in "AAAAAAAAAAAAAAAB"], EVENT)
    owners = frame([own(v, d, f"2023-0{d}-01") for v in "AB" for d in (1, 2)], OWNER)
    plain = attribution.attributed(events, owners, D(2023, 4, 20))
    dealt = attribution.attributed(events, owners, D(2023, 4, 20),
                                   hot=skew.hot_keys(events, ["vin"], rows=3))
    assert rows(plain) == rows(dealt) and not plain.isEmpty()
