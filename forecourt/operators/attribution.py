"""Retired-out vehicle events and the dealers they are attributed to."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.fixed_values import DELIVERY_KPI_TYPES, SELLING_SOURCES
from forecourt.functions.text import code_label
from forecourt.operators.change import exclude_keys
from forecourt.operators.ranking import first_and_last, keep_first, sequence_numbers
from forecourt.operators.skew import lookup_join
from forecourt.session import materialize

# An event is the same event when these agree, whatever file it came in.
EVENT_KEYS = ("vin", "outdate", "daysinservice", "outmile")
EVENT_COLUMNS = ("vin", "outdate", "todaydate", "daysinservice", "outmile", "outtype",
                 "loangreaterthan60")
OWNER_COLUMNS = ("orig_proc_dt", "biz_assoc_id", "model_yr", "sell_src_cd",
                 "veh_prod_rpt_model_cd")

PUBLISHED = {
    "vin": "veh_id_nbr", "todaydate": "file_dt", "orig_proc_dt": "in_svc_dt",
    "outdate": "out_svc_dt", "biz_assoc_id": "biz_assoc_id",
    "daysinservice": "day_in_svc_cnt", "outmile": "out_svc_mil_cnt",
    "outtype": "out_svc_type_cd", "sell_src_cd": "sell_src_cd",
    "veh_prod_rpt_model_cd": "veh_prod_rpt_model_cd", "model_yr": "model_yr",
    "loangreaterthan60": "loan_great_than_60_day_cd",
}


def delivered(deliveries: DataFrame, since: dt.date, through: dt.date, country: str = "US",
              kpi_types: Sequence[int] = DELIVERY_KPI_TYPES,
              sources: Sequence[int] = tuple(SELLING_SOURCES)) -> DataFrame:
    """Delivery records that make a dealer an owner, within a date range."""
    return deliveries.where(
        (F.col("ntl_cd") == country) & F.col("kpi_type_cd").isin(*kpi_types)
        & F.col("sell_src_cd").isin(*sources) & (F.col("veh_deliv_cnt") == 1)
        & F.col("orig_proc_dt").between(F.lit(since), F.lit(through)))


def first_per_pair(records: DataFrame, entity: str = "veh_id_nbr", owner: str = "biz_assoc_id",
                   date: str = "orig_proc_dt") -> DataFrame:
    """The first record per vehicle and dealer."""
    return keep_first(records, [entity, owner], [date])


def owner_sequence(owners: DataFrame, entity: str = "veh_id_nbr", owner: str = "biz_assoc_id",
                   date: str = "orig_proc_dt") -> DataFrame:
    """Rank a vehicle's dealers from the first (``in_dlr_num``) and the last (``out_dlr_num``).

    Input is one row per vehicle and dealer (``first_per_pair``).
    """
    return sequence_numbers(owners, [entity], [date, owner], [F.col(date)],
                            "in_dlr_num", reverse="out_dlr_num")


def ends(owners: DataFrame, entity: str = "veh_id_nbr", date: str = "orig_proc_dt",
         owner: str = "biz_assoc_id", payload: Sequence[str] | None = None) -> DataFrame:
    """First and last dealer record per vehicle, one row per vehicle."""
    rest = [c for c in (payload or owners.columns) if c not in (entity, date, owner)]
    return first_and_last(owners, [entity], [date, owner], rest)


def attribute_events(events: DataFrame, owners: DataFrame, which: str = "first",
                     vehicle: str = "vin", event_date: str = "outdate",
                     entity: str = "veh_id_nbr", date: str = "orig_proc_dt",
                     owner: str = "biz_assoc_id") -> DataFrame:
    """Events with the vehicle's first or last dealer; only events after its record."""
    if which not in ("first", "last"):
        raise ValueError("which must be 'first' or 'last'")
    side = ends(owners, entity, date, owner).select(entity, f"{which}.*")
    return lookup_join(events, side, {vehicle: entity}).where(F.col(event_date) > F.col(date))


def event_sequence(events: DataFrame, vehicle: str, order: Sequence[str], slices,
                   number: str = "seq_asc", reverse: str = "seq_desc") -> DataFrame:
    """Number the distinct events of a vehicle from either end."""
    return sequence_numbers(events.distinct(), [vehicle], order, slices, number, reverse)


def reduced_events(events: DataFrame) -> DataFrame:
    """One row per event with its latest and its first copy, from one aggregation.

    ``latest`` has the greatest file date, a null one last, ``first_seen`` the least, a
    null one first; ties go to the least of the other columns in name order.
    """
    rest = sorted(c for c in EVENT_COLUMNS if c not in EVENT_KEYS and c != "todaydate")
    # ascending like the ties, so that one minimum decides; no day is that late
    back = F.coalesce(-F.unix_date("todaydate"), F.lit(2 ** 31 - 1)).alias("back")
    return events.groupBy(*EVENT_KEYS).agg(
        F.min(F.struct(back, *rest, "todaydate")).alias("latest"),
        F.min(F.struct("todaydate", *rest)).alias("first_seen"))


def _copy(name: str) -> Column:
    return F.struct(*[F.col(f"{name}.{c}").alias(c) for c in EVENT_COLUMNS if c not in EVENT_KEYS])


def attributed(events: DataFrame, owners: DataFrame, as_of: dt.date, history: bool = True,
               today: bool = True, hot: DataFrame | None = None) -> DataFrame:
    """``event_history`` and ``new_events`` of a day in one pass.

    No event is in both: one first seen on the day has no earlier copy, and its latest
    is not before the day. ``hot`` names vehicles whose rows are to be dealt
    (``hot_keys``). Events with their owners are written to the shared folder once.
    """
    day = F.lit(as_of)
    old = (F.col("latest.todaydate") < day) if history else F.lit(False)
    new = (F.col("first_seen.todaydate") == day) if today else F.lit(False)
    copies = reduced_events(events).select(
        *EVENT_KEYS, F.coalesce(old, F.lit(False)).alias("old"),
        F.when(old, _copy("latest")).when(new, _copy("first_seen")).alias("copy"))
    copies = copies.where(F.col("copy").isNotNull()).select(*EVENT_KEYS, "old", "copy.*")
    # read twice below; Spark would make it twice, as the two uses filter it differently
    both = materialize(lookup_join(copies, ends(owners, payload=OWNER_COLUMNS),
                                   {"vin": "veh_id_nbr"}, hot=hot), "attributed")
    rest = [c for c in EVENT_COLUMNS if c not in ("vin", "todaydate")]
    # a vehicle's earliest old event after the first dealer's record
    opening = both.where("old AND outdate > first.orig_proc_dt").groupBy("vin").agg(
        F.min(F.struct("todaydate", *rest, "first")).alias("__event"))
    rows = lookup_join(both, opening, ["vin"], "left", hot=hot)
    is_opening = F.expr("old AND __event IS NOT NULL AND outdate <=> __event.outdate AND "
                        "daysinservice <=> __event.daysinservice AND outmile <=> __event.outmile")
    repeats = F.expr("old AND __event IS NOT NULL AND todaydate <=> __event.todaydate AND "
                     "(outdate <=> __event.outdate "
                     "OR last.biz_assoc_id <=> __event.first.biz_assoc_id)")
    owner = F.when(is_opening, F.col("first")).when(
        F.expr("outdate > last.orig_proc_dt") & ~repeats, F.col("last"))
    return published(rows.withColumn("__owner", owner).where("__owner IS NOT NULL")
                     .select(*EVENT_COLUMNS, "__owner.*"))


def event_history(events: DataFrame, owners: DataFrame, as_of: dt.date) -> DataFrame:
    """Retired-out events filed before ``as_of`` with the dealer they belong to.

    Copies of an event count once, with their latest file date. A vehicle's
    first event goes to its first dealer. Every other event goes to its last
    dealer, except those on the first event's file date that repeat its dealer
    or its out date. ``owners`` is one row per vehicle and dealer.
    """
    return attributed(events, owners, as_of, today=False)


def new_events(events: DataFrame, owners: DataFrame, as_of: dt.date) -> DataFrame:
    """Events first seen in the file of ``as_of``, with the vehicle's last dealer.

    A copy without a file date counts as seen before.
    """
    seen, day = events.select(*EVENT_COLUMNS), F.lit(as_of)
    # the day's rows first: of the history only the keys of earlier files are read
    today = exclude_keys(
        keep_first(seen.where(F.col("todaydate") == day), EVENT_KEYS, ["todaydate"]),
        seen.where((F.col("todaydate") < day) | F.col("todaydate").isNull()), EVENT_KEYS)
    last = ends(owners, payload=OWNER_COLUMNS).select("veh_id_nbr", "last.*")
    joined = lookup_join(today, last, {"vin": "veh_id_nbr"})
    return published(joined.where("outdate > orig_proc_dt"))


def published(rows: DataFrame) -> DataFrame:
    """Rename to the published columns and add the selling source label."""
    return rows.select(*[F.expr(f"{c} AS {n}") for c, n in PUBLISHED.items()],
                       code_label(F.col("sell_src_cd"), SELLING_SOURCES).alias("sell_src_desc"))
