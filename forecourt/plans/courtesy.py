"""Courtesy-transport fact: retired-out vehicles with the dealer they belong to."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame

from forecourt.operators.attribution import attributed, delivered, first_per_pair
from forecourt.operators.audit import conform, with_audit
from forecourt.operators.calendar import calendar_gate
from forecourt.plans.fleet import SOURCE_ID
from forecourt.plans.targets import COURTESY_FACT


def courtesy_fact(events: DataFrame, deliveries: DataFrame, calendar: DataFrame, as_of: dt.date,
                  since: dt.date, job_id: str, mod_ts: Column, source_id: str = SOURCE_ID,
                  country: str = "US") -> DataFrame:
    """History and the newest file from one pass, audited and in target shape.

    Nothing is published unless the day before ``as_of`` is a selling day.
    """
    sold = delivered(deliveries, since, as_of - dt.timedelta(days=1), country)
    owners = first_per_pair(calendar_gate(sold, calendar, as_of, country))
    rows = attributed(events, owners, as_of)
    audited = with_audit(rows, ["veh_id_nbr", "file_dt", "out_svc_dt"], source_id, job_id, mod_ts)
    return conform(audited, COURTESY_FACT)
