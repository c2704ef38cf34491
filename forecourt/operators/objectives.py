"""Objective sheets to one stacked table with a KPI code per set."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.fixed_values import MODEL_CODE_OVERRIDES, OBJECTIVE_KPI_CODES
from forecourt.operators.enrich import apply_overrides

KINDS = {"adjusted": "objective", "unadjusted": "unadjusted_objective"}


def objective_sheets(sheets: Mapping[str, DataFrame], process_date: dt.date,
                     kpi_codes: Mapping[tuple[str, str], int] = OBJECTIVE_KPI_CODES,
                     overrides: Mapping[str, str] = MODEL_CODE_OVERRIDES,
                     override_sheets: tuple[str, ...] = ("dealer_fleet",)) -> DataFrame:
    """Stack sheets x {adjusted, unadjusted} objectives.

    Every sheet needs ``bac``, ``model``, ``isas``, ``objective`` and
    ``unadjusted_objective`` and the same other columns. Each row gives one row
    per kind, so a sheet is read once. Rows without a dealer code go.
    """
    def stack(name: str, sheet: DataFrame) -> DataFrame:
        if name in override_sheets:
            sheet = apply_overrides(sheet, "model", "isas", overrides)
        sets = F.array(*[
            F.struct(F.lit(kpi_codes[name, kind]).alias("kpi_type_code"),
                     F.col(column).alias("__objective"))
            for kind, column in KINDS.items()])
        rest = [c for c in sheet.columns if c not in KINDS.values()]
        return (sheet.select(*rest, F.inline(sets))
                .withColumnRenamed("__objective", "objective"))

    stacked = reduce(DataFrame.unionByName, [stack(n, s) for n, s in sheets.items()])
    return (stacked.dropna(subset=["bac"])
            .withColumn("process_date", F.lit(process_date)))


def hierarchy_reconcile(levels: Mapping[str, DataFrame], keys: Sequence[str], value: str
                        ) -> DataFrame:
    """Where the sum of a level differs from that of the next one below.

    ``levels`` holds the feeds from the top down. A key that a level lacks counts 0
    there. All levels are summed in one aggregation that combines on the map side.
    """
    names = list(levels)
    amount = [f"__{i}" for i in range(len(names))]
    stacked = reduce(DataFrame.unionByName, [
        levels[n].select(*keys, *[(F.col(value) if a == amount[i] else F.lit(0)).cast("long")
                                  .alias(a) for a in amount]) for i, n in enumerate(names)])
    sums = stacked.groupBy(*keys).agg(*[F.sum(a).alias(a) for a in amount])
    pairs = F.array(*[
        F.struct(F.lit(names[i]).alias("upper_level"), F.lit(names[i + 1]).alias("lower_level"),
                 F.col(amount[i]).alias("upper_cnt"), F.col(amount[i + 1]).alias("lower_cnt"))
        for i in range(len(names) - 1)])
    return sums.select(*keys, F.inline(pairs)).where("upper_cnt <> lower_cnt")
