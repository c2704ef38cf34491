"""Audit columns and the final shape of published rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def with_audit(df: DataFrame, keys: Sequence[str], source_id: str, job_id: str,
               mod_ts: Column, iud_code: str = "I", anomaly: str = "N") -> DataFrame:
    """Add the eight audit columns.

    The key value is the key columns and the source id joined by ``|``; it is
    null when one of them is null. The key column names are joined the same way.
    """
    values = [F.col(k).cast("string") for k in keys] + [F.lit(source_id)]
    parts = [p for v in values for p in (F.lit("|"), v)][1:]
    return df.withColumns({
        "src_sys_id": F.lit(source_id),
        "src_sys_uniq_prim_key_val": F.concat(*parts),
        "src_sys_uniq_prim_key_col_val": F.lit("|".join([*keys, "src_sys_id"])),
        "meas_cnt": F.lit(1),
        "dw_anom_flg": F.lit(anomaly),
        "dw_mod_ts": mod_ts,
        "dw_job_id": F.lit(job_id),
        "src_sys_iud_cd": F.lit(iud_code),
    })


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select the target columns in order with their types.

    Names match without regard to case. A missing column is an error, not a
    column of nulls; columns outside the target are dropped.
    """
    have = {c.lower(): c for c in df.columns}
    missing = [f.name for f in schema.fields if f.name.lower() not in have]
    if missing:
        raise ValueError(f"columns missing for target schema: {', '.join(missing)}")
    return df.select(*[F.col(f"`{have[f.name.lower()]}`").cast(f.dataType).alias(f.name)
                       for f in schema.fields])


def conform_positional(df: DataFrame, schema: StructType) -> DataFrame:
    """The same by position: column n takes name and type of target field n."""
    if len(df.columns) != len(schema.fields):
        raise ValueError(f"{len(df.columns)} columns for {len(schema.fields)} target fields")
    return conform(df.toDF(*schema.fieldNames()), schema)
