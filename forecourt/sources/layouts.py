"""Fixed-width layouts of the objective feeds, by feed type.

Fixed values: start positions count from 1.
"""

from __future__ import annotations

from pyspark.sql.types import DateType, IntegerType, LongType, StringType

from forecourt.sources.fixed_width import Field, FixedWidthLayout

TEXT, INT, LONG, DATE = StringType(), IntegerType(), LongType(), DateType()

LAYOUTS = {layout.name: layout for layout in (
    # business associate
    FixedWidthLayout("BAC", (
        Field("biz_assoc_id", 6, 6, LONG),
        Field("sell_src_cd", 12, 2, INT),
        Field("brand_cd", 14, 3, TEXT),
        Field("rpt_dt", 17, 8, DATE),
        Field("obj_cnt", 25, 7, INT))),
    # region
    FixedWidthLayout("REG", (
        Field("region_cd", 10, 2, TEXT),
        Field("sell_src_cd", 12, 2, INT),
        Field("brand_cd", 14, 3, TEXT),
        Field("rpt_dt", 17, 8, DATE),
        Field("obj_cnt", 25, 7, INT))),
    # zone
    FixedWidthLayout("ZON", (
        Field("region_cd", 10, 2, TEXT),
        Field("sec_cd", 14, 2, TEXT),
        Field("zone_cd", 16, 4, TEXT),
        Field("sell_src_cd", 20, 2, INT),
        Field("brand_cd", 22, 3, TEXT),
        Field("rpt_dt", 25, 8, DATE),
        Field("obj_cnt", 33, 7, INT))),
    # area
    FixedWidthLayout("ARE", (
        Field("region_cd", 10, 2, TEXT),
        Field("sec_cd", 14, 2, TEXT),
        Field("zone_cd", 16, 4, TEXT),
        Field("area_cd", 20, 4, TEXT),
        Field("sell_src_cd", 24, 2, INT),
        Field("brand_cd", 26, 3, TEXT),
        Field("rpt_dt", 29, 8, DATE),
        Field("obj_cnt", 37, 7, INT))),
    # nation
    FixedWidthLayout("NAT", (
        Field("sell_src_cd", 3, 2, INT),
        Field("brand_cd", 5, 3, TEXT),
        Field("rpt_dt", 8, 8, DATE),
        Field("obj_cnt", 16, 7, INT))),
    # section
    FixedWidthLayout("SEC", (
        Field("region_cd", 10, 2, TEXT),
        Field("sec_cd", 14, 2, TEXT),
        Field("sell_src_cd", 16, 2, INT),
        Field("brand_cd", 18, 3, TEXT),
        Field("rpt_dt", 21, 8, DATE),
        Field("obj_cnt", 29, 7, INT))),
    # ten slices whose meaning is not documented: kept as text
    FixedWidthLayout("GMM", (
        Field("col1", 10, 2, TEXT),
        Field("col2", 14, 2, TEXT),
        Field("col3", 16, 4, TEXT),
        Field("col4", 20, 4, TEXT),
        Field("col5", 24, 4, TEXT),
        Field("col6", 28, 4, TEXT),
        Field("col7", 32, 4, TEXT),
        Field("col8", 36, 4, TEXT),
        Field("col9", 40, 4, TEXT),
        Field("col10", 44, 4, TEXT))),
)}
