"""Values that published results depend on, stated as they are.

Nothing here is logic: month names, code tables, KPI codes and the fixed
names of the audit columns.
"""

# Month columns of a wide snapshot, in calendar order.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun",
          "jul", "aug", "sep", "oct", "nov", "dec")

# Month labels.
MONTH_LABELS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun",
                "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")

# Selling source code -> label.
SELLING_SOURCES = {11: "Buick", 12: "Cadillac", 13: "Chevrolet", 48: "GMC"}

# KPI types that mark a courtesy-transport delivery.
DELIVERY_KPI_TYPES = (25, 95)

# Brand codes set by model name on dealer-fleet sheets.
MODEL_CODE_OVERRIDES = {
    "Trax": "TXX",
    "Chevy Van Cutaway": "EXV",
    "Savana Cutaway": "SAP",
}

# KPI code of each stacked objective set, (sheet, kind) -> code.
OBJECTIVE_KPI_CODES = {
    ("small_business", "adjusted"): 711,
    ("dealer_fleet", "adjusted"): 714,
    ("dealer_fleet", "unadjusted"): 715,
    ("small_business", "unadjusted"): 716,
}

# Audit columns, in published order.
AUDIT_COLUMNS = (
    "src_sys_id",
    "src_sys_uniq_prim_key_val",
    "src_sys_uniq_prim_key_col_val",
    "meas_cnt",
    "dw_anom_flg",
    "dw_mod_ts",
    "dw_job_id",
    "src_sys_iud_cd",
)

# Fixed value: day zero of spreadsheet serial dates.
SPREADSHEET_DAY_ZERO = "1899-12-30"
