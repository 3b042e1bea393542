"""Column expressions shared by the operators. All are built-in Spark
functions, so they stay inside whole-stage codegen and work unchanged on
batch and streaming DataFrames."""

from shoplens.functions.columns import (  # noqa: F401
    age_band,
    age_years,
    alert_doc_id,
    create_date,
    create_hour,
    epoch_minute,
    log_date,
    log_hour,
    mask_phone,
    pct_change,
    route_change,
    route_log,
    safe_double,
    value_band,
)
