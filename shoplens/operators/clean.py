"""Parsing and cleaning of log lines and change-feed rows (P1-P9)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens import schemas
from shoplens.functions import columns as C


def with_log_time(logs: DataFrame, ts_col: str = "ts") -> DataFrame:
    """Add ``log_date`` (yyyy-MM-dd) and ``log_hour`` (HH) from epoch-ms ``ts``."""
    return logs.withColumns({"log_date": C.log_date(ts_col), "log_hour": C.log_hour(ts_col)})


def _parse(lines: DataFrame, schema, value_col: str) -> DataFrame:
    parsed = F.from_json(F.col(value_col), schema)
    keep = [c for c in lines.columns if c != value_col]
    return lines.select(*keep, parsed.alias("_r")).select(*keep, "_r.*")


def parse_startup(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """JSON startup lines -> startup_log columns plus log_date / log_hour."""
    return with_log_time(_parse(lines, schemas.STARTUP_LOG, value_col))


def parse_event(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """JSON event lines -> event_log columns; numeric ids are read as text."""
    return with_log_time(_parse(lines, schemas.EVENT_LOG, value_col))


def clean_orders(orders_text: DataFrame) -> DataFrame:
    """order_info text rows -> typed order rows.

    total_amount: text -> DOUBLE (NULL if unparsable); create_date and
    create_hour split out of create_time; the phone number is masked. Columns
    other than the 20 order columns (e.g. ``seq``, ``ingest_ts``) are kept;
    order columns that the rows lack stay out.
    """
    extra = [c for c in orders_text.columns if c not in schemas.ORDER_INFO_COLUMNS]
    out = orders_text.withColumns({
        "total_amount": C.safe_double("total_amount"),
        "create_date": C.create_date("create_time"),
        "create_hour": C.create_hour("create_time"),
        "consignee_tel": C.mask_phone("consignee_tel"),
    })
    return out.select(*[c for c in schemas.ORDER_INFO_COLUMNS if c in out.columns], *extra)


def parse_orders(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """JSON order_info lines (numbers possibly quoted) -> typed order rows."""
    return clean_orders(_parse(lines, schemas.ORDER_INFO_TEXT, value_col))


def parse_details(lines: DataFrame, value_col: str = "value") -> DataFrame:
    return _parse(lines, schemas.ORDER_DETAIL, value_col)


def parse_users(lines: DataFrame, value_col: str = "value") -> DataFrame:
    return _parse(lines, schemas.USER_INFO, value_col)
