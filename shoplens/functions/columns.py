"""Scalar column helpers (projections P6-P26 of the blueprint)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shoplens import schemas

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- time -----------------------------------------------------------------

def log_date(ts_ms: ColumnOrName) -> Column:
    """Epoch milliseconds -> ``yyyy-MM-dd`` in the session time zone."""
    return F.date_format(F.timestamp_millis(_col(ts_ms)), "yyyy-MM-dd")


def log_hour(ts_ms: ColumnOrName) -> Column:
    """Epoch milliseconds -> two-digit hour ``HH``."""
    return F.date_format(F.timestamp_millis(_col(ts_ms)), "HH")


def create_date(create_time: ColumnOrName) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text -> part before the first space."""
    return F.try_element_at(F.split(_col(create_time), " "), F.lit(1))


def create_hour(create_time: ColumnOrName) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text -> the time's part before the first colon,
    a single digit padded to two."""
    time_part = F.try_element_at(F.split(_col(create_time), " "), F.lit(2))
    hour = F.try_element_at(F.split(time_part, ":"), F.lit(1))
    return F.when(F.length(hour) == 1, F.lpad(hour, 2, "0")).otherwise(hour)


def epoch_minute(ts_ms: ColumnOrName) -> Column:
    """Whole minutes since the epoch of a millisecond time."""
    return F.floor(_col(ts_ms) / F.lit(60000)).cast("bigint")


# --- text -----------------------------------------------------------------

def mask_phone(tel: ColumnOrName) -> Column:
    """Keep the first four characters of a phone number, mask the rest."""
    return F.concat(F.substring(_col(tel), 1, 4), F.lit("*******"))


def safe_double(text: ColumnOrName) -> Column:
    """Text -> DOUBLE; NULL for unparsable input, NaN and infinities."""
    value = _col(text).try_cast("double")
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def route_log(value: ColumnOrName, by_type: bool = False, type_col: ColumnOrName = "type") -> Column:
    """Topic of a raw log line.

    Default: any line whose text contains ``startup`` goes to the startup topic
    (a plain substring test, as the ingest service does). ``by_type=True``
    routes on the parsed ``type`` field instead, which cannot misroute an event
    whose text happens to contain the word.
    """
    is_startup = (_col(type_col) == F.lit("startup")) if by_type else _col(value).contains("startup")
    return F.when(is_startup, F.lit(schemas.STARTUP_TOPIC)).otherwise(F.lit(schemas.EVENT_TOPIC))


def route_change(table: ColumnOrName, event_type: ColumnOrName) -> Column:
    """Topic for a change row, NULL when the row is not forwarded.

    order_info and order_detail: inserts only; user_info: inserts and updates.
    """
    t, e = _col(table), _col(event_type)
    return (
        F.when((t == "order_info") & (e == "INSERT"), F.lit(schemas.ORDER_INFO_TOPIC))
        .when((t == "order_detail") & (e == "INSERT"), F.lit(schemas.ORDER_DETAIL_TOPIC))
        .when((t == "user_info") & e.isin("INSERT", "UPDATE"), F.lit(schemas.USER_INFO_TOPIC))
    )


def alert_doc_id(mid: ColumnOrName, ts_ms: ColumnOrName) -> Column:
    """Alert document key: device id immediately followed by the minute number."""
    return F.concat(_col(mid), epoch_minute(ts_ms).cast("string"))


# --- numbers and bands ----------------------------------------------------

def age_years(birthday: ColumnOrName, as_of: ColumnOrName) -> Column:
    """Whole 365-day years between a ``yyyy-MM-dd`` birthday and ``as_of``.

    Not a calendar age: days are divided by 365 and truncated toward zero, so a
    future birthday of less than a year gives 0. NULL for unparsable dates.
    """
    days = F.datediff(F.to_date(_col(as_of)), F.try_to_date(_col(birthday), "yyyy-MM-dd"))
    return (days / F.lit(365)).cast("int")


# Age band labels and edges (<20, 20-29, >=30).
AGE_BAND_YOUNG = "under 20"
AGE_BAND_MIDDLE = "20 to 29"
AGE_BAND_OLD = "30 and over"
AGE_BAND_UNKNOWN = "unknown"


def age_band(age: ColumnOrName) -> Column:
    a = _col(age)
    return (
        F.when(a < 20, F.lit(AGE_BAND_YOUNG))
        .when(a < 30, F.lit(AGE_BAND_MIDDLE))
        .when(a >= 30, F.lit(AGE_BAND_OLD))
        .otherwise(F.lit(AGE_BAND_UNKNOWN))
    )


def value_band(value: ColumnOrName, width: int = 100, top: int = 500) -> Column:
    """Lower edge of the ``width``-wide band holding ``value``; the last band
    (starting at ``top``) is open-ended, negative values fall in band 0."""
    lower = (F.floor(_col(value) / F.lit(width)) * F.lit(width)).cast("bigint")
    return F.least(F.greatest(lower, F.lit(0).cast("bigint")), F.lit(top).cast("bigint"))


def pct_change(today: ColumnOrName, yesterday: ColumnOrName) -> Column:
    """Percent change over the previous value; NULL when that is 0 or NULL."""
    y = _col(yesterday).cast("double")
    return F.when(y != 0, (_col(today).cast("double") - y) / y * F.lit(100.0))
