"""Pick one row per key: earliest (first visit) or latest (upsert, last write).

Both are expressed as a ``min``/``max`` aggregate over a struct whose leading
fields are the ordering columns, followed by every other column as a stable
tie-break. An aggregate, not a ``row_number()`` window: the partial
aggregation runs before the shuffle, so a key that holds a third of all rows
is reduced to one row per map task instead of being sorted in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], latest: bool) -> DataFrame:
    keys, order_by = list(keys), list(order_by)
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    # Rows are compared field by field; trailing fields break ties stably.
    packed = F.struct(*[F.col(c) for c in order_by + rest])
    agg = F.max(packed) if latest else F.min(packed)
    picked = df.groupBy(*keys).agg(agg.alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in order_by + rest]).select(*df.columns)


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The row with the smallest ``order_by`` per key (ties broken by the other columns)."""
    return _pick(df, keys, order_by, latest=False)


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The row with the largest ``order_by`` per key: last write wins."""
    return _pick(df, keys, order_by, latest=True)
