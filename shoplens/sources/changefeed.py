"""Database change rows as DataFrames (the change-log client's output, re-aimed).

An envelope carries one table's change of one kind and the after-image of
each changed row as (name, value) text pairs. ``envelopes`` builds them from
entity rows; a real deployment reads the same struct from a topic
(:mod:`shoplens.sources.topics`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens import schemas

_META = ("seq", "ingest_ts", "_key")


def _row_image(df: DataFrame) -> Column:
    cols = [c for c in df.columns if c not in _META]
    return F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in cols])


def parse_envelopes(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Envelopes sent as JSON text on a topic -> envelope columns."""
    keep = [c for c in lines.columns if c != value_col]
    return lines.select(*keep, F.from_json(F.col(value_col), schemas.CHANGE_ENVELOPE).alias("_e")).select(
        *keep, *[F.col(f"_e.{f}").alias(f) for f in schemas.CHANGE_ENVELOPE.fieldNames() if f not in keep])


# Fixed rule of the fixture change feed: which column an UPDATE changes.
FIXTURE_UPDATES = {
    "order_info": ("order_status", "U"),
    "order_detail": ("sku_num", "0"),
    "user_info": ("user_level", "6"),
}


def table_envelopes(rows: DataFrame, table: str) -> DataFrame:
    """Change feed of one table: every row inserted once; rows whose key ends
    in 3 then updated, rows whose key ends in 7 deleted, and rows whose key
    ends in 0 preceded by a transaction marker entry without row data.
    ``rows`` carry ``_key`` (BIGINT) and ``ingest_ts``; ``seq`` orders the
    changes of one key.

    One pass over ``rows``: each row is exploded into the change kinds that
    apply to it (1 to 3 entries), so the table is derived and scanned once.
    """
    key = F.col("_key")
    col, value = FIXTURE_UPDATES[table]

    def kind(entry: str, event: str, offset: int) -> Column:
        return F.struct(F.lit(entry).alias("entry_type"), F.lit(event).alias("event_type"),
                        F.lit(offset).alias("offset"))

    kinds = F.array(
        F.when(key % 10 == 0, kind("TRANSACTIONBEGIN", "INSERT", -1)),
        kind("ROWDATA", "INSERT", 0),
        F.when(key % 10 == 3, kind("ROWDATA", "UPDATE", 1)),
        F.when(key % 10 == 7, kind("ROWDATA", "DELETE", 2)),
    )
    changes = (rows.select("*", F.explode(kinds).alias("_change"))
               .where(F.col("_change").isNotNull()))
    is_update = F.col("_change.event_type") == "UPDATE"
    changed = changes.withColumns({
        col: F.when(is_update, F.lit(value)).otherwise(F.col(col)),
        "seq": key * F.lit(4) + F.col("_change.offset"),
        "ingest_ts": F.when(F.col("_change.offset") > 0, F.col("ingest_ts") + F.expr("INTERVAL 60 SECONDS"))
        .otherwise(F.col("ingest_ts")),
    })
    image = _row_image(changed.drop("_change"))
    empty = F.array().cast(schemas.CHANGE_ENVELOPE["row_datas"].dataType)
    return changed.select(
        F.col("_change.entry_type").alias("entry_type"),
        F.lit(table).alias("table"),
        F.col("_change.event_type").alias("event_type"),
        F.when(F.col("_change.entry_type") == "ROWDATA", F.array(image)).otherwise(empty).alias("row_datas"),
        F.col("seq").cast("bigint").alias("seq"),
        F.col("ingest_ts").cast("timestamp").alias("ingest_ts"),
    )


def keyed_orders(orders_text: DataFrame) -> DataFrame:
    return orders_text.withColumn("_key", F.col("id").cast("bigint"))


def keyed_details(details_text: DataFrame) -> DataFrame:
    return details_text.withColumn("_key", F.col("order_id").cast("bigint"))


def keyed_users(users_text: DataFrame) -> DataFrame:
    """Users get a fixed arrival time per id (2024-01-01 plus id seconds)."""
    return users_text.withColumns({
        "_key": F.col("id").cast("bigint"),
        "ingest_ts": F.timestamp_seconds(F.lit(1704067200) + F.col("id").cast("bigint")),
    })


def fixture_envelopes(orders_text: DataFrame, details_text: DataFrame, users_text: DataFrame) -> DataFrame:
    """Change feed over the three entity tables (see :func:`table_envelopes`)."""
    return (table_envelopes(keyed_orders(orders_text), "order_info")
            .unionByName(table_envelopes(keyed_details(details_text), "order_detail"))
            .unionByName(table_envelopes(keyed_users(users_text), "user_info")))
