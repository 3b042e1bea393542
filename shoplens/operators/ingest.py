"""Ingest and routing: log lines and change rows to per-topic JSON (Q8, Q9).

Routing is a column, not a fork: one pass computes ``topic`` and the sink
either writes with a ``topic`` column (topic sink) or partitions by it
(file sink). No per-topic re-scan of the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens import schemas
from shoplens.functions import columns as C


def now_ms() -> Column:
    """Ingest time of a live service: the query's current time in epoch ms."""
    return F.unix_millis(F.current_timestamp())


def computed_once(rows: DataFrame, **columns: Column) -> DataFrame:
    """``rows`` with costly columns, each computed once a row. As plain columns
    Spark would move a filter on them below the projection and write their
    expressions out again at every use; it does not look into a generator."""
    return rows.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def stamp_log(lines: DataFrame, stamp_ms: Column | str, value_col: str = "value") -> DataFrame:
    """Put ``ts`` = ingest time into each JSON log line, replacing a client ``ts``.

    ``stamp_ms`` is the ingest time in epoch ms (:func:`now_ms` in a live
    service, a fixed column in replays and tests). The text of every other field
    stays as sent: ``ts`` is cut out of the text and appended. Only where the
    text names several ``ts`` (or one that is no scalar) is the line rebuilt from
    its parsed fields: same fields and values, numbers in their shortest form. A
    line that is no JSON object keeps its text and gets ``well_formed`` false.
    """
    stamp = F.col(stamp_ms) if isinstance(stamp_ms, str) else stamp_ms
    parsed = computed_once(lines, _fields=F.from_json(F.col(value_col), "map<string,variant>"))
    fields = F.col("_fields")
    rest = F.map_filter(fields, lambda k, v: k != F.lit("ts"))
    more = F.when(F.size(rest) > 0, F.lit(",")).otherwise(F.lit(""))
    tail = F.concat(more, F.lit('"ts":'), stamp.cast("string"), F.lit("}"))
    scalar = r'"ts"\s*:\s*(-?[0-9][0-9.eE+-]*|"[^"\\]*"|true|false|null)\s*(,|(?=\}))'
    cut = F.regexp_replace(F.col(value_col), scalar, "")
    as_sent = F.concat(F.regexp_replace(F.when(F.map_contains_key(fields, F.lit("ts")), cut).otherwise(F.col(value_col)), r"[\s,]*\}\s*$", ""), tail)
    body = F.to_json(rest)
    rebuilt = F.concat(F.substring(body, F.lit(1), F.length(body) - 1), tail)
    # the text can be cut if it names ts once, as a scalar, and is no other field's text
    named = F.regexp_count(F.col(value_col), F.lit(r'"ts"|\\u0*7[34]'))
    simple = ~F.map_contains_key(fields, F.lit("ts")) | ((named == 1) & (F.regexp_count(F.col(value_col), F.lit(scalar)) == 1))
    stamped = F.when(simple, as_sent).otherwise(rebuilt)
    stamped = F.when(fields.isNotNull(), stamped)
    out = computed_once(parsed.withColumn("_ts", stamp.cast("bigint")), _value=F.coalesce(stamped, F.col(value_col)))
    own = {value_col: F.col("_value"), "ts": F.col("_ts")}
    names = [*lines.columns, *[c for c in ("ts",) if c not in lines.columns]]
    return out.select(*[own.get(c, F.col(c)).alias(c) for c in names if c != "well_formed"], fields.isNotNull().alias("well_formed"))


def route_logs(stamped: DataFrame, value_col: str = "value", by_type: bool = False) -> DataFrame:
    """Replace ``well_formed`` by ``topic``: the rejected topic for malformed
    lines, the startup topic when the text contains ``startup`` (or, with
    ``by_type``, when the parsed ``type`` is ``startup``), else the event topic."""
    if by_type:
        typ = F.get_json_object(F.col(value_col), "$.type")
        topic = C.route_log(value_col, by_type=True, type_col=typ)
    else:
        topic = C.route_log(value_col)
    return stamped.withColumn("topic", F.when(F.col("well_formed"), topic).otherwise(F.lit(schemas.REJECTED_TOPIC))).drop("well_formed")


def may_start(value_col: str = "value") -> Column:
    """True for every line that can reach the startup topic once it is stamped:
    stamping writes no new text but for escapes, which it may resolve. Before
    :func:`stamp_log` it spares all other lines the parsing."""
    return F.col(value_col).contains("startup") | F.col(value_col).contains("\\")


def archive_logs(stamped: DataFrame, path: str, ts_col: str = "ts", batch: str = "0") -> None:
    """Archive stamped lines as text, one folder per day (the rolled log file)
    and ``batch``. A rerun of a batch replaces what it wrote before, so each
    delivery needs a name of its own, such as its time."""
    rows = stamped.where("well_formed").select(F.col("value"), C.log_date(ts_col).alias("log_date"), F.lit(batch).alias("batch"))
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("log_date", "batch").text(path))


def route_changes(envelopes: DataFrame) -> DataFrame:
    """Change envelopes -> (topic, key, value, seq, ingest_ts), one row per
    changed row; the key is the row's id, so all versions of an entity reach
    one partition of a topic in order, and ``seq`` is the change's own number.

    Keeps row-data entries only, forwards order_info/order_detail inserts and
    user_info inserts and updates, and turns each after-image into a flat JSON
    object of text values (NULL values stay JSON null).
    """
    rows = (envelopes.where(F.col("entry_type") == "ROWDATA")
            .withColumn("topic", C.route_change("table", "event_type"))
            .where(F.col("topic").isNotNull()))
    return rows.select(
        "topic",
        F.explode("row_datas").alias("_row"),
        "seq", "ingest_ts",
    ).select("topic", F.get(F.filter("_row", lambda f: f["name"] == "id"), 0)["value"].alias("key"), F.to_json(F.map_from_entries("_row"), {"ignoreNullFields": "false"}).alias("value"),
             "seq", "ingest_ts")
