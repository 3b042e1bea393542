"""Topic sources and sinks.

Production reads the message topics with Spark's Kafka source; the
``spark-sql-kafka`` connector jar is not bundled with PySpark, so in tests a
folder of text files stands in for a topic: one JSON line per message, the
same ``value`` column, the same downstream transforms.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F


def read_topic(spark: SparkSession, bootstrap_servers: str, topics: str | list[str],
               starting_offsets: str = "latest", max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Kafka topics as a stream of (topic, key, value, seq, ingest_ts) rows.

    ``seq`` is the broker offset: it orders the messages of one key when the
    producer keys messages by entity id (one partition per key), which the
    upsert tables use to pick the latest version; ``ingest_ts`` is the record
    timestamp (arrival time for watermarks and the interval join).
    Starts at the latest offsets like the reference; offsets are tracked in
    the query checkpoint instead of a shared consumer group, so two jobs on
    one topic each see every message. A message that carries the change's own
    number (header ``seq``, see :func:`write_topic`) keeps it instead of the
    offset, so a message that was sent twice can be told (:func:`unique_messages`).
    Needs the Kafka connector on the classpath (not available in this
    environment, not run here).
    """
    names = topics if isinstance(topics, str) else ",".join(topics)
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap_servers)
              .option("subscribe", names)
              .option("startingOffsets", starting_offsets)
              .option("includeHeaders", "true"))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    own = F.try_element_at(F.filter("headers", lambda h: h["key"] == "seq"), F.lit(1))["value"].cast("string").try_cast("bigint")
    return reader.load().select(
        "topic", F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
        F.coalesce(own, "offset").alias("seq"), F.col("timestamp").alias("ingest_ts"))


def unique_messages(messages: DataFrame, within: str = "1 hour") -> DataFrame:
    """Messages once each, though a producer that was restarted sent some again:
    the first of each (key, seq), remembered until ``within`` after its arrival.
    Messages without a number cannot be told apart and all stay."""
    seen = messages.withWatermark("ingest_ts", within)
    numbered = seen.where(F.col("seq").isNotNull()).dropDuplicatesWithinWatermark(["key", "seq"])
    return numbered.unionByName(seen.where(F.col("seq").isNull()))


def write_topic(df: DataFrame, bootstrap_servers: str, checkpoint: str, topic_col: str = "topic",
                key_col: str | None = "key"):
    """Stream rows to the topic named in each row's ``topic`` column; the
    message key is ``key_col`` (the entity id), so all versions of one entity
    land in one partition, in order. None sends unkeyed. ``seq``, where the rows
    have it, goes along as a header: Kafka's sink may send a row twice after a
    failure, and readers tell by it."""
    cols = [F.col(topic_col).alias("topic"), F.col("value").cast("string").alias("value")]
    if key_col:
        cols.append(F.col(key_col).cast("string").alias("key"))
    if "seq" in df.columns:
        cols.append(F.array(F.struct(F.lit("seq").alias("key"), F.col("seq").cast("string").cast("binary").alias("value"))).alias("headers"))
    return (df.select(*cols)
            .writeStream.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap_servers)
            .option("includeHeaders", "true")
            .option("checkpointLocation", checkpoint)
            .start())


# Message layout of a file-backed topic: the JSON text plus the broker's
# record metadata that the Kafka source would supply.
TOPIC_FILE_SCHEMA = "value STRING, seq BIGINT, ingest_ts TIMESTAMP"


KEYED_FILE_SCHEMA = "key STRING, " + TOPIC_FILE_SCHEMA


def read_keyed_files(spark: SparkSession, path: str) -> DataFrame:
    """One topic's folder of keyed messages, as the change job writes them."""
    return spark.readStream.schema(KEYED_FILE_SCHEMA).parquet(path).select("key", "value", "seq", "ingest_ts")


def read_topic_files(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                     fmt: str = "parquet") -> DataFrame:
    """A folder of message files as a topic stream.

    ``fmt="parquet"``: files with (value, seq, ingest_ts), as written by
    :func:`stage_topic`; ``fmt="text"``: plain JSON lines, ``value`` only.
    """
    reader = spark.readStream.format(fmt)
    if fmt != "text":
        reader = reader.schema(TOPIC_FILE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def topic_messages(messages: DataFrame, *more: str) -> DataFrame:
    """Messages (value[, seq, ingest_ts]) in the layout of a file-backed topic,
    beside the columns ``more``."""
    out = messages
    for c, typ in (("seq", "bigint"), ("ingest_ts", "timestamp")):
        if c not in out.columns:
            out = out.withColumn(c, F.lit(None).cast(typ))
    return out.select("value", "seq", "ingest_ts", *more)


#: Bytes of a topic file that one task reads: a file of many messages is shared out.
ROW_GROUP = 8 * 1024 * 1024


def topic_writer(messages: DataFrame) -> DataFrameWriter:
    """A writer of message files: much like text repeats in them."""
    return messages.write.option("compression", "zstd").option("parquet.block.size", str(ROW_GROUP))


def append_topic_files(messages: DataFrame, path: str) -> None:
    """Append messages (value[, seq, ingest_ts]) to a file-backed topic."""
    topic_writer(topic_messages(messages)).mode("append").parquet(path)


def write_topic_files(df: DataFrame, path: str, topic_col: str = "topic") -> None:
    """Batch form of the topic sink: one sub-folder per topic."""
    df.select(topic_col, "value").write.mode("append").partitionBy(topic_col).text(path)
