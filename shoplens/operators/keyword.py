"""Keyword search by an inverted index: words of product names to sales.

The index is two tables written per batch (a replayed batch replaces its own
rows): the sales by month and id bucket, and postings (word, day, sale id, id
bucket) by month and word bucket. A search reads the posting folders of its
words, keeps the sales that hold all of them, and joins these to the sales on
the id bucket, a partition column, so Spark prunes the folders without a hit
before it reads any row.

A posting is one row a word and sale; a word in a third of all names has that
many postings, spread over files of its folder (and split by AQE), and is
counted by sale id, never gathered by word.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.streaming.sinks import AppendTable

ID = "order_detail_id"


def words_of(name: str | Column) -> Column:
    """The distinct lower-case words of a text, cut at white space."""
    text = F.col(name) if isinstance(name, str) else name
    return F.array_distinct(F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != ""))


def _bucket(value: str | Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(buckets)).cast("string")


def months_between(first: str, last: str) -> list[str]:
    """``yyyy-MM`` of every month from one ``yyyy-MM-dd`` day to another."""
    at, end, out = dt.date.fromisoformat(first).replace(day=1), dt.date.fromisoformat(last), []
    while at <= end:
        out.append(at.isoformat()[:7])
        at = (at + dt.timedelta(days=32)).replace(day=1)
    return out


class KeywordIndex:
    """Sales searchable by the words of ``sku_name``."""

    def __init__(self, path: str, buckets: int = 16):
        self.rows = AppendTable(f"{path}/rows", partition_by=["dt_month", "id_bucket"])
        self.postings = AppendTable(f"{path}/postings", partition_by=["dt_month", "word_bucket"])
        self.buckets = buckets

    def write_batch(self, sales: DataFrame, batch_id: int) -> None:
        placed = sales.withColumns({"dt_month": F.substring("dt", 1, 7), "id_bucket": _bucket(F.col(ID), self.buckets)})
        self.rows.write_batch(placed, batch_id)
        spark = sales.sparkSession
        if self.rows.exists(spark):  # the postings come from the rows as written: ``sales`` is computed once
            placed = self.rows.read_batch(spark, batch_id)
        words = placed.select("dt_month", "dt", ID, F.col("id_bucket").alias("in_bucket"), F.explode(words_of("sku_name")).alias("word"))
        self.postings.write_batch(words.withColumn("word_bucket", _bucket(F.col("word"), self.buckets)), batch_id)

    def hits(self, spark: SparkSession, keyword: str, first: str, last: str) -> DataFrame:
        """(in_bucket, id) of the sales of these days that hold all words."""
        words = sorted(set(keyword.lower().split()))
        folders = reduce(lambda a, b: a | b, [F.col("word_bucket") == _bucket(F.lit(w), self.buckets) for w in words])
        found = self.postings.read(spark).where(F.col("dt_month").isin(months_between(first, last)) & folders)
        found = found.where(F.col("word").isin(words) & F.col("dt").between(first, last))
        held = found.groupBy("in_bucket", ID).agg(F.count_distinct("word").alias("n"))
        return held.where(F.col("n") == len(words)).select("in_bucket", F.col(ID).alias("hit"))

    def search(self, spark: SparkSession, keyword: str | None, first: str, last: str | None = None) -> DataFrame:
        """Sales from ``first`` to ``last`` (default: that day) whose name holds
        every word of ``keyword``; no word keeps all."""
        last = last or first
        rows = self.rows.read(spark).where(F.col("dt_month").isin(months_between(first, last)) & F.col("dt").between(first, last))
        if (keyword or "").split():
            hits = self.hits(spark, keyword, first, last)
            rows = rows.join(hits, (F.col("id_bucket") == F.col("in_bucket")) & (F.col(ID) == F.col("hit")), "left_semi")
        return rows.drop("dt_month", "id_bucket")
