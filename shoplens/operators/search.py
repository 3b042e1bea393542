"""Sale search and shares (Q10) and sales by province (Q11).

The search filters sale_detail by day (the partition column) and by keyword
tokens on the product name, then answers four things from the same filtered
set: the hit count, gender shares, age-band shares and one page of rows.
Shares are computed on the grouped result (a handful of rows), so the
``OVER ()`` total never sees more than one row per group.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.functions import columns as C
from shoplens.operators.metrics import money_sum

# Fixed value: the day the search page asks for when none is given.
DEFAULT_SEARCH_DAY = "2019-03-04"


def filter_sales(sales: DataFrame, day: str | None = None, keyword: str | None = None) -> DataFrame:
    """Rows of ``day`` (default day if empty) whose product name contains every
    whitespace-separated token of ``keyword``, case-insensitive; an empty
    keyword keeps all rows of the day."""
    out = sales.where(F.col("dt") == (day or DEFAULT_SEARCH_DAY))
    for token in (keyword or "").lower().split():
        out = out.where(F.lower(F.col("sku_name")).contains(token))
    return out


def search_total(filtered: DataFrame) -> DataFrame:
    """One row (total): number of hits, for paging."""
    return filtered.agg(F.count(F.lit(1)).alias("total"))


def search_page(filtered: DataFrame, start: int = 0, length: int = 20) -> DataFrame:
    """Rows ``start`` .. ``start + length - 1`` in order_detail_id order.

    Spark plans ORDER BY + OFFSET + LIMIT as a top-(start + length) per
    partition and a merge, so only that many rows per task reach the driver.
    """
    return filtered.orderBy("order_detail_id").offset(int(start)).limit(int(length))


@dataclass
class SortedHits:
    """Hits sorted once into ranges of ``order_detail_id``, with the number of
    rows of each, so that a page far down costs the ranges that hold it: no task
    or driver ever gathers the rows before it."""

    rows: DataFrame
    counts: list[tuple[str, int]]  # range, rows; in order

    def page(self, start: int = 0, length: int = 20) -> DataFrame:
        """Rows ``start`` .. ``start + length - 1``, as :func:`search_page`."""
        before, wanted, first = 0, [], None
        for name, n in self.counts:
            if before < start + length and before + n > start:
                wanted.append(name)
                first = before if first is None else first
            before += n
        hits = self.rows.where(F.col(RANGE).isin(wanted)).drop(RANGE)
        return hits.orderBy("order_detail_id").offset(start - (first or 0)).limit(length)


RANGE = "_range"


def sort_hits(filtered: DataFrame, path: str, ranges: int | None = None) -> SortedHits:
    """Write the hits to ``path`` (a shared folder), one folder a range. Hits of
    one id stay in one range. The driver learns one count a range."""
    by = ([ranges] if ranges else []) + ["order_detail_id"]
    placed = filtered.repartitionByRange(*by).withColumn(RANGE, F.lpad(F.spark_partition_id().cast("string"), 8, "0"))
    placed.write.partitionBy(RANGE).parquet(path)
    schema = T.StructType([*filtered.schema.fields, T.StructField(RANGE, T.StringType())])
    rows = filtered.sparkSession.read.schema(schema).parquet(path)
    counts = rows.groupBy(RANGE).agg(F.count(F.lit(1)).alias("n")).collect()
    return SortedHits(rows, sorted((r[RANGE], r["n"]) for r in counts))


def share_counts(filtered: DataFrame) -> DataFrame:
    """(user_gender, age_band, n): the one grouping that all shares come from."""
    return filtered.groupBy("user_gender", C.age_band("user_age").alias("age_band")).agg(F.count(F.lit(1)).alias("n"))


def shares(filtered: DataFrame) -> DataFrame:
    """(dim, label, n, pct): hits and percent per gender and per age band, in
    one pass over the hits."""
    both = share_counts(filtered).select(
        "n", F.explode(F.array(*[F.struct(F.lit(d).alias("dim"), F.col(c).alias("label")) for d, c in (("gender", "user_gender"), ("age", "age_band"))])).alias("d"))
    counts = both.groupBy("d.dim", "d.label").agg(F.sum("n").alias("n"))
    total = F.sum("n").over(Window.partitionBy("dim"))
    return counts.withColumn("pct", F.round(F.col("n") * F.lit(100.0) / total, 2))


def _one_share(filtered: DataFrame, dim: str, name: str) -> DataFrame:
    return shares(filtered).where(F.col("dim") == dim).select(F.col("label").alias(name), "n", "pct")


def gender_share(filtered: DataFrame) -> DataFrame:
    """(user_gender, n, pct): hits per gender and percent of all hits."""
    return _one_share(filtered, "gender", "user_gender")


def age_share(filtered: DataFrame) -> DataFrame:
    """(age_band, n, pct): hits per age band (<20, 20-29, >=30) and percent."""
    return _one_share(filtered, "age", "age_band")


def search_page_after(filtered: DataFrame, after: str | None = None, length: int = 20) -> DataFrame:
    """The ``length`` rows that follow the row ``after`` (keyset paging): a
    deep page costs what the first one does."""
    rows = filtered if after is None else filtered.where(F.col("order_detail_id") > after)
    return rows.orderBy("order_detail_id").limit(int(length))


def search_answer(filtered: DataFrame, start: int = 0, length: int = 20) -> DataFrame:
    """One row (total, stat, detail): the hit count, the shares and one page,
    all from ``filtered``, which is derived once if the caller checkpoints it.
    ``detail`` and ``stat`` are bounded by the page and by the labels."""
    page = search_page(filtered, start, length)
    order = ["order_detail_id", *[c for c in page.columns if c != "order_detail_id"]]
    detail = page.agg(F.to_json(F.array_sort(F.collect_list(F.struct(*order)))).alias("detail"))
    stat = shares(filtered).agg(F.coalesce(F.sum(F.when(F.col("dim") == "gender", F.col("n"))), F.lit(0)).alias("total"),
                                F.to_json(F.array_sort(F.collect_list(F.struct("dim", "label", "n", "pct")))).alias("stat"))
    # two rows become one
    null = F.lit(None)
    both = stat.withColumn("detail", null.cast("string")).unionByName(detail.select(null.cast("bigint").alias("total"), null.cast("string").alias("stat"), "detail"))
    return both.agg(F.max("total").alias("total"), F.max("stat").alias("stat"), F.max("detail").alias("detail"))


def province_sales(orders: DataFrame, nation: DataFrame | None = None,
                   width: int = 100, top: int = 500) -> DataFrame:
    """(province_id[, province], order_count, order_amount, band) per province.

    ``band`` is the lower edge of the ``width``-wide band of the order count
    (0-100 ... 500-600, last band open). ``nation`` names the provinces; the
    join is left to Spark's size check (broadcast while the dimension is
    under the threshold, which a province list always is).
    """
    agg = orders.groupBy("province_id").agg(
        F.count(F.lit(1)).alias("order_count"),
        money_sum("total_amount").alias("order_amount"))
    out = agg.withColumn("band", C.value_band("order_count", width, top))
    if nation is not None:
        names = nation.select(F.col("n_nationkey").cast("string").alias("province_id"),
                              F.col("n_name").alias("province"))
        out = out.join(names, "province_id", "left")
    return out
