"""The keyword index against a plain search, and what its plans read."""

import random

import pytest

from conftest import rows
from shoplens.operators.keyword import KeywordIndex, months_between
from test_streaming import _plan, scratch

NAMES = ["red ring", "Red  plate", "ring", "ring RED ring", "tired ring", "", None, " red\tbolt ", "r\u00e9d ring"]


@pytest.fixture(scope="module")
def sales(spark):
    rng = random.Random(4)
    days = ["2024-01-31", "2024-02-01", "2024-02-29", "2024-03-15"]
    return [(f"id{i}", rng.choice(NAMES), rng.choice(days)) for i in range(200)]


@pytest.fixture(scope="module")
def index(spark, sales):
    found = KeywordIndex(scratch(), buckets=4)
    columns = "order_detail_id string, sku_name string, dt string"
    found.write_batch(spark.createDataFrame(sales[:120], columns), 0)
    for _ in range(2):  # a replayed batch
        found.write_batch(spark.createDataFrame(sales[120:], columns), 1)
    return found


@pytest.mark.parametrize("keyword", ["red", "RING red", "ring ring", "tired", "nothing", "red nothing", "", None, "  "])
@pytest.mark.parametrize("first, last", [("2024-02-01", None), ("2024-01-31", "2024-03-14"), ("2024-01-01", "2024-12-31")])
def test_search_equals_a_plain_one(spark, sales, index, keyword, first, last):
    words = set((keyword or "").lower().split())
    want = sorted(i for i, name, day in sales if first <= day <= (last or first) and words <= set((name or "").lower().split()))
    assert [r[0] for r in rows(index.search(spark, keyword, first, last), "order_detail_id")] == want


def test_a_search_reads_its_words_and_months_only(spark, index):
    text = _plan(index.search(spark, "red ring", "2024-02-01"))
    assert "dynamicpruning" in text.lower()
    filters = [line for line in text.splitlines() if line.startswith("PartitionFilters")]
    assert len(filters) >= 2 and all("dt_month" in f for f in filters) and any("word_bucket" in f for f in filters)
    assert "In(word, [red,ring])" in text


def test_months():
    assert months_between("2023-11-30", "2024-02-01") == ["2023-11", "2023-12", "2024-01", "2024-02"]
    assert months_between("2024-02-01", "2024-02-01") == ["2024-02"]


@pytest.mark.parametrize("n", [0, 1, 7, 300])
def test_pages_of_sorted_hits(spark, n):
    from shoplens.operators import search
    ids = [f"{(i * 37) % max(n, 1):05}" for i in range(n)]
    hits = search.sort_hits(spark.createDataFrame([(i, "x") for i in ids], "order_detail_id string, sku_name string"), scratch(), ranges=5)
    assert sum(k for _, k in hits.counts) == n
    for start in (0, 1, n // 2, max(n - 3, 0), n, n + 10):
        assert [r.order_detail_id for r in hits.page(start, 4).collect()] == sorted(ids)[start : start + 4]
    if n == 300:
        text = _plan(hits.page(150, 4))
        assert "PartitionFilters" in text and len([1 for name, _ in hits.counts if f"{name}" in text]) <= 2


def test_a_batch_is_computed_once_for_rows_and_postings(spark):
    from pyspark.sql import functions as F
    computed = spark.sparkContext.accumulator(0)

    def name(i):
        computed.add(1)
        return "red ring" if i % 2 else "bolt"

    batch = spark.range(0, 30, numPartitions=2).select(
        F.format_string("id%02d", "id").alias("order_detail_id"), F.udf(name)("id").alias("sku_name"), F.lit("2024-01-05").alias("dt"))
    made = KeywordIndex(scratch(), buckets=2)
    made.write_batch(batch, 0)
    assert computed.value == 30
    assert [r[0] for r in rows(made.search(spark, "ring", "2024-01-05"), "order_detail_id")] == [f"id{i:02d}" for i in range(1, 30, 2)]
    made.write_batch(batch.limit(0), 1)  # nothing to add
    assert made.search(spark, "bolt", "2024-01-05").count() == 15
