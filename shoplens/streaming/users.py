"""Users as of the sale: user versions kept in the state store, by user.

Sales and user changes share one keyed stream. A key's state holds the versions
that a sale may still need, so a micro-batch costs its own rows, whatever the
number of users; no user table is read. Needs Spark's RocksDB state store: start
the query inside :func:`rocksdb`.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from shoplens import schemas
from shoplens.functions import columns as C
from shoplens.session import setting

VERSIONS = "found array<struct<seq: bigint, at: bigint, gender: string, level: string, birthday: string>>"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
ROCKSDB_CONF = "spark.sql.streaming.stateStore.rocksdb"


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB; a query takes the
    setting along when it starts, so the session's own is put back after. Files
    are not given room ahead: some megabytes for every partition of every store
    and run, however few rows it holds."""
    with setting(spark, "spark.sql.streaming.stateStore.providerClass", ROCKSDB), setting(spark, f"{ROCKSDB_CONF}.allowFAllocate", "false"):
        yield


class UserVersions(StatefulProcessor):
    """Per user: its versions by arrival; each sale leaves with the last one
    that had arrived by the sale's time. Versions that were replaced more than
    ``keep_seconds`` before the newest row of the user are dropped."""

    def __init__(self, columns: list[str], keep_seconds: int):
        self.columns, self.keep_seconds = columns, keep_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.versions = handle.getValueState("versions", VERSIONS)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known = [tuple(v) for v in self.versions.get()[0]] if self.versions.exists() else []
        sales, newest = [], None  # times are microseconds
        for r in rows:
            newest = max(x for x in (newest, r["at"], -(2**62)) if x is not None)
            if r["is_user"]:
                known.append((r["seq"], r["at"], r["gender"], r["level"], r["birthday"]))
            else:
                sales.append(r)
        known = sorted({(v[1], v[0]): v for v in known if v[1] is not None}.values(), key=lambda v: (v[1], v[0] if v[0] is not None else -1))
        for s in sales:
            then = next((v for v in reversed(known) if s["at"] is not None and v[1] <= s["at"]), (None,) * 5)
            yield Row(**{c: s[c] for c in self.columns}, gender=then[2], level=then[3], birthday=then[4])
        if newest is not None:
            bound = newest - self.keep_seconds * 1_000_000
            last_old = max((i for i, v in enumerate(known) if v[1] <= bound), default=0)
            known = known[last_old:]
        self.versions.update((known,))

    def close(self) -> None:
        pass


def enrich_stream(sales: DataFrame, changes: DataFrame, as_of: str, keep_seconds: int = 86_400) -> DataFrame:
    """Stream form of ``sale_detail.enrich_users_as_of``: ``sales`` with
    ``sale_ts``, ``changes`` of users with ``seq`` and ``ingest_ts``. Sales
    without a user id need no state and pass by."""
    columns = [c for c in sales.columns if c != "sale_ts"]
    found = T.StructType([*[sales.schema[c] for c in columns], *[T.StructField(c, T.StringType()) for c in ("gender", "level", "birthday")]])
    none = lambda c: F.lit(None).cast(c)
    s = sales.where(F.col("user_id").isNotNull()).select(
        F.col("user_id").alias("key"), F.lit(False).alias("is_user"), none("bigint").alias("seq"), F.unix_micros("sale_ts").alias("at"),
        *[none("string").alias(c) for c in ("gender", "level", "birthday")], *columns)
    u = changes.where(F.col("id").isNotNull()).select(
        F.col("id").alias("key"), F.lit(True).alias("is_user"), "seq", F.unix_micros("ingest_ts").alias("at"), "gender", F.col("user_level").alias("level"),
        "birthday", *[F.lit(None).cast(sales.schema[c].dataType).alias(c) for c in columns])
    with_user = s.unionByName(u).groupBy("key").transformWithState(UserVersions(columns, keep_seconds), found, "Append", "None")
    nobody = sales.where(F.col("user_id").isNull()).select(*columns, *[none("string").alias(c) for c in ("gender", "level", "birthday")])
    rows = with_user.unionByName(nobody)
    age = F.coalesce(C.age_years(F.col("birthday"), F.lit(as_of)), F.lit(0))
    return rows.select(*columns, F.col("gender").alias("user_gender"), F.col("level").alias("user_level"), age.alias("user_age")).select(*schemas.SALE_DETAIL_COLUMNS)
