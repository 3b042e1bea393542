"""Helpers shared by the text operators: tables, staged tables, word runs.

Nothing outside this subpackage imports it. Intermediate tables go to the
shared folder named by ``spark.checkpoint.dir`` (see ``session.work_path``),
so any executor can read them and a lost executor only costs recomputation.
"""

from __future__ import annotations

import os
import re
import shutil
import tempfile
from collections.abc import Callable, Iterator
from itertools import chain
from weakref import WeakKeyDictionary

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from shoplens.session import ensure_checkpoint_dir, setting, work_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
CHUNK_CHARS = 1_000_000
_SHIPPED: set[str] = set()
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: The folders of staged tables.
_FOLDERS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def prepare(spark: SparkSession) -> None:
    """Make the package importable on the executors (as ``--py-files`` does)."""
    ensure_checkpoint_dir(spark)
    if spark.conf.get(BATCH) == "10000":  # Spark's default; an owner's choice stays
        spark.conf.set(BATCH, "2000")  # whole texts: keep a batch to a few MB
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    folder = tempfile.mkdtemp(prefix="shoplens-llm-")
    sc.addPyFile(shutil.make_archive(os.path.join(folder, "shoplens_llm"), "zip", root_dir=root, base_dir="shoplens"))
    _SHIPPED.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage.
    Its shuffle files go when it is written; they would else lie on the executors'
    disks until the driver's garbage is collected."""
    path = work_path(df.sparkSession, "llm", name)
    with setting(df.sparkSession, FREE_SHUFFLES, "true"):
        df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _FOLDERS[out] = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more; others stay."""
    for t in tables:
        folder = _FOLDERS.pop(t, None)
        if folder is not None:
            jvm = t.sparkSession._jvm
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def set_aside(df: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df`` with its columns that begin with an underscore, as the operators'
    own do, under other names; and a function that gives the names back and
    drops what was added."""
    used, moved = {c.lower() for c in df.columns}, {}
    for c in df.columns:
        if c.startswith("_"):
            new = f"in{c}"
            while new.lower() in used:
                new = f"in_{new}"
            used.add(new.lower())
            moved[c] = new
    return df.withColumnsRenamed(moved), lambda d: d.select(*[F.col(f"`{moved.get(c, c)}`").alias(c) for c in df.columns])


def whole_text(col: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(col), F.lit(""))


def row_key(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Column:
    """A total order for rows with the same id: id, then the text's hash."""
    return F.struct(F.col(id_col), F.xxhash64(F.col(text_col)))


def chunks(texts: list[str], limit: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Slices of consecutive texts of at most ``limit`` characters (a longer
    text is a slice of its own)."""
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > limit:
            yield start, i
            start, size = i, 0
        size += len(t)
    if texts:
        yield start, len(texts)


def word_runs(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words of all texts: codes into the distinct words, the distinct
    words, and the number of words of each text."""
    lists = [WORD.findall(t) for t in texts]
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    flat = np.empty(int(counts.sum()), object)
    flat[:] = list(chain.from_iterable(lists))
    codes, words = pd.factorize(flat)
    return codes, words, counts


def starts_of(counts: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(counts)[:-1])).astype(np.int64) if len(counts) else np.zeros(0, np.int64)


def spread(df: DataFrame) -> DataFrame:
    """Even rows out before expensive per-row work; AQE may split or merge."""
    return df.hint("rebalance")


def map_rows(df: DataFrame, keep: list[str], added: str, run) -> DataFrame:
    """The ``keep`` columns untouched and new ones (DDL ``added``):
    ``run(batch)`` gets an Arrow record batch of ``df`` and returns a dict of
    lists or arrays for the new names. A new name replaces a kept one."""
    new = T.StructType.fromDDL(added)
    names = [f.name for f in new]
    schema = T.StructType([f for f in df.schema if f.name in keep and f.name not in names] + list(new))
    kept = [f.name for f in schema if f.name not in names]
    arrow = to_arrow_schema(schema)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = run(b)
            arrays = [b.column(b.schema.get_field_index(n)) for n in kept] + [pa.array(got[n], type=arrow.field(n).type) for n in names]
            yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in schema])

    return df.mapInArrow(each, schema)


def texts_of(batch: pa.RecordBatch, col: str = "text") -> list[str]:
    """The batch's texts; null counts as empty."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(col)).to_pylist()]
