"""Replay a table through a streaming job in arrival order.

The messages are cut into ``n_chunks`` consecutive ranges of their arrival
time. Each range is appended to the file-backed topic and the job is run
with ``availableNow`` against the same checkpoint, as if the range had
arrived while the job was live: state, watermarks and sinks carry over
between runs exactly as across micro-batches of a long-running job, and each
run is also a restart from the checkpoint. The messages are derived once, into
a folder beside the topic, from which the ranges are read; it goes at the end.

A job with state would keep a whole range in it. With ``at_once`` a range of more
messages is cut at quantiles of their arrival, and each part is one file of every
topic (an empty one where a topic has no message), in the order of the files' times:
read with ``max_files_per_trigger=1`` a micro-batch gets one part of each topic, and
the watermark clears the state between them.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shoplens.session import setting
from shoplens.sources.topics import append_topic_files, topic_messages, topic_writer

#: Messages of a micro-batch that a job with state gets at once.
AT_ONCE = 2_000_000
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Seconds after which a running job's finished shuffles are looked for.
FREE_EVERY = 20


def time_chunks(time_col: Column, lo: float, hi: float, n_chunks: int) -> list[Column]:
    """``n_chunks`` predicates covering [lo, hi] in consecutive ranges."""
    step = (hi - lo) / n_chunks if hi > lo else 1.0
    preds = []
    for i in range(n_chunks):
        start = lo + i * step
        p = time_col >= F.lit(start) if i > 0 else F.lit(True)
        if i < n_chunks - 1:
            p = p & (time_col < F.lit(lo + (i + 1) * step))
        preds.append(p)
    return preds


class _Files:
    """Files of the shared folder, in any file system that Spark can write."""

    def __init__(self, spark: SparkSession, folder: str):
        self.conf, self.hadoop = spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop.fs
        self.fs = self.path(folder).getFileSystem(self.conf)

    def path(self, name: str):
        return self.hadoop.Path(name)

    def parquet(self, folder: str) -> list[str]:
        if not self.fs.exists(self.path(folder)):
            return []
        found = [f.getPath().toString() for f in self.fs.listStatus(self.path(folder))]
        return [f for f in found if f.endswith(".parquet")]

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)

    def place(self, old: str, new: str, at_ms: int, copy: bool) -> None:
        """``old`` under the name ``new`` with the time ``at_ms``."""
        if copy:
            done = self.hadoop.FileUtil.copy(self.fs, self.path(old), self.fs, self.path(new), False, self.conf)
        else:
            done = self.fs.rename(self.path(old), self.path(new))
        if not done:
            raise RuntimeError(f"{old} could not be placed at {new}")
        self.fs.setTimes(self.path(new), at_ms, -1)


def _cuts(times: DataFrame, at_once: int) -> list[float]:
    """Arrivals (column ``t``) at which a range is cut into parts of about
    ``at_once`` messages; equal ones stay together."""
    parts = -(-times.count() // at_once)
    if parts < 2:
        return []
    found = times.agg(F.percentile_approx("t", [i / parts for i in range(1, parts)], 10_000).alias("c")).first()["c"]
    return sorted(set(found or []))


def _append_parts(messages: DataFrame, tcol: str, path: str, cuts: list[float], at_ms: int) -> None:
    """Append the messages to the topic as one file for each part between ``cuts``."""
    spark, n, scratch = messages.sparkSession, len(cuts) + 1, f"{path}.parts"
    files = _Files(spark, path)
    part = reduce(lambda a, b: a + b, [(F.col(tcol) >= F.lit(c)).cast("int") for c in cuts], F.lit(0))
    rows = messages.select(part.alias("part"), *[c for c in messages.columns if c != tcol])
    with setting(spark, FREE_SHUFFLES, "true"):
        topic_writer(rows.repartitionById(n, "part")).mode("overwrite").partitionBy("part").parquet(scratch)
    topic_writer(messages.drop(tcol).where(F.lit(False)).coalesce(1)).mode("overwrite").parquet(f"{scratch}/none")
    nothing = files.parquet(f"{scratch}/none")[0]
    files.fs.mkdirs(files.path(path))
    for p in range(n):
        held = files.parquet(f"{scratch}/part={p}")
        if len(held) > 1:
            raise RuntimeError(f"{scratch}: part {p} is not one file")
        files.place(held[0] if held else nothing, f"{path}/{at_ms}-{p:06d}.parquet", at_ms + p, copy=not held)
    files.delete(scratch)


def _finish(query: StreamingQuery, spark: SparkSession) -> None:
    """Wait for the job's end. The shuffle files of its finished micro-batches lie
    on the executors' disks until the driver's garbage is collected."""
    while not query.awaitTermination(FREE_EVERY):
        spark._jvm.System.gc()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    spark._jvm.System.gc()


def replay(topics: dict[str, tuple[DataFrame, str]], run: Callable[[], StreamingQuery], n_chunks: int = 4,
           at_once: int | None = None, keep: bool = True, starting: Callable[[int], None] = lambda chunk: None) -> None:
    """Feed each topic ``{path: (messages, epoch_seconds_column)}`` chunk by chunk.

    ``run`` starts the job (``available_now=True``) on the topic folders, after
    ``starting(i)``. ``at_once``: messages of a micro-batch; the job has to read one
    file a trigger. Without ``keep`` the files of a range go when the next one was
    read, as a topic's retention drops them; the last range stays.
    """
    spark, staged = SparkSession.active(), {}
    for path, (msgs, tcol) in topics.items():
        with setting(spark, FREE_SHUFFLES, "true"):
            topic_writer(topic_messages(msgs, tcol)).parquet(f"{path}.staged")
        staged[path] = spark.read.parquet(f"{path}.staged"), tcol
    bounds = None
    for msgs, tcol in staged.values():
        row = msgs.agg(F.min(tcol).alias("lo"), F.max(tcol).alias("hi")).first()
        if row["lo"] is None:
            continue
        lo, hi = float(row["lo"]), float(row["hi"])
        bounds = (lo, hi) if bounds is None else (min(bounds[0], lo), max(bounds[1], hi))
    at_ms = 0
    for i in range(n_chunks if bounds is not None else 0):
        chunk = {path: (msgs.where(time_chunks(F.col(tcol), *bounds, n_chunks)[i]), tcol) for path, (msgs, tcol) in staged.items()}
        before = {path: _Files(spark, path).parquet(path) for path in topics}
        if at_once is not None:
            cuts = _cuts(reduce(DataFrame.unionByName, [msgs.select(F.col(tcol).alias("t")) for msgs, tcol in chunk.values()]), at_once)
            at_ms = max(int(time.time() * 1000), at_ms + 1)
        for path, (msgs, tcol) in chunk.items():
            if at_once is not None:
                _append_parts(msgs, tcol, path, cuts, at_ms)
            else:
                append_topic_files(msgs.drop(tcol), path)
        at_ms += len(cuts) if at_once is not None else 0
        starting(i)
        _finish(run(), spark)
        if not keep:
            for path, old in before.items():
                for name in old:
                    _Files(spark, path).delete(name)
    for path in topics:
        _Files(spark, path).delete(f"{path}.staged")
