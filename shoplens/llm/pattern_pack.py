"""Best-fit packing by length patterns fitted with non-negative least squares.

1. Every document becomes its token ids plus an end id; longer ones than a
   sequence are cut from the end into full pieces, so only the first piece may
   be shorter. Full pieces are sequences of their own.
2. The lengths of the other pieces are counted (at most ``size`` - 1 numbers,
   whatever the corpus). Patterns of two to four lengths that fill a sequence
   are enumerated, and non-negative least squares fits how often to repeat each
   so that together they use up the histogram. The counts are rounded down to
   what the histogram still holds.
3. What is left is packed by best-fit decreasing on the counts alone, which
   yields further patterns with repeat counts.
4. The plan (patterns and counts, bounded by ``size``) says for each length
   which ranks go to which pattern slot. Ranks within a length come from counts
   per (length, bucket of documents), so no length is gathered in one task.

Defined cases: null text is the empty text (a piece of one end id); repeated
rows are each packed; an empty table gives an empty result; other columns are
ignored. Texts are tokenized whole, in runs that the tokenizer itself never
joins: it splits before white space that follows a non-space.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections import Counter, defaultdict
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shoplens.llm.common import chunks, prepare, staged, starts_of, table, texts_of

MODEL, RANKS, END, SIZE = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken", 2, 1024
BUCKETS = 512
#: Unicode white space, and the four separators that some engines count too.
SPACE = "\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
UNSURE = re.compile("[\x1c-\x1f\u180e\u200b\ufeff]|<\\|endoftext\\|>")
RUN = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
JOINED = re.compile(f"[{SPACE}]+[^{SPACE}]")
CHUNK_CHARS = 3_500_000


class RunCoder:
    """Ids of texts, encoding each distinct run of a chunk of texts once.

    Runs that begin with white space are joined and encoded together, since the
    tokenizer never joins them; the bytes that ids stand for tell the runs
    apart again. ``ranks``: the same vocabulary for a faster library; texts
    that it might split in another way go to the tokenizer itself."""

    def __init__(self, model: str = MODEL, ranks: str | None = RANKS):
        self.model, self.fast, self._tool = model, None, None
        if ranks:
            with open(public_tokenizers.path(ranks), "rb") as f:
                table_of = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding(model, pat_str=public_tokenizers.PATTERN, mergeable_ranks=table_of, special_tokens={})
            sizes = {i: len(token) for token, i in table_of.items()}
        else:  # one character of a byte-level token stands for one byte
            sizes = {i: len(token) for token, i in self.tool.get_vocab().items()}
        self.n_bytes = np.zeros(max(sizes) + 1, np.int64)
        self.n_bytes[list(sizes)] = list(sizes.values())

    @property
    def tool(self) -> Tokenizer:
        """The tokenizer itself, loaded when a text needs it."""
        if self._tool is None:
            self._tool = Tokenizer.from_file(public_tokenizers.path(self.model))
        return self._tool

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tool.encode(text, add_special_tokens=False).ids, np.uint32)

    def _plain(self, text: str) -> np.ndarray:
        return np.array(self.fast.encode_ordinary(text), np.uint32) if self.fast else self.whole(text)

    def _runs(self, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The runs' ids one after the other, and the number of each."""
        n, parts = np.zeros(len(runs), np.int64), []
        joined = np.array([JOINED.match(r) is not None for r in runs], bool)
        order = np.concatenate((np.flatnonzero(joined), np.flatnonzero(~joined)))
        for k in range(0, int(joined.sum()), 2000):
            some = order[k : min(k + 2000, int(joined.sum()))]
            ids = self._plain("".join(runs[some]))
            ends = np.cumsum([len(r.encode()) for r in runs[some]])
            n[some] = np.diff(np.searchsorted(np.cumsum(self.n_bytes[ids]), ends), prepend=-1)
            parts.append(ids)
        for k in order[int(joined.sum()) :]:
            ids = self._plain(runs[k])
            n[k] = len(ids)
            parts.append(ids)
        begin = np.empty(len(runs), np.int64)
        begin[order] = starts_of(n[order])
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32), np.stack((begin, n))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        plain = [UNSURE.search(t) is None for t in texts]
        lists = [RUN.findall(t) if p else [] for t, p in zip(texts, plain, strict=True)]
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = np.empty(int(counts.sum()), object)
        flat[:] = list(chain.from_iterable(lists))
        codes, runs = pd.factorize(flat)
        pool, (begin, n) = self._runs(runs)
        each = n[codes]
        place = np.arange(int(each.sum()), dtype=np.int64) + np.repeat(begin[codes] - starts_of(each), each)
        ids = pool[place]
        ends = np.concatenate(([0], np.cumsum(each)))[np.concatenate(([0], np.cumsum(counts)))]
        return [ids[ends[i] : ends[i + 1]] if p else self.whole(t) for i, (t, p) in enumerate(zip(texts, plain, strict=True))]


@lru_cache(maxsize=2)
def _coder(model: str) -> RunCoder:
    return RunCoder(model, RANKS if model == MODEL else None)


def pieces(docs: DataFrame, model: str = MODEL, end: int = END, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32) of every document."""
    id_field = docs.schema[id_col]
    schema = f"`{id_col}` {id_field.dataType.simpleString()}, piece int, start long, length long, ids_crc32 long"

    def run(batches):
        coder = _coder(model)
        for b in batches:
            texts, ids = texts_of(b, text_col), b.column(b.schema.get_field_index(id_col))
            for i, j in chunks(texts, CHUNK_CHARS):
                rows = []
                for k, x in enumerate(coder.encode(texts[i:j]), i):
                    x = np.append(x, np.uint32(end)).astype("<u4")
                    first = len(x) % size or size
                    cuts = [0, *range(first, len(x), size), len(x)]
                    rows += [(k, p, s, e - s, zlib.crc32(x[s:e].tobytes())) for p, (s, e) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))]
                k, *rest = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(k)), pa.array(rest[0], pa.int32()), *[pa.array(c, pa.int64()) for c in rest[1:]]], names=[id_col, "piece", "start", "length", "ids_crc32"])

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def patterns_of(hist: np.ndarray, size: int) -> list[tuple[int, ...]]:
    """Patterns of two to four present lengths that fill a sequence best: each
    length with its nearest full partner, and with each of a spread of lengths
    and their nearest full partners. At most about 40 patterns a length."""
    there = np.flatnonzero(hist)
    near = np.full(size + 1, 0)  # the largest present length up to n
    near[there] = there
    near = np.maximum.accumulate(near)
    few = there[np.unique(np.linspace(0, len(there) - 1, 12).astype(int))] if len(there) else there
    found = set()
    for a in map(int, there):
        if c := int(near[size - a]):
            found.add(tuple(sorted((a, c), reverse=True)))
        for b in map(int, few):
            rest = size - a - b
            if rest > 0 and (c := int(near[rest])):
                found.add(tuple(sorted((a, b, c), reverse=True)))
                for d in map(int, few[::3]):
                    if rest - d > 0 and (c := int(near[rest - d])):
                        found.add(tuple(sorted((a, b, d, c), reverse=True)))
    return sorted(p for p in found if sum(p) >= 0.98 * size)


def nnls(patterns: list[tuple[int, ...]], hist: np.ndarray, steps: int = 400) -> np.ndarray:
    """x >= 0 that minimises |A x - hist|, A's columns being the patterns'
    length counts; by projected gradient with momentum on the sparse A."""
    if not patterns:
        return np.zeros(0)
    col = np.repeat(np.arange(len(patterns)), [len(p) for p in patterns])
    row = np.concatenate([np.array(p) for p in patterns])
    use = np.bincount(row, minlength=len(hist))
    x, y, t = np.zeros(len(patterns)), np.zeros(len(patterns)), 1.0
    step = 1 / max(1, use.max() * max(len(p) for p in patterns))  # at most 1 / |A'A|
    for _ in range(steps):
        miss = np.bincount(row, y[col], len(hist)) - hist
        new = np.maximum(0, y - step * np.bincount(col, miss[row], len(patterns)))
        t, before = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        x, y = new, new + (before - 1) / t * (new - x)
    return x


def plan(hist: np.ndarray, size: int) -> list[tuple[tuple[int, ...], int]]:
    """(pattern, repeats) that use every piece of ``hist`` exactly once."""
    left = hist.astype(np.int64).copy()
    found = patterns_of(left, size)
    out: list[tuple[tuple[int, ...], int]] = []
    fit = nnls(found, left.astype(float))

    def take(p: tuple[int, ...], most: int) -> None:
        n = min([most, *(int(left[v]) // k for v, k in Counter(p).items())])
        if n > 0:
            for v, k in Counter(p).items():
                left[v] -= n * k
            out.append((p, n))

    for k in sorted(range(len(found)), key=lambda k: (size - sum(found[k]), -fit[k], found[k])):
        take(found[k], int(fit[k] + 1e-9))
    # best-fit decreasing on what is left: the largest length opens a sequence,
    # each next piece is the largest that still fits; repeated as often as the
    # counts allow
    for a in range(size, 0, -1):
        while left[a] > 0:
            p, room, used = [a], size - a, Counter([a])
            b = min(room, size)
            while room > 0 and b > 0:
                while b > 0 and left[b] - used[b] <= 0:
                    b -= 1
                if b <= 0:
                    break
                p.append(b)
                used[b] += 1
                room -= b
                b = min(b, room)
            take(tuple(p), int(left[a]))
    return out


def slots(plan_rows: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, rank from, rank to, first sequence, offset): pieces of a length
    with those ranks go to consecutive sequences, at that offset."""
    at, seq, out = defaultdict(int), 0, []
    for p, n in plan_rows:
        offset = 0
        for v in p:
            out.append((v, at[v], at[v] + n, seq, offset))
            at[v] += n
            offset += v
        seq += n
    return out


def ranked(rows: DataFrame, id_col: str) -> DataFrame:
    """``rows`` with ``rank`` from 0 within their length, without gathering a
    length: a piece's rank is its place in its (length, bucket) plus the counts
    of the length's earlier buckets."""
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64(id_col, "piece"), F.lit(BUCKETS)))
    counts = rows.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.withColumn("_before", F.sum("_n").over(Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)))
    place = F.row_number().over(Window.partitionBy("length", "_bucket").orderBy(id_col, "piece", "start", "ids_crc32"))
    placed = rows.withColumn("_place", place).join(before.drop("_n"), ["length", "_bucket"])
    return placed.withColumn("rank", F.col("_place") - 1 + F.coalesce("_before", F.lit(0))).drop("_place", "_before", "_bucket")


def pack(docs: DataFrame, model: str = MODEL, end: int = END, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece with its sequence and its place there."""
    spark = docs.sparkSession
    prepare(spark)
    cut = staged(pieces(docs, model, end, size, id_col, text_col), "pieces")
    # at most `size` rows, whatever the corpus
    hist = np.zeros(size + 1, np.int64)
    for length, n in cut.groupBy("length").count().collect():
        hist[length] = n
    hist[size] = 0
    place = spark.createDataFrame(slots(plan(hist, size)), "length long, rank_from long, rank_to long, first_sequence long, offset long")
    rest = ranked(cut.where(F.col("length") < size), id_col)
    # the plan has a bounded number of rows: broadcast
    fit = rest.join(F.broadcast(place), "length").where((F.col("rank") >= F.col("rank_from")) & (F.col("rank") < F.col("rank_to")))
    columns = [id_col, "piece", "start", "length", "ids_crc32"]
    fit = fit.select(*columns, (F.col("first_sequence") + F.col("rank") - F.col("rank_from")).alias("sequence_id"), "offset")
    full = cut.where(F.col("length") == size).select(*columns, (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return fit.unionByName(full)


def op9_pattern_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens."""
    return pack(table(spark, sf_dir, "documents"))
