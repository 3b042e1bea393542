"""Vector codes: product quantisation whose nearest entries are found by
Orchard's search.

A vector becomes integers floor(4096 * x) and is cut into ``PARTS`` equal
consecutive parts; each part position has a codebook of at most ``ENTRIES``
entries. Every entry of a codebook keeps the other entries sorted by their
distance to it. A search starts at an entry, walks its list, computes distances
to entries not visited yet, jumps to the list of an improved entry, and stops
beyond twice the current distance: an entry farther away from the current one
cannot be as near to the vector. All arithmetic is in integers, so the answer
is the nearest entry exactly, ties to the lower index.

A round of the fit is one pass over the table: tasks assign their rows and emit
one row of sums per (part, entry, position), which an aggregate adds up. The
driver sees codebooks only (``ENTRIES`` numbers per component).

Defined cases: rows whose vector is null or holds null, NaN or infinite
components are dropped. The dimension is the most frequent length that
``PARTS`` divides (the longer of equally frequent ones); kept rows of another
length return null code and error and take no part in the fit. Rows are ordered
by id (nulls last), then vector; a repeated id counts as often as it stands.
Fewer rows than ``ENTRIES`` give fewer entries. Null labels form one group. An
empty table, or one without a usable vector, gives no codes. Other columns are
ignored. Components so large that a squared distance leaves 64 bits raise an
error rather than give a wrong code.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.llm.common import map_rows, prepare, staged, table

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096


class Codebook:
    """The entries of one part position with their distance-sorted lists."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        k = len(entries)
        self.gaps = ((entries[:, None] - entries[None]) ** 2).sum(-1)
        order = np.argsort(self.gaps, axis=1, kind="stable")
        self.lists = order[order != np.arange(k)[:, None]].reshape(k, k - 1)

    def search(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry and squared distance of every row of ``x``."""
        n, k = len(x), len(self.entries)
        now = np.zeros(n, np.int64)
        best = ((x - self.entries[0]) ** 2).sum(1)
        at = np.zeros(n, np.int64)  # place in the current entry's list
        seen = np.zeros((n, k), bool)
        seen[:, 0] = True
        live = np.arange(n if k > 1 else 0)
        while len(live):
            entry = self.lists[now[live], at[live]]
            near = self.gaps[now[live], entry] <= 4 * best[live]  # squared: beyond twice the distance
            live, entry = live[near], entry[near]
            at[live] += 1
            fresh = ~seen[live, entry]
            rows, entry = live[fresh], entry[fresh]
            seen[rows, entry] = True
            d = ((x[rows] - self.entries[entry]) ** 2).sum(1)
            better = (d < best[rows]) | ((d == best[rows]) & (entry < now[rows]))
            rows = rows[better]
            now[rows], best[rows], at[rows] = entry[better], d[better], 0
            live = live[at[live] < k - 1]
        return now, best


def usable(vec_col: str) -> Column:
    """Not null, and no component null or not finite."""
    inf = F.lit(float("inf"))
    def finite(x: Column) -> Column:
        x = x.cast("double")
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf)

    return F.col(vec_col).isNotNull() & F.forall(F.col(vec_col), finite)


def as_parts(vectors: pa.Array, dim: int, parts: int, scale: int) -> np.ndarray:
    """Integer components as (row, part, position)."""
    x = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
    if len(x) and 4.0 * dim * np.abs(x).max() ** 2 >= 2.0**62:
        raise ValueError("a vector component is too large for 64-bit squared distances")
    return x.astype(np.int64).reshape(-1, parts, dim // parts)


def assign(x: np.ndarray, books: list[Codebook]) -> tuple[np.ndarray, np.ndarray]:
    """Codes (row, part) and summed squared distance per row."""
    codes = np.zeros(x.shape[:2], np.int64)
    error = np.zeros(len(x), np.int64)
    for p, book in enumerate(books):
        codes[:, p], d = book.search(x[:, p])
        error += d
    return codes, error


def refine(vectors: DataFrame, books: np.ndarray, scale: int) -> np.ndarray:
    """One round: assign all rows, replace every used entry by the floor of the
    mean of its parts. ``books`` is (part, entry, position)."""
    parts, k, width = books.shape
    (vec_col,) = vectors.columns
    found = T.StructType.fromDDL("part int, entry int, pos int, total long, n long")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = [Codebook(b) for b in books]
        total, n = np.zeros((parts, k, width), np.int64), np.zeros((parts, k), np.int64)
        for b in batches:
            x = as_parts(b.column(0), parts * width, parts, scale)
            codes, _ = assign(x, search)
            for p in range(parts):
                np.add.at(total[p], codes[:, p], x[:, p])
                n[p] += np.bincount(codes[:, p], minlength=k)
        p, e, j = np.nonzero(np.broadcast_to(n[:, :, None] > 0, total.shape))
        cols = [p.astype(np.int32), e.astype(np.int32), j.astype(np.int32), total[p, e, j], n[p, e]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=found.names)

    added = vectors.select(vec_col).mapInArrow(sums, found).groupBy("part", "entry", "pos").agg(
        F.sum("total").alias("total"), F.sum("n").alias("n"))
    new = books.copy()
    for r in added.collect():  # parts x entries x width numbers
        new[r.part, r.entry, r.pos] = r.total // r.n
    return new


def fit(rows: DataFrame, dim: int, id_col: str, vec_col: str, parts: int = PARTS, entries: int = ENTRIES,
        rounds: int = ROUNDS, scale: int = SCALE) -> np.ndarray:
    """Codebooks (part, entry, position) of ``rows``, whose vectors have ``dim``
    usable components: started from the rows of the smallest ids, then refined."""
    first = rows.select(id_col, vec_col).orderBy(F.col(id_col).asc_nulls_last(), vec_col).limit(entries).collect()
    start = pa.array([r[1] for r in first], pa.list_(pa.float64()))
    books = as_parts(start, dim, parts, scale).transpose(1, 0, 2)
    for _ in range(rounds):
        books = refine(rows.select(vec_col), books, scale)
    return books


def dimension(rows: DataFrame, vec_col: str, parts: int) -> int | None:
    sizes = rows.groupBy(F.size(vec_col).alias("size")).agg(F.count(F.lit(1)).alias("n"))
    top = sizes.where((F.col("size") > 0) & (F.col("size") % parts == 0)).orderBy(F.desc("n"), F.desc("size")).limit(1).collect()
    return top[0]["size"] if top else None


def digest(books: np.ndarray | None) -> str | None:
    """sha256 of all components by part, entry, position."""
    if books is None:
        return None
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def encode(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", keep: tuple[str, ...] = ("label",),
           parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray | None]:
    """(id, ``keep``, code, error) per kept row, and the codebooks."""
    prepare(vectors.sparkSession)
    rows = vectors.select(id_col, *keep, vec_col).where(usable(vec_col))
    dim = dimension(rows, vec_col, parts)
    if dim is None:
        none = {"code": F.lit(None).cast("string"), "error": F.lit(None).cast("long")}
        return rows.select(id_col, *keep, *[c.alias(n) for n, c in none.items()]), None
    fits = F.size(vec_col) == dim
    books = fit(rows.where(fits), dim, id_col, vec_col, parts, entries, rounds, scale)
    search = [Codebook(b) for b in books]

    def run(b: pa.RecordBatch) -> dict:
        codes, error = assign(as_parts(b.column(b.schema.get_field_index(vec_col)), dim, parts, scale), search)
        text = codes.astype(np.uint8).tobytes().hex()
        return {"code": [text[i : i + 2 * parts] for i in range(0, len(text), 2 * parts)], "error": error}

    coded = map_rows(rows.where(fits), [id_col, *keep], "code string, error long", run)
    other = rows.where(~fits).select(id_col, *keep, F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    return coded.unionByName(other), books


def op11_orchard_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all vectors, with the summed error of each label."""
    coded, books = encode(table(spark, sf_dir, "embeddings"))
    coded = staged(coded, "vector_codes")
    errors = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    joined = coded.join(errors, F.col("label").eqNullSafe(F.col("of")), "left")
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).cast("string").alias("codebooks_sha256"))


def _rounds_sql() -> str:
    """Codebooks c1.. and the last assignment, one pair of steps a round."""
    steps = []
    for r in range(ROUNDS + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT rid, p, min(d * 16 + e) % 16 AS e, min(d * 16 + e) // 16 AS d FROM (
    SELECT x.rid, x.p, c.e, sum((x.x - c.x) * (x.x - c.x)) AS d
    FROM part x JOIN c{r} c ON x.p = c.p AND x.j = c.j GROUP BY ALL) GROUP BY rid, p)""")
        if r < ROUNDS:
            steps.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT c.p, c.e, c.j, coalesce((m.s - ((m.s % m.n + m.n) % m.n)) // m.n, c.x) AS x
  FROM c{r} c LEFT JOIN (SELECT x.p, a.e, x.j, sum(x.x) AS s, count(*) AS n
    FROM part x JOIN a{r} a ON x.rid = a.rid AND x.p = a.p GROUP BY ALL) m ON c.p = m.p AND c.e = m.e AND c.j = m.j)""")
    return ",\n".join(steps)


OP11_SQL = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) - 1 AS rid, vec_id, label, embedding
  FROM embeddings
  WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
),
part AS MATERIALIZED (
  SELECT rid, i // (d // 8) AS p, i % (d // 8) AS j, CAST(floor(4096 * CAST(embedding[i + 1] AS DOUBLE)) AS BIGINT) AS x
  FROM (SELECT rid, embedding, len(embedding) AS d, unnest(range(len(embedding))) AS i FROM kept)
),
c0 AS MATERIALIZED (SELECT p, rid AS e, j, x FROM part WHERE rid < 16),
{_rounds_sql()},
coded AS (
  SELECT rid, string_agg('0' || substr('0123456789abcdef', CAST(e AS INTEGER) + 1, 1), '' ORDER BY p) AS code,
         CAST(sum(d) AS BIGINT) AS error
  FROM a{ROUNDS} GROUP BY rid
),
rows AS (SELECT vec_id, label, code, error FROM kept JOIN coded USING (rid))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, e, j)) FROM c{ROUNDS}) AS codebooks_sha256
FROM rows
"""
