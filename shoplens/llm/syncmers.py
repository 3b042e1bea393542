"""Document fingerprints from closed syncmers, in built-in functions only.

Words are the letters. Of each run of ``K`` words, the hashes of its inner runs
of ``S`` words are compared; the run is an anchor when the least of them is the
first or the last (a closed syncmer). That depends on the run alone, so an edit
changes only the anchors that touch it, and equal passages give equal anchors
wherever they stand. A fingerprint lists the anchors in text order; likeness is
the share of distinct anchors that two texts have in common.

Defined cases: null text is empty and has no anchor; a text too short for one
gets the hash of all its words; two texts without anchors have likeness 1;
rows with equal ids are ordered by their text's hash, null ids come first;
repeated rows follow each other; a single row is its own next document; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shoplens.llm.common import staged, table, whole_text

K, S = 8, 2
SPACES = " \t\n\x0b\x0c\r"
#: Rows of neighbouring ids that share a window; and of windows, and of those.
NEAR = 1 << 10
#: Up to so many windows (of three numbers each) the table of windows is
#: broadcast; beyond, it is joined by shuffling.
SMALL = 200_000


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def anchors(text: Column, k: int = K, s: int = S) -> Column:
    """The text's anchors in order (array<int>)."""
    trimmed = F.btrim(text, F.lit(SPACES))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))

    def of(letters: Column) -> Column:
        inner = F.transform(letters, lambda x, i: F.xxhash64(x, *[F.get(letters, i + j) for j in range(1, s)]))

        def closed(m: Column) -> Column:
            edge = lambda i: F.least(F.get(m, i), F.get(m, i + (k - s)))
            within = lambda i: F.least(*[F.get(m, i + j) for j in range(1, k - s)])
            places = F.when(F.size(letters) >= k, F.sequence(F.lit(0), F.size(letters) - k)).otherwise(F.array().cast("array<int>"))
            chosen = F.filter(places, lambda i: edge(i) <= within(i))
            return F.transform(chosen, lambda i: F.hash(*[F.get(letters, i + j) for j in range(k)]))

        return _let(_let(inner, closed), lambda a: F.when((F.size(a) == 0) & (F.size(letters) > 0), F.array(F.hash(letters))).otherwise(a))

    return _let(F.transform(words, lambda w: F.xxhash64(w)), of)


def as_string(found: Column) -> Column:
    """Eight hex digits for each anchor."""
    return F.array_join(F.transform(found, lambda a: F.lpad(F.lower(F.hex(a.cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Shared distinct anchors over all distinct anchors, 0 to 1."""
    both, all_ = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(all_ == 0, F.lit(1.0)).otherwise(both / all_)


def with_sentinels(docs: DataFrame) -> DataFrame:
    """``docs`` (_id, _tie, text) with ``_near``, the window of a row, and
    ``_last``: for each window also a copy of the row that follows its last
    (``_last`` 1; 2 where that is the very first). Windows are found level by
    level, so that only one row in ``NEAR`` cubed meets in one place."""
    near = lambda c, n: F.floor(F.col(c) / F.lit(n)).cast("long")
    first = docs.groupBy(near("_id", NEAR).alias("b1")).agg(F.min(F.struct("_id", "_tie")).alias("first"))
    first = first.withColumn("b2", near("b1", NEAR)).withColumn("b3", near("b2", NEAR))
    b2 = first.groupBy("b2", "b3").agg(F.max("b1").alias("end"))
    b3 = b2.groupBy("b3").agg(F.max("end").alias("end"))
    top = b3.select("b3", F.lag("end").over(Window.orderBy("b3")).alias("before3"), F.max("end").over(Window.partitionBy()).alias("very_last"))
    mid = b2.select("b2", "b3", F.lag("end").over(Window.partitionBy("b3").orderBy("b2")).alias("before2")).join(top, "b3")
    low = first.select("first", "b2", F.lag("b1").over(Window.partitionBy("b2").orderBy("b1")).alias("before1")).join(mid, "b2")
    into = low.select(
        F.col("first._id").alias("_id"), F.col("first._tie").alias("_tie"),
        F.coalesce("before1", "before2", "before3", "very_last").alias("_near"),
        F.when(F.coalesce("before1", "before2", "before3").isNull(), 2).otherwise(1).alias("_last"),
    )
    into = staged(into, "next_windows")  # ids only, a NEARth of the rows
    if into.count() <= SMALL:
        into = F.broadcast(into)
    sentinels = docs.join(into, ["_id", "_tie"])
    rows = docs.withColumns({"_near": near("_id", NEAR), "_last": F.lit(0)})
    return rows.unionByName(sentinels.select(*rows.columns))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, s: int = S) -> DataFrame:
    """Fingerprints of every document and of its text with the last quarter
    replaced from the next document."""
    rows = docs.select(F.col(id_col).alias("_given"), whole_text(text_col).alias("_text"))
    rows = rows.withColumns({"_id": F.coalesce(F.col("_given").cast("long"), F.lit(-(1 << 62))), "_tie": F.xxhash64("_text")})
    rows = with_sentinels(rows).withColumn("_anchors", anchors(F.col("_text"), k, s))
    order = Window.partitionBy("_near").orderBy("_last", "_id", "_tie")
    follow = rows.select("*", F.lead(F.struct("_text", "_anchors")).over(order).alias("_next")).where(F.col("_last") == 0)
    n = F.char_length("_text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("_text", F.lit(1), n - quarter), F.substring(F.col("_next._text"), F.lit(1), quarter))
    follow = follow.select(
        F.col("_given").alias(id_col), n.cast("long").alias("n_chars"), "_anchors", F.col("_next._anchors").alias("_next_anchors"),
        edited.alias("_edited"),
    )
    done = follow.select("*", anchors(F.col("_edited"), k, s).alias("_edited_anchors"))
    return done.select(
        id_col, "n_chars", F.sha2("_edited", 256).alias("edited_sha256"),
        as_string(F.col("_anchors")).alias("fingerprint"), as_string(F.col("_edited_anchors")).alias("edited_fingerprint"),
        likeness(F.col("_anchors"), F.col("_edited_anchors")).alias("near_edited"),
        likeness(F.col("_anchors"), F.col("_next_anchors")).alias("near_next"),
    )


def op8_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents."""
    return fingerprints(table(spark, sf_dir, "documents"))
