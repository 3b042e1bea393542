"""Merkle manifest of a table by sibling-shift self-joins.

Every row is a leaf; the leaves of a group (language) form a tree of ``ARITY``
children a node, and the groups' roots ("subroots") form one more tree. Level by
level, the nodes in slot zero of their run name their siblings by computed
indices (their own plus the slot offsets), an equijoin fetches the siblings, and
the slot-zero row emits the parent. No node is ever collected: the driver learns
the number of levels only.

Places in a group come from one sort by range: a row's place within its
partition, plus the rows of its group in earlier partitions (one row a
partition and group). Proofs go down again: a run hands its children its own
path, so a path is stored once for eight leaves and a leaf's proof and folded
root are expressions over it.

Defined cases: a null field is the digit string ``-``; a null group sorts before
all others, null ids before all ids; rows of one id are ordered by their leaf
digest, and equal rows are leaves of their own; a lone node is its tree's root;
an empty table gives an empty result; other columns are ignored. Texts are
digested whole. A row without an id is never tampered with.
"""

from __future__ import annotations

from dataclasses import dataclass
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shoplens.llm.common import prepare, staged, table

ARITY = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
HOPS = "array<struct<before: string, after: string>>"
IN_PARTITION = 1 << 33  # Spark's monotonically increasing ids: partition * 2^33 + row


def field(c: Column) -> Column:
    """``-`` if null, else UTF-8 byte count, colon, value."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_digest(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*map(field, fields)), 256)


def ranked(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``idx`` (place within ``tree`` by ``order``, from 0) and
    ``n`` (rows of the tree). Staged once, so that a place is final."""
    # the last key splits rows that are equal in all others
    keyed = rows.withColumn("split", F.monotonically_increasing_id())
    ranges = keyed.repartitionByRange("tree", *order, "split").sortWithinPartitions("tree", *order).drop("split")
    rows = staged(ranges.withColumn("at", F.monotonically_increasing_id()), name)
    part = F.floor(F.col("at") / IN_PARTITION).alias("part")
    runs = rows.groupBy("tree", part).agg(F.min("at").alias("first_at"), F.count(F.lit(1)).alias("size"))
    # a tree has at most one row a partition here
    tree = Window.partitionBy("tree")
    earlier = F.coalesce(F.sum("size").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = runs.select("tree", "part", F.sum("size").over(tree).alias("n"), (earlier - F.col("first_at")).alias("shift"))
    return (rows.withColumn("part", part).join(placed, ["tree", "part"])
            .withColumn("idx", F.col("at") + F.col("shift")).drop("part", "at", "shift"))


def parents(nodes: DataFrame, arity: int) -> DataFrame:
    """One level up: (tree, idx, n, hash) -> (tree, idx, n, hash, hashes) of
    the parents, ``hashes`` being their children in slot order."""
    slot_zero = nodes.where(F.col("idx") % arity == 0)
    last = F.least(F.col("idx") + (arity - 1), F.col("n") - 1)
    asks = slot_zero.select("tree", "n", F.floor(F.col("idx") / arity).alias("up"), F.explode(F.sequence("idx", last)).alias("idx"))
    found = asks.join(nodes.select("tree", "idx", "hash"), ["tree", "idx"])
    runs = found.groupBy("tree", "up", "n").agg(F.array_sort(F.collect_list(F.struct("idx", "hash"))).alias("run"))
    hashes = F.transform("run", lambda r: r["hash"])
    return runs.select("tree", F.col("up").alias("idx"), F.ceil(F.col("n") / arity).alias("n"),
                       F.sha2(F.array_join(hashes, ""), 256).alias("hash"), hashes.alias("hashes"))


@dataclass
class Trees:
    """``levels[k]``: the parents of level ``k``'s nodes; ``roots``: (tree,
    level, hash) of each tree's last node."""

    levels: list[DataFrame]
    roots: DataFrame
    arity: int


def build(nodes: DataFrame, name: str, arity: int = ARITY) -> Trees:
    """All trees of ``nodes`` (tree, idx, n, hash), whose ``idx`` and ``n`` are
    longs. Each level is written once."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    levels, at = [], nodes
    roots = nodes.where("n = 1").select("tree", F.lit(0).alias("level"), "hash")
    while most > 1:
        up = staged(parents(at.where("n > 1"), arity), name)
        levels.append(up)
        roots = roots.unionByName(up.where("n = 1").select("tree", F.lit(len(levels)).alias("level"), "hash"))
        at, most = up.select("tree", "idx", "n", "hash"), -(-most // arity)
    return Trees(levels, roots, arity)


def hop(hashes: Column, slot: Column) -> Column:
    """The siblings before and after a slot."""
    return F.struct(F.array_join(F.slice(hashes, F.lit(1), slot), "").alias("before"),
                    F.array_join(F.slice(hashes, slot + 2, F.greatest(F.size(hashes) - slot - 1, F.lit(0))), "").alias("after"))


def runs_with_paths(trees: Trees, tops: DataFrame) -> DataFrame:
    """(tree, up, hashes, hops, more columns of ``tops``) of the lowest level:
    each run of leaves with its parent's path. ``tops`` gives each tree's path
    above its root: (tree, level, hops, ...)."""
    extra = [c for c in tops.columns if c not in ("tree", "level", "hops")]
    below = None
    for k in range(len(trees.levels), 0, -1):
        paths = tops.where(F.col("level") == k).select("tree", F.lit(0).cast("long").alias("idx"), "hops", *extra)
        if below is not None:
            child = below.select("tree", "up", "hashes", "hops", *extra, F.posexplode("hashes").alias("slot", "hash"))
            paths = paths.unionByName(child.select(
                "tree", (F.col("up") * trees.arity + F.col("slot")).alias("idx"),
                F.concat(F.array(hop(F.col("hashes"), F.col("slot"))), "hops").alias("hops"), *extra))
        below = trees.levels[k - 1].select("tree", "idx", "hashes").join(paths, ["tree", "idx"]).withColumnRenamed("idx", "up")
    return below


def with_paths(leaves: DataFrame, trees: Trees, tops: DataFrame) -> DataFrame:
    """``leaves`` (tree, idx, n, ...) with ``hops`` (siblings before and after,
    level by level up to the end of ``tops``) and the columns of ``tops``."""
    lone = leaves.where("n = 1").join(tops.where("level = 0").drop("level"), "tree")
    if not trees.levels:
        return lone
    runs = runs_with_paths(trees, tops)
    asked = leaves.where("n > 1").withColumn("up", F.floor(F.col("idx") / trees.arity))
    joined = asked.join(runs, ["tree", "up"]).withColumn(
        "hops", F.concat(F.array(hop(F.col("hashes"), (F.col("idx") % trees.arity).cast("int"))), "hops"))
    return joined.select(*lone.columns).unionByName(lone)


def fold(leaf: Column, hops: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(hops, leaf, lambda acc, h: F.sha2(F.concat(h["before"], acc, h["after"]), 256))


def manifest(docs: DataFrame, tampered: dict[str, Column] | None = None, id_col: str = "doc_id", group_col: str = "lang",
             fields: tuple[str, ...] = FIELDS, arity: int = ARITY) -> DataFrame:
    """Per row of ``docs``: (id, leaf, subroot, root, hops, folded_root), where
    ``folded_root`` folds the row as it stands with the columns in ``tampered``
    replaced."""
    prepare(docs.sparkSession)
    tampered = tampered or {}
    tree = F.coalesce(F.concat(F.lit("1"), F.col(group_col).cast("string")), F.lit("0"))  # null before all
    leaves = docs.select(tree.alias("tree"), F.col(id_col).alias("id"), leaf_digest([F.col(c) for c in fields]).alias("hash"),
                         leaf_digest([tampered.get(c, F.col(c)) for c in fields]).alias("shown"))
    leaves = ranked(leaves, ["id", "hash"], "merkle_leaves")
    groups = build(leaves.select("tree", "idx", "n", "hash"), "merkle_level", arity)

    subroots = groups.roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "level", "hash")
    subroots = ranked(subroots, ["name"], "merkle_subroots")
    top = build(subroots.select("tree", "idx", "n", "hash"), "merkle_top", arity)
    root = top.roots.select("tree", "level", F.array().cast(HOPS).alias("hops"), F.col("hash").alias("root"))
    tops = with_paths(subroots.withColumnRenamed("level", "of_level"), top, root)
    tops = tops.select(F.col("name").alias("tree"), F.col("of_level").alias("level"), "hops", F.col("hash").alias("subroot"), "root")

    rows = with_paths(leaves, groups, staged(tops, "merkle_tops"))
    return rows.select(F.col("id").alias(id_col), F.col("hash").alias("leaf"), "subroot", "root", "hops",
                       fold(F.col("shown"), F.col("hops")).alias("folded_root"))


def op12_shift_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of all documents by language; a third is shown in lower case."""
    docs = table(spark, sf_dir, "documents")
    picked = F.crc32(F.col("doc_id").cast("string")) % 3 == 0  # null: not picked
    lower = F.when(picked, F.translate("text", ascii_uppercase, ascii_lowercase)).otherwise(F.col("text"))
    rows = manifest(docs, {"text": lower})
    proof = F.array_join(F.transform("hops", lambda h: F.concat(h["before"], h["after"])), "")
    return rows.select("doc_id", "leaf", "subroot", "root", F.sha2(proof, 256).alias("proof_sha256"), "folded_root",
                       (F.col("folded_root") == F.col("root")).alias("verified"))


def _level_sql(prefix: str, start: str, depth: int) -> str:
    """Levels of all trees: {prefix}0 are the nodes; a tree of one node stays."""
    steps = [f"{prefix}0 AS MATERIALIZED ({start})"]
    for k in range(depth):
        steps.append(f"""{prefix}{k + 1} AS MATERIALIZED (
  SELECT tree, idx // {ARITY} AS idx, CASE WHEN n > 1 THEN sha256(string_agg(h, '' ORDER BY idx)) ELSE any_value(h) END AS h,
         list(h ORDER BY idx) AS run, n AS below, (n + {ARITY - 1}) // {ARITY} AS n
  FROM {prefix}{k} GROUP BY tree, idx // {ARITY}, n)""")
    return ",\n".join(steps)


def _fold_sql(name: str, prefix: str, start: str, depth: int) -> str:
    """Walk up {depth} levels: proof text and folded hash."""
    steps = [f"{name}0 AS ({start})"]
    for k in range(depth):
        slot = f"(f.idx // {ARITY**k}) % {ARITY}"
        before, after = f"array_to_string(u.run[1:{slot}], '')", f"array_to_string(u.run[{slot} + 2:], '')"
        steps.append(f"""{name}{k + 1} AS (
  SELECT f.* EXCLUDE (proof, shown),
         CASE WHEN u.below > 1 THEN concat(f.proof, {before}, {after}) ELSE f.proof END AS proof,
         CASE WHEN u.below > 1 THEN sha256(concat({before}, f.shown, {after})) ELSE f.shown END AS shown
  FROM {name}{k} f JOIN {prefix}{k + 1} u ON f.tree = u.tree AND f.idx // {ARITY ** (k + 1)} = u.idx)""")
    return ",\n".join(steps)


def _field_sql(c: str) -> str:
    return f"coalesce(CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"


_DEPTH, _TOP_DEPTH = 8, 3
_LEAF = "sha256(concat({}))".format(", ".join(map(_field_sql, FIELDS)))
# crc32, bit by bit: each byte of the decimal id is followed by seven zeros
_CRC = """xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
    lambda ch: [CAST(ascii(ch) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))), lambda c, b: xor(xor(c, b) >> 1, (xor(c, b) & 1) * 3988292384)))"""
OP12_SQL = f"""
WITH told AS (
  SELECT doc_id, coalesce('1' || lang, '0') AS tree, source, lang, n_chars, text,
         CASE WHEN doc_id IS NOT NULL AND {_CRC} % 3 = 0
              THEN translate(text, '{ascii_uppercase}', '{ascii_lowercase}') ELSE text END AS shown_text
  FROM documents
),
leaf AS MATERIALIZED (
  SELECT doc_id, tree, {_LEAF} AS h, {_LEAF.replace(_field_sql("text"), _field_sql("shown_text"))} AS shown FROM told
),
place AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n FROM leaf
),
{_level_sql("g", "SELECT tree, idx, h, n FROM place", _DEPTH)},
sub AS MATERIALIZED (SELECT '' AS tree, tree AS name, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n, h FROM g{_DEPTH}),
{_level_sql("t", "SELECT tree, idx, h, n FROM sub", _TOP_DEPTH)},
{_fold_sql("f", "g", "SELECT *, '' AS proof FROM place", _DEPTH)},
up AS (SELECT f.doc_id, f.h AS leaf, s.h AS subroot, '' AS tree, s.idx, f.proof, f.shown FROM f{_DEPTH} f JOIN sub s ON f.tree = s.name),
{_fold_sql("r", "t", "SELECT * FROM up", _TOP_DEPTH)}
SELECT doc_id, leaf, subroot, (SELECT h FROM t{_TOP_DEPTH}) AS root, sha256(proof) AS proof_sha256, shown AS folded_root,
       shown = (SELECT h FROM t{_TOP_DEPTH}) AS verified
FROM r{_TOP_DEPTH}
"""
