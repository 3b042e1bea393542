"""Temperature mixing of sources, in built-in functions only.

A source's share of all tokens is raised to an exponent t and the results are
normalised to weights: t = 1 keeps the corpus as it is, t = 0 gives all sources
the same weight. Entropy falls and the greatest repetition falls as t rises, so
the exponent is found by bisection: the largest one that still reaches the
target entropy, then raised, if need be, until no source is repeated more than
the limit. Each pass settles ``LEVELS`` bisections at once in one aggregate.

The weights then become rows. A source has ``BLOCKS`` blocks of documents (by
hash). Its token budget is spent in epochs; each epoch goes through the blocks
in an order of its own, and through a block's documents in an order of its own.
The last epoch stops at the budget: whole blocks that fit, then documents of
the next block while they fit. Only per-block sums are ordered within a source,
so a source with most of the rows is never gathered in one place.

Tokens are words (runs without ASCII white space). Defined cases: null text has
no token; null source is the source named ""; documents without tokens are kept
in every full epoch; sources without tokens get weight 0 and one epoch; rows
with one id and text are spent together or apart, in either case as often as
they occur; an empty table gives an empty result; other columns stay with
their row.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shoplens.llm.common import staged, table, whole_text

BLOCK_DIGITS = 3  # hex digits: 4096 blocks a source
LEVELS, PASSES = 5, 6
ENTROPY, REPEATS, SEED = 0.95, 4.0, "mix-1"
WORDS = r"[^\x20\x09-\x0D]+"


def with_blocks(docs: DataFrame, id_col: str, source_col: str, text_col: str, seed: str) -> DataFrame:
    """``docs`` with ``_source``, ``_tokens``, ``_key`` (the row's identity) and
    ``_block``."""
    text = whole_text(text_col)
    key = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.md5(text)))
    return docs.withColumns({
        "_source": F.coalesce(F.col(source_col), F.lit("")),
        "_tokens": F.regexp_count(text, F.lit(WORDS)).cast("long"),
        "_key": key,
    }).withColumn("_block", F.substring("_key", 1, BLOCK_DIGITS))


def _entropy(shares: DataFrame, exponents: list[float]) -> dict[float, tuple[float, float, float]]:
    """For each exponent: entropy of the weights, the greatest weight per share
    and the least. One row an exponent reaches the driver."""
    tries = shares.where("share > 0").select("share", F.explode(F.array(*[F.lit(x) for x in exponents])).alias("t"))
    p = F.pow("share", F.col("t"))
    rows = tries.groupBy("t").agg(F.sum(p).alias("z"), F.sum(p * F.ln(p)).alias("plogp"), F.max(p / F.col("share")).alias("most"), F.min(p / F.col("share")).alias("least")).collect()
    return {r.t: (float(math.log(r.z) - r.plogp / r.z), r.most / r.z, r.least / r.z) for r in rows}


def _bisect(shares: DataFrame, holds) -> float:
    """The exponent in 0..1 up to which ``holds(figures)`` is true."""
    low, high = 0.0, 1.0
    for _ in range(PASSES):
        n = 1 << LEVELS
        grid = [low + (high - low) * k / n for k in range(1, n)]
        figures = _entropy(shares, grid)
        good = [t for t in grid if t in figures and holds(figures[t])]
        bad = [t for t in grid if t in figures and not holds(figures[t])]
        low, high = max([low, *good]), min([high, *bad])
    return round((low + high) / 2, 6)


def exponent(shares: DataFrame, n_sources: int, entropy: float, repeats: float, budget_share: float | None) -> float:
    """The exponent; 1 where there is at most one source with tokens.
    ``budget_share``: tokens to spend over all tokens; None: just so many that
    every source is shown once at least."""
    if n_sources < 2:
        return 1.0
    goal = entropy * math.log(n_sources)
    t = _bisect(shares, lambda f: f[0] >= goal)
    # repetition of a source: its weight times the budget over its tokens
    most = lambda f: f[1] * budget_share if budget_share is not None else f[1] / f[2]
    return max(t, _bisect(shares, lambda f: most(f) > repeats) + 1e-6 if most(_entropy(shares, [t])[t]) > repeats else t)


def mix(docs: DataFrame, entropy: float = ENTROPY, repeats: float = REPEATS, budget: float | None = 1.0, seed: str = SEED, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` as often as they are spent, with ``_epoch``,
    ``_block``, ``_tokens``, ``_source`` and ``_weight``. ``budget`` is a share
    of all tokens; None keeps every document at least once."""
    rows = with_blocks(docs, id_col, source_col, text_col, seed)
    # (source, block) sums: the one pass over the texts before the last
    blocks = staged(rows.groupBy("_source", "_block").agg(F.sum("_tokens").alias("block_tokens")), "mix_blocks")
    sources = blocks.groupBy("_source").agg(F.sum("block_tokens").alias("source_tokens"))
    total, n_sources = sources.agg(F.sum("source_tokens"), F.count(F.when(F.col("source_tokens") > 0, 1))).first()
    shares = staged(sources.withColumn("share", F.col("source_tokens") / F.lit(float(total or 1))), "mix_shares")
    t = exponent(shares, n_sources, entropy, repeats, budget)
    p = F.pow("share", F.lit(t))
    z, least = shares.where("share > 0").agg(F.sum(p), F.min(p / F.col("share"))).first()
    spend = budget if budget is not None else (z or 1.0) / (least or 1.0)
    weight = F.when(F.col("share") > 0, F.round(p / F.lit(z or 1.0), 9)).otherwise(0.0)
    if budget is None:
        # from the source's own tokens, at least once and at most ``repeats``
        # times: neither rounding nor slack grows with the corpus
        own = F.col("source_tokens")
        goal = F.when(F.col("share") > 0, F.greatest(own, F.floor(F.least(own * (p / F.col("share") / F.lit(least or 1.0)) * (1 + 1e-9), own * F.lit(repeats))))).otherwise(0).cast("long")
    else:
        # half a token of slack, so that rounding cannot cost a whole last document
        goal = F.floor(weight * F.lit(spend * (total or 0)) + 0.5).cast("long")
    plan = shares.withColumn("_weight", weight).withColumn("goal", goal)
    plan = plan.withColumn("full", F.when(F.col("source_tokens") > 0, F.floor(F.col("goal") / F.col("source_tokens"))).otherwise(1).cast("int"))
    plan = plan.withColumn("rest", F.when(F.col("source_tokens") > 0, F.col("goal") - F.col("full") * F.col("source_tokens")).otherwise(0))
    # the last epoch: blocks in its order, at most 16 ** BLOCK_DIGITS a source
    turn = F.md5(F.concat_ws("|", F.lit(seed), F.col("full").cast("string"), F.col("_block")))
    upto = F.sum("block_tokens").over(Window.partitionBy("_source").orderBy("turn", "_block").rowsBetween(Window.unboundedPreceding, 0))
    cut = blocks.join(plan, "_source").withColumn("turn", turn).withColumn("upto", upto)
    cut = cut.select("_source", "_block", "_weight", F.col("full").alias("_full"), (F.col("upto") <= F.col("rest")).alias("_whole"),
                     ((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("block_tokens") < F.col("rest"))).alias("_edge"),
                     (F.col("rest") - (F.col("upto") - F.col("block_tokens"))).alias("_room"))
    # the table of blocks joins the rows: few rows a source, the size is Spark's to judge
    rows = rows.join(cut, ["_source", "_block"])
    again = F.when(F.col("_whole"), F.col("_full") + 1).otherwise(F.col("_full"))
    spent = rows.where(again > 0).withColumn("_epoch", F.explode(F.sequence(F.lit(0), again - 1)))
    order = F.md5(F.concat_ws("|", F.col("_full").cast("string"), F.col("_key")))
    edge = rows.where("_edge").withColumn("_order", order)
    # one block a source: a bounded share of its rows
    sofar = F.sum("_tokens").over(Window.partitionBy("_source").orderBy("_order").rowsBetween(Window.unboundedPreceding, 0))
    edge = edge.withColumn("_sofar", sofar).where(F.col("_sofar") <= F.col("_room")).drop("_order", "_sofar").withColumn("_epoch", F.col("_full"))
    columns = [*docs.columns, "_source", "_epoch", "_block", "_tokens", "_weight"]
    return spent.select(*columns).unionByName(edge.select(*columns))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, to 95 % of the sources' greatest entropy, at most four
    times each, as many tokens as there are."""
    mixed = mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", F.col("_source").alias("source"), F.col("_epoch").alias("epoch"), F.col("_block").alias("block"), F.col("_tokens").alias("n_tokens"), F.round("_weight", 6).alias("weight"))


#: The same in SQL: bisection by recursion, then the budgets and the two cuts.
OP5_SQL = rf"""
WITH RECURSIVE rows_of AS (
  SELECT doc_id, coalesce(source, '') AS source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n,
         md5(concat_ws('|', '{SEED}', coalesce(CAST(doc_id AS VARCHAR), ''), md5(coalesce(text, '')))) AS key
  FROM documents),
shares AS (
  SELECT source, sum(n) AS tokens, sum(n) / (SELECT CAST(sum(n) AS DOUBLE) FROM rows_of) AS p FROM rows_of GROUP BY source),
entropy_cut AS (
  SELECT 0 AS i, CAST(0 AS DOUBLE) AS low, CAST(1 AS DOUBLE) AS high
  UNION ALL
  SELECT i + 1, CASE WHEN e >= goal THEN (low + high) / 2 ELSE low END, CASE WHEN e >= goal THEN high ELSE (low + high) / 2 END
  FROM (SELECT i, any_value(low) AS low, any_value(high) AS high,
               ln(sum(pow(p, (low + high) / 2))) - sum(pow(p, (low + high) / 2) * ln(pow(p, (low + high) / 2))) / sum(pow(p, (low + high) / 2)) AS e,
               {ENTROPY} * ln(count(*)) AS goal
        FROM entropy_cut, shares WHERE p > 0 AND i < 40 GROUP BY i)),
repeat_cut AS (
  SELECT 0 AS i, CAST(0 AS DOUBLE) AS low, CAST(1 AS DOUBLE) AS high
  UNION ALL
  SELECT i + 1, CASE WHEN m > {REPEATS} THEN (low + high) / 2 ELSE low END, CASE WHEN m > {REPEATS} THEN high ELSE (low + high) / 2 END
  FROM (SELECT i, any_value(low) AS low, any_value(high) AS high, max(pow(p, (low + high) / 2) / p) / sum(pow(p, (low + high) / 2)) AS m
        FROM repeat_cut, shares WHERE p > 0 AND i < 40 GROUP BY i)),
first_t AS (SELECT round((low + high) / 2, 6) AS t FROM entropy_cut WHERE i = 40),
final_t AS (
  SELECT CASE WHEN (SELECT count(*) FROM shares WHERE p > 0) < 2 THEN 1.0
              WHEN (SELECT max(pow(p, t) / p) / sum(pow(p, t)) FROM shares WHERE p > 0) > {REPEATS}
              THEN greatest(t, (SELECT round((low + high) / 2, 6) + 1e-6 FROM repeat_cut WHERE i = 40)) ELSE t END AS t
  FROM first_t),
weights AS (
  SELECT source, tokens, CASE WHEN p > 0 THEN round(pow(p, t) / (SELECT sum(pow(p, t)) FROM shares, final_t WHERE p > 0), 9) ELSE 0 END AS w
  FROM shares, final_t),
goals AS (
  SELECT source, tokens, w, CAST(floor(w * (SELECT CAST(sum(tokens) AS DOUBLE) FROM shares) + 0.5) AS BIGINT) AS goal FROM weights),
plan AS (
  SELECT source, w, CASE WHEN tokens > 0 THEN CAST(goal // tokens AS INTEGER) ELSE 1 END AS n_full,
         CASE WHEN tokens > 0 THEN goal % tokens ELSE 0 END AS rest FROM goals),
blocks AS (SELECT source, substr(key, 1, {BLOCK_DIGITS}) AS block, sum(n) AS tokens FROM rows_of GROUP BY ALL),
cut AS (
  SELECT source, block, w, n_full, rest, tokens, sum(tokens) OVER (
           PARTITION BY source ORDER BY md5(concat_ws('|', '{SEED}', CAST(n_full AS VARCHAR), block)), block ROWS UNBOUNDED PRECEDING) AS upto
  FROM blocks JOIN plan USING (source)),
spent AS (
  SELECT r.*, c.block, c.w, c.n_full, c.upto <= c.rest AS is_whole, c.upto > c.rest AND c.upto - c.tokens < c.rest AS is_edge, c.rest - (c.upto - c.tokens) AS room
  FROM rows_of r JOIN cut c ON r.source = c.source AND substr(r.key, 1, {BLOCK_DIGITS}) = c.block)
SELECT doc_id, source, CAST(epoch AS INTEGER) AS epoch, block, n AS n_tokens, round(w, 6) AS weight
FROM (SELECT *, unnest(range(n_full + CASE WHEN is_whole THEN 1 ELSE 0 END)) AS epoch FROM spent)
UNION ALL
SELECT doc_id, source, n_full, block, n, round(w, 6)
FROM (SELECT *, sum(n) OVER (PARTITION BY source ORDER BY md5(concat_ws('|', CAST(n_full AS VARCHAR), key)) ROWS UNBOUNDED PRECEDING) AS sofar FROM spent WHERE is_edge)
WHERE sofar <= room
"""
