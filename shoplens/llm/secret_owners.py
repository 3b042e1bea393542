"""Secret scan with corpus-wide ownership frequency.

Every document is scanned for candidates: assignments, access keys and hex
strings (the base kinds), and tokens that look like keys only by their shape
(``generic``: 20 or more letters and digits mixed, of high entropy). The
candidates' hashes are counted over the whole corpus by distinct repositories
and distinct owners. A value that many owners hold is a copied example; one
held by few owners is owner-specific and counts as live-looking, however many
repositories of theirs repeat it. Generic
candidates are reported only when owner-specific; base spans always stay.

Spans are code points with an exclusive end. Defined cases: null text scans as
empty; repeated rows each get their row and count as one repository; null
repository or owner counts as a value of its own; an empty table gives an
empty result; other columns are ignored. No secret value leaves the scan: only
its SHA-256 does.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.llm.common import map_rows, prepare, set_aside, staged, table, texts_of

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
GENERIC = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
MAX_OWNERS = 2
CANDIDATE = "kind: string, start: bigint, end: bigint, hash: string"


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) of the base kinds, by start, then kind."""
    found = [("assign", m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", m.start(), m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [("hex", m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def looks_random(value: str) -> bool:
    """Letters and digits mixed, with at least 3 bits a character."""
    n = len(value)
    if not (any(c.isdigit() for c in value) and any(c.isalpha() for c in value)):
        return False
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) >= 3


def candidates(text: str) -> list[tuple[str, int, int, str]]:
    """Base spans and the generic ones that overlap none of them; by start."""
    base = base_spans(text)
    more = []
    for m in GENERIC.finditer(text):
        if looks_random(m[0]) and not any(s < m.end() and m.start() < e for _, s, e, _ in base):
            more.append(("generic", m.start(), m.end(), m[0]))
    return sorted(base + more, key=lambda x: (x[1], (*KINDS, "generic").index(x[0])))


def scan(docs: DataFrame, carry: list[str], text_col: str = "text") -> DataFrame:
    """``carry`` columns and ``_found``: the candidates of each row's text."""

    def run(batch):
        found = []
        for t in texts_of(batch, text_col):
            found.append([{"kind": k, "start": s, "end": e, "hash": hashlib.sha256(v.encode()).hexdigest()} for k, s, e, v in candidates(t)])
        return {"_found": found}

    return map_rows(docs.select(*dict.fromkeys([*carry, text_col])), carry, f"_found array<struct<{CANDIDATE}>>", run)


def ownership(found: DataFrame, repo_col: str, owner_col: str) -> DataFrame:
    """(hash, n_repos, n_owners): distinct repositories (within their owner)
    and owners of each candidate. Three aggregates, each combined on the map
    side, so a value copied into a third of all rows meets as few rows."""
    rows = found.select(F.explode("_found.hash").alias("hash"), F.col(repo_col).alias("repo"), F.col(owner_col).alias("owner"))
    by_owner = rows.distinct().groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("repos"))
    return by_owner.groupBy("hash").agg(F.sum("repos").alias("n_repos"), F.count(F.lit(1)).alias("n_owners"))


def judge(found: DataFrame, repo_col: str, owner_col: str, max_owners: int = MAX_OWNERS) -> DataFrame:
    """``found`` with ``live``: each row's candidates with their frequencies and
    the verdict (array of struct kind, start, end, n_repos, n_owners, live)."""
    rows = found.withColumn("_rid", F.monotonically_increasing_id())
    rows = staged(rows, "secret_rows")
    stats = ownership(rows, repo_col, owner_col)
    each = rows.select("_rid", F.explode("_found").alias("c")).select("_rid", "c.*")
    each = each.join(stats, "hash").withColumn("live", F.col("n_owners") <= max_owners)
    # a row has at most its own text's candidates
    spans = each.groupBy("_rid").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end", "n_repos", "n_owners", "live"))).alias("spans"))
    return rows.drop("_found").join(spans, "_rid", "left").drop("_rid")


def _joined(spans, kinds=None):
    """kind:start:end by start, then kind as listed."""
    listed = F.array(*[F.lit(k) for k in (*KINDS, "generic")])
    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], F.array_position(listed, s["kind"]).alias("k"), s["end"], s["kind"], s["live"])))
    keep = F.filter(order, lambda s: s["kind"].isin(*KINDS) | s["live"]) if kinds is None else F.filter(order, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(keep, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", repo_col: str = "doc_id", owner_col: str = "source", text_col: str = "text", max_owners: int = MAX_OWNERS) -> DataFrame:
    """One row per document: counts and spans of the base kinds, all spans, the
    number of live-looking ones, and each candidate's frequencies."""
    prepare(docs.sparkSession)
    carry = list(dict.fromkeys([id_col, repo_col, owner_col]))
    judged = judge(scan(docs, carry, text_col), repo_col, owner_col, max_owners)
    spans = F.coalesce("spans", F.array().cast("array<struct<start:bigint,kind:string,end:bigint,n_repos:bigint,n_owners:bigint,live:boolean>>"))
    judged = judged.withColumn("spans", spans)
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return judged.select(
        id_col,
        *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(_joined(F.col("spans"), KINDS), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["live"])).cast("long").alias("n_live"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["n_owners"])), F.lit(0)).alias("most_owners"),
    )


def mask(docs: DataFrame, repo_col: str = "doc_id", owner_col: str = "source", text_col: str = "text", max_owners: int = MAX_OWNERS) -> DataFrame:
    """``docs`` with every reported span replaced by ``[kind]``; all rows and
    columns stay, whatever their names. Only rows with a generic candidate are joined to the corpus
    frequencies; the others are settled where they are read."""
    prepare(docs.sparkSession)
    docs, named_back = set_aside(docs)
    stats = ownership(staged(scan(docs, list(dict.fromkeys([repo_col, owner_col])), text_col).where(F.size("_found") > 0), "secret_found"), repo_col, owner_col)
    copied = stats.where(F.col("n_owners") > max_owners).select("hash")
    copied = staged(copied, "secret_copied")
    names = docs.columns
    rows = scan(docs, names, text_col)
    generic = F.exists("_found", lambda c: c["kind"] == "generic")
    none = F.array().cast("array<string>")
    open_rows = rows.where(generic).withColumn("_rid", F.xxhash64(*names))
    pairs = open_rows.select("_rid", F.explode(F.filter("_found", lambda c: c["kind"] == "generic")["hash"]).alias("hash")).distinct()
    known = pairs.join(copied, "hash").groupBy("_rid").agg(F.collect_set("hash").alias("_copied"))
    open_rows = open_rows.join(known, "_rid", "left").withColumn("_copied", F.coalesce("_copied", none)).drop("_rid")

    def run(batch):
        found, known = (batch.column(batch.schema.get_field_index(n)).to_pylist() for n in ("_found", "_copied"))
        texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
        return {text_col: [t and masked(t, f, set(k)) for t, f, k in zip(texts, found, known, strict=True)]}

    out = map_rows(rows.where(~generic).withColumn("_copied", none).unionByName(open_rows), names, f"`{text_col}` string", run)
    return named_back(out)


def masked(text: str, found: list[dict], copied: set[str]) -> str:
    """``text`` with each reported span as ``[kind]``; overlapping ones merge."""
    parts, at = [], 0
    for c in found:
        if c["kind"] == "generic" and c["hash"] in copied:
            continue
        if c["start"] >= at:
            parts += [text[at : c["start"]], f"[{c['kind']}]"]
        at = max(at, c["end"])
    return "".join(parts) + text[at:]


def op10_secret_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; a document is a repository, its source the owner."""
    return find_secrets(table(spark, sf_dir, "documents"))
