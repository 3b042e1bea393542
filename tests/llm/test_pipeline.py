"""The pipeline stage by stage against brute force, on small documents."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from shoplens.llm import crf_lines, order_minhash
from textrows import SCHEMA, empty, make_rows, sentences  # noqa: F401 - fixtures

LABELS = "/root/testdata/sf0.001"
ODD = ["_found", "_copied", "_rid", "_node", "_source", "_block", "_tokens", "_key", "_epoch", "_id", "in_key", "goal", "label"]
WORD = re.compile(r"[^\x20\x09-\x0D]+")
KINDS = [("assign", re.compile(r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A), 6),
         ("access", re.compile(r"AKIA[A-Z0-9]+"), 20), ("hex", re.compile(r"[0-9a-f]+"), 24)]


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.fixture(scope="module")
def stages(spark):
    """The stages' outputs on documents with odd further columns."""
    given = [r for r in make_rows() if r[0] is None or r[0] not in (85, 86)]  # the longest: too slow to align by hand
    df = spark.createDataFrame(given, SCHEMA).repartition(3).withColumns({c: F.lit(c.upper()) for c in ODD})
    out = [df]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], LABELS).checkpoint(eager=True))
    return out


def collected(df):
    return sorted(df.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))


def test_columns_pass_whatever_their_names(stages):
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns
        assert all(r[c] == c.upper() for r in df.select(*ODD).distinct().collect() for c in ODD)


def test_rejected_documents_go(spark, stages):
    verdict = crf_lines.label_lines(stages[0], spark.read.parquet(f"{LABELS}/labels.parquet"))
    kept = Counter(r.doc_id for r in verdict.where("kept").collect())
    assert Counter(r.doc_id for r in stages[1].collect()) == kept
    assert all(len(WORD.findall(r.text)) >= 50 for r in stages[1].collect()) and kept


def test_one_of_each_group_stays(stages):
    before, after = collected(stages[1]), collected(stages[2])
    words = [WORD.findall(r.text) for r in before]
    group = list(range(len(before)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(before)):
        for j in range(i):
            most = max(len(words[i]), len(words[j]))
            if abs(len(words[i]) - len(words[j])) <= 0.2 * most and edits(words[i], words[j]) <= 0.2 * most:
                group[top(i)] = top(j)
    least = defaultdict(list)
    for i, r in enumerate(before):
        least[top(i)].append((r.doc_id is None, r.doc_id))
    assert sorted((r.doc_id is None, r.doc_id) for r in after) == sorted(min(g) for g in least.values())
    assert len(after) < len(before)


def test_secrets_go_and_documents_stay(stages):
    before, after = collected(stages[2]), collected(stages[3])
    assert [r.doc_id for r in before] == [r.doc_id for r in after]
    for old, new in zip(before, after):
        for _, pattern, least in KINDS:
            for m in pattern.finditer(old.text):
                value = m.group(m.lastindex or 0)
                assert len(value) < least or value not in new.text
        assert new.n_chars is None or new.n_chars == len(new.text)
        if not any(p.search(old.text) for _, p, _ in KINDS):
            assert new.text == old.text


def test_every_document_is_spent_and_no_source_too_often(stages):
    before, after = Counter(r.doc_id for r in stages[3].collect()), Counter(r.doc_id for r in stages[4].collect())
    assert set(before) == set(after) and all(after[i] >= n for i, n in before.items())
    size = lambda df: {r.source: r.n for r in df.groupBy("source").agg(F.sum(F.size(F.split(F.trim("text"), "[ \t-\r]+"))).alias("n")).collect()}
    was, now = size(stages[3]), size(stages[4])
    assert all(now[s] <= was[s] * corpus_pipeline.REPEATS + 1 for s in was)


def test_sequences_hold_all_tokens(stages):
    tool = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for r in stages[4].collect():
        want[r.doc_id] += len(tool.encode(r.text, add_special_tokens=False).ids) + 1
    got, rows = Counter(), defaultdict(list)
    for r in stages[5].collect():
        got[r.doc_id] += r.length
        rows[r.sequence_id].append((r.offset, r.length))
    assert got == want
    for pieces in rows.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024


def test_empty_tables_run_through(spark, empty):
    df = empty
    for _, stage in corpus_pipeline.STAGES:
        df = stage(spark, df, LABELS)
    assert df.collect() == []


@pytest.mark.parametrize("texts", [["a b c"], ["a", "b c"], ["", None, "x"], ["one two three four five", "one two"]])
def test_classes_of_very_few_words(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    classes = {r.id: r.class_id for r in order_minhash.near_classes(df).collect()}
    assert set(classes) == set(range(len(texts)))


def test_a_row_with_an_id_stays_before_one_without(spark):
    text = sentences(random.Random(1), 60)
    df = spark.createDataFrame([(None, text), (5, text), (9, text)], "doc_id long, text string")
    assert [r.doc_id for r in order_minhash.one_of_each(df).collect()] == [5]
