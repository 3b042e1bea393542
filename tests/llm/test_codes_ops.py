"""Vector codes, Merkle manifest and piece encoding against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shoplens.llm import orchard_codes, piece_rounds, shift_merkle
from textrows import docs, empty, rows  # noqa: F401 - fixtures

# 11 ------------------------------------------------------------ vector codes

VECTORS = "vec_id long, embedding array<float>, label int, code string, rid int"


def nearest(x, entries):
    d = [sum((int(a) - int(b)) ** 2 for a, b in zip(x, e)) for e in entries]
    best = min(d)
    return d.index(best), best


def plain_codes(vectors, k=16, rounds=6):
    """{row number: (code, error)} and codebooks, one row at a time."""
    ints = [[math.floor(4096 * float(np.float32(x))) for x in v] for v in vectors]
    w = len(ints[0]) // 8
    cut = [[v[p * w : (p + 1) * w] for p in range(8)] for v in ints]
    books = [[cut[i][p] for i in range(min(k, len(cut)))] for p in range(8)]
    for r in range(rounds + 1):
        found = [[nearest(v[p], books[p]) for p in range(8)] for v in cut]
        if r < rounds:
            for p in range(8):
                for e in range(len(books[p])):
                    mine = [cut[i][p] for i in range(len(cut)) if found[i][p][0] == e]
                    if mine:
                        books[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    return [("".join(f"{e:02x}" for e, _ in f), sum(d for _, d in f)) for f in found], books


def test_vector_codes_match_brute_force(spark):
    rng = random.Random(3)
    rows = []
    for i in range(150):
        v = [rng.gauss(0, 1) for _ in range(32)]
        rows.append((i * 3 - 20, v, i % 4 if i % 9 else None, "x", 1))
    for i in range(40):  # ties and repeated vectors
        rows.append((1000 + i, [float(rng.randint(-1, 1)) for _ in range(32)], 9, "x", 1))
    rows += [(2000 + i, [0.5] * 32, 9, "x", 1) for i in range(30)]
    dropped = [(-100, None, 1, "x", 1), (-99, [1.0] * 31 + [None], 1, "x", 1), (-98, [float("nan")] * 32, 1, "x", 1),
               (-97, [1.0] * 31 + [float("-inf")], 1, "x", 1)]
    other = [(-96, [1.0] * 24, 1, "x", 1), (-95, [], 1, "x", 1)]
    df = spark.createDataFrame(rows + dropped + other, VECTORS).repartition(3)
    coded, books = orchard_codes.encode(df)
    got = {r.vec_id: (r.code, r.error, r.label) for r in coded.collect()}
    want, want_books = plain_codes([r[1] for r in rows])
    assert {i for i, *_ in rows + other} == set(got)
    assert {r[0]: (c, e, r[2]) for r, (c, e) in zip(rows, want)} == {k: v for k, v in got.items() if k not in (-96, -95)}
    assert got[-96][:2] == got[-95][:2] == (None, None)
    assert books.tolist() == want_books


def test_vector_codes_of_few_rows_and_none(spark):
    df = spark.createDataFrame([], VECTORS)
    coded, books = orchard_codes.encode(df)
    assert coded.collect() == [] and books is None and orchard_codes.digest(books) is None
    one = spark.createDataFrame([(None, [1.0] * 8, None, "x", 1), (None, [1.0] * 8, None, "x", 1)], VECTORS)
    coded, books = orchard_codes.encode(one)
    assert [(r.vec_id, r.code, r.error) for r in coded.collect()] == [(None, "00" * 8, 0)] * 2
    assert books.shape == (8, 2, 1)
    with pytest.raises(Exception, match="too large"):
        orchard_codes.encode(spark.createDataFrame([(1, [1e30] * 8, 1, "x", 1)], VECTORS))


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 20), st.integers(1, 4), st.integers(1, 6), st.integers(0, 2**32))
def test_orchard_search_is_exact(k, width, spread, seed):
    rng = np.random.default_rng(seed)
    entries = rng.integers(-spread, spread + 1, (k, width))
    x = rng.integers(-spread, spread + 1, (50, width))
    at, d = orchard_codes.Codebook(entries).search(x)
    assert list(zip(at.tolist(), d.tolist())) == [nearest(v, entries.tolist()) for v in x.tolist()]


def test_orchard_search_skips_far_entries():
    """Beyond twice the current distance nothing is computed: far entries stay unvisited."""
    entries = np.array([[0], [1], [100], [200], [300]])
    book, asked = orchard_codes.Codebook(entries), []

    class Watched(np.ndarray):
        def __getitem__(self, i):
            asked.extend(np.atleast_1d(i).tolist() if not isinstance(i, tuple) else [])
            return np.asarray(self)[i]

    book.entries = entries.view(Watched)
    at, _ = book.search(np.array([[0], [1]]))
    assert at.tolist() == [0, 1] and not {2, 3, 4} & set(asked)


# 12 -------------------------------------------------------- Merkle manifest

H = lambda s: hashlib.sha256(s.encode()).hexdigest()


def plain_tree(nodes):
    """Root and, per node, its siblings level by level as (before, after)."""
    paths = [[] for _ in nodes]
    level, of = list(nodes), list(range(len(nodes)))
    while len(level) > 1:
        for i, at in enumerate(of):
            run = level[at // 8 * 8 : at // 8 * 8 + 8]
            paths[i].append(("".join(run[: at % 8]), "".join(run[at % 8 + 1 :])))
        level = [H("".join(level[i : i + 8])) for i in range(0, len(level), 8)]
        of = [at // 8 for at in of]
    return level[0], paths


def plain_manifest(rows, shown=lambda i, t: t):
    def leaf(i, t, lang, source, n):
        return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, t)))

    langs = {}
    for i, t, lang, source, n in rows:
        langs.setdefault(lang, []).append((i, leaf(i, t, lang, source, n), leaf(i, shown(i, t), lang, source, n)))
    order = sorted(langs, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        langs[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    trees = {g: plain_tree([x[1] for x in langs[g]]) for g in order}
    root, top = plain_tree([trees[g][0] for g in order])
    out = []
    for g, above in zip(order, top):
        for (i, h, s), path in zip(langs[g], trees[g][1]):
            hops = path + above
            folded = s
            for a, b in hops:
                folded = H(a + folded + b)
            out.append((i, h, trees[g][0], root, H("".join(a + b for a, b in hops)), folded))
    return out


def _key(t):
    return tuple("" if x is None else str(x) for x in t)


def manifest_rows(df, tampered=None):
    got = shift_merkle.manifest(df, tampered)
    proof = F.sha2(F.array_join(F.transform("hops", lambda h: F.concat(h["before"], h["after"])), ""), 256)
    return sorted((tuple(r) for r in got.select("doc_id", "leaf", "subroot", "root", proof, "folded_root").collect()), key=_key)


def test_manifest_matches_brute_force(docs, rows):
    picked = lambda i: i is not None and zlib.crc32(str(i).encode()) % 3 == 0
    lower = lambda t: t and t.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    want = sorted(plain_manifest(rows, lambda i, t: lower(t) if picked(i) else t), key=_key)
    text = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(F.col("text"))
    got = manifest_rows(docs, {"text": text})
    assert got == want
    assert any(r[5] != r[3] for r in got) and any(r[5] == r[3] for r in got)


@pytest.mark.parametrize("sizes", [[1], [8], [9], [1, 1], [64, 65, 1, 7], [600] + [1] * 20])
def test_manifest_of_tree_shapes(spark, sizes):
    rows = [(i * 7, f"Text {i}", f"g{g:02}" if g else None, "s", i) for g, n in enumerate(sizes) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    got = manifest_rows(df)
    assert got == sorted(plain_manifest(rows), key=_key)
    assert all(r[5] == r[3] for r in got)


def test_manifest_of_repeated_rows_and_none(spark, empty):
    assert shift_merkle.manifest(empty).collect() == []
    rows = [(None, None, None, None, None)] * 9 + [(5, "Same", "en", "s", 1)] * 70
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    df = df.withColumns({c: F.lit("clash") for c in ("tree", "idx", "n", "hash", "hops", "up", "at", "split", "root", "leaf")})
    assert manifest_rows(df) == sorted(plain_manifest(rows), key=_key)


# 13 ------------------------------------------------------- piece encoding

_PIECES = piece_rounds.load()
_TEXT = st.text(alphabet=st.sampled_from(list("theHEinguzo 1'. \n\t\x00é中😀　▁")) | st.characters(codec="utf-8"), max_size=80)


@settings(max_examples=300, deadline=None)
@given(st.lists(_TEXT, max_size=5))
def test_pieces_are_the_librarys(texts):
    ids = _PIECES.encode(texts)
    assert ids.to_pylist() == _PIECES.tool.encode(texts)
    assert _PIECES.decode(ids) == [_PIECES.tool.decode(x) if x else "" for x in ids.to_pylist()]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 260) | st.integers(0, 31999), max_size=12), max_size=4))
def test_any_ids_decode_as_in_the_library(ids):
    assert _PIECES.decode(pa.array(ids, pa.list_(pa.int32()))) == [_PIECES.tool.decode(x) if x else "" for x in ids]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="thezuinga", min_size=2, max_size=400))
def test_rounds_and_queue_merge_alike(text):
    """Words without a cut, where a merge often makes a better pair."""
    sym = _PIECES.symbol[piece_rounds._points(text)]
    rounds, _ = _PIECES.merge_all(sym, np.zeros(len(sym), np.int64))
    assert rounds.tolist() == _PIECES.merge_queue(sym).tolist()


def test_long_words_and_texts():
    rng = random.Random(2)
    texts = ["x" * 50_000, "the" * 2000, " " * 9001, "".join(rng.choices("abcdefghijklmnopqrstuvwxyzABCDEF0123456789+/", k=30_000)), "a word " * 40_000]
    assert _PIECES.encode(texts).to_pylist() == _PIECES.tool.encode(texts)


def test_pieces_of_a_table(docs, rows, empty):
    got = piece_rounds.encode(docs, keep=("doc_id", "n_tokens"), round_trip=True)
    seen = sorted(((r.doc_id, tuple(r.ids), r.decoded) for r in got.collect()), key=_key)
    tool = _PIECES.tool
    want = sorted(((i, tuple(tool.encode(t or "")), tool.decode(tool.encode(t or ""))) for i, t, *_ in rows), key=_key)
    assert seen == want
    again = sorted(((r.doc_id, r.decoded) for r in piece_rounds.decode(got.select("doc_id", "ids", F.lit(1).alias("decoded"))).collect()), key=_key)
    assert again == sorted(((i, d) for i, _, d in want), key=_key)
    assert piece_rounds.encode(empty, round_trip=True).collect() == []
