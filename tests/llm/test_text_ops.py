"""The operators on documents against brute force."""

from __future__ import annotations

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shoplens.llm import common, crf_lines, lm_mix, mixing, order_minhash, pattern_pack, secret_owners, syncmers, token_cache
from shoplens.session import work_path
from textrows import docs, empty, rows  # noqa: F401 - fixtures

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(t):
    return WORD.findall(t or "")


# 1 ---------------------------------------------------------------- scoring


def with_held(df):
    from pyspark.sql import functions as F

    return df.withColumn("_h", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 == 0, F.lit(False)))


def test_scores_base_figures_and_gain(spark, docs, rows):
    got = defaultdict(list)
    for r in lm_mix.score_texts(with_held(docs), "_h", "lang").collect():
        got[r.doc_id].append(r)
    assert sum(map(len, got.values())) == len(rows)
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    lower = lambda t: (t or "").encode().lower().decode()
    count = Counter()
    for i, t, *_ in rows:
        if not held(i):
            count.update([*words(lower(t)), "\n"])
    n, v = sum(count.values()), len(count)
    for i, t, *_ in rows:
        w = [*words(lower(t)), "\n"]
        base = sum(math.log10((count[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        r = min(got[i], key=lambda r: abs(r.base_score - base))
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(i), len(w), sum(count[x] > 0 for x in w), n)
        assert r.score < 0 and math.isfinite(r.score) and r.bits_per_byte > 0


def test_word_probabilities_add_up():
    """Over all words of two letters, ends included, the spelling model gives
    no more than one."""
    rng = random.Random(0)
    letters = "abcd"
    train = ["".join(rng.choices(letters, k=rng.randint(1, 4))) for _ in range(300)]
    train = sorted(set(train))
    counts = np.zeros((2, 1 << lm_mix.TABLE_BITS), np.float32)
    lm_mix.count_bits([lm_mix.coded(w) for w in train], counts)
    mixer = lm_mix.Mixer(counts)
    mixer.learn([lm_mix.coded(w) for w in train])
    every = [bytes(x) for k in (1, 2) for x in _all(range(256), k)]
    closed = [w + b" " for w in every if b" " not in w]
    total = np.power(10.0, mixer.score(closed)).sum()
    assert total <= 1 + 1e-6
    known = [w for w in train if len(w) <= 2]
    assert np.power(10.0, mixer.score([lm_mix.coded(w) for w in known])).sum() > 0.05


def _all(symbols, k):
    return [()] if k == 0 else [(s, *rest) for s in symbols for rest in _all(symbols, k - 1)]


def test_batches_of_words_score_alike():
    counts = np.zeros((2, 1 << lm_mix.TABLE_BITS), np.float32)
    some = [lm_mix.coded(w) for w in ["alpha", "beta", "gammaray", "ü", "x" * 100_000]]
    lm_mix.count_bits(some, counts)
    mixer = lm_mix.Mixer(counts)
    together = mixer.score(some)
    assert np.allclose(together, [mixer.score([w])[0] for w in some])


def test_scores_of_no_documents_and_no_training(spark, empty):
    assert lm_mix.score_texts(with_held(empty), "_h", "lang").collect() == []
    from pyspark.sql import functions as F

    one = spark.createDataFrame([(1, "a b", "en")], "doc_id long, text string, lang string").withColumn("_h", F.lit(True))
    (r,) = lm_mix.score_texts(one, "_h", "lang").collect()
    assert r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score)


def test_word_order_and_words_before_count(spark):
    """Held-out texts of the same words: the order of the training texts is
    likelier, so contexts reach over word ends."""
    rng = random.Random(1)
    pairs = [("red", "fish"), ("blue", "bird"), ("old", "tree"), ("new", "road"), ("big", "house"), ("wet", "stone")]
    texts = [" ".join(" ".join(p) for p in rng.choices(pairs, k=30)) for _ in range(60)]
    order = [p for _ in range(5) for p in pairs]
    known = " ".join(f"{a} {b}" for a, b in order)
    other = " ".join([a for a, _ in order] + [b for _, b in order])
    data = [(k, t, "en", False) for k, t in enumerate(texts)] + [(100, known, "en", True), (101, other, "en", True)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, _h boolean")
    score = {r.doc_id: (r.score, r.base_score) for r in lm_mix.score_texts(df, "_h", "lang").where("doc_id >= 100").collect()}
    assert score[100][1] == pytest.approx(score[101][1])
    assert score[100][0] > score[101][0] + 10
    assert score[100][0] > score[100][1] + 10  # 60 words, of which each second one follows from the first


def _text_mixer(bits):
    rng = np.random.default_rng(3)
    code = lm_mix.Code(rng.integers(0, 50, (12, 3)).astype(float), np.array([4.0, 2.0, 1.0]))
    sizes = rng.integers(2, 20, 40)
    numbers = rng.integers(2, 12, sizes.sum())
    numbers[::7] = -5  # a word outside the vocabulary
    numbers[np.cumsum(sizes) - 1] = lm_mix.STOP
    seen = np.zeros((2, 1 << lm_mix.SEEN_BITS))
    for k, c in enumerate(code.contexts(numbers, sizes)[1:]):
        seen[k] += np.bincount(lm_mix.seen_slot(c), minlength=seen.shape[1])
    used = lm_mix.in_table(seen, bits)
    counts = np.zeros((2, 1 << bits), np.uint32)
    lm_mix.count_decisions(code, used, numbers, sizes, counts)
    mixer = lm_mix.TextMixer(code, used, lm_mix.paired(counts))
    mixer.learn_texts(numbers, sizes)
    return mixer, numbers, sizes


@pytest.mark.parametrize("bits", [6, 9, 16])
def test_token_probabilities_add_up(bits):
    """After any start, the tokens' probabilities add up to one, also where the
    table is too small for all contexts."""
    mixer, *_ = _text_mixer(bits)
    for start in ([2], [5, 7], [-5, 3, 3]):
        each = np.array([[*start, x] for x in range(12)])
        scores = mixer.score_texts(each.ravel(), np.full(12, len(start) + 1))
        alone = mixer.score_texts(np.array(start), np.array([len(start)]))
        assert np.power(10.0, scores).sum() == pytest.approx(10 ** alone[0], rel=1e-6)


def test_texts_score_alike_alone_and_together():
    mixer, numbers, sizes = _text_mixer(16)
    ends = np.cumsum(sizes)
    alone = [mixer.score_texts(numbers[e - n : e], np.array([n]))[0] for n, e in zip(sizes, ends)]
    assert np.allclose(mixer.score_texts(numbers, sizes), alone)


def test_frequent_contexts_fit_the_table():
    seen = np.zeros((2, 1 << lm_mix.SEEN_BITS))
    seen[0, :10] = 1000
    seen[0, 10:5000] = 1
    used = lm_mix.in_table(seen, 16)
    assert used[0, :10].all() and not used[0, 10:].any() and not used[1].any()  # 4,990 of one more do not fit
    assert lm_mix.in_table(seen, 20)[0, :5000].all()
    assert (lm_mix.paired(np.array([[0, 200_000], [3, 100_000]], np.uint32)) == [3 << 16, 65535 | (32768 << 16)]).all()


# 3 ----------------------------------------------------------- near copies


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(row[j] + 1, now[-1] + 1, row[j - 1] + (x != y)))
        row = now
    return row[-1]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=14), st.lists(st.integers(0, 4), max_size=14), st.integers(0, 9))
def test_banded_edits(a, b, most):
    assert order_minhash.banded_edits(a, b, most) == min(edits(a, b), most + 1)


def brute_classes(rows):
    """Components of all pairs with an edit similarity of 0.8 or more."""
    texts = [words(t) for _, t, *_ in rows]
    head = list(range(len(rows)))

    def root(k):
        while head[k] != k:
            k = head[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            n = max(len(texts[a]), len(texts[b]))
            if abs(len(texts[a]) - len(texts[b])) <= 0.2 * n and root(a) != root(b):
                most = int(0.2 * n + 1e-9)
                common = sum((Counter(texts[a]) & Counter(texts[b])).values())
                if n - common <= most and (texts[a] == texts[b] or edits(texts[a], texts[b]) <= most):
                    head[root(a)] = root(b)
    groups = defaultdict(list)
    for k in range(len(rows)):
        groups[root(k)].append(k)
    return list(groups.values())


def test_near_classes(spark, docs, rows):
    got = order_minhash.near_classes(docs).collect()
    assert len(got) == len(rows)
    by = defaultdict(list)
    for r in got:
        by[r.label].append(r.id)
    key = lambda g: sorted(g, key=str)
    want = sorted((key([rows[k][0] for k in g]) for g in brute_classes(rows)), key=str)
    assert sorted((key(g) for g in by.values()), key=str) == want
    for r in got:
        ids = [i for i in by[r.label] if i is not None]
        assert r.class_id == (min(ids) if ids else None) and r.class_size == len(by[r.label])


def test_one_of_each(spark, docs, rows, empty):
    got = order_minhash.one_of_each(docs)
    assert got.columns == docs.columns
    kept = [r.doc_id for r in got.collect()]
    assert len(kept) == len(brute_classes(rows))
    for g in brute_classes(rows):
        ids = [rows[k][0] for k in g]
        assert sum(kept.count(i) for i in set(ids)) == 1
    assert order_minhash.one_of_each(empty).collect() == []


def test_many_near_copies_and_a_shared_passage(spark):
    """Buckets with hundreds of near copies, and with texts that only share a
    passage, which must stay apart."""
    rng = random.Random(2)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    passage = " ".join(f"p{k}" for k in range(60))
    rows = []
    for k in range(150):
        w = list(base)
        w[rng.randrange(len(w))] = f"own{k}"
        rows.append((k, " ".join(w)))
    rows += [(k, " ".join(f"q{rng.randrange(10_000)}" for _ in range(70)) + " " + passage) for k in range(150, 300)]
    got = order_minhash.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    sizes = Counter(r.label for r in got)
    assert sorted(sizes.values())[-1] == 150 and len(sizes) == 151


# 4 ------------------------------------------------------------ token counts


def test_token_counts_and_cache(spark, docs, rows):
    import sentencepiece

    tool = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    cache = work_path(spark, "cache")
    some = docs.where("doc_id < 30")
    token_cache.count_tokens(some, cache).collect()
    first = token_cache.read_cache(spark, cache).count()
    got = token_cache.count_tokens(docs, cache).collect()
    texts = {t or "" for _, t, *_ in rows}
    cached = token_cache.read_cache(spark, cache)
    assert first == len({t for i, t, *_ in rows if i is not None and i < 30} - {None} | {""} - ({""} if not any(i is not None and i < 30 and not t for i, t, *_ in rows) else set()))
    assert cached.count() == len(texts) == cached.select("digest").distinct().count()
    want = sorted(((i, len((t or "").encode()), len(tool.encode(t or ""))) for i, t, *_ in rows), key=str)
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in got), key=str) == want
    assert all(r.over_limit == (r.n_tokens > 4096) for r in got)
    # another version of the tokenizer has counts of its own
    other = token_cache.count_tokens(some, cache, model="byte_bpe_50k.json")
    assert other.count() == some.count() and token_cache.read_cache(spark, cache).select("tokenizer").distinct().count() == 2


def test_token_counts_of_no_documents(spark, empty):
    assert token_cache.count_tokens(empty, work_path(spark, "cache")).collect() == []


# 5 ----------------------------------------------------------------- mixing


def mixed_by_hand(rows, entropy, repeats, budget, seed):
    tokens, blocks = Counter(), defaultdict(Counter)
    items = []
    for i, t, _, s, *_ in rows:
        key = hashlib.md5("|".join([seed, "" if i is None else str(i), hashlib.md5((t or "").encode()).hexdigest()]).encode()).hexdigest()
        items.append((i, s or "", len(words(t)), key, key[:3]))
        tokens[s or ""] += len(words(t))
        blocks[s or ""][key[:3]] += len(words(t))
    total = sum(tokens.values())
    share = {s: n / total for s, n in tokens.items()}
    live = {s: p for s, p in share.items() if p > 0}

    def weights(t):
        z = sum(p**t for p in live.values())
        return {s: p**t / z for s, p in live.items()}

    def bisect(holds):
        low, high = 0.0, 1.0
        for _ in range(60):
            mid = (low + high) / 2
            low, high = (mid, high) if holds(weights(mid)) else (low, mid)
        return round((low + high) / 2, 6)

    t = bisect(lambda w: -sum(x * math.log(x) for x in w.values()) >= entropy * math.log(len(live)))
    ratio = lambda w: [w[s] / live[s] for s in live]
    most = lambda w: max(ratio(w)) * budget if budget is not None else max(ratio(w)) / min(ratio(w))
    if most(weights(t)) > repeats:
        t = max(t, bisect(lambda w: most(w) > repeats) + 1e-6)
    w = weights(t)
    spend = budget if budget is not None else 1 / min(ratio(w))
    out = []
    for s in tokens:
        goal = math.floor(round(w.get(s, 0), 9) * spend * total + (1e-6 * total if budget is None else 0.5))
        full = goal // tokens[s] if tokens[s] else 1
        rest = goal - full * tokens[s] if tokens[s] else 0
        mine = [x for x in items if x[1] == s]
        for e in range(full):
            out += [(i, s, e) for i, *_ in mine]
        turn = sorted(blocks[s], key=lambda b: (hashlib.md5(f"{seed}|{full}|{b}".encode()).hexdigest(), b))
        for b in turn:
            inside = [x for x in mine if x[4] == b]
            if blocks[s][b] <= rest:
                out += [(i, s, full) for i, *_ in inside]
                rest -= blocks[s][b]
            else:
                if rest > 0:
                    used = 0
                    for x in sorted(inside, key=lambda x: hashlib.md5(f"{full}|{x[3]}".encode()).hexdigest()):
                        used += x[2]
                        if used <= rest:
                            out.append((x[0], s, full))
                break
    return sorted(out, key=str), t


@pytest.mark.parametrize("entropy, repeats, budget", [(0.95, 4.0, 1.0), (0.99, 1.3, 1.0), (0.9, 1.5, None), (0.5, 9.0, 2.5)])
def test_mixing_against_hand_made(spark, docs, rows, entropy, repeats, budget):
    got = mixing.mix(docs, entropy, repeats, budget)
    assert set(docs.columns) <= set(got.columns)
    got = got.collect()
    want, _ = mixed_by_hand(rows, entropy, repeats, budget, mixing.SEED)
    assert sorted(((r.doc_id, r._source, r._epoch) for r in got), key=str) == want
    if budget is None:
        assert Counter(r.doc_id for r in got).keys() == {i for i, *_ in rows}


def test_mixing_of_no_documents(spark, empty):
    assert mixing.mix(empty).collect() == []
    one = spark.createDataFrame([(1, "a b c", "s")], "doc_id long, text string, source string")
    assert [r._epoch for r in mixing.mix(one).collect()] == [0]


# 7 ----------------------------------------------------------- line labels


def base_figures(t):
    t, w = t or "", words(t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(zip(w, w[1:], w[2:], strict=False))
    hit = {k + j for k in range(len(w) - 2) if windows[w[k], w[k + 1], w[k + 2]] > 1 for j in range(3)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(hit), len(w) < 50 or 100 * len(hit) > 50 * len(w))


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(k, 1) for k in range(60)] + [(87, 0), (None, 1), (85, None)], "doc_id long, quality int")


def test_line_labels_base_figures(spark, docs, rows, labels):
    got = crf_lines.label_lines(docs, labels).collect()
    figure = lambda r: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
    assert sorted(((r.doc_id, *figure(r)) for r in got), key=str) == sorted(((i, *base_figures(t)) for i, t, *_ in rows), key=str)
    assert not any(r.base_failed and r.kept for r in got)
    assert all(r.kept for r in got if r.doc_id is not None and 0 <= r.doc_id < 66)


def test_kept_rows_keep_their_columns(spark, docs, labels, empty):
    got = crf_lines.keep_good(docs, labels)
    assert got.columns == docs.columns and got.first()["kept"] == "clash"
    assert crf_lines.keep_good(empty, labels).collect() == []
    assert crf_lines.label_lines(docs, labels.limit(0)).where("kept").count() > 0


def test_line_labels_held_out_accuracy(spark):
    """Trained on half the labelled documents, right on the other half."""
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    field = crf_lines.train(*crf_lines.sample(docs, labels.where("doc_id % 2 = 0")))
    got = crf_lines.judged(docs, field, ["doc_id"]).join(labels.where("doc_id % 2 = 1"), "doc_id").where("not base_failed").collect()
    right = sum(r.kept == bool(r.quality) for r in got)
    assert len(got) > 100 and right >= 0.97 * len(got)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 5), min_size=1, max_size=4), st.integers(0, 10_000))
def test_viterbi_against_all_labellings(lengths, seed):
    rng = np.random.default_rng(seed)
    n, k = sum(lengths), len(crf_lines.BINS)
    features = rng.integers(0, crf_lines.OFFSETS[-1], (n, k))
    field = crf_lines.Field(rng.normal(size=(int(crf_lines.OFFSETS[-1]), 2)), rng.normal(size=(2, 2)))
    got = field.decode(features, np.array(lengths))
    score, at = field.scores(features), 0
    for length in lengths:
        value = lambda y, at=at: sum(score[at + i, b] for i, b in enumerate(y)) + sum(field.pair[a, b] for a, b in zip(y, y[1:], strict=False))
        best = max(_all((0, 1), length), key=value)
        assert value(tuple(got[at : at + length])) == pytest.approx(value(best))
        at += length


def test_gradient_of_the_line_field():
    rng = np.random.default_rng(3)
    lengths, k = np.array([3, 1, 4]), len(crf_lines.BINS)
    features = rng.integers(0, crf_lines.OFFSETS[-1], (8, k))
    label = rng.integers(0, 2, 8)
    field = crf_lines.Field(rng.normal(size=(int(crf_lines.OFFSETS[-1]), 2)) * 0.3, rng.normal(size=(2, 2)))

    def likelihood():
        score, total, at = field.scores(features), 0.0, 0
        for n in lengths:
            value = lambda y, at=at: sum(score[at + i, b] for i, b in enumerate(y)) + sum(field.pair[a, b] for a, b in zip(y, y[1:], strict=False))
            total += value(tuple(label[at : at + n])) - np.logaddexp.reduce([value(y) for y in _all((0, 1), int(n))])
            at += n
        return total

    line, pair = field.slopes(features, lengths, label)
    for weights, slope in ((field.line, line), (field.pair, pair)):
        for at in list(np.ndindex(weights.shape))[:40]:
            weights[at] += 1e-5
            up = likelihood()
            weights[at] -= 2e-5
            down = likelihood()
            weights[at] += 1e-5
            assert slope[at] == pytest.approx((up - down) / 2e-5, abs=1e-4)


# 8 ------------------------------------------------------------- syncmers


def test_fingerprints(spark, docs, rows, empty):
    got = syncmers.fingerprints(docs).collect()
    key = lambda x: (x[0] is not None, x[0] or 0)
    assert len(got) == len(rows)
    by_text = defaultdict(set)
    texts = defaultdict(list)
    for i, t, *_ in rows:
        texts[i].append(t or "")
    ids = sorted(texts, key=lambda i: key((i,)))
    for r in got:
        same = texts[r.doc_id]
        at = ids.index(r.doc_id)
        after = {*texts[ids[(at + 1) % len(ids)]], *(same if len(same) > 1 else ())}
        wanted = {hashlib.sha256((t[: len(t) - len(t) // 4] + n[: len(t) // 4]).encode()).hexdigest() for t in same for n in after}
        assert r.edited_sha256 in wanted and r.n_chars in map(len, same)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if len(same) == 1:
            by_text[same[0]].add(r.fingerprint)
    assert all(len(v) == 1 for v in by_text.values())
    assert syncmers.fingerprints(empty).collect() == []


def test_anchors_depend_on_their_run_alone(spark):
    from pyspark.sql import functions as F

    rng = random.Random(1)
    middle = " ".join(f"m{rng.randrange(99)}" for _ in range(60))
    rows = [(1, middle), (2, "other words first " + middle + "  and\nsome after"), (3, "short text"), (4, "")]
    got = {r.i: r.a for r in spark.createDataFrame(rows, "i int, t string").select("i", syncmers.anchors(F.col("t")).alias("a")).collect()}
    assert got[1] == [a for a in got[2] if a in set(got[1])] and len(got[1]) >= 8
    assert len(got[3]) == 1 and got[4] == []


# 9 -------------------------------------------------------------- packing


def test_packing_round_trip(spark, docs, rows):
    from tokenizers import Tokenizer

    tool = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = pattern_pack.pack(docs).collect()
    want = Counter()
    total = 0
    for i, t, *_ in rows:
        ids = np.array([*tool.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        total += len(ids)
        first = len(ids) % 1024 or 1024
        cuts = [0, *range(first, len(ids), 1024), len(ids)]
        for p, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want[i, p, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(by) <= math.ceil(total / 1024) * 1.1 + 2


def test_packing_of_no_documents(spark, empty):
    assert pattern_pack.pack(empty).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aTé中1'! \n\t\r\x0b\x1c\x85 ᠎​　﻿😀")) | st.characters(codec="utf-8"), max_size=40))
def test_runs_are_tokenized_as_the_whole(text):
    for coder in (_CODER, _SLOW):
        (ids,) = coder.encode([text])
        assert list(ids) == list(coder.whole(text))


_CODER, _SLOW = pattern_pack.RunCoder(), pattern_pack.RunCoder(ranks=None)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 64), st.integers(1, 40)), min_size=1, max_size=30))
def test_plan_uses_every_piece_once(pieces):
    hist = np.zeros(65, np.int64)
    for length, n in pieces:
        hist[length] += n
    plan = pattern_pack.plan(hist, 64)
    used = np.zeros(65, np.int64)
    for p, n in plan:
        assert sum(p) <= 64 and n > 0
        for v in p:
            used[v] += n
    assert (used == hist).all()
    slots = pattern_pack.slots(plan)
    for v in np.flatnonzero(hist):
        mine = sorted((a, b) for x, a, b, *_ in slots if x == v)
        assert mine[0][0] == 0 and mine[-1][1] == hist[v] and all(x[1] == y[0] for x, y in zip(mine, mine[1:], strict=False))


def test_patterns_fill_a_known_histogram():
    """Counts made from three patterns are fitted without waste."""
    hist = np.zeros(1025, np.int64)
    for p, n in (((700, 324), 50), ((512, 300, 212), 40), ((900, 100, 24), 30)):
        for v in p:
            hist[v] += n
    assert sum(n for _, n in pattern_pack.plan(hist, 1024)) <= 124


# 10 -------------------------------------------------------------- secrets


def base_by_hand(t):
    letters = lambda x: "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in x)
    keys = "|".join(letters(x) for x in ("password", "passwd", "secret", "token", "api_?key"))
    found = [(m.start(), 0, m.end(), "assign") for m in re.finditer(rf"""({keys})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24]
    return [f"{k}:{a}:{b}" for a, _, b, k in sorted(found)]


def test_secrets(spark, docs, rows, empty):
    got = secret_owners.find_secrets(docs).collect()
    figure = lambda t: hashlib.sha256(",".join(base_by_hand(t or "")).encode()).hexdigest()
    assert sorted(((r.doc_id, r.base_sha256) for r in got), key=str) == sorted(((i, figure(t)) for i, t, *_ in rows), key=str)
    spans = {r.doc_id: r.spans for r in got}
    assert spans[88].split(",") == base_by_hand(dict((r[0], r[1]) for r in rows)[88])
    # the value of four owners is an example; the one of a single owner is not
    assert spans[90] == spans[91] == spans[92] == "" and spans[89].startswith("generic:") and "hex" in spans[89]
    assert [r.most_owners for r in got if r.doc_id == 90] == [4]
    assert secret_owners.find_secrets(empty).collect() == []


def test_masking_takes_effect(spark, docs, rows, empty):
    out = secret_owners.mask(docs)
    assert out.columns == docs.columns
    got = out.collect()
    assert len(got) == len(rows)
    texts = {r.doc_id: r.text for r in got}
    assert texts[88] == 'password = "a9f8e7d6c5b4a39281706f5e4d3c2b1a"'.replace('password = "a9f8e7d6c5b4a39281706f5e4d3c2b1a', "[assign]") + " and [access], then tOkEn: abc and [assign]"
    assert "Qm7Xk2Lp9Rt4Vz8Wn3Bc5" in texts[89] and "Jh6Gf4Ds2Aq1Wz3Xe5Rc9" not in texts[89] and "[hex]" in texts[89]
    clean = {i: t for i, t, *_ in rows if i is not None and i not in (88, 89)}
    assert all(texts[i] == t for i, t in clean.items())
    assert secret_owners.mask(empty).collect() == []


# 3, large buckets ------------------------------------------------------------


def chained(rng, n_chains, length, shared, own):
    """Chains of copies, each with some words of the one before replaced,
    behind a passage that all of them share."""
    passage = [f"p{k}" for k in range(shared)]
    out = []
    for c in range(n_chains):
        w = [f"c{c}x{k}" for k in range(own)]
        for _ in range(length):
            out.append(" ".join(passage + w))
            w = list(w)
            for k in rng.sample(range(own), own // 4):
                w[k] = f"n{rng.randrange(10**9)}"
    rng.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("n_chains, length", [(120, 2), (40, 6)])
def test_a_large_bucket_of_chained_copies(spark, n_chains, length):
    """All texts share a passage, thus buckets; each is similar to its
    neighbours in the chain only."""
    rows = chained(random.Random(4), n_chains, length, 50, 50)
    got = order_minhash.near_classes(spark.createDataFrame(rows, "doc_id long, text string"), 0.85).collect()
    texts = [t.split() for _, t in rows]
    head = list(range(len(rows)))

    def root(k):
        while head[k] != k:
            k = head[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if len(set(texts[a]) & set(texts[b])) >= 85 and edits(texts[a], texts[b]) <= 15:
                head[root(a)] = root(b)
    want = Counter(root(k) for k in range(len(rows)))
    assert sorted(Counter(r.label for r in got).values()) == sorted(want.values())


def test_word_pair_counts_pass_every_similar_pair():
    rng = random.Random(8)
    for _ in range(200):
        a = [f"w{rng.randrange(60)}" for _ in range(rng.randint(5, 400))]
        b, most = list(a), int(0.2 * len(a))
        for _ in range(most):
            k = rng.randrange(len(b))
            b[k : k + 1] = rng.choice([["x"], [b[k], "y"], []])
            b = b or ["z"]
        if not order_minhash.similar(a, b):
            continue
        given = order_minhash.word_runs([" ".join(a), " ".join(b)])
        x, _, _ = order_minhash.alike(order_minhash.marks(order_minhash.word_hashes(given), given[2]), given[2], np.arange(2), np.zeros(2), 0.8)
        assert len(x) == 1


def shared_sketch(similarity, n_words=200, tries=400, seed=6):
    """Share of pairs with scattered substitutions that share a sketch."""
    rng, hits = random.Random(seed), 0
    for _ in range(tries):
        a = [f"w{rng.randrange(5000)}" for _ in range(n_words)]
        b = list(a)
        for k in rng.sample(range(n_words), round((1 - similarity) * n_words)):
            b[k] = f"n{k}"
        one, other = order_minhash.sketch([" ".join(a), " ".join(b)])
        hits += bool(set(one) & set(other))
    return hits / tries


def test_pairs_at_the_threshold_are_candidates():
    assert shared_sketch(0.8) >= 0.97 and shared_sketch(0.85) >= 0.99


def test_slack_of_the_mixing_does_not_grow_with_the_corpus(spark):
    """A source of one small document beside one of millions of words."""
    rows = [(0, "a b c", "small"), *[(k, "word " * 400_000, "large") for k in range(1, 26)]]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = Counter(r.doc_id for r in mixing.mix(df, repeats=1.5, budget=None).select("doc_id").collect())
    assert got == Counter({k: 1 for k in range(26)})


def test_copies_within_one_owner_do_not_hide_a_key(spark):
    key = "Jh6Gf4Ds2Aq1Wz3Xe5Rc9"
    df = spark.createDataFrame([(k, f"text {k} {key}", "s1") for k in range(30)], "doc_id long, text string, source string")
    assert all(r.n_live == 1 and "generic" in r.spans for r in secret_owners.find_secrets(df).collect())
    assert all(key not in r.text for r in secret_owners.mask(df).collect())


def edited(rng, words, n_edits):
    out = list(words)
    for _ in range(n_edits):
        k = rng.randrange(len(out))
        out[k : k + 1] = rng.choice([[f"e{rng.randrange(10**6)}"], [out[k], f"e{rng.randrange(10**6)}"], []])
        out = out or ["e"]
    return out


def test_rare_pairs_of_similar_texts_meet():
    """Whatever the counts of the slots, two similar texts have a listed pair in common."""
    rng = random.Random(12)
    for _ in range(300):
        a = [f"w{rng.randrange(rng.choice([3, 60]))}" for _ in range(rng.randint(5, 120))]
        b = edited(rng, a, int(0.2 * len(a)))
        if not order_minhash.similar(a, b):
            continue
        given = order_minhash.word_runs([" ".join(a), " ".join(b)])
        common = np.random.default_rng(rng.randrange(99)).integers(0, 50, 1 << 10)
        one, other = order_minhash.rare_pairs(order_minhash.word_hashes(given), given[2], common, 0.8)
        assert set(one) & set(other)


def test_links_of_a_list_join_what_similar_pairs_join():
    """Short texts by links, long ones as unverified pairs; pairs met before are left out."""
    rng = random.Random(14)
    for long in (2000, 12):
        texts = []
        for _ in range(6):
            a = [f"w{rng.randrange(9)}" for _ in range(rng.randint(5, 30))]
            texts += [edited(rng, a, rng.randint(0, 4)) or ["z"] for _ in range(5)]
        given = order_minhash.word_runs([" ".join(t) for t in texts])
        counts, words = given[2], order_minhash.word_hashes(given)
        rows = [w if len(w) <= long else order_minhash.marks(w, counts[k : k + 1])[0] for k, w in enumerate(np.split(words, np.cumsum(counts)[:-1]))]
        before = [np.array([[1], [2], []][k % 3], np.int64) for k in range(len(texts))]
        for met in ([np.zeros(0, np.int64)] * len(texts), before):
            x, y, known = order_minhash.linked([r.tobytes() for r in rows], counts, np.arange(len(texts)), np.zeros(len(texts)), met, 0.8, long)
            assert known == [bool(counts[i] <= long and counts[j] <= long) for i, j in zip(x, y, strict=True)]
            assert all(order_minhash.similar(texts[i], texts[j]) for i, j, k in zip(x, y, known, strict=True) if k)
            pairs = [(i, j) for i in range(len(texts)) for j in range(i) if not set(met[i]) & set(met[j]) and order_minhash.similar(texts[i], texts[j])]
            links = [(i, j) for i, j in zip(x, y, strict=True) if order_minhash.similar(texts[i], texts[j])]
            assert united(len(texts), links) == united(len(texts), pairs)


def united(n, links):
    label = list(range(n))
    for _ in range(n):
        for i, j in links:
            label[i] = label[j] = min(label[i], label[j])
    return label


def test_short_texts_keep_their_links(spark):
    """Pairs at the threshold, of 5 to 40 words, behind no shared sketch."""
    rng, rows = random.Random(13), []
    for k in range(60):
        n = rng.choice([5, 6, 8, 10, 15, 20, 30, 39])
        a = [f"t{k}x{i}" for i in range(n)]
        b = list(a)
        for i in rng.sample(range(n), n // 5):
            b[i] = f"u{k}x{i}"
        rows += [(2 * k, " ".join(a)), (2 * k + 1, " ".join(b))]
    got = order_minhash.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r.class_id == r.id // 2 * 2 and r.class_size == 2 for r in got)


def test_staged_tables_leave_no_shuffle_files(spark):
    """What a staged table was shuffled through goes when it is written."""
    import time
    from pathlib import Path

    from pyspark.sql import functions as F

    from shoplens.llm.common import staged

    def files():
        dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
        return {f for d in dirs for f in Path(d).rglob("shuffle_*.data")}

    before = files()
    got = staged(spark.range(0, 20_000, 1, 4).groupBy((F.col("id") % 7000).alias("k")).agg(F.count(F.lit(1)).alias("n")), "counted")
    until = time.time() + 20
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before
    assert got.agg(F.count(F.lit(1)), F.sum("n")).first()[:] == (7000, 20_000)


def test_pairs_in_many_parts_give_the_same_classes(spark, monkeypatch):
    """Candidates verified a few at a time: the links are those of one go."""
    rng, rows = random.Random(31), []
    for k in range(2):
        base = [f"w{rng.randrange(400)}" for _ in range(60)]
        for i in range(12):
            words = list(base)
            for j in rng.sample(range(60), 8):
                words[j] = f"c{k}x{i}x{j}"
            rows.append((100 * k + i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(order_minhash, "LEAST", 30)
    monkeypatch.setattr(order_minhash, "PART", 1000)
    sizes, real = [], order_minhash.verified
    monkeypatch.setattr(order_minhash, "verified", lambda pairs, *more: sizes.append(pairs.count()) or real(pairs, *more))
    parts = {r.id: r.class_id for r in order_minhash.near_classes(df).collect()}
    want = united(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if order_minhash.similar(rows[i][1].split(), rows[j][1].split())])
    assert parts == {rows[i][0]: rows[k][0] for i, k in enumerate(want)}


def test_staged_tables_go_when_they_are_read(spark, monkeypatch):
    """Lists that give their pairs in parts, and links verified in parts, leave the
    classes of brute force; of the tables staged on the way only the classes stay."""
    rng, rows = random.Random(32), []
    for k in range(2):
        base = [f"w{rng.randrange(400)}" for _ in range(60)]
        for i in range(12):
            words = list(base)
            for j in rng.sample(range(60), 8):
                words[j] = f"c{k}x{i}x{j}"
            rows.append((100 * k + i, " ".join(words)))
    monkeypatch.setattr(order_minhash, "LEAST", 12)
    monkeypatch.setattr(order_minhash, "PAIRS", 0)
    folders, real = {}, order_minhash.staged

    def staged(df, name):
        out = real(df, name)
        folders[common._FOLDERS[out]] = name
        return out

    monkeypatch.setattr(order_minhash, "staged", staged)
    got = order_minhash.near_classes(spark.createDataFrame(rows, "doc_id long, text string"))
    assert list(folders.values()).count("listed_pairs") > 1 and list(folders.values()).count("linked") > 1
    held = [name for folder, name in folders.items() if os.path.exists(folder.removeprefix("file:"))]
    assert "classes" in held and not set(held) - {"classes", "linked", "labels", "edges", "blocks"}  # links and labels only
    want = united(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if order_minhash.similar(rows[i][1].split(), rows[j][1].split())])
    assert {r.id: r.class_id for r in got.collect()} == {rows[i][0]: rows[k][0] for i, k in enumerate(want)}
