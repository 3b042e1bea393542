"""Line labelling with a linear-chain conditional random field.

A text's lines are labelled content or boilerplate: each line has a score per
label from its features (length, symbols, capitals, digits, repetition, place),
neighbours have a score per pair of labels, and Viterbi decoding finds the best
labels of the whole text. A document is kept when the words of its content
lines are at least ``SHARE`` of all words, and the base rules do not reject it.

The field is trained here, by gradient ascent on the log likelihood, on a
bounded sample of labelled documents (``SAMPLE``, by hash of the id): lines of
good documents count as content unless they repeat an earlier line, lines of
poor ones as boilerplate. Decoding covers every line of every text.

Defined cases: null text has no words and fails the base rules; a text without
line feeds is one line; lines without words take part in the chain but weigh
nothing; texts of any length are decoded whole; repeated rows each get a row;
without labels every line counts as content, and the base rules decide; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.llm.common import chunks, map_rows, prepare, starts_of, table, texts_of, word_runs

SAMPLE, STEPS, RATE, SHARE = 2000, 150, 0.1, 0.3
SYMBOLS = "#*$%&|<>"
OTHER, UPPER, DIGIT, SYMBOL, STOP, SHOUT, MARK, SPACE, LETTER = range(9)


def _classes() -> np.ndarray:
    """Class of each code point below 0x500; the rest count as letters."""
    out = np.full(0x500, OTHER, np.uint8)
    for c in range(0x500):
        x = chr(c)
        out[c] = (SPACE if x in " \t\n\x0b\x0c\r" else SYMBOL if x in SYMBOLS else STOP if x in ".?" else SHOUT if x == "!"
                  else UPPER if x.isupper() else LETTER if x.isalpha() else DIGIT if x.isdigit() else MARK if x.isprintable() else OTHER)
    return out


CLASS = _classes()
#: Upper bounds of the bins of each feature; every feature has one more bin.
BINS = {
    "words": (0, 1, 3, 7, 15, 40),
    "symbols a word": (0, 0.1, 0.5),
    "capitals": (0.05, 0.3, 0.6),
    "shouts a word": (0, 0.2),
    "digits": (0, 0.1),
    "marks a word": (0.05, 0.4),
    "letters a word": (3, 6, 9),
    "repeated words": (0, 0.5),
    "stop at end": (0,),
    "equals an earlier line": (0,),
    "equals a later line": (0,),
    "first": (0,),
    "last": (0,),
}
OFFSETS = np.concatenate(([0], np.cumsum([len(b) + 1 for b in BINS.values()]))).astype(np.int64)


class Lines:
    """Lines of some texts: features, words and base counts."""

    def __init__(self, texts: list[str]):
        self.n_texts = len(texts)
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = np.where(points < len(CLASS), CLASS[np.minimum(points, len(CLASS) - 1)], LETTER)
        split = [t.split("\n") for t in texts]
        self.lines = np.fromiter(map(len, split), np.int64, len(texts))
        n = int(self.lines.sum())
        owner = np.repeat(np.arange(len(texts)), self.lines)
        length = np.fromiter((len(x) for s in split for x in s), np.int64, n)
        # places of the lines in the joined texts, which keep their line feeds
        first = starts_of(self.lines) if len(texts) else np.zeros(0, np.int64)
        ahead = np.cumsum(length + 1) - (length + 1)
        begin = ahead - owner  # a text has one line feed fewer than lines
        sums = lambda mask: np.concatenate(([0], np.cumsum(mask)))
        of = lambda c: c[begin + length] - c[begin]
        space = kind == SPACE
        opens = ~space
        opens[1:] &= space[:-1]
        at = starts_of(size)
        at = at[size > 0]
        opens[at] = ~space[at]
        words = sums(opens)
        self.words = of(words)
        whole = lambda c: c[np.cumsum(size)] - c[starts_of(size)] if len(texts) else np.zeros(0, np.int64)
        self.n_words, self.word_chars, symbols = whole(words), whole(sums(~space)), sums(kind == SYMBOL)
        self.n_symbols = whole(symbols)
        # lines equal to another one of their text
        earlier, later, at_line = np.zeros(n, bool), np.zeros(n, bool), 0
        for s in split:
            seen: dict[str, int] = {}
            for x in s:
                if x in seen:
                    earlier[at_line] = later[seen[x]] = True
                seen[x] = at_line
                at_line += 1
        some = self.words > 0
        self.dup_lines = np.bincount(owner, earlier & some, len(texts)).astype(np.int64)
        repeated = self._repeated(texts)
        in_line = np.concatenate(([0], np.cumsum(repeated)))
        word_at = words[begin]
        per_line = in_line[word_at + self.words] - in_line[word_at]
        word_begin = np.concatenate(([0], np.cumsum(self.n_words)))
        self.repeat_words = in_line[word_begin[1:]] - in_line[word_begin[:-1]]
        per_word, upper = np.maximum(self.words, 1), of(sums(kind == UPPER))
        letters = of(sums(kind == LETTER)) + upper
        ink = of(sums(~space))
        last_ink = np.maximum.accumulate(np.where(~space, np.arange(len(kind)), 0)) if len(kind) else np.zeros(0, np.int64)
        end = np.where(some, begin + length - 1, 0)
        stop = some & (kind[last_ink[end]] == STOP) if len(kind) else some
        last = np.zeros(n, bool)
        last[first + self.lines - 1] = True
        start = np.zeros(n, bool)
        start[first] = True
        values = (
            self.words, of(symbols) / per_word, upper / np.maximum(letters, 1), of(sums(kind == SHOUT)) / per_word, of(sums(kind == DIGIT)) / np.maximum(ink, 1),
            of(sums(kind == MARK)) / per_word, letters / per_word, per_line / per_word, stop, earlier & some, later & some, start, last,
        )
        self.features = np.stack([np.searchsorted(cuts, v, side="left") + o for cuts, v, o in zip(BINS.values(), values, OFFSETS, strict=False)], 1)
        self.earlier = earlier

    def _repeated(self, texts: list[str]) -> np.ndarray:
        """For each word: is it in a 3-word window that its text has twice?"""
        codes, distinct, counts = word_runs(texts)
        hit = np.zeros(len(codes), bool)
        if len(codes) < 4:
            return hit
        base = len(distinct)
        owner = np.repeat(np.arange(len(texts)), counts)
        window = (codes[:-2] * base + codes[1:-1]) * base + codes[2:] if base < 2_000_000 else np.unique(np.stack((codes[:-2], codes[1:-1], codes[2:])), axis=1, return_inverse=True)[1]
        inside = np.flatnonzero(owner[:-2] == owner[2:])
        window, doc = window[inside], owner[inside]
        order = np.lexsort((window, doc))
        same = (window[order][1:] == window[order][:-1]) & (doc[order][1:] == doc[order][:-1])
        twice = np.zeros(len(order), bool)
        twice[1:] |= same
        twice[:-1] |= same
        found = inside[order[twice]]
        for j in range(3):
            hit[found + j] = True
        return hit


class Field:
    """Weights: (features, 2) for lines, (2, 2) for neighbours; label 1 is
    content. ``by_step``: the lines of all texts, place by place."""

    def __init__(self, line: np.ndarray, pair: np.ndarray):
        self.line, self.pair = line, pair

    @staticmethod
    def by_step(lines: np.ndarray) -> list[np.ndarray]:
        order = np.argsort(-lines, kind="stable")
        first = starts_of(lines)[order]
        count = lines[order]
        left = len(order)
        steps = []
        for t in range(int(count[0]) if len(count) else 0):
            while left and count[left - 1] <= t:
                left -= 1
            steps.append(first[:left] + t)
        return steps

    def scores(self, features: np.ndarray) -> np.ndarray:
        return self.line[features].sum(1)

    def decode(self, features: np.ndarray, lines: np.ndarray) -> np.ndarray:
        """Viterbi: the best labels of each text."""
        score, steps = self.scores(features), self.by_step(lines)
        back = np.zeros((len(features), 2), np.int8)
        best = score.copy()
        for before, now in zip(steps[:-1], steps[1:], strict=True):
            ways = best[before[: len(now)]][:, :, None] + self.pair
            back[now] = ways.argmax(1)
            best[now] = ways.max(1) + score[now]
        label = np.zeros(len(features), np.int8)
        for t in range(len(steps) - 1, -1, -1):
            now = steps[t]
            after = len(steps[t + 1]) if t + 1 < len(steps) else 0
            label[now] = best[now].argmax(1)
            if after:
                label[now[:after]] = back[steps[t + 1], label[steps[t + 1]]]
        return label

    def slopes(self, features: np.ndarray, lines: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Observed less expected features: the log likelihood's gradient."""
        score, steps = self.scores(features), self.by_step(lines)
        add = lambda z, axis: np.logaddexp.reduce(z, axis=axis)
        fore, rear = score.copy(), np.zeros_like(score)
        for before, now in zip(steps[:-1], steps[1:], strict=True):
            fore[now] = score[now] + add(fore[before[: len(now)]][:, :, None] + self.pair, 1)
        for before, now in zip(steps[-2::-1], steps[:0:-1], strict=True):
            rear[before[: len(now)]] = add(self.pair + (score[now] + rear[now])[:, None, :], 2)
        p = fore + rear
        p = np.exp(p - add(p, 1)[:, None])
        seen = np.eye(2)[label]
        line = np.zeros_like(self.line)
        np.add.at(line, features, (seen - p)[:, None, :])
        pair = np.zeros((2, 2))
        for before, now in zip(steps[:-1], steps[1:], strict=True):
            b = before[: len(now)]
            z = fore[b][:, :, None] + self.pair + (score[now] + rear[now])[:, None, :]
            z = np.exp(z - add(z.reshape(len(z), 4), 1)[:, None, None])
            np.add.at(pair, (label[b], label[now]), 1)
            pair -= z.sum(0)
        return line, pair


def train(texts: list[str], good: list[bool], steps: int = STEPS) -> Field:
    """The field from labelled texts (ridge 1, step sizes by past slopes)."""
    field = Field(np.zeros((int(OFFSETS[-1]), 2)), np.zeros((2, 2)))
    if not texts:
        field.line[:, 1] = 1.0
        return field
    lines = Lines(texts)
    label = np.repeat(np.array(good, bool), lines.lines) & ~lines.earlier
    past = [np.full_like(field.line, 1e-6), np.full_like(field.pair, 1e-6)]
    for _ in range(steps):
        for weights, slope, sum_ in zip((field.line, field.pair), field.slopes(lines.features, lines.lines, label.astype(np.int64)), past, strict=True):
            slope = slope - weights
            sum_ += slope**2
            weights += 5 * RATE * slope / np.sqrt(sum_)
    return field


def sample(docs: DataFrame, labels: DataFrame, size: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", good_col: str = "quality") -> tuple[list[str], list[bool]]:
    """At most ``size`` labelled texts, by hash of the id."""
    ids = labels.where(F.col(good_col).isNotNull() & F.col(id_col).isNotNull()).select(id_col, (F.col(good_col) > 0).alias("_good"))
    ids = ids.orderBy(F.xxhash64(id_col), id_col).limit(size)
    rows = docs.select(id_col, text_col).join(F.broadcast(ids), id_col).where(F.col(text_col).isNotNull()).orderBy(id_col).limit(size).collect()
    return [r[text_col] for r in rows], [r["_good"] for r in rows]


FIGURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, content_share double, base_failed boolean, kept boolean"


def judged(docs: DataFrame, field: Field, keep: list[str], share: float = SHARE, text_col: str = "text") -> DataFrame:
    """The ``keep`` columns with the counts and the verdict of each text."""
    weights = (field.line, field.pair)

    def run(batch):
        texts, parts, decoder = texts_of(batch, text_col), [], Field(*weights)
        for i, j in chunks(texts):
            x = Lines(texts[i:j])
            content = decoder.decode(x.features, x.lines) * x.words
            part = np.bincount(np.repeat(np.arange(j - i), x.lines), content, j - i) / np.maximum(x.n_words, 1)
            failed = (x.n_words < 50) | (100 * x.repeat_words > 50 * x.n_words)
            parts.append((x.n_words, x.word_chars, x.n_symbols, x.dup_lines, x.repeat_words, part, failed, ~failed & (part >= share)))
        names = [f.split()[0] for f in FIGURES.split(", ")]
        return dict(zip(names, map(np.concatenate, zip(*parts, strict=True)), strict=True)) if parts else {n: [] for n in names}

    return map_rows(docs.select(*dict.fromkeys([*keep, text_col])), keep, FIGURES, run)


def label_lines(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    prepare(docs.sparkSession)
    return judged(docs, train(*sample(docs, labels, id_col=id_col, text_col=text_col)), [id_col], text_col=text_col)


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, all columns."""
    prepare(docs.sparkSession)
    field = train(*sample(docs, labels, id_col=id_col, text_col=text_col))
    taken = {f.split()[0] for f in FIGURES.split(", ")}
    aside = {c: f"_in_{c}" if c.lower() in taken else c for c in docs.columns}
    rows = judged(docs.withColumnsRenamed(aside), field, list(aside.values()), text_col=text_col)
    return rows.where("kept").select(*[F.col(f"`{new}`").alias(c) for c, new in aside.items()])


def op7_crf_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, with a field trained on a sample of the labels."""
    return label_lines(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
