"""SentencePiece encoding and decoding by vectorised merge rounds.

Texts are normalised as the model's library does and cut where no piece of the
vocabulary holds the two neighbouring characters side by side: no merge can
cross such a place, so the parts ("words") are independent. Each distinct word
of a block of texts is merged once, all of them together, in flat numpy arrays
of symbols: every round finds each word's best pair (segmented minimum of the
pairs' ranks), merges its occurrences from the left, and compacts; words
without a pair leave, until none remains.

Merging all occurrences at once must give what one merge at a time gives. It
does, unless a merge makes a pair that ranks no worse than the present one; a
word's occurrences after the first such merge therefore wait for a later round.
Words of more than ``LONG`` symbols (no blank, no safe cut) would need too many
rounds and go through a queue of pairs, in n log n steps.

The model has to be a BPE model with byte fallback: characters without a piece
become the ids of their UTF-8 bytes. Decoding maps ids to their pieces' text,
byte ids to bytes (what is no valid UTF-8 becomes U+FFFD, byte by byte) and
control ids to nothing, and drops one blank that begins the text.

Defined cases: null and empty texts have no ids and decode to the empty text;
texts are never cut; repeated rows give repeated results; an empty table gives
an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import codecs
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from shoplens.llm.common import chunks, prepare, table, texts_of

MODEL = "piece_bpe_32k.model"
BLOCK_CHARS = 4_000_000
LONG = 4096
NONE = np.iinfo(np.int32).max
BLANK = "▁"  # the library's visible blank
codecs.register_error("each_byte", lambda e: ("�", e.start + 1))


class Pieces:
    """A model's tables: symbols of characters, ranked pairs, text of pieces.

    A symbol is a piece's id, or minus one minus the code point of a character
    that has no piece."""

    def __init__(self, model: str):
        import sentencepiece

        self.tool = tool = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(model))
        n = tool.get_piece_size()
        names = [tool.id_to_piece(i) for i in range(n)]
        self.byte_ids = np.array([tool.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        plain = [i for i in range(n) if not (tool.is_byte(i) or tool.is_control(i) or tool.is_unknown(i))]
        if not all(map(tool.is_byte, self.byte_ids.tolist())) or any(map(tool.is_unused, plain)):
            raise ValueError(f"{model}: needs a BPE model with byte fallback and without unused pieces")
        ids = {names[i]: i for i in plain}
        # equal scores share a rank: the leftmost of such pairs goes first
        self.rank = np.unique([-tool.get_score(i) for i in range(n)], return_inverse=True)[1].astype(np.int32)

        self.symbol = -np.arange(1, 0x110001, dtype=np.int32)
        for ch in filter(lambda p: len(p) == 1, ids):
            self.symbol[ord(ch)] = ids[ch]
        of = lambda s: ids.get(s, -ord(s) - 1 if len(s) == 1 else None)
        pairs = [(of(p[:k]), of(p[k:]), i) for p, i in ids.items() for k in range(1, len(p))]
        left, right, made = np.array([t for t in pairs if None not in t], np.int64).T
        keys = self._key(left, right)
        order = np.argsort(keys)
        self.keys, self.made = keys[order], made[order].astype(np.int32)

        side = {(a, b) for p in ids for a, b in zip(p, p[1:])}
        within = sorted({c for ab in side for c in ab})
        self.group = np.zeros(0x110000, np.int32)  # 0: a character of no longer piece
        self.group[[ord(c) for c in within]] = np.arange(1, len(within) + 1)
        self.beside = np.zeros((len(within) + 1, len(within) + 1), bool)
        for a, b in side:
            self.beside[self.group[ord(a)], self.group[ord(b)]] = True

        as_plain = set(plain)
        as_bytes = {int(i): bytes([b]) for b, i in enumerate(self.byte_ids)}
        text = [names[i].replace(BLANK, " ").encode() if i in as_plain else as_bytes.get(i, b"") for i in range(n)]
        text[tool.unk_id()] = " ⁇ ".encode()  # fixed value: what the library writes for an unknown piece
        # the second half: pieces that begin a text, without their blank
        first = [t[1:] if t[:1] == b" " and i in as_plain else t for i, t in enumerate(text)]
        self.text = pa.array(text + first, pa.binary())
        self.silent = np.array([tool.is_control(i) for i in range(n)])

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(np.int64) << 32) + right

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (``NONE``: no piece) and piece of each pair of symbols."""
        key = self._key(left, right)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        made = self.made[at]
        return np.where(self.keys[at] == key, self.rank[made], NONE), made

    # --- encoding ---------------------------------------------------------

    def merge_round(self, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """One round over the symbols of all words: (sym, kept, over), where
        ``over`` marks symbols of words without a pair."""
        m = len(sym)
        rank, made = np.full(m, NONE, np.int32), np.zeros(m, np.int32)
        if m > 1:
            rank[:-1], made[:-1] = self.pairs(sym[:-1], sym[1:])
            rank[:-1][word[:-1] != word[1:]] = NONE
        starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        best = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.r_[starts, m]))
        over = best == NONE
        at = np.flatnonzero((rank == best) & ~over)
        if not len(at):
            return sym, ~over, over
        # overlapping occurrences: the first, third, ... of each row of neighbours
        row_start = np.maximum.accumulate(np.where(np.r_[True, np.diff(at) != 1], at, 0))
        at = at[(at - row_start) % 2 == 0]
        piece, r = made[at], rank[at]
        # pairs that a merge makes with its neighbours, the left one merged before
        w = word[at]
        before = np.where(np.r_[False, np.diff(at) == 2], np.r_[0, piece[:-1]], sym[at - 1])
        has_left, has_right = (at > 0) & (word[at - 1] == w), at + 2 < m
        after = np.minimum(at + 2, m - 1)
        has_right &= word[after] == w
        new = np.minimum(np.where(has_left, self.pairs(before, piece)[0], NONE), np.where(has_right, self.pairs(piece, sym[after])[0], NONE))
        early = new <= r
        if early.any():  # later occurrences of such a word wait
            gone = np.cumsum(early) - early
            first = np.flatnonzero(np.r_[True, w[1:] != w[:-1]])
            ok = gone == np.repeat(gone[first], np.diff(np.r_[first, len(w)]))
            at, piece = at[ok], piece[ok]
        sym = sym.copy()
        sym[at] = piece
        kept = ~over
        kept[at + 1] = False
        return sym, kept, over

    def merge_all(self, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rounds until no pair remains; ``word`` ascends."""
        out = []
        while len(sym):
            sym, kept, over = self.merge_round(sym, word)
            out.append((sym[over], word[over]))
            sym, word = sym[kept], word[kept]
        sym, word = map(np.concatenate, zip(*out)) if out else (sym, word)
        order = np.argsort(word, kind="stable")
        return sym[order], word[order]

    def merge_queue(self, sym: np.ndarray) -> np.ndarray:
        """One very long word: the best pair first, leftmost of equals."""
        s = sym.tolist()
        n = len(s)
        prev, nxt = list(range(-1, n - 1)), [*range(1, n), -1]
        rank, made = self.pairs(sym[:-1], sym[1:])
        found = rank < NONE
        heap = list(zip(rank[found].tolist(), np.flatnonzero(found).tolist(), sym[:-1][found].tolist(), sym[1:][found].tolist(), made[found].tolist()))
        heapq.heapify(heap)
        known: dict[tuple[int, int], tuple[int, int] | None] = {}

        def push(i: int, j: int) -> None:
            pair = (s[i], s[j])
            if pair not in known:
                r, p = self.pairs(np.array([pair[0]], np.int32), np.array([pair[1]], np.int32))
                known[pair] = (int(r[0]), int(p[0])) if r[0] < NONE else None
            if known[pair]:
                heapq.heappush(heap, (known[pair][0], i, *pair, known[pair][1]))

        gone = bytearray(n)
        while heap:
            _, i, a, b, piece = heapq.heappop(heap)
            j = nxt[i]
            if gone[i] or j < 0 or s[i] != a or s[j] != b:
                continue
            s[i], gone[j] = piece, 1
            nxt[i] = nxt[j]
            if nxt[i] >= 0:
                prev[nxt[i]] = i
                push(i, nxt[i])
            if prev[i] >= 0:
                push(prev[i], i)
        return np.array([x for x, g in zip(s, gone) if not g], np.int32)

    def ids_of_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and their number per word."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        sym = self.symbol[_points("".join(words))]
        word = np.repeat(np.arange(len(words)), size)
        long = size > LONG
        parts = [self.merge_all(sym[~long[word]], word[~long[word]])]
        starts = np.cumsum(size) - size
        for k in np.flatnonzero(long):
            got = self.merge_queue(sym[starts[k] : starts[k] + size[k]])
            parts.append((got, np.full(len(got), k)))
        sym, word = map(np.concatenate, zip(*parts))
        order = np.argsort(word, kind="stable")
        sym, word = sym[order], word[order]
        bare = np.flatnonzero(sym < 0)
        if len(bare):  # characters without a piece: their bytes
            chars = [chr(-s - 1).encode() for s in sym[bare].tolist()]
            width = np.ones(len(sym), np.int64)
            width[bare] = [len(c) for c in chars]
            is_bare = np.repeat(sym < 0, width)
            sym, word = np.repeat(sym, width), np.repeat(word, width)
            sym[is_bare] = self.byte_ids[np.frombuffer(b"".join(chars), np.uint8)]
        return sym.astype(np.int32), np.bincount(word, minlength=len(words))

    def encode(self, texts: list[str]) -> pa.ListArray:
        """The ids of every text."""
        texts = [self.tool.normalize(t) if t else "" for t in texts]
        whole = "".join(texts)
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
        if not whole:
            return pa.ListArray.from_arrays(pa.array(np.zeros(len(texts) + 1, np.int32)), pa.array([], pa.int32()))
        group = self.group[_points(whole)]
        cut = np.r_[True, ~self.beside[group[:-1], group[1:]]]
        cut[(ends - np.diff(np.r_[0, ends]))[np.diff(np.r_[0, ends]) > 0]] = True  # texts stay apart
        starts = np.flatnonzero(cut)
        bounds = [*starts.tolist(), len(whole)]
        words = np.empty(len(starts), object)
        words[:] = [whole[i:j] for i, j in zip(bounds, bounds[1:])]
        code, distinct = pd.factorize(words)
        ids, n = self.ids_of_words(list(distinct))
        first = np.cumsum(n) - n
        n_of = n[code]
        at = np.repeat(first[code] - (np.cumsum(n_of) - n_of), n_of) + np.arange(n_of.sum())
        total = np.r_[0, np.cumsum(n_of)]  # ids before each word
        offsets = np.r_[0, total[np.searchsorted(starts, ends)]]
        return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids[at]))

    # --- decoding ---------------------------------------------------------

    def decode(self, ids: pa.ListArray) -> list[str]:
        """The text of every list of ids; null counts as empty."""
        if ids.null_count:
            ids = pa.array([x or [] for x in ids.to_pylist()], pa.list_(pa.int32()))
        flat = ids.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        size = np.diff(ids.offsets.to_numpy())
        row = np.repeat(np.arange(len(size)), size)
        # the first id of a row that is no control piece loses its blank
        spoken = np.flatnonzero(~self.silent[flat])
        first = spoken[np.r_[True, np.diff(row[spoken]) != 0]] if len(spoken) else spoken
        flat[first] += len(self.silent)
        taken = self.text.take(pa.array(flat))
        data = taken.buffers()[2].to_pybytes() if len(flat) else b""
        at = np.frombuffer(taken.buffers()[1], np.int32, len(flat) + 1) if len(flat) else np.zeros(1, np.int32)
        # bytes on the two sides of a control piece form no character together
        quiet = np.flatnonzero(np.r_[self.silent, self.silent][flat])
        stops = np.sort(np.r_[0, np.cumsum(size), quiet])
        ends = at[stops].tolist()
        runs = [data[i:j].decode("utf-8", "each_byte") for i, j in zip(ends, ends[1:])]
        if not len(quiet):
            return runs
        n = np.r_[0, np.cumsum(np.bincount(row[quiet], minlength=len(size)) + 1)].tolist()
        return ["".join(runs[i:j]) for i, j in zip(n, n[1:])]


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


@lru_cache(maxsize=2)
def load(model: str = MODEL) -> Pieces:
    return Pieces(model)


def _with(df: DataFrame, keep: list[str], added: str, run) -> DataFrame:
    """``keep`` and the added columns; ``run(batch)`` yields (slice, arrays)."""
    new = T.StructType.fromDDL(added)
    schema = T.StructType([df.schema[c] for c in keep if c not in new.names] + list(new))
    names = [f.name for f in to_arrow_schema(schema)]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, arrays in run(b):
                kept = [part.column(part.schema.get_field_index(c)) for c in names if c not in new.names]
                yield pa.RecordBatch.from_arrays([*kept, *arrays], names=names)

    return df.mapInArrow(each, schema)


def encode(docs: DataFrame, model: str = MODEL, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), round_trip: bool = False) -> DataFrame:
    """``keep`` and ``ids`` (array of int) of every text; with ``round_trip``
    also ``decoded``, the text that the ids decode to, in the same pass."""
    prepare(docs.sparkSession)

    def run(b: pa.RecordBatch):
        texts, tool = texts_of(b, text_col), load(model)
        for i, j in chunks(texts, BLOCK_CHARS):
            ids = tool.encode(texts[i:j])
            yield b.slice(i, j - i), [ids, *([pa.array(tool.decode(ids), pa.string())] if round_trip else [])]

    cols = list(dict.fromkeys([*keep, text_col]))
    return _with(docs.select(*cols), list(keep), "ids array<int>" + (", decoded string" if round_trip else ""), run)


def decode(rows: DataFrame, model: str = MODEL, ids_col: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and ``decoded`` (text) of every array of ids."""
    prepare(rows.sparkSession)

    def run(b: pa.RecordBatch):
        yield b, [pa.array(load(model).decode(b.column(b.schema.get_field_index(ids_col))), pa.string())]

    return _with(rows.select(*dict.fromkeys([*keep, ids_col])), list(keep), "decoded string", run)


def op13_piece_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded text of every document."""
    rows = encode(table(spark, sf_dir, "documents"), round_trip=True)
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
