"""Operator 5: exact merge-type SentencePiece encoding by backtracking, and decoding.

A sequence of pieces is the one that merging would make if and only if every two neighbours are: merging their joint
text again gives these two. The encoder therefore never merges a text. An Aho-Corasick automaton finds the longest
piece at each position; the encoder takes it if it is compatible with the piece before (a memo of pairs, filled by
re-merging), else the next shorter piece that is its prefix; if none fits, it marks the position as failed in a
bitfield, takes back the last piece and goes on there. No position is tried twice, so the time is linear.

No piece holds the space mark after another character, so merging never crosses the start of a word: words are encoded
once and kept (the memo of a worker is emptied when it is full, which changes no result). Documents are cut at spaces
and line ends, their words looked up, and the pieces of all words gathered by numpy.

Models: BPE with byte fallback, identity normalisation and a leading space mark, as files of the sentencepiece
library give; others are refused. The place of the model is a parameter.

Defined results: a null text gives null, an empty one no pieces. Text that holds the space mark itself (U+2581) is
encoded as the library does and decodes to spaces. Of merges with equal scores the leftmost goes first, as in the library.
Repeated rows get equal results, an empty table an empty one. Very long texts are encoded whole. Every row is handled
alone; other columns are not read.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._words import trim

MARK = "▁"
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Words that a worker keeps.
MEMO = 400_000


class Vocabulary:
    """Pieces, ranks, and the automaton of one model."""

    def __init__(self, path: str):
        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.vocab_size()
        pieces = [sp.id_to_piece(i) for i in range(n)]
        special = {i for i in range(n) if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)}
        self.text = [p if i not in special else "" for i, p in enumerate(pieces)]
        self.id = {p: i for i, p in enumerate(self.text) if p}
        if any(MARK in p.lstrip(MARK) for p in self.id):
            raise ValueError("the model has pieces that span words")
        self.byte = {int(p[3:5], 16): i for i, p in enumerate(pieces) if sp.is_byte(i)}
        if len(self.byte) != 256 or sp.encode("a") != sp.encode("a ")[:1] or sp.encode("ﬁ") == sp.encode("fi") or not sp.encode("a", out_type=str)[0].startswith(MARK):
            raise ValueError("the model is no BPE with byte fallback, identity normalisation and a leading space mark")
        self.score = [sp.get_score(i) for i in range(n)]
        self.size = [len(p) for p in self.text]
        # Pieces that merging their own characters doesn't give can never be part of an encoding.
        self.whole = {p: i for p, i in self.id.items() if len(p) == 1 or self.merge(p) == [i]}
        self.automaton = ahocorasick.Automaton()
        for p, i in self.whole.items():
            self.automaton.add_word(p, i)
        self.automaton.make_automaton()
        self.shorter: list[int] = [-1] * n
        for p, i in self.whole.items():
            for k in range(len(p) - 1, 0, -1):
                if p[:k] in self.whole:
                    self.shorter[i] = self.whole[p[:k]]
                    break
        raw = [p.replace(MARK, " ").encode() for p in self.text]
        for b, i in self.byte.items():
            raw[i] = bytes([b])
        self.raw_off = np.concatenate(([0], np.cumsum([len(r) for r in raw]))).astype(np.int64)
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.pair: dict[int, bool] = {}
        self.words = _Memo(self)

    def merge(self, s: str) -> list[int]:
        """The pieces of s by merging the best pair again and again; s has known characters only."""
        parts = list(s)
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                i = self.id.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or self.score[i] > best):
                    best, at = self.score[i], k
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.id.get(p, -1) for p in parts]

    def fits(self, a: int, b: int) -> bool:
        """Whether merging the joint text of two pieces gives these two."""
        key = a << 32 | b
        known = self.pair.get(key)
        if known is None:
            if len(self.pair) > 2 * MEMO:
                self.pair.clear()
            known = self.pair[key] = self.merge(self.text[a] + self.text[b]) == [a, b]
        return known

    def known(self, s: str) -> list[int]:
        """The encoding of a text of known characters."""
        i = self.whole.get(s)
        if i is not None:
            return [i]
        n, size, shorter = len(s), self.size, self.shorter
        longest = [-1] * n
        for end, i in self.automaton.iter(s):
            at = end - size[i] + 1
            if longest[at] < 0 or size[longest[at]] < size[i]:
                longest[at] = i
        out: list[int] = []
        failed, pos, piece = 0, 0, longest[0]
        while pos < n:
            last = out[-1] if out else -1
            while piece >= 0:
                end = pos + size[piece]
                if not failed >> end & 1 and (last < 0 or self.fits(last, piece)):
                    break
                piece = shorter[piece]
            if piece >= 0:
                out.append(piece)
                pos = end
                piece = longest[pos] if pos < n else -1
            elif last < 0:
                return self.merge(s)  # not reached: merging always gives one encoding
            else:
                failed |= 1 << pos
                out.pop()
                pos -= size[last]
                piece = last
        return out

    def encode_chunk(self, s: str) -> list[int]:
        """The encoding of any text in which spaces are marks; unknown characters become bytes and part the text."""
        out: list[int] = []
        lo = 0
        for k, c in enumerate(s):
            if c not in self.id:
                if lo < k:
                    out += self.known(s[lo:k])
                out += [self.byte[b] for b in c.encode()]
                lo = k + 1
        if lo < len(s):
            out += self.known(s[lo:])
        return out

    def cut(self, text: str) -> list[str]:
        """Words for the memo: as they are after one space; with a leading NUL where no space comes before."""
        if "  " in text or "\0" in text or MARK in text or text[0] == " " or text[-1] == " ":
            s = MARK + text.replace(" ", MARK)
            cuts = [k for k in range(1, len(s)) if s[k] == MARK and s[k - 1] != MARK]
            return ["\0" + s[a:b] for a, b in zip([0, *cuts], [*cuts, len(s)])]
        return text.replace("\n", " \0\n").split(" ")

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int32)
        words = self.cut(text)
        at = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))
        return self.words.gather(at)

    def encode_many(self, texts: list[str]) -> list[np.ndarray]:
        """The encodings of texts; words that the memo lacks are encoded by the library, which gives the same pieces."""
        words = [self.cut(t) if t else [] for t in texts]
        size = [len(w) for w in words]
        memo = self.words
        memo.pending = []
        at = np.fromiter(map(memo.__getitem__, itertools.chain.from_iterable(words)), np.int64, sum(size))
        new, memo.pending = memo.pending, None
        # Before a line end the library's leading mark stands alone; other words without a space before are encoded here.
        made = iter(self.library.encode([w[1:] if w[:1] == "\0" else w for w in new if w and (w[0] != "\0" or w[1] == "\n")], num_threads=1))
        memo.fill([[self.id[MARK]] if not w else next(made) if w[0] != "\0" else next(made)[1:] if w[1] == "\n" else self.encode_chunk(w[1:]) for w in new])
        flat = self.words.gather(at)
        ends = np.concatenate(([0], np.cumsum(self.words.off[at + 1] - self.words.off[at])))[np.concatenate(([0], np.cumsum(size)))]
        return [flat[i:j] for i, j in zip(ends[:-1].tolist(), ends[1:].tolist())]

    def decode(self, ids: np.ndarray) -> bytes:
        """The UTF-8 text of ids; the space that encoding put first goes."""
        lo = self.raw_off[ids]
        size = self.raw_off[ids + 1] - lo
        total = int(size.sum())
        if not total:
            return b""
        at = np.repeat(lo - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(total)
        out = self.raw[at].tobytes()
        return out[1:] if out[:1] == b" " else out


class _Memo(dict):
    """Word -> its number; the pieces of all words lie in one growing array."""

    def __init__(self, v: Vocabulary):
        super().__init__()
        self.v = v
        self.pending: list[str] | None = None
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.flat = np.zeros(1 << 16, np.int32)
        self.off = np.zeros(1 << 14, np.int64)
        self.n = self.used = 0

    def __missing__(self, word: str) -> int:
        if self.pending is not None:
            self.pending.append(word)
            self[word] = k = self.n
            self.n += 1
            return k
        return self.add(word, self.v.encode_chunk(word[1:] if word[:1] == "\0" else MARK + word))

    def add(self, word: str, ids: list[int]) -> int:
        if self.n + 2 > len(self.off):
            self.off = np.concatenate((self.off, np.zeros_like(self.off)))
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate((self.flat, np.zeros_like(self.flat)))
        self.flat[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        self.off[self.n + 1] = self.used
        self[word] = k = self.n
        self.n += 1
        return k

    def fill(self, lists: list[list[int]]) -> None:
        """The pieces of the words that were pending, in their order."""
        first, m = self.n - len(lists), len(lists)
        size = np.fromiter(map(len, lists), np.int64, m)
        total = int(size.sum())
        while self.n + 2 > len(self.off):
            self.off = np.concatenate((self.off, np.zeros_like(self.off)))
        while self.used + total > len(self.flat):
            self.flat = np.concatenate((self.flat, np.zeros_like(self.flat)))
        self.flat[self.used : self.used + total] = np.fromiter(itertools.chain.from_iterable(lists), np.int32, total)
        self.off[first + 1 : first + 1 + m] = self.used + np.cumsum(size)
        self.used += total

    def gather(self, at: np.ndarray) -> np.ndarray:
        lo = self.off[at]
        size = self.off[at + 1] - lo
        start = np.concatenate(([0], np.cumsum(size)))
        return self.flat[np.repeat(lo - start[:-1], size) + np.arange(start[-1])]


@functools.lru_cache(maxsize=2)
def vocabulary(path: str = MODEL) -> Vocabulary:
    """One per worker and model."""
    return Vocabulary(path)


def encode_batch(texts: pa.Array, path: str) -> list[np.ndarray | None]:
    v = vocabulary(path)
    out = []
    for t in texts:
        if len(v.words) > MEMO:
            v.words.reset()
        s = t.as_py()
        out.append(None if s is None else v.encode(s))
    return out


def id_lists(rows: list[np.ndarray | None]) -> pa.Array:
    off = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([0 if r is None else len(r) for r in rows], out=off[1:])
    full = [r for r in rows if r is not None]
    flat = np.concatenate(full) if full else np.zeros(0, np.int32)
    none = pa.array([r is None for r in rows], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(off), pa.array(flat, pa.int32()), mask=none)


def encode(text: Column, path: str = MODEL) -> Column:
    """array<int> of the pieces of a text column."""

    def run(texts: pa.Array) -> pa.Array:
        return id_lists(encode_batch(texts, path))

    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "array<int>").asNondeterministic()(text)


def decode(ids: Column, path: str = MODEL) -> Column:
    """The text of an array<int> column; null for null."""

    def run(ids: pa.Array) -> pa.Array:
        v = vocabulary(path)
        off, flat = ids.offsets.to_numpy(), ids.values.to_numpy()
        gone = ids.is_null().to_numpy(zero_copy_only=False)
        return pa.array([None if g else v.decode(flat[a:b]).decode("utf-8", "replace") for a, b, g in zip(off[:-1], off[1:], gone)], pa.string())

    run.__annotations__ = {"ids": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "string").asNondeterministic()(ids)


def checked(text: Column, path: str = MODEL) -> Column:
    """struct<token_ids array<int>, exact boolean> of a text column: exact says that decoding gives the text again.

    What a task has learned goes at its end: the worker lives on for other stages.
    """

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        v = vocabulary(path)
        for texts in batches:
            rows = encode_batch(texts, path)
            same = [None if r is None else v.decode(r) == t.as_py().encode() for t, r in zip(texts, rows)]
            yield pa.StructArray.from_arrays([id_lists(rows), pa.array(same, pa.bool_())], ["token_ids", "exact"])
        v.words.reset()
        v.pair.clear()
        trim()

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "struct<token_ids:array<int>,exact:boolean>").asNondeterministic()(text)


def encoded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = MODEL) -> DataFrame:
    """(doc_id, token_ids, n_tokens, exact): exact says that decoding gives the text again."""
    out = docs.select(docs[id_col].alias("doc_id"), checked(docs[text_col], path).alias("e"))
    return out.select("doc_id", "e.token_ids", F.size("e.token_ids").cast("long").alias("n_tokens"), "e.exact")


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(spark.read.parquet(f"{sf_dir}/documents.parquet"))
