"""Operator 6: toxic spans by a linear-chain conditional random field.

Two states, clean and toxic, over words (runs of ASCII letters and digits and of all bytes from 128 on, ASCII letters
in lower case). Features are hashed: the word, its length, and both neighbours. Parts of words are no features: words
that merely begin like a toxic one are not toxic.

Training is bounded: at most MAX_TOXIC toxic and MAX_CLEAN other labelled documents of up to MAX_CHARS characters, by the
order of a hash of the id, reach the driver; of an id with several texts the first in order is taken. Near copies among them (bigram Jaccard >= COPY) count once. A word of a toxic document is labelled toxic if hardly any clean
document has it and its frequency in toxic ones is no chance (likelihood ratio at least EVIDENCE). Weights follow
full-batch gradients of the conditional likelihood, with expectations by forward-backward.

Scoring covers every document, in one Arrow UDF with a table of fixed size: forward and backward messages are odds, each
step is a fractional linear map, and lanes of the word stream are composed first and run second, so numpy works on all
lanes at once and the result is exact. A word is tagged if its marginal reaches CUT; the score of a document is the
greatest marginal; tagged neighbours merge to a span with offsets in characters.

Defined results: null, empty and wordless texts have score 0.0 and no span. Labels without document, or null, don't
count; an id with several labels is toxic if any says so. Without any toxic label nothing is tagged. Repeated rows get
equal results. Equal marginals are no matter: the score is their value, and each word at CUT or above is tagged. With an
empty table the result is empty. Very long texts are scored whole. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._words import BASE, U, char_sums, chunks, mix, runs, spans, sums

MAX_TOXIC = 1500
MAX_CLEAN = 3000
MAX_CHARS = 20_000
EVIDENCE = 30.0
COPY = 0.5
BITS = 22
ROUNDS = 40
CUT = 0.5
#: Values of the features of a word: itself, its length, the word before, the word after.
VALUES = np.array([1.0, 0.5, 0.1, 0.1])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_INSIDE = np.array([48 <= b < 58 or 65 <= b < 91 or 97 <= b < 123 or b >= 128 for b in range(256)])


class Tokens:
    """Words of one chunk with byte spans, hashes and the hashed features (one row of indices per feature)."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        low = _LOWER[data]
        self.start, self.end = runs(_INSIDE[data], off)
        self.ptr = np.searchsorted(self.start, off)
        total = sums(low)
        n = len(self.start)
        self.hash = h = spans(total, self.start, self.end)
        self.first = np.zeros(n, bool)
        self.first[self.ptr[:-1][np.diff(self.ptr) > 0]] = True
        edge = mix(self.end.astype(U) - self.start.astype(U))
        before, after = np.zeros(n, U), np.zeros(n, U)
        before[1:] = h[:-1]
        before[self.first] = 0
        after[:-1] = h[1:]
        after[:-1][self.first[1:]] = 0
        parts = (h, edge, before, after)
        self.features = np.stack([(mix(x + U((k + 1) * int(BASE) % 2**64)) >> U(64 - BITS)).astype(np.int32) for k, x in enumerate(parts)]) if n else np.zeros((4, 0), np.int32)


def fractional_scan(a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray) -> np.ndarray:
    """o[i] = (a[i] * o[i-1] + b[i]) / (c[i] * o[i-1] + d[i]) with o[-1] = 1, all entries positive or zero."""
    n = len(a)
    lanes = max(1, int(n**0.5))
    steps = -(-n // lanes)
    pad = lanes * steps - n
    a, b, c, d = (np.concatenate((x, np.full(pad, v))).reshape(lanes, steps).T.copy() for x, v in ((a, 1.0), (b, 0.0), (c, 0.0), (d, 1.0)))
    p, q, r, s = np.ones(lanes), np.zeros(lanes), np.zeros(lanes), np.ones(lanes)
    for t in range(steps):
        p, q, r, s = a[t] * p + b[t] * r, a[t] * q + b[t] * s, c[t] * p + d[t] * r, c[t] * q + d[t] * s
        top = p + q + r + s
        p, q, r, s = p / top, q / top, r / top, s / top
    o, start = 1.0, np.empty(lanes)
    for k, (x, y, z, w) in enumerate(zip(p.tolist(), q.tolist(), r.tolist(), s.tolist())):
        start[k] = o
        o = (x * o + y) / max(z * o + w, 1e-300)
        o = min(max(o, 1e-200), 1e200)
    out, o = np.empty((steps, lanes)), start
    for t in range(steps):
        o = (a[t] * o + b[t]) / (c[t] * o + d[t])
        out[t] = o
    return out.T.reshape(-1)[:n]


class Crf:
    """Weights: emission of toxic against clean by feature; logarithms of transitions and of the start."""

    def __init__(self, weights: np.ndarray, move: np.ndarray, start: float):
        self.weights, self.move, self.start = weights, move, start

    def messages(self, t: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Emission odds, forward odds, backward odds."""
        e = np.exp(np.clip(VALUES @ self.weights[t.features], -25, 25)).astype(np.float64)
        (t00, t01), (t10, t11) = np.exp(self.move)
        f = t.first
        one = np.ones(len(e))
        fwd = fractional_scan(np.where(f, 0, e * t11), np.where(f, e * np.exp(self.start), e * t01), np.where(f, 0, t10), np.where(f, 1, t00))
        last = np.append(f[1:], True)
        nxt = np.append(e[1:], 1.0)
        back = fractional_scan(*(np.where(last, v, x * one)[::-1] for v, x in ((0, t11 * nxt), (1, t10), (0, t01 * nxt), (1, t00))))[::-1]
        return e, fwd, back

    def marginals(self, t: Tokens) -> np.ndarray:
        if not len(t.start):
            return np.zeros(0)
        _, fwd, back = self.messages(t)
        odds = fwd * back
        return odds / (1 + odds)


def fit(parts: list[tuple[Tokens, np.ndarray]], rounds: int = ROUNDS, rate: float = 2.0, decay: float = 1e-7) -> Crf:
    """Gradient ascent over all parts, with steps scaled by past gradients; of a part: tokens, and 1 for toxic words."""
    crf = Crf(np.zeros(1 << BITS, np.float32), np.array([[0.0, -3.0], [0.0, -1.0]]), -3.0)
    n = max(1, sum(len(y) for _, y in parts))
    past = np.zeros(1 << BITS, np.float32)
    past_move, past_start = np.zeros((2, 2)), 0.0
    for _ in range(rounds):
        g = -decay * n * crf.weights
        gm, gs = np.zeros((2, 2)), 0.0
        for t, y in parts:
            e, fwd, back = crf.messages(t)
            odds = fwd * back
            miss = y - odds / (1 + odds)
            for value, f in zip(VALUES, t.features):
                np.add.at(g, f, (value * miss).astype(np.float32))
            # Pair marginals of neighbours within a document.
            inner = ~t.first[1:]
            a, b = y[:-1][inner], y[1:][inner]
            x, nb = fwd[:-1][inner], (e[1:] * back[1:])[inner]
            tm = np.exp(crf.move)
            w = np.stack([tm[0, 0] * np.ones(len(x)), tm[0, 1] * nb, tm[1, 0] * x, tm[1, 1] * x * nb])
            gm += np.bincount(2 * a + b, minlength=4).reshape(2, 2) - (w / w.sum(axis=0)).sum(axis=1).reshape(2, 2)
            gs += float(miss[t.first].sum())
        past += g * g
        past_move += gm * gm
        past_start += gs * gs
        crf.weights += rate * g / (np.sqrt(past) + np.float32(1e-9))
        crf.move += 0.2 * gm / (np.sqrt(past_move) + 1e-9)
        crf.start += 0.2 * gs / (past_start**0.5 + 1e-9)
    return crf


def near_copies(hashes: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """Rows whose bigrams reach a Jaccard similarity of COPY with those of a row before them that is no copy itself.

    Such a pair shares one of the rarest bigrams of each, more than the share 1 - COPY of them; only rows that do are compared.
    """
    rows = len(ptr) - 1
    gram = hashes.copy()
    gram[:-1] = mix(gram[:-1] * BASE + hashes[1:])
    row = np.repeat(np.arange(rows), np.diff(ptr))
    inner = np.append(row[1:] == row[:-1], False)[: len(row)]
    inner[ptr[:-1][np.diff(ptr) == 1]] = True
    gram = np.where(np.repeat(np.diff(ptr) == 1, np.diff(ptr)), hashes, gram)
    _, code = np.unique(gram[inner], return_inverse=True)
    kinds = int(code.max(initial=0)) + 1
    key = np.unique(row[inner] * np.int64(kinds) + code)
    r, c = key // kinds, key % kinds
    rare = c[np.lexsort((c, np.bincount(c, minlength=kinds)[c], r))]
    off = np.searchsorted(r, np.arange(rows + 1))
    lists: dict[int, list[int]] = {}
    out = np.zeros(rows, bool)
    for k in range(rows):
        mine, n = c[off[k] : off[k + 1]], int(off[k + 1] - off[k])
        head = rare[off[k] : off[k + 1]][: n - int(np.ceil(COPY * n)) + 1].tolist()
        for x in {x for g in head for x in lists.get(g, ())}:
            m = int(off[x + 1] - off[x])
            if min(m, n) >= COPY * max(m, n):
                both = len(np.intersect1d(mine, c[off[x] : off[x + 1]], assume_unique=True))
                if both >= COPY * (m + n - both):
                    out[k] = True
                    break
        if not out[k]:
            for g in head:
                lists.setdefault(g, []).append(k)
    return out


def label_words(hashes: np.ndarray, ptr: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """1 for the words of toxic rows that the labels of rows show to be toxic; near copies count once."""
    rows = len(toxic)
    row = np.repeat(np.arange(rows), np.diff(ptr))
    fresh = ~near_copies(hashes, ptr) & (np.diff(ptr) > 0)
    use = fresh[row]
    word, code = np.unique(hashes, return_inverse=True)
    pair = np.unique(code[use] * np.int64(rows) + row[use])
    hot = toxic[pair % rows]
    k = np.bincount((pair // rows)[hot], minlength=len(word)).astype(float)
    m = np.bincount((pair // rows)[~hot], minlength=len(word)).astype(float)
    share = np.count_nonzero(hot) / max(1, len(pair))
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = 2 * (np.where(k > 0, k * np.log(k / ((k + m) * share)), 0) + np.where(m > 0, m * np.log(m / ((k + m) * (1 - share))), 0))
    bad = (k >= 0.95 * (k + m)) & (ratio >= EVIDENCE)
    return (bad[code] & toxic[row]).astype(np.int64)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN, max_chars: int = MAX_CHARS) -> Crf | None:
    """Fits on a sample of bounded size; None if there is no toxic word to learn."""
    known = labels.select(F.col("doc_id").alias("id"), "toxic").dropna().groupBy("id").agg(F.max("toxic").alias("toxic"))
    fits = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).filter(F.length("text") <= max_chars)
    order = F.xxhash64("id")
    here = known.join(fits.select("id"), "id", "left_semi")
    some = here.filter("toxic = 1").orderBy(order, "id").limit(max_toxic).union(here.filter("toxic = 0").orderBy(order, "id").limit(max_clean))
    # Both the broadcast and what is collected are bounded by the three limits.
    rows = fits.join(F.broadcast(some), "id").groupBy("id", "toxic").agg(F.min("text").alias("text")).toArrow().sort_by([("id", "ascending")])
    if not rows.num_rows:
        return None
    parts = [Tokens(data, off) for _, _, data, off in chunks(rows["text"].combine_chunks())]
    start = np.cumsum([0] + [len(t.hash) for t in parts])
    ptr = np.concatenate([t.ptr[:-1] + a for t, a in zip(parts, start)] + [start[-1:]])
    y = label_words(np.concatenate([t.hash for t in parts]), ptr, rows["toxic"].to_numpy() == 1)
    return fit([(t, y[a:b]) for t, a, b in zip(parts, start[:-1], start[1:])]) if y.any() else None


def tags(text: Column, crf: Crf | None, cut: float = CUT) -> Column:
    """struct<score, spans: array<struct<start, end>>> of a text column."""

    def run(texts: pa.Array) -> pa.Array:
        score, off, lo, hi = [], [0], [], []
        for _, _, data, o in chunks(texts):
            t = Tokens(data, o)
            p = crf.marginals(t) if crf else np.zeros(len(t.start))
            rows = len(o) - 1
            top = np.zeros(rows)
            some = np.diff(t.ptr) > 0
            if some.any():
                top[some] = np.maximum.reduceat(p, t.ptr[:-1][some])
            score.append(top)
            hot = np.flatnonzero(p >= cut)
            chars = char_sums(data)
            row = np.searchsorted(t.ptr, hot, "right") - 1
            head = np.concatenate(([True], (hot[1:] != hot[:-1] + 1) | (row[1:] != row[:-1]))) if len(hot) else np.zeros(0, bool)
            tail = np.append(head[1:], True) if len(hot) else head
            base = chars[o[row]]
            lo.append((chars[t.start[hot]] - base)[head])
            hi.append((chars[t.end[hot]] - base)[tail])
            off += (off[-1] + np.cumsum(np.bincount(row[head], minlength=rows))).tolist()
        flat = lambda x: pa.array(np.concatenate(x or [np.zeros(0)]).astype(np.int32))
        inner = pa.StructArray.from_arrays([flat(lo), flat(hi)], ["start", "end"])
        return pa.StructArray.from_arrays(
            [pa.array(np.concatenate(score or [np.zeros(0)])), pa.ListArray.from_arrays(pa.array(off, pa.int32()), inner)], ["score", "spans"]
        )

    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "struct<score:double,spans:array<struct<start:int,end:int>>>").asNondeterministic()(text)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, score, spans) of every row of ``docs``."""
    crf = train(docs, labels, id_col, text_col, **options)
    return docs.select(docs[id_col].alias("doc_id"), tags(docs[text_col], crf).alias("t")).select("doc_id", "t.score", "t.spans")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; those without a toxic span have an empty list."""
    return toxicity(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
