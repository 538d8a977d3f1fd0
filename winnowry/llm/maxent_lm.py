"""Operator 8: a hashed maximum-entropy language model.

Words are counted over the whole corpus. The most frequent have places of their own, the others share an eighth of the
places by hash. Places are factored into LEVELS digits of base ``width``: classes, classes within a class, and members,
so p(word) = p(class) * p(inner class | class) * p(member | both) * p(word | place), each but the last a softmax over
``width`` values given the features. The last is the word's exact part of the occurrences of its place in the corpus, so
no word is scored by an average of those that share its place. Width and table rows grow with the number of types that occur FREQUENT times.
Features are the word before, the two before, and two skips (the word two and three before); their hashes, with the
digits so far, choose rows of a weight table for each level.

Training is ROUNDS passes of distributed gradient updates: every task starts from the current weights and sums of past
gradients, runs over all its words in batches with steps scaled by row, and returns the change; changes are summed by
slices of the tables in a shuffle and averaged by words. A gradient is scattered to the rows of all features of a batch
at once, two weights as one complex number. Scoring multiplies rows of exponentials instead of taking exponentials of
sums, unless weights are so large that products could overflow. What travels back to the driver is one table. Scoring runs over all
documents in blocks. The occurrences of every word without a place of its own, however many there are, come from a
shuffle of each block's words by slices of their hashes and go back to the block. ``scores`` is an Arrow UDF for any
texts; their words needn't occur in the corpus, so there the types that share a place have equal parts.

Defined results: a null, empty or blank text has 0 words and null for the mean and the perplexity. Repeated rows are
trained on as often as they occur and get equal scores. Words that occur equally often are ranked by hash. With an empty
table the result is empty. Very long texts are scored whole. Other columns are not read. Sums of floats depend on the
division into tasks in the last digits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from winnowry.session import cut

from ._words import BASE, CHUNK, U, Words, chunks, mix, trim

#: The least width: 32 ** 3 places.
WIDTH, LEVELS = 32, 3
#: Rows of the tables at the least width, as powers of two.
BITS = (13, 14, 15)
#: Types with this many occurrences have places of their own, however many types these are.
FREQUENT = 20_000
FEATURES = 4
BATCH, SCORED = 2048, 1 << 11
ROUNDS = 1
RATE = 0.1
#: Sums of weights beyond this are as good as certain.
MOST = 40.0
#: Words are looked up by this many first bits of their hashes.
FIRST = 18
SLICES = 256
#: Bytes of text that are enough for a block of scored documents.
BLOCK = 8 << 20


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, data, off in chunks(batch.column(0), 8 << 20):
            w, n = np.unique(Words(data, off).hash, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), pa.array(n)], ["word", "n"])
    trim()


def layout(frequent: int) -> tuple[int, int]:
    """The width, which is even, and the places that rare words share: a power of two, an eighth of all or less."""
    width = max(WIDTH, 2 * int(np.ceil((frequent * 8 / 7) ** (1 / LEVELS) / 2)))
    return width, 1 << int(np.log2(width**LEVELS / 8))


class Model:
    """Places of the frequent words, types and occurrences by shared place, and the weights of each level."""

    def __init__(
        self,
        words: np.ndarray,
        types: np.ndarray,
        width: int = WIDTH,
        shared: int | None = None,
        bits: tuple[int, ...] = BITS,
        total: np.ndarray | None = None,
    ):
        self.width = width
        self.shared = layout(0)[1] if shared is None else shared
        self.own = width**LEVELS - self.shared
        more = max(0, int(np.ceil(LEVELS * np.log2(width / WIDTH))))
        self.bits = tuple(b + more for b in bits)
        order = np.argsort(words)
        self.words, self.place = words[order], order
        #: Where words begin by their first bits, and how many share these at most.
        bounds = np.searchsorted(self.words >> U(64 - FIRST), np.arange((1 << FIRST) + 1, dtype=U)).astype(np.int32)
        self.first, self.longest = bounds[:-1], int(np.diff(bounds).max())
        self.log_types = np.log(np.maximum(types, 1)).astype(np.float32)
        #: Logarithms of the occurrences of all words that share a place; 0 for places of one word.
        self.log_total = np.log(np.maximum(types if total is None else total, 1))
        self.tables = [np.zeros((1 << b, width), np.float32) for b in self.bits]
        #: Sums of squared gradients by row.
        self.seen = [np.zeros(1 << b, np.float32) for b in self.bits]

    def places(self, h: np.ndarray) -> np.ndarray:
        out = self.own + (h & U(self.shared - 1)).astype(np.int64)
        if len(self.words):
            at, last = np.take(self.first, (h >> U(64 - FIRST)).astype(np.int64)), len(self.words) - 1
            for k in range(self.longest):
                there = np.minimum(at + k, last)
                hit = np.flatnonzero(np.take(self.words, there) == h)
                out[hit] = self.place[there[hit]]
        return out

    @staticmethod
    def features(w: Words) -> np.ndarray:
        """Hashes (FEATURES, n); what lies before the text counts as one word."""
        n, h = len(w.hash), w.hash
        pos = np.arange(n) - np.repeat(w.ptr[:-1], w.counts)

        def back(k: int) -> np.ndarray:
            out = np.zeros(n, U)
            out[k:] = h[: n - k] if k < n else h[:0]
            out[pos < k] = 0
            return out

        a, b, c = back(1), back(2), back(3)
        return np.stack([mix(x + U(s)) for s, x in ((11, a), (12, a * BASE + b), (13, b), (14, c))])

    def powers(self) -> list[np.ndarray] | None:
        """Exponentials of the weights, or nothing where products of FEATURES of them could overflow."""
        if any(np.abs(t).max() > MOST / 2 for t in self.tables):
            return None
        return [np.exp(t) for t in self.tables]

    def softmax(self, f: np.ndarray, place: np.ndarray, powers: list[np.ndarray] | None = None):
        """For each level: the table, its rows (FEATURES, n), the targets, exponentials, and their sums."""
        join, least, most = (np.multiply, np.exp(np.float32(-MOST)), np.exp(np.float32(MOST))) if powers else (np.add, np.float32(-MOST), np.float32(MOST))
        for k, (table, bits) in enumerate(zip(self.tables, self.bits)):
            before, target = np.divmod(place // self.width ** (LEVELS - 1 - k), self.width)
            key = mix(f + before.astype(U) * BASE) if k else f
            rows = (key >> U(64 - bits)).astype(np.int64)
            source = powers[k] if powers else table
            z, more = np.take(source, rows[0], axis=0), np.empty((len(place), self.width), np.float32)
            for row in rows[1:]:
                join(z, np.take(source, row, axis=0, out=more, mode="clip"), out=z)
            if z.max(initial=least) > most or z.min(initial=most) < least:
                np.clip(z, least, most, out=z)
            if not powers:
                np.exp(z, out=z)
            yield table, rows, target, z, np.einsum("ij->i", z)

    def log_place(self, f: np.ndarray, place: np.ndarray, powers: list[np.ndarray] | None = None) -> np.ndarray:
        """The logarithmic probability of each word's place."""
        at = np.arange(len(place))
        return sum(np.log(z[at, target] / total) for _, _, target, z, total in self.softmax(f, place, powers))

    def log_probability(self, f: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The same of a word, if the types that share a place have equal parts."""
        return self.log_place(f, place) - self.log_types[place]

    def update(self, f: np.ndarray, place: np.ndarray, rate: float) -> None:
        """One step up the gradient of the batch's logarithmic likelihood."""
        n, half = len(place), self.width // 2
        at, column = np.arange(n), np.arange(half)
        index, step = np.empty((n, half), np.int64), np.empty((n, self.width), np.float32)
        for (table, rows, target, z, total), seen in zip(self.softmax(f, place), self.seen):
            g = np.multiply(z, (np.float32(-1) / total)[:, None], out=z)
            g[at, target] += 1
            size = np.einsum("ij,ij->i", g, g) / np.float32(self.width)
            pairs = table.reshape(-1).view(np.complex64)
            for row in rows:
                np.add.at(seen, row, size)
                np.multiply(g, (np.float32(rate) / np.sqrt(seen[row] + np.float32(1e-3)))[:, None], out=step)
                np.add((row * half)[:, None], column, out=index)
                np.add.at(pairs, index.reshape(-1), step.reshape(-1).view(np.complex64))

    def flat(self) -> np.ndarray:
        return np.concatenate([x.reshape(-1) for x in (*self.tables, *self.seen)])

    def set(self, x: np.ndarray) -> None:
        parts = [*self.tables, *self.seen]
        ends = np.cumsum([p.size for p in parts])
        made = [y.reshape(p.shape).astype(np.float32) for p, y in zip(parts, np.split(x, ends[:-1]))]
        self.tables, self.seen = made[:LEVELS], made[LEVELS:]

    def copy(self) -> Model:
        mine = Model.__new__(Model)
        mine.__dict__ |= self.__dict__
        mine.set(self.flat())
        return mine

    def learn(self, w: Words, rate: float) -> None:
        f, place = self.features(w), self.places(w.hash)
        for lo in range(0, len(place), BATCH):
            self.update(f[:, lo : lo + BATCH], place[lo : lo + BATCH], rate)

    def by_place(self, w: Words, powers: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The place of each word, and the logarithmic probability of the place."""
        f, place = self.features(w), self.places(w.hash)
        parts = [self.log_place(f[:, lo : lo + SCORED], place[lo : lo + SCORED], powers) for lo in range(0, len(place), SCORED)]
        return place, np.concatenate(parts or [np.zeros(0)]).astype(np.float64)

    def score(self, w: Words, powers: list[np.ndarray] | None = None) -> np.ndarray:
        """The logarithmic probability of each word, if the types that share a place have equal parts."""
        place, p = self.by_place(w, powers)
        return p - self.log_types[place]


def _train(model: Model, rate: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine, n = model.copy(), 0
        for batch in batches:
            for _, _, data, off in chunks(batch.column(0)):
                w = Words(data, off)
                n += len(w.hash)
                mine.learn(w, rate)
        if n:
            change = ((mine.flat() - model.flat()) * np.float32(n)).astype("<f4")
            parts = np.array_split(change, SLICES)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(SLICES), pa.int32()), pa.array([n] * SLICES, pa.int64()), pa.array([p.tobytes() for p in parts], pa.binary())],
                ["slice", "n", "change"],
            )
        trim()

    return run


def _sum(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, n = None, 0
    for b in batches:
        for m, c in zip(b.column("n").to_pylist(), b.column("change")):
            x = np.frombuffer(c.as_py(), "<f4").astype(np.float64)
            total = x if total is None else total + x
            n += m
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([(total / n).astype("<f4").tobytes()], pa.binary())], ["slice", "change"])


def train(docs: DataFrame, text_col: str = "text", rounds: int = ROUNDS, rate: float = RATE) -> Model:
    texts = docs.select(docs[text_col].alias("text"))
    counts = texts.mapInArrow(_counts, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    counts = cut(counts, "op8-words")
    width, shared = layout(counts.filter(F.col("n") >= FREQUENT).count())
    own = width**LEVELS - shared
    top = counts.orderBy(F.desc("n"), "word").limit(own).collect()
    words = np.array([r["word"] for r in top], np.int64).view(U)
    types, total = np.zeros(own + shared), np.zeros(own + shared, np.int64)
    types[:own] = 1
    bucket = F.col("word").bitwiseAND(F.lit(shared - 1))
    for r in counts.groupBy(bucket.cast("int").alias("b")).agg(F.count("*").alias("types"), F.sum("n").alias("n")).collect():
        types[own + r["b"]], total[own + r["b"]] = r["types"], r["n"]
    home = own + (words % U(shared)).astype(np.int64)
    np.add.at(types, home, -1)
    np.add.at(total, home, -np.array([r["n"] for r in top], np.int64))
    model = Model(words, types, width, shared, total=total)
    for _ in range(rounds):
        made = texts.mapInArrow(_train(model, rate), "slice int, n bigint, change binary")
        done = made.groupBy("slice").applyInArrow(_sum, "slice int, change binary").collect()
        if done:
            change = np.concatenate([np.frombuffer(bytes(r["change"]), "<f4") for r in sorted(done)])
            model.set(model.flat() + change)
    return model


def scores(text: Column, model: Model) -> Column:
    """struct<n_words, mean_logprob, perplexity> of any text column; types that share a place have equal parts."""

    def run(texts: pa.Array) -> pa.Array:
        count, total, powers = [], [], model.powers()
        for _, _, data, off in chunks(texts):
            w = Words(data, off)
            c = np.concatenate(([0.0], np.cumsum(model.score(w, powers))))
            total.append(c[w.ptr[1:]] - c[w.ptr[:-1]])
            count.append(w.counts)
        n = np.concatenate(count or [np.zeros(0, np.int64)])
        mean = np.concatenate(total or [np.zeros(0)]) / np.maximum(n, 1)
        none = n == 0
        return pa.StructArray.from_arrays(
            [pa.array(n.astype(np.int64)), pa.array(mean, mask=none), pa.array(np.exp(-mean), mask=none)], ["n_words", "mean_logprob", "perplexity"]
        )

    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "struct<n_words:bigint,mean_logprob:double,perplexity:double>").asNondeterministic()(text)


def _block(ids: pa.Array, parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    """One row: ids, words, sums and rare words of the documents; the rare words, sorted, and what points at them."""
    *lists, rare = (np.concatenate(x) for x in zip(*parts))
    words, at, times = np.unique(rare, return_inverse=True, return_counts=True)
    ends = pa.array([0, len(ids)], pa.int32())
    packed = [x.tobytes() for x in (at.astype("<u4"), words.astype("<u8"), times.astype("<i8"))]
    return pa.RecordBatch.from_arrays(
        [*(pa.ListArray.from_arrays(ends, x) for x in (ids, *map(pa.array, lists))), *(pa.array([x], pa.binary()) for x in packed)],
        ["doc_id", "n_words", "total", "rare", "at", "words", "times"],
    )


def _blocks(model: Model):
    """Blocks of documents with the sums of what is known without the other blocks, and the words that share places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = model.powers()
        for batch in batches:
            start, size, parts = 0, 0, []
            for _, hi, data, off in chunks(batch.column(1), min(CHUNK, BLOCK)):
                w = Words(data, off)
                place, p = model.by_place(w, powers)
                c = np.concatenate(([0.0], np.cumsum(p - model.log_total[place])))
                rare = np.flatnonzero(place >= model.own)
                parts.append((w.counts, c[w.ptr[1:]] - c[w.ptr[:-1]], np.diff(np.searchsorted(rare, w.ptr)), w.hash[rare]))
                size += len(data)
                if size >= BLOCK or hi == len(batch):
                    yield _block(batch.column(0).slice(start, hi - start), parts)
                    start, size, parts = hi, 0, []
        trim()

    return run


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of a block by SLICES of their hashes, in order."""
    for batch in batches:
        for block, words, times in zip(*batch.columns):
            w, n = np.frombuffer(words.as_buffer(), "<u8"), np.frombuffer(times.as_buffer(), "<i8")
            cuts = np.searchsorted(w, np.arange(1, SLICES, dtype=U) * U((1 << 64) // SLICES))
            parts = [(k, x.tobytes(), y.tobytes()) for k, (x, y) in enumerate(zip(np.split(w, cuts), np.split(n, cuts))) if len(x)]
            if parts:
                k, x, y = zip(*parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k, pa.int32()), pa.array([block.as_py()] * len(k), pa.int64()), pa.array(x, pa.binary()), pa.array(y, pa.binary())],
                    ["slice", "block", "words", "times"],
                )


def _occurrences(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each block's words of a slice, how often they occur in all blocks."""
    blocks, words, times = [], [], []
    for b in batches:
        blocks += b.column("block").to_pylist()
        words += [np.frombuffer(x.as_py(), "<u8") for x in b.column("words")]
        times += [np.frombuffer(x.as_py(), "<i8") for x in b.column("times")]
    _, at = np.unique(np.concatenate(words), return_inverse=True)
    n, new = np.concatenate(times), np.zeros(at.max() + 1, np.int64)
    np.add.at(new, at, n)
    back = np.split(new[at].astype("<i8"), np.cumsum([len(x) for x in words])[:-1])
    yield pa.RecordBatch.from_arrays(
        [pa.array(blocks, pa.int64()), pa.array([key[0].as_py()] * len(blocks), pa.int32()), pa.array([x.tobytes() for x in back], pa.binary())],
        ["block", "slice", "n"],
    )


def _finish(block: pa.Table, found: pa.Table) -> pa.Table:
    """The documents of a block, with the parts of the words that share places."""
    n = [np.frombuffer(x.as_py(), "<i8") for x in found.sort_by("slice").column("n")]
    logs = np.log(np.concatenate(n or [np.ones(0)]))
    ids, counts, total, rare = (block.column(k).combine_chunks().flatten() for k in ("doc_id", "n_words", "total", "rare"))
    c = np.concatenate(([0.0], np.cumsum(logs[np.frombuffer(block.column("at")[0].as_py(), "<u4")])))
    ends = np.concatenate(([0], np.cumsum(rare.to_numpy())))
    words = counts.to_numpy()
    mean, none = (total.to_numpy() + c[ends[1:]] - c[ends[:-1]]) / np.maximum(words, 1), words == 0
    return pa.table([ids, counts, pa.array(mean, mask=none), pa.array(np.exp(-mean), mask=none)], ["doc_id", "n_words", "mean_logprob", "perplexity"])


def scored(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, n_words, mean_logprob, perplexity) of every row, by a model of all rows."""
    model = train(docs, text_col, **options)
    docs = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    kind = docs.schema["doc_id"].dataType
    lists = [("doc_id", kind), ("n_words", T.LongType()), ("total", T.DoubleType()), ("rare", T.LongType())]
    made = T.StructType([T.StructField(k, T.ArrayType(t)) for k, t in lists] + [T.StructField(k, T.BinaryType()) for k in ("at", "words", "times")])
    blocks = docs.mapInArrow(_blocks(model), made)
    blocks = cut(blocks.withColumn("block", F.monotonically_increasing_id()), "op8-blocks")
    words = blocks.select("block", "words", "times").mapInArrow(_slices, "slice int, block bigint, words binary, times binary")
    found = words.groupBy("slice").applyInArrow(_occurrences, "block bigint, slice int, n binary")
    left = blocks.drop("words", "times").groupBy("block")
    numbers = [("n_words", T.LongType()), ("mean_logprob", T.DoubleType()), ("perplexity", T.DoubleType())]
    out = T.StructType([T.StructField(k, t) for k, t in [("doc_id", kind), *numbers]])
    return left.cogroup(found.groupBy("block")).applyInArrow(_finish, out)


def op8_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark.read.parquet(f"{sf_dir}/documents.parquet"))
