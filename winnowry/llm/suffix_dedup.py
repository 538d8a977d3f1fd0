"""Operator 2: repeated passages by a distributed sparse suffix array.

A passage is MIN_WORDS words or more in a row that occur at another place too, in any document. Suffixes start at
anchors: positions whose 4-gram hash is the least of some WINDOW neighbouring ones. The choice depends on the words
alone, so copies of a passage have the same anchors, and one lies among its first WINDOW words: no passage is missed,
while only about 2 in WINDOW + 1 positions need a suffix.

1. Anchors are counted by the 64-bit hash of the MIN_WORDS - WINDOW + 1 words that follow (map-side combining); those
   that occur once leave.
2. The rest get their context: those words, 16 bits each for sorting, with their 64-bit hash as the last resort, and
   32 bits of the hash of each window of MIN_WORDS words that begins at the anchor or up to WINDOW - 1 words before it.
3. Sampled splitters range-partition the suffixes by their leading words; ties are split by place, so a passage with
   any number of copies spreads over several buckets.
4. Each bucket is sorted by multikey quicksort. Neighbours whose common prefix is long enough form runs; in a run, the
   windows of MIN_WORDS words around the anchors that agree are repeated. Runs at the edge of a bucket are compared
   across the boundary, by an aggregation over the hashes of their windows.
5. Windows merge to spans by document.

Two windows are equal if the 64 bits of their common words and the 32 bits of their whole are.

Defined results: null, empty and short texts have no spans and no row; an empty table gives an empty result. A passage
may repeat within one document, overlapping itself: a word said 51 times in a row is a repeated passage. Of equal places the first by (doc_id, position)
is kept, later ones are listed in ``drop``; both appear in ``spans``. Rows that agree in doc_id and text are the same
occurrence, and a null doc_id sorts first. Very long texts are handled whole. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winnowry.session import cut

from ._words import BASE, U, Words, chunks, mix

MIN_WORDS = 50
WINDOW = 24
GRAM = 4


def _slide(x: np.ndarray, w: int, best) -> np.ndarray:
    """best over x[i : i + w] for each i, by doubling."""
    out, have = x, 1
    while have < w:
        step = min(have, w - have)
        out = best(out[: len(out) - step], out[step:])
        have += step
    return out


def anchors(h: np.ndarray, w: int) -> np.ndarray:
    """Positions that are the least of some w neighbours, ties included; ends count as neighbourhoods of their own."""
    if len(h) <= w:
        return np.flatnonzero(h == h.min()) if len(h) else np.zeros(0, np.int64)
    least = _slide(h, w, np.minimum)
    pad = np.zeros(w - 1, h.dtype)
    reach = _slide(np.concatenate((pad, least, pad)), w, np.maximum)
    return np.flatnonzero(reach == h)


def _anchor_lists(min_words: int, w: int):
    lead = min_words - w + 1

    def find(texts: pa.Array) -> pa.Array:
        off, pos, ctx = [np.zeros(1, np.int64)], [], []
        base = 0
        for _, _, data, o in chunks(texts):
            words = Words(data, o)
            n = len(words.hash)
            g, _ = words.grams(GRAM)
            at = anchors(g >> U(1), w)
            row = words.row()
            end = words.ptr[1:][row[at]] if n else np.zeros(0, np.int64)
            at = at[(at + lead <= end) & (words.counts[row[at]] >= min_words)] if n else at
            acc = np.zeros(len(at), U)
            for k in range(lead):
                acc = acc * BASE + words.hash[at + k]
            pos.append((at - words.ptr[row[at]]) if n else at)
            ctx.append(mix(acc).view(np.int64))
            count = np.bincount(row[at], minlength=len(o) - 1) if n else np.zeros(len(o) - 1, np.int64)
            off.append(base + np.cumsum(count))
            base = int(off[-1][-1])
        inner = pa.StructArray.from_arrays(
            [pa.array(np.concatenate(pos or [np.zeros(0)]).astype(np.int32)), pa.array(np.concatenate(ctx or [np.zeros(0, np.int64)]))],
            ["pos", "ctx"],
        )
        return pa.ListArray.from_arrays(pa.array(np.concatenate(off).astype(np.int32)), inner)

    find.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(find, "array<struct<pos:int,ctx:bigint>>").asNondeterministic()


def _contexts(min_words: int, w: int):
    """array<struct<pos, right, windows>>: right holds big-endian 16-bit codes of the words from pos on and their 64-bit
    hash, windows 32 bits of the hash of each window, 0 where it leaves the text."""
    lead = min_words - w + 1

    def cut_out(texts: pa.Array, places: pa.Array) -> pa.Array:
        off, parts, rights, windows = [0], [], [], []
        p_off, p_all = places.offsets.to_numpy().astype(np.int64), places.values.to_numpy().astype(np.int64)
        for lo, hi, data, o in chunks(texts):
            words = Words(data, o)
            whole, ok = words.grams(min_words)
            whole = np.append(np.where(ok, (whole >> U(32)) | U(1), U(0)).astype("<u4"), np.uint32(0))
            code = (words.hash >> U(48)).astype(">u2")
            mine = p_all[p_off[lo] : p_off[hi]]
            row = np.repeat(np.arange(hi - lo), np.diff(p_off[lo : hi + 1]))
            at = mine + words.ptr[row]
            right, window = np.zeros((len(at), lead + 4), ">u2"), np.zeros((len(at), w), "<u4")
            acc = np.zeros(len(at), U)
            for k in range(lead):
                right[:, k] = code[at + k]
                acc = acc * BASE + words.hash[at + k]
            right[:, lead:] = mix(acc).astype(">u8").view(">u2").reshape(-1, 4)
            for k in range(w):
                window[:, k] = whole[np.where(mine >= k, at - k, -1)]
            parts.append(mine)
            rights.append(right)
            windows.append(window)
            off += (p_off[lo + 1 : hi + 1] - p_off[0]).tolist()

        def binary(rows: list[np.ndarray], width: int) -> pa.Array:
            flat = np.concatenate(rows).tobytes() if rows else b""
            n = len(flat) // width
            ends = np.arange(n + 1, dtype=np.int32) * width
            return pa.BinaryArray.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(flat)])

        pos = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        inner = pa.StructArray.from_arrays([pa.array(pos.astype(np.int32)), binary(rights, 2 * lead + 8), binary(windows, 4 * w)], ["pos", "right", "windows"])
        return pa.ListArray.from_arrays(pa.array(np.array(off, np.int32)), inner)

    cut_out.__annotations__ = {"texts": pa.Array, "places": pa.Array, "return": pa.Array}
    return F.arrow_udf(cut_out, "array<struct<pos:int,right:binary,windows:binary>>").asNondeterministic()


def multikey_quicksort(m: np.ndarray) -> np.ndarray:
    """The order of the rows of m by their columns: three-way partitioning on one column at a time."""
    order = np.arange(len(m))
    stack = [(0, len(m), 0)]
    while stack:
        lo, hi, d = stack.pop()
        if hi - lo < 2 or d >= m.shape[1]:
            continue
        part = order[lo:hi]
        if hi - lo <= 48:
            order[lo:hi] = part[np.lexsort(m[part, d:].T[::-1])]
            continue
        col = m[part, d]
        pivot = np.sort(col[[0, len(col) // 2, -1]])[1]
        less, same = col < pivot, col == pivot
        a, b = int(less.sum()), int(same.sum())
        order[lo:hi] = np.concatenate((part[less], part[same], part[~(less | same)]))
        stack += [(lo, lo + a, d), (lo + a, lo + a + b, d + 1), (lo + a + b, hi, d)]
    return order


def _bucket(min_words: int, w: int):
    lead = min_words - w + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        t = pa.Table.from_batches(got).combine_chunks()
        n = t.num_rows

        def flat(name: str, width: int, kind: str) -> np.ndarray:
            col = t[name].chunk(0)
            start = np.frombuffer(col.buffers()[1], np.int32)[col.offset]
            return np.frombuffer(col.buffers()[2], kind, n * width, start).reshape(n, width)

        right, windows = flat("right", lead + 4, ">u2").astype(np.uint16), flat("windows", w, "<u4")
        place = t.select(["doc_id", "did", "pos"])
        order = multikey_quicksort(right)
        s = right[order]
        common = (s[1:] == s[:-1]).all(axis=1)
        run_id = np.concatenate(([0], np.cumsum(~common)))
        edge = np.zeros(n, bool)
        edge[order] = (run_id == 0) | (run_id == run_id[-1])
        said = np.ascontiguousarray(right[:, lead:]).astype(">u2").view(">u8").reshape(-1).astype(U)  # the hash of the common words
        ok = windows > 0
        keys = mix(said[:, None] + (windows.astype(U) << U(5)) + np.arange(w, dtype=U))
        who = pa.compute.rank(t["did"].combine_chunks(), tiebreaker="dense").to_numpy().astype(np.int64)
        doc = t["doc_id"].combine_chunks()
        rank = pa.compute.rank(doc, null_placement="at_start", tiebreaker="dense").to_numpy().astype(np.int64)
        pos = t["pos"].to_numpy().astype(np.int64)
        every, later = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for o in range(w):
            mine = np.flatnonzero(ok[:, o] & ~edge)
            k = keys[mine, o]
            by = np.lexsort((pos[mine], who[mine], rank[mine], k))
            mine, k = mine[by], k[by]
            if len(mine) < 2:
                continue
            head = np.concatenate(([True], k[1:] != k[:-1]))
            same_place = np.concatenate(([False], (who[mine][1:] == who[mine][:-1]) & (pos[mine][1:] == pos[mine][:-1]) & ~head[1:]))
            group = np.cumsum(head) - 1
            first = ~same_place
            distinct = np.bincount(group[first])
            nth = np.cumsum(first) - np.concatenate(([0], np.cumsum(distinct)[:-1]))[group]
            hit = distinct[group] > 1
            every[mine[hit]] |= 1 << o
            later[mine[hit & (nth > 1)]] |= 1 << o
        found = np.flatnonzero(every)
        none = pa.nulls(len(found), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [*(c.combine_chunks().take(pa.array(found)) for c in place.columns), pa.array(every[found]), pa.array(later[found]), none],
            ["doc_id", "did", "pos", "every", "later", "key"],
        )
        at, o = np.nonzero(ok & edge[:, None])
        for lo in range(0, len(at), 100_000):
            a, b = at[lo : lo + 100_000], o[lo : lo + 100_000]
            yield pa.RecordBatch.from_arrays(
                [
                    *(c.combine_chunks().take(pa.array(a)) for c in place.columns),
                    pa.array(np.left_shift(np.int64(1), b)),
                    pa.array(np.zeros(len(a), np.int64)),
                    pa.array(keys[a, b].view(np.int64)),
                ],
                ["doc_id", "did", "pos", "every", "later", "key"],
            )

    return run


def _spans(min_words: int):
    """Merges the windows of one document: (pos, bits) -> spans."""

    def merge(rows: pa.Array) -> pa.Array:
        off = rows.offsets.to_numpy()
        pos, every, later = (rows.values.field(k).to_numpy().astype(np.int64) for k in ("pos", "every", "later"))

        def merged(bits: np.ndarray) -> pa.Array:
            ends, lo, hi = [0], [], []
            for a, b in zip(off[:-1], off[1:]):
                p, m = pos[a:b], bits[a:b]
                starts = np.unique(np.concatenate([p[(m >> o) & 1 == 1] - o for o in range(63) if (m >> o).any()] or [np.zeros(0, np.int64)]))
                if len(starts):
                    gap = np.flatnonzero(starts[1:] > starts[:-1] + min_words)
                    lo += starts[np.concatenate(([0], gap + 1))].tolist()
                    hi += (starts[np.concatenate((gap, [len(starts) - 1]))] + min_words).tolist()
                ends.append(len(lo))
            inner = pa.StructArray.from_arrays([pa.array(lo, pa.int32()), pa.array(hi, pa.int32())], ["start", "end"])
            return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), inner)

        return pa.StructArray.from_arrays([merged(every), merged(later)], ["spans", "drop"])

    merge.__annotations__ = {"rows": pa.Array, "return": pa.Array}
    span = "array<struct<start:int,end:int>>"
    return F.arrow_udf(merge, f"struct<spans:{span},drop:{span}>").asNondeterministic()


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, window: int = WINDOW) -> DataFrame:
    """(doc_id, spans, drop) of every document with a repeated passage; spans of words [start, end), counted from 0."""
    base = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).filter(F.length("text") >= 2 * min_words - 1)
    base = base.withColumn("did", F.xxhash64("doc_id", "text"))
    a = base.select("did", F.explode(_anchor_lists(min_words, window)(F.col("text"))).alias("a")).select("did", "a.*")
    place = F.struct("did", "pos")
    often = a.groupBy("ctx").agg(F.min(place).alias("p"), F.max(place).alias("q")).filter("p <> q").select("ctx")
    left = a.join(often, "ctx", "left_semi").groupBy("did").agg(F.collect_set("pos").alias("places"))
    suffixes = base.join(left, "did").select("doc_id", "did", F.explode(_contexts(min_words, window)(F.col("text"), F.col("places"))).alias("c"))
    suffixes = cut(suffixes.select("doc_id", "did", "c.*"), "op2-suffixes")
    kind = docs.schema[id_col].dataType.simpleString()
    buckets = suffixes.repartitionByRange("right", "did", "pos")
    out = cut(buckets.mapInArrow(_bucket(min_words, window), f"doc_id {kind}, did bigint, pos int, every bigint, later bigint, key bigint"), "op2-buckets")
    inside = out.filter("key IS NULL").drop("key")
    across = out.filter("key IS NOT NULL")
    at = F.struct("doc_id", "did", "pos")
    shared = across.groupBy("key").agg(F.min(at).alias("p"), F.max(at).alias("q")).filter(~F.col("p").eqNullSafe(F.col("q")))
    edges = across.join(shared, "key").select(
        "doc_id", "did", "pos", "every", F.when(at.eqNullSafe(F.col("p")), F.lit(0).cast("long")).otherwise(F.col("every")).alias("later")
    )
    rows = inside.unionByName(edges).groupBy("did").agg(F.first("doc_id").alias("doc_id"), F.collect_list(F.struct("pos", "every", "later")).alias("rows"))
    return rows.select("doc_id", _spans(min_words)(F.col("rows")).alias("s")).select("doc_id", "s.*")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(spark.read.parquet(f"{sf_dir}/documents.parquet"))
