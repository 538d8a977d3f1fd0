"""Operator 4: benchmark decontamination by size-partitioned MinHash containment search.

Test items are short and documents long, so the Jaccard similarity of an item and a whole document says little. Items
are therefore partitioned by size: class c holds items of 2**(c-1) < shingles <= 2**c, and for it each document is cut
into windows of two adjacent blocks of 2**c shingles, one block apart, so that any run of an item's length lies whole
in one window and containment x means Jaccard similarity of at least x * q / (2 * 2**c + q * (1 - x)). MinHash values
of the windows (block minima, joined pairwise, and joined again for the next class) are looked up in a table of the
items' values; one agreeing value makes a candidate. With 48 hash functions and THRESHOLD 0.6 the least similarity is
0.136, and a match is missed with probability 0.0009 at most, with full containment 0.000001. Items of at most 8
shingles are looked up by every shingle, which misses none. Candidates are verified by exact containment: the share of
the item's distinct shingles that the document has.

The documents are read once per slice of the items, with no shuffle: the table of a slice is limited to SLICE_BYTES,
and more items make more slices, so what travels to the executors never grows beyond that. Slices are made one after
the other, and the result of each is written before the next, so the driver holds one at a time.

Defined results: of a tie, that is an item at the threshold, the document counts as contaminated; an empty table of
documents or items gives an empty result. Very long texts are searched whole. Null, empty and blank texts and items match nothing; an item or document shorter than 3 words is one
shingle of all its words. Words are compared as they are. Rows that share an id are judged each by itself; repeated
rows repeat their results, but an item row repeated with equal id and text counts once. Null ids are reported as null.
Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from winnowry.session import cut

from ._words import U, Words, chunks, mix

SHINGLE = 3
THRESHOLD = 0.6
HASHES = 48
#: Items of up to this many shingles are looked up by each of them.
TINY = 8
#: Bytes of the lookup table that is sent to the executors at once.
SLICE_BYTES = 32 << 20


def _factors(m: int) -> np.ndarray:
    return (mix(np.arange(1, m + 1, dtype=U)) >> U(32)).astype(np.uint32) | np.uint32(1)


def _distinct(g: np.ndarray) -> np.ndarray:
    s = np.sort(g)
    return s[np.concatenate(([True], s[1:] != s[:-1]))] if len(s) else s


class Items:
    """The lookup table of one slice: shingle sets, and sorted MinHash values by class and hash function."""

    def __init__(self, ids: list, texts: list[str], n: int, m: int):
        self.n, self.factors = n, _factors(m)
        self.ids, self.sets = [], []
        for _, _, data, off in chunks(pa.array(texts, pa.string())):
            g, ptr = Words(data, off).shingles(n)
            self.sets += [_distinct(g[a:b]) for a, b in zip(ptr[:-1], ptr[1:])]
        self.ids = list(ids)
        tiny = [(x, k) for k, s in enumerate(self.sets) if len(s) <= TINY for x in s.tolist()]
        self.tiny = np.array(sorted(tiny), dtype=[("g", U), ("k", np.int64)]) if tiny else None
        self.classes: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for c in sorted({math.ceil(math.log2(len(s))) for s in self.sets if len(s) > TINY}):
            mine = [k for k, s in enumerate(self.sets) if len(s) > TINY and math.ceil(math.log2(len(s))) == c]
            low = [(self.sets[k] >> U(32)).astype(np.uint32) for k in mine]
            table = []
            for f in self.factors:
                v = np.array([(x * f).min() for x in low], np.uint32)
                order = np.argsort(v, kind="stable")
                table.append((v[order], np.array(mine)[order]))
            self.classes[c] = table

    def find(self, g: np.ndarray, ptr: np.ndarray) -> set[tuple[int, int]]:
        """Candidate (row, item) for rows with the shingles g[ptr[r]:ptr[r + 1]]."""
        out: set[tuple[int, int]] = set()
        if not len(g):
            return out
        if self.tiny is not None:
            self._look(self.tiny["g"], self.tiny["k"], g, np.repeat(np.arange(len(ptr) - 1), np.diff(ptr)), out)
        if not self.classes:
            return out
        low = (g >> U(32)).astype(np.uint32)
        plans, width, count = [], 1, np.diff(ptr)
        for c in range(min(self.classes), max(self.classes) + 1):
            step = (1 << c) // width  # blocks of the level below in a block of this one
            blocks = -(-count // step)
            first = np.concatenate(([0], np.cumsum(count)))[:-1]
            row = np.repeat(np.arange(len(count)), blocks)
            local = np.arange(len(row)) - np.repeat(np.concatenate(([0], np.cumsum(blocks)))[:-1], blocks)
            plans.append((c, first[row] + local * step, row))
            width, count = 1 << c, blocks
        for j, f in enumerate(self.factors):
            level = low * f
            for c, start, row in plans:
                level = np.minimum.reduceat(level, start)
                if c in self.classes:
                    window = level.copy()
                    pair = row[1:] == row[:-1]
                    window[:-1][pair] = np.minimum(level[:-1][pair], level[1:][pair])
                    self._look(*self.classes[c][j], window, row, out)
        return out

    @staticmethod
    def _look(keys: np.ndarray, items: np.ndarray, values: np.ndarray, row: np.ndarray, out: set) -> None:
        lo = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
        hit = np.flatnonzero(keys[lo] == values)
        if len(hit):
            end = np.searchsorted(keys, values[hit], "right")
            for r, a, b in zip(row[hit].tolist(), lo[hit].tolist(), end.tolist()):
                for k in range(a, b):
                    out.add((r, int(items[k])))

    def leaks(self, texts: pa.Array, threshold: float) -> list[list[tuple[int, float]]]:
        """For each row the (index of an item, containment) that reach the threshold."""
        out: list[list[tuple[int, float]]] = []
        for _, _, data, off in chunks(texts):
            g, ptr = Words(data, off).shingles(self.n)
            mine: list[list[tuple[int, float]]] = [[] for _ in range(len(ptr) - 1)]
            seen: dict[int, np.ndarray] = {}
            for r, k in sorted(self.find(g, ptr)):
                if r not in seen:
                    seen[r] = np.sort(g[ptr[r] : ptr[r + 1]])
                s, d = self.sets[k], seen[r]
                at = np.minimum(np.searchsorted(d, s), len(d) - 1)
                share = np.count_nonzero(d[at] == s) / len(s)
                if share >= threshold:
                    mine[r].append((k, share))
            out += mine
        return out


def _slices(items: DataFrame, id_col: str, text_col: str, hashes: int) -> Iterator[tuple[list, list[str], bool]]:
    """The items in slices whose tables stay below SLICE_BYTES, one at a time, and whether there are several."""
    base = items.select(items[id_col].alias("item_id"), items[text_col].alias("text")).filter(F.length(F.trim("text")) > 0).distinct()
    n, size = base.select(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    parts = max(1, math.ceil((n * hashes * 12 + size * 3) / SLICE_BYTES))
    if parts > 1:
        base = cut(base.withColumn("part", F.pmod(F.xxhash64("text", "item_id"), F.lit(parts)).cast("int")), "op4-items")
    for p in range(parts):
        rows = (base.filter(F.col("part") == p) if parts > 1 else base).collect()
        if rows:
            yield [r[0] for r in rows], [r[1] for r in rows], parts > 1


def _hits(text: Column, table: Items, threshold: float) -> Column:
    """array<struct<item: index in the table, containment>> of a text column."""

    def hits(texts: pa.Array) -> pa.Array:
        rows = table.leaks(texts, threshold)
        off = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int32)
        flat = [x for r in rows for x in r]
        inner = pa.StructArray.from_arrays(
            [pa.array([k for k, _ in flat], pa.int32()), pa.array([s for _, s in flat], pa.float64())], ["item", "containment"]
        )
        return pa.ListArray.from_arrays(pa.array(off), inner)

    hits.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(hits, "array<struct<item:int,containment:double>>").asNondeterministic()(text)


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    threshold: float = THRESHOLD,
    shingle: int = SHINGLE,
    hashes: int = HASHES,
) -> DataFrame:
    """(doc_id, item_id, containment) of every document and item at or above the threshold."""
    out = None
    base = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    kind = items.schema[item_id].dataType
    for ids, texts, several in _slices(items, item_id, item_text, hashes):
        table = Items(ids, texts, shingle, hashes)
        found = base.select("doc_id", F.explode(_hits(F.col("text"), table, threshold)).alias("h"))
        names = F.array(*[F.lit(x).cast(kind) for x in ids]) if len(ids) <= 1000 else None
        if names is not None:
            found = found.select("doc_id", names[F.col("h.item")].alias("item_id"), "h.containment")
        else:
            lookup = docs.sparkSession.createDataFrame(list(enumerate(ids)), f"item int, item_id {kind.simpleString()}")
            found = found.select("doc_id", "h.*").join(lookup, "item").select("doc_id", "item_id", "containment")
        found = cut(found, "op4-slice") if several else found
        out = found if out is None else out.unionByName(found)
    if out is None:
        return base.select("doc_id", F.lit(None).cast(kind).alias("item_id"), F.lit(0.0).alias("containment")).filter("false")
    return out


def clean(docs: DataFrame, items: DataFrame, text_col: str = "text", threshold: float = THRESHOLD, hashes: int = HASHES) -> DataFrame:
    """``docs`` without the documents that contain an item."""
    names = docs.columns
    for ids, texts, several in _slices(items, "item_id", "text", hashes):
        packed = docs.select(F.struct(*[docs[c] for c in names]).alias("r"), _hits(docs[text_col], Items(ids, texts, SHINGLE, hashes), threshold).alias("h"))
        docs = packed.filter(F.size("h") == 0).select("r.*")
        docs = cut(docs, "op4-clean") if several else docs
    return docs


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


SQL = f"""
WITH pool AS (SELECT 'd' AS kind, row_number() OVER () AS r, doc_id AS id, text FROM documents
              UNION ALL SELECT 'i', row_number() OVER () AS r, item_id, text FROM (SELECT DISTINCT item_id, text FROM benchmark)),
w AS (SELECT kind, r, id, list_filter(string_split_regex(text, '[\\t-\\r ]+'), lambda x: x <> '') AS w FROM pool),
g AS (SELECT DISTINCT kind, r, id, unnest(CASE WHEN len(w) < {SHINGLE} THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - {SHINGLE - 2}), lambda k: array_to_string(w[k : k + {SHINGLE - 1}], ' ')) END) AS s
      FROM w WHERE len(w) > 0),
n AS (SELECT r, count(*) AS n FROM g WHERE kind = 'i' GROUP BY r)
SELECT d.id AS doc_id, i.id AS item_id, count(*) / max(n.n)::DOUBLE AS containment
FROM g d JOIN g i ON d.kind = 'd' AND i.kind = 'i' AND d.s = i.s JOIN n ON n.r = i.r
GROUP BY d.r, d.id, i.r, i.id HAVING count(*) / max(n.n)::DOUBLE >= {THRESHOLD}::DOUBLE
"""
