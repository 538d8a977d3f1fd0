"""Operator 9: exact n-gram Jaccard join by T-occurrence search with DivideSkip.

Two documents are linked if the Jaccard similarity of their sets of word 3-grams is at least THRESHOLD. The search is
exact: no sketch, no sample, no limit on lists or partners.

1. Grams are counted over the whole corpus. A batch of texts sends each of its grams once to the part that counts it,
   so a gram that a third of all documents hold costs one entry a batch; what occurs once comes back to no document.
   A document of n grams of which fewer than T = ceil(THRESHOLD * n) occur elsewhere can have no partner and leaves.
2. Documents with equal gram sets are one class from here on; copies are only counted.
3. Classes get a block: a label that spreads along shared MinHash bands of their repeated grams. Blocks only divide the
   work: any division gives the same result.
4. Inside a block every class is a query to the T-occurrence problem: find what occurs at least T times in the inverted
   lists of its grams. DivideSkip orders the lists by length, merges the short ones with a heap (or, where they hold more
   than HEAP entries together, with a counting pass that gives the same counts), and probes the long ones by binary
   search. Large blocks are divided by a hash into parts, each pair of which is a task of its own.
5. Across blocks: all grams are ordered, rare ones first. Linked documents share one of the first m - T + 1 of their m
   repeated grams, so pairs from different blocks meet in the list of such a gram; they are verified on whole sets.
   No list makes pairs of one block, so thousands of copies make none.

The result counts links and joins them to groups; pairs never leave the tasks that find them, except those of 5.
Grams are compared by 48 bits of their hashes.

Defined results: null, empty and blank texts have no grams and no partner; a text of fewer than 3 words is one gram.
Rows with a null doc_id have no result. Rows that agree in doc_id and text count once; a doc_id with several texts joins
the groups of all of them and has the sum of their links. Ties are no matter: a pair at the threshold is linked, and the
least doc_id names the group. An empty table gives an empty result. Very long texts are handled whole. Other columns are
not read. The input should be a stored table: batches that an executor lost are read again.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winnowry.operators.components import connected_components
from winnowry.session import cut

from ._words import BASE, U, Words, arrow_type, chunks, mix, trim

GRAM = 3
THRESHOLD = 0.45
#: Bytes of text, and documents at most, that are sent out together.
BATCH_BYTES, BATCH_DOCS = 4 << 20, 60_000
#: Entries of short lists up to which a heap merges them.
HEAP = 512
#: Grams of a part of a block.
PART_GRAMS = 1 << 19
#: MinHash bins and how many make a band; they divide the work and don't change the result.
BINS, ROWS = 64, 4
_LOW = U((1 << 40) - 1)


def distinct_grams(data: np.ndarray, off: np.ndarray, n: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct gram hashes of each row, flat, and the slices by row."""
    g, ptr = Words(data, off).shingles(n)
    row = np.repeat(np.arange(len(ptr) - 1, dtype=np.uint16 if len(ptr) < 65536 else np.int64), np.diff(ptr))
    order = np.argsort(g)
    order = order[np.argsort(row[order], kind="stable")]
    g, row = g[order], row[order]
    keep = np.ones(len(g), bool)
    keep[1:] = (g[1:] != g[:-1]) | (row[1:] != row[:-1])
    return g[keep], np.searchsorted(row[keep], np.arange(len(ptr)))


def gram_sets(texts: pa.Array, n: int = GRAM) -> Iterator[np.ndarray]:
    """The sorted distinct gram hashes of each row."""
    for _, _, data, off in chunks(texts):
        g, ptr = distinct_grams(data, off, n)
        yield from (g[a:b] for a, b in zip(ptr[:-1].tolist(), ptr[1:].tolist()))


def identities(g: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """A hash of each row's set; 0 for an empty one."""
    size = np.diff(ptr)
    out = np.zeros(len(size), U)
    at = ptr[:-1][size > 0]
    if len(at):
        out[size > 0] = mix(np.add.reduceat(g, at) + U(3) * np.bitwise_xor.reduceat(mix(g), at) + size[size > 0].astype(U)) | U(1)
    return out


def pack(keys: np.ndarray) -> bytes:
    """Sorted numbers below 2**40: as gaps of four bytes, or, where one is too wide, as five bytes each."""
    gap = np.diff(keys, prepend=U(0))
    if len(keys) and int(gap.max()) >> 32:
        return b"\5" + keys.astype("<u4").tobytes() + (keys >> U(32)).astype(np.uint8).tobytes()
    return b"\4" + gap.astype("<u4").tobytes()


def unpack(b: bytes) -> np.ndarray:
    if b[0] == 4:
        return np.cumsum(np.frombuffer(b, "<u4", offset=1), dtype=U)
    n = (len(b) - 1) // 5
    return np.frombuffer(b, "<u4", n, 1).astype(U) | (np.frombuffer(b, np.uint8, n, 1 + 4 * n).astype(U) << U(32))


def _pack48(x: np.ndarray) -> bytes:
    return x.astype("<u4").tobytes() + (x >> U(32)).astype("<u2").tobytes()


def _unpack48(b: bytes) -> np.ndarray:
    n = len(b) // 6
    return np.frombuffer(b, "<u4", n).astype(U) | (np.frombuffer(b, "<u2", n, 4 * n).astype(U) << U(32))


def _need(n: np.ndarray, t: float) -> np.ndarray:
    """The least overlap of a set of n grams with a partner."""
    return np.maximum(1, np.ceil(n * t - 1e-9)).astype(np.int64)


def _runs(x: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1]))) if len(x) else np.zeros(0, np.int64)


_SENT = "part int, batch bigint, ids array<{kind}>, rids array<bigint>, sets binary, sizes binary, known binary, holders binary, one binary, holder binary, more binary, times binary"
_NAMES = [f.split()[0] for f in _SENT.split(", ")]


def _scatter(n: int, parts: int, kind: pa.DataType):
    """Rows (part, batch, one, holder, more, times) for the parts, and one row of a batch for itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, serial = TaskContext.get().partitionId(), 0
        ids, grams, sizes, have = [], [], [], 0

        def send() -> Iterator[pa.RecordBatch]:
            g, size = np.concatenate(grams), np.concatenate(sizes)
            ptr = np.concatenate(([0], np.cumsum(size)))
            rid = identities(g, ptr)
            _, first = np.unique(rid, return_index=True)
            mine = np.sort(first[size[first] > 0])
            keep = np.zeros(len(size), bool)
            keep[mine] = True
            g = g[np.repeat(keep, size)]
            holder = np.repeat(np.arange(len(mine)), size[mine]).astype("<u2")
            part = ((g >> U(32)) * U(parts)) >> U(32)
            key = (part << U(40)) | (g & _LOW)
            order = np.argsort(key)
            key, holder = key[order], holder[order]
            head = _runs(key)
            count = np.diff(np.append(head, len(key)))
            single = head[count == 1]
            one, who = key[single], holder[single]
            more, times = key[head[count > 1]], np.minimum(count[count > 1], 65535).astype("<u2")
            known = np.repeat(count > 1, count)
            batch = task << 32 | serial
            none = [None] * 4
            row = [batch % parts, batch, pa.concat_arrays(ids), rid.view(np.int64), rid[mine].tobytes(), size[mine].astype("<u4").tobytes(), key[known].tobytes(), holder[known].tobytes(), *none]
            yield pa.RecordBatch.from_arrays(
                [pa.array([row[0]], pa.int32()), pa.array([batch], pa.int64()), pa.array([row[2]], pa.list_(kind)), pa.array([row[3]], pa.list_(pa.int64())), *(pa.array([x], pa.binary()) for x in row[4:])], _NAMES
            )
            edges = np.arange(parts + 1, dtype=U) << U(40)
            a, b = np.searchsorted(one, edges), np.searchsorted(more, edges)
            used = np.flatnonzero((np.diff(a) > 0) | (np.diff(b) > 0))
            cols = [[pack(one[a[p] : a[p + 1]] & _LOW) for p in used], [who[a[p] : a[p + 1]].tobytes() for p in used], [pack(more[b[p] : b[p + 1]] & _LOW) for p in used], [times[b[p] : b[p + 1]].tobytes() for p in used]]
            k = len(used)
            if k:
                empty = [pa.nulls(k, pa.list_(kind)), pa.nulls(k, pa.list_(pa.int64())), *[pa.nulls(k, pa.binary())] * 4]
                yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(np.full(k, batch)), *empty, *(pa.array(c, pa.binary()) for c in cols)], _NAMES)

        for batch in batches:
            texts = batch.column(1)
            for lo, hi, data, off in chunks(texts):
                for a in range(0, hi - lo, BATCH_DOCS):
                    b = min(hi - lo, a + BATCH_DOCS)
                    g, ptr = distinct_grams(data[off[a] : off[b]], off[a : b + 1] - off[a], n)
                    if have and (have + off[b] - off[a] > BATCH_BYTES or sum(map(len, sizes)) + b - a > BATCH_DOCS):
                        yield from send()
                        serial += 1
                        ids, grams, sizes, have = [], [], [], 0
                    ids.append(batch.column(0).slice(lo + a, b - a).cast(kind))
                    grams.append(g)
                    sizes.append(np.diff(ptr))
                    have += max(1, int(off[b] - off[a]))
        if ids:
            yield from send()
        ids, grams, sizes = [], [], []
        trim()

    return run


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over one part: the grams that occur more than once go back to their batches, with a logarithm of their number."""
    rows, schema = [], None
    for batch in batches:
        schema = batch.schema
        own = pc.is_valid(batch.column("ids"))
        if own.true_count:
            mine = batch.filter(own)
            yield pa.RecordBatch.from_arrays([mine.column(c) for c in _NAMES], _NAMES)
        rest = batch.filter(pc.invert(own))
        rows += zip(*(rest.column(c).to_pylist() for c in ("part", "batch", "one", "holder", "more", "times")))
        del batch, own, rest
    if not rows:
        return
    keys = lambda r: [unpack(s) | U(r[0] << 40) for s in (r[2], r[4])]
    every, at = np.empty(sum((len(s) - 1) // s[0] for r in rows for s in (r[2], r[4])), U), 0  # the first byte is the width
    for r in rows:
        for x in keys(r):
            every[at : at + len(x)] = x
            at += len(x)
    every.sort()
    same = every[1:] == every[:-1]
    often = np.unique(np.concatenate((every[1:][same], *(keys(r)[1] for r in rows))))
    del every, same
    total = np.zeros(len(often), np.int64)

    def places(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(often, x), max(0, len(often) - 1))
        hit = often[at] == x if len(often) else np.zeros(len(x), bool)
        return at[hit], hit

    for r in rows:
        x, y = keys(r)
        total[places(x)[0]] += 1  # a batch has a key once
        total[places(y)[0]] += np.frombuffer(r[5], "<u2")
    level = np.minimum(255, 1 + np.round(8 * np.log2(np.maximum(total, 1)))).astype(np.uint8)
    out = []
    for r in rows:
        x, y = keys(r)
        at, hit = places(x)
        if len(at) or len(y):
            out.append((*r[:2], pack(x[hit] & _LOW), np.frombuffer(r[3], "<u2")[hit].tobytes() + level[at].tobytes(), pack(y & _LOW), level[places(y)[0]].tobytes()))
    del rows
    for lo in range(0, len(out), 256):
        cols = list(zip(*out[lo : lo + 256]))
        k = len(cols[0])
        empty = [_null(c, k, schema) for c in _NAMES[2:8]]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()), *empty, *(pa.array(c, pa.binary()) for c in cols[2:])], _NAMES)
    cols = []
    del out, often, total, level
    trim()


def _null(name: str, k: int, schema: pa.Schema) -> pa.Array:
    return pa.nulls(k, schema.field(name).type)


def bands(ids: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """Hashes (row, BINS // ROWS) of the least values in ROWS bins; an empty bin takes the value of the next."""
    rows = len(ptr) - 1
    h = mix(ids + U(7))
    at = np.repeat(np.arange(rows), np.diff(ptr)) * BINS + (h >> U(58)).astype(np.int64)
    order = np.lexsort((h, at))
    first = order[_runs(at[order])]
    low = np.zeros(rows * BINS, U)
    low[at[first]] = h[first]
    low = low.reshape(rows, BINS)
    while (low == 0).any() and len(h):
        low = np.where(low == 0, np.roll(low, -1, axis=1), low)
    acc = np.zeros((rows, BINS // ROWS), U)
    for k in range(ROWS):
        acc = acc * BASE + low[:, k::ROWS]
    return mix(acc + np.arange(BINS // ROWS, dtype=U))


def _able(t: float):
    """Over one batch: its documents again with the grams they share with others, rare ones first, if these suffice."""

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, holders, levels, more, more_level = ([np.zeros(0, k)] for k in (U, np.uint16, np.uint8, U, np.uint8))
        own = None
        for batch in batches:
            for r in range(batch.num_rows):
                if batch.column("ids")[r].is_valid:
                    own = batch.slice(r, 1)
                    continue
                p, one, holder, two, times = (batch.column(c)[r].as_py() for c in ("part", "one", "holder", "more", "times"))
                x, y = (unpack(s) | U(p << 40) for s in (one, two))
                keys.append(x)
                holders.append(np.frombuffer(holder, "<u2", len(x)))
                levels.append(np.frombuffer(holder, np.uint8, len(x), 2 * len(x)))
                more.append(y)
                more_level.append(np.frombuffer(times, np.uint8))
        sets, sizes, known, known_by = (own.column(c)[0].as_py() for c in ("sets", "sizes", "known", "holders"))
        rid, n = np.frombuffer(sets, U), np.frombuffer(sizes, "<u4").astype(np.int64)
        x, level = np.concatenate(more), np.concatenate(more_level)
        order = np.argsort(x)
        if len(known):
            keys.append(np.frombuffer(known, U))
            holders.append(np.frombuffer(known_by, "<u2"))
            levels.append(level[order][np.searchsorted(x[order], keys[-1])])
        key, holder, level = np.concatenate(keys), np.concatenate(holders), np.concatenate(levels)
        count = np.bincount(holder, minlength=len(n))
        good = count >= _need(n, t)
        keep = good[holder]
        gram = mix(key[keep]) >> U(16)
        order = np.lexsort((gram, level[keep], holder[keep]))
        gram = gram[order]
        ptr = np.concatenate(([0], np.cumsum(count[good])))
        k = int(good.sum())
        flat = bands(gram, ptr)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(k + 1, dtype=np.int32) * flat.shape[1]), pa.array(flat.reshape(-1).view(np.int64)))
        names = ["ids", "rids", "rid", "n", "grams", "bands"]
        ids, rids = own.column("ids"), own.column("rids")
        yield pa.RecordBatch.from_arrays([ids, rids, pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.nulls(1, lists.type)], names)
        packed = [_pack48(gram[a:b]) for a, b in zip(ptr[:-1], ptr[1:])]
        yield pa.RecordBatch.from_arrays([pa.nulls(k, ids.type), pa.nulls(k, rids.type), pa.array(rid[good].view(np.int64)), pa.array(n[good]), pa.array(packed, pa.binary()), lists], names)
        del keys, holders, levels, key, holder, level, gram, order, keep, packed
        trim()

    return run


def divide_skip(lists: list[np.ndarray], need: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids below ``size`` that occur in at least ``need`` of the sorted lists, and how often.

    The longest lists (at most need - 1) are left out of the merge and probed by binary search for what is left.
    """
    lists = sorted((x for x in lists if len(x)), key=len)
    if len(lists) < need:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    skip = min(need - 1, int(need / (0.01 * math.log2(len(lists[-1]) + 2) + 1)), len(lists) - 1)
    short, long = lists[: len(lists) - skip], lists[len(lists) - skip :]
    if sum(map(len, short)) <= HEAP:
        ids: list[int] = []
        counts: list[int] = []
        for x in heapq.merge(*(s.tolist() for s in short)):
            if ids and ids[-1] == x:
                counts[-1] += 1
            else:
                ids.append(x)
                counts.append(1)
        found, count = np.array(ids, np.int64), np.array(counts, np.int64)
    else:
        count = np.bincount(np.concatenate(short), minlength=size)
        found = np.flatnonzero(count)
        count = count[found]
    alive = count >= max(1, need - skip)
    found, count = found[alive], count[alive]
    for k, x in enumerate(long):
        if not len(found):
            break
        at = np.minimum(np.searchsorted(x, found), len(x) - 1)
        count = count + (x[at] == found)
        alive = count >= need - (len(long) - 1 - k)
        found, count = found[alive], count[alive]
    return found, count


def links_within(grams: list[np.ndarray], n: np.ndarray, t: float, left: int = 0) -> Iterator[tuple[int, np.ndarray]]:
    """(q, its linked predecessors) by T-occurrence search; with ``left``, queries are the sets from there on against those before."""
    m = len(grams)
    flat = np.concatenate(grams) if m else np.zeros(0, U)
    owner = np.repeat(np.arange(m), [len(g) for g in grams])
    order = np.argsort(flat, kind="stable")
    who, head = owner[order], _runs(flat[order])
    size = np.diff(np.append(head, len(flat)))
    of = np.repeat(np.arange(len(head)), size)
    before = np.arange(len(flat)) - head[of]  # members of the list before the owner
    if left:
        before = np.minimum(before, np.add.reduceat(who < left, head, dtype=np.int64)[of]) if len(flat) else before
    start, many = np.empty(len(flat), np.int64), np.empty(len(flat), np.int64)
    start[order], many[order] = head[of], before
    ptr = np.concatenate(([0], np.cumsum([len(g) for g in grams]))).astype(np.int64)
    need = _need(n, t)
    for q in range(max(1, left), m):
        a, b = start[ptr[q] : ptr[q + 1]], many[ptr[q] : ptr[q + 1]]
        some = np.flatnonzero(b)
        if len(some) < need[q]:
            continue
        found, both = divide_skip([who[x : x + y] for x, y in zip(a[some].tolist(), b[some].tolist())], int(need[q]), m)
        found = found[both / (n[found] + n[q] - both) >= t]
        if len(found):
            yield q, found


def _linked(t: float):
    """Over one part of a block, or two: a row (src, null, links) for each class and a forest of links (src, dst, null)."""

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = pa.Table.from_batches(list(batches)).sort_by([("side", "ascending"), ("rid", "ascending")])
        rid, n, copies = (got[c].to_numpy() for c in ("rid", "n", "copies"))
        left = 0 if key[1].as_py() == key[2].as_py() else int(np.count_nonzero(got["side"].to_numpy() == key[1].as_py()))
        if key[1].as_py() != key[2].as_py() and left in (0, len(rid)):
            return
        links = np.zeros(len(rid), np.int64)
        root = np.arange(len(rid))
        src, dst = [], []
        for q, found in links_within([_unpack48(g) for g in got["grams"].to_pylist()], n, t, left):
            links[q] += copies[found].sum()
            links[found] += copies[q]
            roots, first = np.unique(root[found], return_index=True)
            new = roots != root[q]
            if new.any():
                src += rid[found[first[new]]].tolist()
                dst += [rid[q]] * int(new.sum())
                root[np.isin(root, roots[new])] = root[q]
        some = np.flatnonzero(links)
        yield pa.RecordBatch.from_arrays([pa.array(rid[some]), pa.nulls(len(some), pa.int64()), pa.array(links[some])], ["src", "dst", "links"])
        yield pa.RecordBatch.from_arrays([pa.array(src, pa.int64()), pa.array(dst, pa.int64()), pa.nulls(len(src), pa.int64())], ["src", "dst", "links"])
        if got.nbytes > 1 << 20:
            del got
            trim()

    return run


def _postings(t: float, parts: int):
    """The first grams of every class by part: rows (part, classes, grams, holder)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                rows = batch.slice(lo, 4096)
                rid, block, n = (rows.column(c).to_numpy() for c in ("rid", "block", "n"))
                grams = [_unpack48(g) for g in rows.column("grams").to_pylist()]
                first = [g[: len(g) - k + 1] for g, k in zip(grams, _need(n, t).tolist())]
                flat = np.concatenate(first)
                holder = np.repeat(np.arange(len(first)), [len(f) for f in first])
                part = ((flat >> U(16)) * U(parts)) >> U(32)
                order = np.argsort(part, kind="stable")
                flat, holder, part = flat[order], holder[order], part[order]
                cols = []
                head = _runs(part)
                for a, b in zip(head.tolist(), [*head[1:].tolist(), len(part)]):
                    used, local = np.unique(holder[a:b], return_inverse=True)
                    cols.append((int(part[a]), np.stack((rid[used], block[used])).astype("<i8").tobytes(), _pack48(flat[a:b]), local.astype("<u2").tobytes()))
                if cols:
                    x = list(zip(*cols))
                    yield pa.RecordBatch.from_arrays([pa.array(x[0], pa.int32()), *(pa.array(c, pa.binary()) for c in x[1:])], ["part", "classes", "grams", "holder"])

    return run


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over one part of the lists: pairs of classes of different blocks that meet in a list."""
    grams, rids, blocks = [], [], []
    for batch in batches:
        for classes, g, holder in zip(*(batch.column(c).to_pylist() for c in ("classes", "grams", "holder"))):
            r, b = np.frombuffer(classes, "<i8").reshape(2, -1)
            at = np.frombuffer(holder, "<u2")
            grams.append(_unpack48(g))
            rids.append(r[at])
            blocks.append(b[at])
    if not grams:
        return
    gram, rid, block = (np.concatenate(x) for x in (grams, rids, blocks))
    del grams, rids, blocks
    order = np.lexsort((block, gram))
    gram, rid, block = gram[order], rid[order], block[order]
    head = _runs(gram)
    size = np.diff(np.append(head, len(gram)))
    mixed = np.repeat(block[head] != block[head + size - 1], size)
    end = np.repeat(head + size, size)[mixed]
    rid, block, at = rid[mixed], block[mixed], np.flatnonzero(mixed)
    end = np.searchsorted(at, end)
    name, code = np.unique(rid, return_inverse=True)
    pairs, held, alive, d = [], 0, np.arange(len(rid)), 1
    while True:
        alive = alive[alive + d < end[alive]]
        if not len(alive):
            break
        a, b = alive, alive + d
        apart = block[a] != block[b]
        x, y = code[a[apart]], code[b[apart]]
        pairs.append(np.unique(np.minimum(x, y) * np.int64(len(name)) + np.maximum(x, y)))
        held += len(pairs[-1])
        if held > 4_000_000:
            pairs = [np.unique(np.concatenate(pairs))]
            held = len(pairs[0]) // 2
        d += 1
    found = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
    for lo in range(0, len(found), 100_000):
        p = found[lo : lo + 100_000]
        a, b = name[p // len(name)], name[p % len(name)]
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["src", "dst"])
    del gram, rid, block, order, head, size, mixed, end, at, pairs, found
    trim()


def _jaccard():
    def jaccard(x: pa.Array, y: pa.Array, n: pa.Array, m: pa.Array) -> pa.Array:
        both = np.zeros(len(x), np.int64)
        for k, (a, b) in enumerate(zip(x, y)):
            s = np.sort(np.concatenate((_unpack48(a.as_py()), _unpack48(b.as_py()))))
            both[k] = np.count_nonzero(s[1:] == s[:-1])
        return pa.array(both / (n.to_numpy() + m.to_numpy() - both))

    jaccard.__annotations__ = {"x": pa.Array, "y": pa.Array, "n": pa.Array, "m": pa.Array, "return": pa.Array}
    return F.arrow_udf(jaccard, "double").asNondeterministic()


def _labels(able: DataFrame, rounds: int = 2) -> DataFrame:
    """(rid, block): the least rid that spreads along shared bands."""
    held = able.select("rid", F.explode("bands").alias("band")).distinct()
    label = held.select("rid", F.col("rid").alias("block")).distinct()
    for _ in range(rounds):
        least = held.join(label, "rid").groupBy("band").agg(F.min("block").alias("block"))
        label = held.join(least, "band").groupBy("rid").agg(F.min("block").alias("block"))
    return label


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, gram: int = GRAM) -> DataFrame:
    """(doc_id, group_id, n_links) of all documents with a partner.

    group_id is the least doc_id of the group, n_links the number of documents whose similarity with this one reaches the
    threshold, copies included.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    field = docs.schema[id_col].dataType
    kind = field.simpleString()
    base = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).filter("doc_id IS NOT NULL")
    arrow = arrow_type(docs, id_col)
    schema = _SENT.format(kind=kind)
    sent = base.mapInArrow(_scatter(gram, parts, arrow), schema).repartitionById(parts, "part")  # one part a task: a hash would give some tasks several
    back = sent.mapInArrow(_frequent, schema).groupBy("batch")
    made = cut(back.applyInArrow(_able(threshold), f"ids array<{kind}>, rids array<bigint>, rid bigint, n bigint, grams binary, bands array<bigint>"), "op9-able")
    members = made.filter("ids IS NOT NULL").select(F.explode(F.arrays_zip(F.col("ids").alias("doc_id"), F.col("rids").alias("rid"))).alias("m")).select("m.*").filter("rid <> 0")
    members = cut(members.distinct(), "op9-members")
    able = made.filter("rid IS NOT NULL").select("rid", "n", "grams", "bands")
    copies = members.groupBy("rid").agg(F.count("*").alias("copies"))
    label = cut(_labels(able), "op9-labels")
    width = F.length("grams") / 6
    sizes = able.select("rid", width.alias("w")).distinct().join(label, "rid").groupBy("block").agg(F.count("*").alias("many"), F.ceil(F.sum("w") / PART_GRAMS).alias("k"))
    marks = label.join(sizes, "block").join(copies, "rid")
    reps = cut(able.drop("bands").dropDuplicates(["rid"]).join(marks, "rid"), "op9-classes")

    # Inside the blocks.
    side = F.pmod(F.xxhash64("rid"), F.col("k"))
    inner = reps.filter("many > 1").withColumn("side", side).withColumn("other", F.explode(F.expr("sequence(0L, k - 1)")))
    inner = inner.select("block", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "side", "rid", "n", "copies", "grams")
    inner = inner.repartition(parts, "block", "i", "j")  # work is uneven by bytes: no coalescing
    found = cut(inner.groupBy("block", "i", "j").applyInArrow(_linked(threshold), "src bigint, dst bigint, links bigint"), "op9-links")

    # Across them.
    lists = reps.select("rid", "block", "n", "grams").mapInArrow(_postings(threshold, parts), "part int, classes binary, grams binary, holder binary")
    pairs = lists.repartitionById(parts, "part").mapInArrow(_across, "src bigint, dst bigint").distinct()
    size = reps.select("rid", "n", "copies")
    pairs = pairs.join(size.toDF("src", "n", "c"), "src").join(size.toDF("dst", "m", "d"), "dst")
    pairs = pairs.filter(F.least("n", "m") >= F.greatest("n", "m") * F.lit(threshold) - 1e-6)
    sets = reps.select("rid", "grams")
    pairs = pairs.join(sets.toDF("src", "x"), "src").join(sets.toDF("dst", "y"), "dst")
    pairs = cut(pairs.select("src", "dst", "c", "d", _jaccard()("x", "y", "n", "m").alias("jaccard")).filter(F.col("jaccard") >= threshold).drop("jaccard"), "op9-pairs")

    counts = found.filter("links IS NOT NULL").select(F.col("src").alias("rid"), "links")
    counts = counts.union(pairs.select("src", "d")).union(pairs.select("dst", "c")).groupBy("rid").agg(F.sum("links").alias("links"))
    edges = found.filter("dst IS NOT NULL").select("src", "dst").union(pairs.select("src", "dst"))
    classes = connected_components(edges).withColumnRenamed("id", "rid")
    named = members.join(copies, "rid").join(counts, "rid", "left").join(classes, "rid", "left")
    named = named.select("doc_id", F.coalesce("component", "rid").alias("c"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    # A doc_id with several texts joins the groups of all of them.
    several = named.groupBy("doc_id").agg(F.min("c").alias("src"), F.max("c").alias("dst")).filter("src <> dst")
    if several.limit(1).count():
        more = named.join(several.select("doc_id", "src"), "doc_id").select("src", F.col("c").alias("dst"))
        same = connected_components(more).withColumnsRenamed({"id": "c", "component": "to"})
        named = named.join(same, "c", "left").select("doc_id", F.coalesce("to", "c").alias("c"), "links")
        named = named.groupBy("doc_id", "c").agg(F.sum("links").alias("links"))
    groups = named.groupBy("c").agg(F.min("doc_id").alias("group_id"), F.count("*").alias("size")).filter("size > 1")
    return named.join(groups, "c").select("doc_id", "group_id", F.col("links").alias("n_links"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the members of groups other than the one with the least id."""
    gone = near_groups(docs, id_col, text_col, **options).filter("doc_id <> group_id").select(F.col("doc_id").alias("__gone"))
    return docs.join(gone, docs[id_col] == gone["__gone"], "left_anti")


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(text, '[\\t-\\r ]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < {GRAM} THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - {GRAM - 2}), lambda k: array_to_string(w[k : k + {GRAM - 1}], ' ')) END) AS s
      FROM w WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM g a JOIN g b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE o / (x.n + y.n - o)::DOUBLE >= {THRESHOLD}::DOUBLE),
reach(id, far) AS (SELECT DISTINCT a, a FROM e UNION SELECT reach.id, e.b FROM reach JOIN e ON e.a = reach.far),
grp AS (SELECT id AS doc_id, min(far) AS group_id FROM reach GROUP BY id),
links AS (SELECT a AS doc_id, count(*) AS n_links FROM e GROUP BY a)
SELECT doc_id, group_id, n_links FROM grp JOIN links USING (doc_id)
"""
