"""Operator 7: token ids as static range asymmetric numeral system (rANS) blocks.

Texts are encoded to piece ids (those of operator 5, by the library, word by word) and packed into blocks of whole documents, written to the shared folder
once. Frequencies are counted over all of it and scaled to a sum of 2**SCALE, one table shared by all blocks. A block
is coded by LANES interleaved lanes: word i belongs to lane i % LANES, numpy steps all lanes at once, and 64-bit states
put out 32-bit words. Every EVERY steps a checkpoint keeps the lane states, the place in the words and a checksum of
the ids up to the next, so that pieces of a block, and blocks, decode in parallel and independently.

The first row of the result (block -1) holds the table; all others are blocks.

Defined results: a null text has length -1 and no ids, an empty one length 0. A block is closed when it has BLOCK ids, and
before a document of more than BLOCK ids, which gets a block of its own; documents are never divided. Repeated rows are
coded each for itself, and equal texts give equal ids wherever they stand; a null id stays null; ids may be of any type. An
empty table gives the table row alone. Of ids that are equally frequent, the least takes what rounding leaves. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winnowry.session import cut

from ._words import arrow_type
from .sentencepiece_bpe import MEMO, MODEL, vocabulary

SCALE = 20
LANES = 256
#: Ids after which a block is closed.
BLOCK = 1 << 18
#: Steps between checkpoints.
EVERY = 256
LOW = np.uint64(1 << 31)
_32 = np.uint64(32)


def scaled(counts: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Frequencies with the sum 2**scale, at least 1 for every id (also for those that don't occur)."""
    total = 1 << scale
    if len(counts) > total // 2:
        raise ValueError("too many ids for the scale")
    share = counts / max(1, counts.sum())
    f = 1 + np.floor(share * (total - len(counts))).astype(np.int64)
    f[int(np.argmax(counts))] += total - int(f.sum())
    return f


class Table:
    """Frequencies, running sums, and the id of every slot."""

    def __init__(self, freq: np.ndarray, scale: int = SCALE):
        self.scale = scale
        self.freq = freq.astype(np.uint64)
        self.sum = np.concatenate(([0], np.cumsum(freq)[:-1])).astype(np.uint64)
        self._slot: np.ndarray | None = None

    @property
    def slot(self) -> np.ndarray:
        if self._slot is None:
            self._slot = np.repeat(np.arange(len(self.freq), dtype=np.int32), self.freq.astype(np.int64))
        return self._slot

    def encode(self, ids: np.ndarray, lanes: int = LANES, every: int = EVERY) -> tuple[bytes, list[dict]]:
        """The words, and the checkpoints in decoding order (the first is the start)."""
        n = len(ids)
        steps = -(-n // lanes)
        full = np.full(steps * lanes, int(np.argmax(self.freq)), np.int64)
        full[:n] = ids
        grid = full.reshape(steps, lanes)
        x = np.full(lanes, LOW, np.uint64)
        scale = np.uint64(self.scale)
        limit = self.freq << np.uint64(63 - self.scale)
        words: list[np.ndarray] = []
        marks: list[dict] = []
        put = 0
        for t in range(steps - 1, -1, -1):
            s = grid[t]
            f = self.freq[s]
            over = x >= limit[s]
            if over.any():
                words.append(x[over].astype(np.uint32))
                put += len(words[-1])
                x[over] >>= _32
            q = x // f
            x = (q << scale) + (x - q * f) + self.sum[s]
            if t % every == 0:
                part = ids[t * lanes : (t + every) * lanes].astype("<u4")
                marks.append({"step": t, "word": put, "states": x.astype("<u8").tobytes(), "crc": zlib.crc32(part.tobytes())})
        stream = np.concatenate(words[::-1]).astype("<u4").tobytes() if words else b""
        for m in marks:
            m["word"] = put - m["word"]
        return stream, marks[::-1]

    def decode(self, stream: bytes, mark: dict, n: int, lanes: int = LANES, every: int = EVERY) -> np.ndarray:
        """The ids from a checkpoint to the next, or to the end at n; raises ValueError if the checksum differs."""
        words = np.frombuffer(stream, "<u4").astype(np.uint64)
        x = np.frombuffer(mark["states"], "<u8").astype(np.uint64)
        at, first = mark["word"], mark["step"]
        steps = min(every, -(-n // lanes) - first)
        out = np.empty((steps, lanes), np.int32)
        mask, scale = np.uint64((1 << self.scale) - 1), np.uint64(self.scale)
        for t in range(steps):
            r = x & mask
            s = self.slot[r.astype(np.int64)]
            out[t] = s
            x = self.freq[s] * (x >> scale) + r - self.sum[s]
            under = np.flatnonzero(x < LOW)
            if len(under):
                x[under] = (x[under] << _32) | words[at : at + len(under)]
                at += len(under)
        ids = out.reshape(-1)[: n - first * lanes]
        if zlib.crc32(ids.astype("<u4").tobytes()) != mark["crc"]:
            raise ValueError("checksum differs")
        return ids


def _blocks(path: str, block: int, kind: pa.DataType):
    """Rows of (ids of documents, lengths, piece ids) of whole documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        small = len(v.text) <= 65536
        docs: list = []
        rows: list[np.ndarray | None] = []

        def close() -> pa.RecordBatch:
            ids = np.concatenate([r for r in rows if r is not None] or [np.zeros(0, np.int32)]).astype("<u4")
            size = [-1 if r is None else len(r) for r in rows]
            return pa.RecordBatch.from_arrays(
                [pa.array([list(docs)], pa.list_(kind)), pa.array([size], pa.list_(pa.int32())), pa.array([_pack(ids)], pa.binary())],
                ["doc_ids", "lengths", "ids"],
            )

        have = 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 128):
                part = batch.slice(lo, 128)
                if len(v.words) > MEMO:
                    v.words.reset()
                texts = part.column(1).to_pylist()
                for d, t, r in zip(part.column(0).to_pylist(), texts, v.encode_many([t or "" for t in texts])):
                    if docs and len(r) > block:
                        yield close()
                        docs, rows, have = [], [], 0
                    docs.append(d)
                    rows.append(None if t is None else (r := r.astype(np.uint16 if small else np.int32)))
                    have += 0 if r is None else len(r)
                    if have >= block:
                        yield close()
                        docs, rows, have = [], [], 0
        if docs:
            yield close()

    return run


def _pack(ids: np.ndarray) -> bytes:
    return ids.astype("<u2").tobytes() if not len(ids) or ids.max() < 65536 else b"\1" + ids.astype("<u4").tobytes()


def _unpack(b: bytes) -> np.ndarray:
    return np.frombuffer(b, "<u4", offset=1) if len(b) % 2 else np.frombuffer(b, "<u2")


def _count(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for b in batch.column(0):
                total += np.bincount(_unpack(b.as_py()), minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["id", "n"])

    return run


_MARK = pa.struct([("step", pa.int32()), ("word", pa.int32()), ("states", pa.binary()), ("crc", pa.int64())])


def _encode(freq: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(freq)
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                ids = _unpack(row.column("ids")[0].as_py()).astype(np.int64)
                stream, marks = table.encode(ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        row.column("block"), row.column("doc_ids"), row.column("lengths"), pa.array([len(ids)], pa.int64()),
                        pa.array([stream], pa.binary()), pa.array([marks], pa.list_(_MARK)), pa.array([zlib.crc32(stream)], pa.int64()),
                    ],
                    ["block", "doc_ids", "lengths", "n_tokens", "payload", "checkpoints", "crc"],
                )

    return run


def encoded_blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = MODEL, block: int = BLOCK) -> DataFrame:
    """(block, doc_ids, lengths, n_tokens, payload, checkpoints, crc); block -1 holds the frequencies as 32-bit numbers."""
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    arrow = arrow_type(docs, id_col)
    base = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    made = base.mapInArrow(_blocks(path, block, arrow), f"doc_ids array<{kind}>, lengths array<int>, ids binary")
    stored = cut(made.withColumn("block", F.monotonically_increasing_id()), "op7-ids")
    size = len(vocabulary(path).text)  # fixed by the model, not by the data
    counts = np.zeros(size, np.int64)
    for r in stored.select("ids").mapInArrow(_count(size), "id int, n bigint").groupBy("id").agg(F.sum("n").alias("n")).collect():
        counts[r["id"]] = r["n"]
    freq = scaled(counts)
    schema = (
        f"block bigint, doc_ids array<{kind}>, lengths array<int>, n_tokens bigint, payload binary, "
        "checkpoints array<struct<step:int,word:int,states:binary,crc:bigint>>, crc bigint"
    )
    coded = stored.select("block", "doc_ids", "lengths", "ids").mapInArrow(_encode(freq), schema)
    raw = freq.astype("<u4").tobytes()
    head = spark.createDataFrame([(-1, [], [], int(counts.sum()), bytearray(raw), [], zlib.crc32(raw))], schema)
    return head.unionByName(coded)


def decoded(blocks: DataFrame) -> DataFrame:
    """(doc_id, token_ids) from blocks with their table row; every payload, checkpoint and length is verified."""
    raw = blocks.filter("block = -1").select("payload").first()[0]
    freq = np.frombuffer(bytes(raw), "<u4").astype(np.int64)
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(freq)
        for batch in batches:
            for r in batch.to_pylist():
                if zlib.crc32(r["payload"]) != r["crc"]:
                    raise ValueError("checksum differs")
                parts = [table.decode(r["payload"], m, r["n_tokens"]) for m in r["checkpoints"]]
                ids = np.concatenate(parts) if parts else np.zeros(0, np.int32)
                ends = np.concatenate(([0], np.cumsum(np.maximum(r["lengths"], 0)))).astype(np.int64)
                lists = [None if n < 0 else ids[a : a + n].tolist() for a, n in zip(ends, r["lengths"])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["doc_ids"], batch.schema.field("doc_ids").type.value_type), pa.array(lists, pa.list_(pa.int32()))], ["doc_id", "token_ids"]
                )

    return blocks.filter("block >= 0").mapInArrow(run, f"doc_id {kind}, token_ids array<int>")


def op7_rans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_blocks(spark.read.parquet(f"{sf_dir}/documents.parquet"))
