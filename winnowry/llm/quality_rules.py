"""Operator 1: repetition coverage.

Rolling hashes of word n-grams of several lengths are compared within each document; the characters of words inside
an n-gram that has occurred before, and of lines that have, are set against all characters of the words or lines.
All runs inside one Arrow UDF over the text column: no shuffle, and columns other than the text stay in the JVM.

Defined results: a null or empty text has no words, all shares 0.0, and is kept. A text shorter than n words has share
0.0 for n. Of equal n-grams or lines all but the first count. A share at its limit is kept. Repeated rows are judged each
by itself. An empty table gives an empty result. Very long texts are judged whole. Other columns, whatever their names,
are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._words import BASE, U, Words, by_row, char_sums, chunks, mix, repeated, runs, spans, sums

#: Largest share of word characters inside repeated n-grams, by n: as in the published Gopher rules it falls with n, but
#: it is wide enough for a short text that says one line twice.
LIMITS = {5: 0.50, 6: 0.49, 7: 0.48, 8: 0.47, 9: 0.46, 10: 0.45}
#: Largest share of line characters inside repeated lines.
LINE_LIMIT = 0.50


def coverage(data: np.ndarray, off: np.ndarray, lengths: tuple[int, ...]) -> dict[str, np.ndarray]:
    """Per row: words, word characters, line characters, and the characters inside repeated lines and n-grams."""
    total, chars = sums(data), char_sums(data)
    w = Words(data, off, total)
    size = chars[w.end] - chars[w.start]
    out = {"n_words": w.counts, "word_chars": by_row(size, w.ptr)}
    start, end = runs(data != 10, off)
    line_ptr = np.searchsorted(start, off)
    line_row = np.repeat(np.arange(len(off) - 1), np.diff(line_ptr))
    salt = mix(np.arange(len(off), dtype=U) + U(1))
    _, later = repeated(spans(total, start, end) + salt[line_row])
    line_size = chars[end] - chars[start]
    out["line_chars"] = by_row(line_size, line_ptr)
    out["dup_line_chars"] = by_row(line_size * later, line_ptr)
    row, n_words = w.row(), len(w.hash)
    left = np.repeat(w.ptr[1:], w.counts) - np.arange(n_words)
    where = np.arange(n_words)
    for n in sorted(lengths):
        # An n-gram can only be repeated where the shorter one was: later lengths look at those places alone.
        where = where[left[where] >= n]
        acc = w.hash[where].copy()
        for k in range(1, n):
            acc *= BASE
            acc += w.hash[where + k]
        every, later = repeated(mix(acc) + salt[row[where]])
        again, where = where[later], where[every]
        edge = np.zeros(n_words + 1, np.int32)
        edge[again] += 1
        edge[again + n] -= 1
        out[f"dup{n}_chars"] = by_row(size * (np.cumsum(edge[:-1]) > 0), w.ptr)
    return out


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return np.where(whole > 0, part / np.maximum(whole, 1), 0.0)


def rules(text: Column, limits: dict[int, float] = LIMITS, line_limit: float = LINE_LIMIT) -> Column:
    """struct<n_words, dup_line_share, dup<n>_share..., keep> of a text column."""
    lengths = tuple(sorted(limits))
    fields = "n_words long, dup_line_share double, " + ", ".join(f"dup{n}_share double" for n in lengths) + ", keep boolean"

    def judge(texts: pa.Array) -> pa.Array:
        parts = [coverage(d, o, lengths) for _, _, d, o in chunks(texts)]
        if not parts:
            parts = [coverage(np.zeros(0, np.uint8), np.zeros(1, np.int64), lengths)]
        c = {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}
        lines = _share(c["dup_line_chars"], c["line_chars"])
        shares = [_share(c[f"dup{n}_chars"], c["word_chars"]) for n in lengths]
        keep = lines <= line_limit
        for n, s in zip(lengths, shares):
            keep &= s <= limits[n]
        return pa.StructArray.from_arrays(
            [pa.array(x) for x in (c["n_words"].astype(np.int64), lines, *shares, keep)],
            ["n_words", "dup_line_share", *(f"dup{n}_share" for n in lengths), "keep"],
        )

    judge.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(judge, f"struct<{fields.replace(' ', ':').replace(',:', ',')}>").asNondeterministic()(text)


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row for each row of ``docs``: its id, the shares, and ``keep``."""
    return docs.select(docs[id_col].alias("doc_id"), rules(docs[text_col], **options).alias("q")).select("doc_id", "q.*")


def kept(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that pass, with the columns of ``docs``."""
    names = docs.columns
    packed = docs.select(F.struct(*[docs[c] for c in names]).alias("r"), rules(docs[text_col], **options).alias("q"))
    return packed.filter("q.keep").select("r.*")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that the rules keep, with their shares."""
    return quality_rules(spark.read.parquet(f"{sf_dir}/documents.parquet")).filter("keep")


def _sql() -> str:
    grams = ", ".join(f"({n}, {v}::DOUBLE)" for n, v in LIMITS.items())
    shares = ", ".join(f"COALESCE(max(sh.share) FILTER (sh.n = {n}), 0.0::DOUBLE) AS dup{n}_share" for n in LIMITS)
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, COALESCE(text, '') AS text FROM documents),
w0 AS (SELECT r, unnest(list_filter(string_split_regex(text, '[\\t-\\r ]+'), lambda x: x <> '')) AS w,
              generate_subscripts(list_filter(string_split_regex(text, '[\\t-\\r ]+'), lambda x: x <> ''), 1) AS p FROM d),
ws AS (SELECT r, list(w ORDER BY p) AS ws, count(*) AS n_words, sum(length(w)) AS chars FROM w0 GROUP BY r),
k(n, cap) AS (VALUES {grams}),
g0 AS (SELECT r, n, unnest(range(1, n_words - n + 2)) AS p FROM ws, k WHERE n_words >= n),
g AS (SELECT g0.r, n, p, list_aggregate(ws.ws[p : p + n - 1], 'string_agg', ' ') AS gram FROM g0 JOIN ws ON ws.r = g0.r),
dup AS (SELECT r, n, p FROM (SELECT r, n, p, row_number() OVER (PARTITION BY r, n, gram ORDER BY p) AS c FROM g) WHERE c > 1),
cov AS (SELECT DISTINCT r, n, p + o AS p FROM (SELECT r, n, p, unnest(range(0, n)) AS o FROM dup)),
sh AS (SELECT cov.r, cov.n, sum(length(w0.w)) / max(ws.chars)::DOUBLE AS share
       FROM cov JOIN w0 ON w0.r = cov.r AND w0.p = cov.p JOIN ws ON ws.r = cov.r GROUP BY cov.r, cov.n),
piv AS (SELECT sh.r, {shares}, bool_and(sh.share <= k.cap) AS ok FROM sh JOIN k ON k.n = sh.n GROUP BY sh.r),
l0 AS (SELECT r, unnest(string_split(text, chr(10))) AS l FROM d),
l1 AS (SELECT r, l, length(l) AS one, count(*) AS c FROM l0 WHERE l <> '' GROUP BY r, l),
l AS (SELECT r, sum(one * (c - 1)) / sum(one * c)::DOUBLE AS share FROM l1 GROUP BY r)
SELECT d.doc_id, COALESCE(ws.n_words, 0)::BIGINT AS n_words, COALESCE(l.share, 0.0::DOUBLE) AS dup_line_share,
       {", ".join(f"COALESCE(dup{n}_share, 0.0::DOUBLE) AS dup{n}_share" for n in LIMITS)},
       COALESCE(ok, true) AND COALESCE(l.share, 0.0::DOUBLE) <= {LINE_LIMIT}::DOUBLE AS keep
FROM d LEFT JOIN ws ON ws.r = d.r LEFT JOIN piv ON piv.r = d.r LEFT JOIN l ON l.r = d.r
WHERE COALESCE(ok, true) AND COALESCE(l.share, 0.0::DOUBLE) <= {LINE_LIMIT}::DOUBLE
"""


SQL = _sql()
