"""Operator 10: overlapping three-line windows.

Every run of three consecutive non-blank lines (compared without surrounding blanks) is hashed; a window that occurs
more than once in the corpus is repeated, and all its occurrences but the first, by (doc_id, position), are removed.
Covered lines of overlapping windows are merged, so a passage of any length of at least three lines goes whole.

Plan: windows explode in the JVM, counts and first places are aggregated with map-side combining (a window that
millions share costs one row per task), the repeated ones join back to the windows, and only line numbers travel to
the documents. Two 64-bit hashes identify a window.

Defined results: null and empty texts and texts of fewer than three non-blank lines stay as they are. Rows that agree
in doc_id and text are the same occurrence, so repeated rows get the same result and neither loses anything to the
other; a null doc_id sorts first and matches only itself; of equal windows in one document the first place counts. Blank
lines always stay. An empty table gives an empty result. Very long texts are handled whole. Other columns are not read;
the result has doc_id, text and n_removed alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: What counts as a blank at the ends of a line.
BLANK = " \t\r"


def _windows(docs: DataFrame) -> DataFrame:
    lines = F.expr(
        f"filter(transform(split(text, '\\n', -1), (x, i) -> struct(trim(BOTH '{BLANK}' FROM x) AS t, i AS i)), x -> x.t <> '')"
    )
    made = F.expr(
        "transform(sequence(0, size(l) - 3), k -> struct("
        "xxhash64(l[k].t, l[k + 1].t, l[k + 2].t) AS h1, xxhash64(l[k + 2].t, 'w', l[k].t, 'w', l[k + 1].t) AS h2, "
        "l[k].i AS a, l[k + 1].i AS b, l[k + 2].i AS c))"
    )
    few = docs.filter(F.length("text") > 4).select("doc_id", "t", lines.alias("l")).filter(F.size("l") >= 3)
    return few.select("doc_id", "t", F.explode(made).alias("w")).select("doc_id", "t", "w.*")


def _deduped(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text, n_removed, r): r is the whole row of ``docs``."""
    row = F.struct(*[docs[c] for c in docs.columns])
    base = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"), row.alias("r"))
    base = base.withColumn("t", F.xxhash64("text"))
    w = _windows(base)
    place = F.struct("doc_id", "t", "a")
    seen = w.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    seen = seen.filter(~F.col("first").eqNullSafe(F.col("last"))).drop("last")
    again = w.join(seen, ["h1", "h2"]).filter(~place.eqNullSafe(F.col("first")))
    gone = again.groupBy("doc_id", "t").agg(F.array_distinct(F.flatten(F.collect_set(F.array("a", "b", "c")))).alias("gone"))
    gone = gone.withColumnsRenamed({"doc_id": "doc_id_", "t": "t_"})
    joined = base.join(gone, base.doc_id.eqNullSafe(gone.doc_id_) & (base.t == gone.t_), "left")
    kept = joined.withColumn("lines", F.when(F.col("gone").isNotNull(), F.split("text", "\n", -1)))
    rest = F.expr("array_join(transform(array_except(sequence(0, size(lines) - 1), gone), k -> lines[k]), '\\n')")
    return kept.select(
        "doc_id",
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(rest).alias("text"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
        "r",
    )


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, n_removed) for each row of ``docs``; ``text`` without the lines of later occurrences."""
    return _deduped(docs, id_col, text_col).drop("r")


def rewritten(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size_col: str = "n_chars") -> DataFrame:
    """``docs`` with the shorter texts, without rows that lost lines and have none but blank ones left."""
    out = _deduped(docs, id_col, text_col).filter((F.col("n_removed") == 0) | (F.trim("text", F.lit(BLANK + "\n")) != ""))
    new = {text_col: F.col("text"), size_col: F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col(f"r.{size_col}"))}
    return out.select(*[new.get(c, F.col("r")[c]).alias(c) for c in docs.columns])


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = """
WITH l0 AS (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line,
                   generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
nb AS (SELECT doc_id, text, i, trim(line, ' ' || chr(9) || chr(13)) AS t FROM l0 WHERE trim(line, ' ' || chr(9) || chr(13)) <> ''),
w AS (SELECT * FROM (SELECT doc_id, text, i AS a, lead(i) OVER k AS b, lead(i, 2) OVER k AS c, t AS x, lead(t) OVER k AS y, lead(t, 2) OVER k AS z
      FROM nb WINDOW k AS (PARTITION BY doc_id, text ORDER BY i)) WHERE c IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY x, y, z ORDER BY doc_id, a) AS n FROM w),
gone AS (SELECT DISTINCT doc_id, text, unnest([a, b, c]) AS i FROM r WHERE n > 1),
rest AS (SELECT l0.doc_id, l0.text, string_agg(line, chr(10) ORDER BY l0.i) FILTER (gone.i IS NULL) AS kept, count(gone.i) AS n_removed
         FROM l0 LEFT JOIN gone ON gone.doc_id = l0.doc_id AND gone.text = l0.text AND gone.i = l0.i GROUP BY l0.doc_id, l0.text)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE COALESCE(kept, '') END AS text, COALESCE(n_removed, 0)::BIGINT AS n_removed
FROM documents d LEFT JOIN rest ON rest.doc_id = d.doc_id AND rest.text = d.text
"""
