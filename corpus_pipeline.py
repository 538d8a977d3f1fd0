"""The corpus pipeline: five stages over ``documents``, each written and read again before the next.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept, and returns the columns of
documents (the last one adds its own). Other columns of ``docs`` are passed on untouched, whatever their names.

In all stages: a null or empty text has nothing to judge and stays, a null id stays with its row, very long texts are
handled whole, repeated rows are handled each by itself unless a stage says otherwise, and an empty table gives an
empty one with the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winnowry.llm import decontaminate, line_dedup, ngram_join, quality_rules, sentencepiece_bpe
from winnowry.session import cut


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules reject go.

    A share at its limit stays. Equal rows are judged alike, each by itself.
    """
    return quality_rules.kept(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three-line windows go, and documents of which nothing but blanks is left by that.

    Of equal windows the first by (doc_id, line) stays; a null id comes first. Rows that agree in id and text are one
    occurrence and stay alike. Blank lines stay, and so do documents that were blank before. ``n_chars`` follows the text.
    """
    return line_dedup.rewritten(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the least doc_id stays.

    Pairs at the threshold are duplicates. Texts without a word have no duplicates; rows with a null id stay; rows that
    agree in id and text are one document and stay or go together.
    """
    return ngram_join.one_of_each(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain an item of ``benchmark`` go.

    A document at the threshold goes. Null and blank items match nothing; without items every document stays.
    """
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with ``token_ids`` and ``exact``: whether decoding gives the text again.

    A null text has null for both, an empty one no ids and true. Columns of these names are replaced.
    """
    names = [c for c in docs.columns if c not in ("token_ids", "exact")]
    packed = docs.select(F.struct(*[docs[c] for c in names]).alias("r"), sentencepiece_bpe.checked(docs["text"]).alias("e"))
    return packed.select("r.*", "e.token_ids", "e.exact")


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("SentencePiece encoding and decoding", tokens),
]

#: The last stage's pieces can't be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs, "pipeline-" + name.lower().replace(" ", "-"))
    return docs
