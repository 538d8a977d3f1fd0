"""Queries of the subpackage and the SQL that says the same."""

from __future__ import annotations

from . import (
    chat_format,
    decontaminate,
    line_dedup,
    maxent_lm,
    ngram_join,
    quality_rules,
    rans,
    sentencepiece_bpe,
    suffix_dedup,
    toxicity,
)


def queries() -> dict:
    return {
        "op1_quality_rules": quality_rules.op1_quality_rules,
        "op2_suffix_dedup": suffix_dedup.op2_suffix_dedup,
        "op3_chat_format": chat_format.op3_chat_format,
        "op4_decontaminate": decontaminate.op4_decontaminate,
        "op5_sentencepiece": sentencepiece_bpe.op5_sentencepiece,
        "op6_toxicity": toxicity.op6_toxicity,
        "op7_rans": rans.op7_rans,
        "op8_maxent_lm": maxent_lm.op8_maxent_lm,
        "op9_ngram_jaccard": ngram_join.op9_ngram_jaccard,
        "op10_line_dedup": line_dedup.op10_line_dedup,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_quality_rules": quality_rules.SQL,
        "op4_decontaminate": decontaminate.SQL,
        "op9_ngram_jaccard": ngram_join.SQL,
        "op10_line_dedup": line_dedup.SQL,
    }
