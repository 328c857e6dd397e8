"""The queries of this subpackage and their SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm import chat_format, compact_windows, decontam, lm_score, mixing, ngram_join, periodic_runs, phrases, pii, quality, simhash, suffix_dedup, token_output

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": pii.op1_pii,
    "op2_mixing": mixing.op2_mixing,
    "op3_lm": lm_score.op3_lm,
    "op4_suffix": suffix_dedup.op4_suffix,
    "op5_quality": quality.op5_quality,
    "quality_policies": quality.quality_policies,
    "quality_ablations": quality.quality_ablations,
    "op6_decontam": decontam.op6_decontam,
    "op7_tokens": token_output.op7_tokens,
    "op8_windows": compact_windows.op8_windows,
    "op9_jaccard": ngram_join.op9_jaccard,
    "op10_chat": chat_format.op10_chat,
    "op11_phrases": phrases.op11_phrases,
    "op12_runs": periodic_runs.op12_runs,
    "op13_simhash": simhash.op13_simhash,
}
ORACLE_SQL: dict[str, str] = {
    "op2_mixing": mixing.OP2_SQL,
    "op5_quality": quality.OP5_SQL,
    "quality_policies": quality.POLICIES_SQL,
    "quality_ablations": quality.ABLATIONS_SQL,
    "op9_jaccard": ngram_join.OP9_SQL,
    "op10_chat": chat_format.OP10_SQL,
    "op11_phrases": phrases.OP11_SQL,
}
