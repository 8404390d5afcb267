"""The queries of this subpackage and the SQL that checks those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

from ..session import ship
from . import conversations, cover_tree, language, line_dedup, mixing, ngram_join, pieces, pii, quality_classifier, quality_rules, repeats, resample, toxicity


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {
        "op1_line_dedup": line_dedup.op1_line_dedup,
        "op2_toxicity": toxicity.op2_toxicity,
        "op3_suffix_dedup": repeats.op3_suffix_dedup,
        "op4_cover_tree": cover_tree.op4_cover_tree,
        "op5_quality_rules": quality_rules.op5_quality_rules,
        "op6_quality_classifier": quality_classifier.op6_quality_classifier,
        "op7_language": language.op7_language,
        "op8_sentencepiece": pieces.op8_sentencepiece,
        "op9_ngram_join": ngram_join.op9_ngram_join,
        "op10_mixing": mixing.op10_mixing,
        "op11_resample": resample.op11_resample,
        "op12_private": pii.op12_private,
        "op13_conversation_repair": conversations.op13_conversation_repair,
        "pipeline": corpus_pipeline.run,
    }
    return {name: _shipped(query) for name, query in found.items()}


def oracle_sql() -> dict[str, str]:
    return {"op1_line_dedup": line_dedup.OP1_SQL, "op4_cover_tree": cover_tree.OP4_SQL, "op5_quality_rules": quality_rules.OP5_SQL, "op10_mixing": mixing.OP10_SQL, "op11_resample": resample.OP11_SQL, "op13_conversation_repair": conversations.OP13_SQL}
