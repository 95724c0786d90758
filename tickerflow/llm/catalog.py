"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

from ..session import ensure_checkpoint_dir, ship_package
from . import op01_lm_score, op02_substrings, op03_jaccard, op04_toxicity, op05_shards, op06_decontaminate, op07_mixing, op08_main_text, op09_token_counts, op10_quality, op11_codes, op12_minhash, op13_manifest

_QUERIES = {
    "op1_lm_score": op01_lm_score.query,
    "op2_substrings": op02_substrings.query,
    "op3_jaccard": op03_jaccard.query,
    "op4_toxicity": op04_toxicity.query,
    "op5_shards": op05_shards.query,
    "op6_decontaminate": op06_decontaminate.query,
    "op7_mixing": op07_mixing.query,
    "op8_main_text": op08_main_text.query,
    "op9_token_counts": op09_token_counts.query,
    "op10_quality": op10_quality.query,
    "op11_codes": op11_codes.query,
    "op12_minhash": op12_minhash.query,
    "op13_manifest": op13_manifest.query,
    "pipeline": corpus_pipeline.run,
}


def _prepared(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_checkpoint_dir(spark)
        ship_package(spark)
        return fn(spark, sf_dir)

    run.__doc__ = fn.__doc__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _prepared(fn) for name, fn in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {
        "op7_mixing": op07_mixing.SQL,
        "op10_quality": op10_quality.SQL,
        "op11_codes": op11_codes.SQL,
        "op12_minhash": op12_minhash.SQL,
        "op13_manifest": op13_manifest.SQL,
    }
