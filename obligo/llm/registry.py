"""The registered queries of this subpackage and their reference SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from obligo.llm import (
    exact_dedup,
    fingerprints,
    line_dedup,
    lm_score,
    merkle,
    mixing,
    packing,
    pii,
    quality,
    runs,
    secret_scan,
    simhash,
    toxicity,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": secret_scan.query,
    "op2_simhash_dedup": simhash.query,
    "op3_line_dedup": line_dedup.query,
    "op4_toxicity": toxicity.query,
    "op5_fingerprints": fingerprints.query,
    "op6_mix_sources": mixing.query,
    "op7_lm_score": lm_score.query,
    "op8_exact_dedup": exact_dedup.query,
    "op9_quality": quality.query,
    "op10_packing": packing.query,
    "op11_periodic_runs": runs.query,
    "op12_pii": pii.query,
    "op13_merkle": merkle.query,
    "pipeline": corpus_pipeline.run,
}

SQL: dict[str, str] = {
    "op3_line_dedup": line_dedup.SQL,
    "op8_exact_dedup": exact_dedup.SQL,
    "op13_merkle": merkle.SQL,
    **({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}),
}
