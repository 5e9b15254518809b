"""Queries of this package and their SQL, for ``__spark_entry__``."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from . import common
from .align import op13_cross_tokenizer_alignment
from .bpe import op12_bpe_round_trip
from .decontaminate import op8_decontaminate
from .fingerprints import op7_bottom_k_fingerprints
from .license_scan import op10_license_scan
from .line_dedup import op3_line_dedup, op3_sql
from .packing import op4_best_fit_packing
from .prob_minhash import op2_prob_minhash
from .secret_scan import op6_secret_scan, op6_sql
from .suffix_dedup import op1_suffix_dedup
from .token_counts import op5_token_counts
from .toxicity import op9_toxicity_chain
from .whitening import op11_embedding_whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_prob_minhash": op2_prob_minhash,
    "op3_line_dedup": op3_line_dedup,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_token_counts": op5_token_counts,
    "op6_secret_scan": op6_secret_scan,
    "op7_bottom_k_fingerprints": op7_bottom_k_fingerprints,
    "op8_decontaminate": op8_decontaminate,
    "op9_toxicity_chain": op9_toxicity_chain,
    "op10_license_scan": op10_license_scan,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_bpe_round_trip": op12_bpe_round_trip,
    "op13_cross_tokenizer_alignment": op13_cross_tokenizer_alignment,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL: dict[str, str] = {"op3_line_dedup": op3_sql(), "op6_secret_scan": op6_sql()}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def shipped(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            common.ship(spark)
            return fn(spark, sf_dir)

        return run

    return {name: shipped(fn) for name, fn in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
