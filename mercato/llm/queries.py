"""The registered queries of this folder and their SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from mercato.llm import (
    collision_search,
    hamming_search,
    license_scan,
    mixing,
    ngram_join,
    packing,
    periodic_runs,
    secret_scan,
    spelling_variants,
    suffix_dedup,
    token_counts,
    toxicity,
    url_filter,
)

OPERATORS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        license_scan.op1_license_scan,
        packing.op2_best_fit_packing,
        mixing.op3_mixing_sources,
        collision_search.op4_nearest_neighbours,
        url_filter.op5_url_filters,
        ngram_join.op6_ngram_jaccard_join,
        token_counts.op7_token_counts,
        toxicity.op8_toxicity,
        hamming_search.op9_exact_hamming_search,
        suffix_dedup.op10_suffix_dedup,
        secret_scan.op11_secret_scan,
        spelling_variants.op12_spelling_variants,
        periodic_runs.op13_periodic_runs,
    )
}

SQL: dict[str, str] = {
    "op5_url_filters": url_filter.OP5_SQL,
    "op9_exact_hamming_search": hamming_search.OP9_SQL,
    "op11_secret_scan": secret_scan.OP11_SQL,
    "op12_spelling_variants": spelling_variants.OP12_SQL,
    "op13_periodic_runs": periodic_runs.OP13_SQL,
}
