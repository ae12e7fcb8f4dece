"""The operators' queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from attrition.llm import (
    bpe,
    decontaminate,
    language_id,
    license_scan,
    mixing,
    periodic,
    secret_scan,
    simhash,
    token_files,
    toxicity,
    treap,
    url_filter,
    vantage,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_url_filter": url_filter.op1_url_filter,
        "op2_license_scan": license_scan.op2_license_scan,
        "op3_language_id": language_id.op3_language_id,
        "op4_decontaminate": decontaminate.op4_decontaminate,
        "op5_nearest": vantage.op5_nearest,
        "op6_token_files": token_files.op6_token_files,
        "op7_simhash": simhash.op7_simhash,
        "op8_secret_scan": secret_scan.op8_secret_scan,
        "op9_toxicity": toxicity.op9_toxicity,
        "op10_mix_sources": mixing.op10_mix_sources,
        "op11_ranked_search": treap.op11_ranked_search,
        "op12_periodic_runs": periodic.op12_periodic_runs,
        "op13_bpe": bpe.op13_bpe,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_url_filter": url_filter.ORACLE,
        "op2_license_scan": license_scan.ORACLE,
        "op4_decontaminate": decontaminate.ORACLE,
        "op5_nearest": vantage.ORACLE,
        "op10_mix_sources": mixing.ORACLE,
        "op11_ranked_search": treap.ORACLE,
    }
