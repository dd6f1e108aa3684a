"""Registered queries of this package and their SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskloom.llm import class_lm, collocations, html_text, language_id, latent_leaks, ngram_join, order_minhash, packing, source_mix, substring_dedup, suffix_dedup, url_rules, whitening


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_class_lm": class_lm.op1,
        "op2_html_text": html_text.op2,
        "op3_language_id": language_id.op3,
        "op4_order_minhash": order_minhash.op4,
        "op5_ngram_join": ngram_join.op5,
        "op6_substring_dedup": substring_dedup.op6,
        "op7_suffix_dedup": suffix_dedup.op7,
        "op8_packing": packing.op8,
        "op9_url_rules": url_rules.op9,
        "op10_latent_leaks": latent_leaks.op10,
        "op11_source_mix": source_mix.op11,
        "op12_collocations": collocations.op12,
        "op13_whitening": whitening.op13,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op5_ngram_join": ngram_join.op5_sql(),
        "op6_substring_dedup": substring_dedup.op6_sql(),
        "op7_suffix_dedup": suffix_dedup.op7_sql(),
        "op9_url_rules": url_rules.op9_sql(),
        "op12_collocations": collocations.op12_sql(),
    }
