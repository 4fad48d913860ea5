"""The operators' queries and their DuckDB SQL, by query name."""

from __future__ import annotations

import public_tokenizers

from flightmart.llm import (
    bpe, fim, html, language, near_dedup, packing, pivots, quality, secrets, seed_dedup, suffix_dedup, toxicity, winnowing,
)
from flightmart.llm.common import table


def op1_toxicity(spark, sf_dir):
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_winnowing(spark, sf_dir):
    return winnowing.fingerprints(table(spark, sf_dir, "documents"))


def op3_near_dedup(spark, sf_dir):
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op4_html(spark, sf_dir):
    return html.extracted(table(spark, sf_dir, "pages"))


def op5_packing(spark, sf_dir):
    return packing.packed(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op6_suffix_dedup(spark, sf_dir):
    return suffix_dedup.cut_texts(table(spark, sf_dir, "documents"))


def op7_language(spark, sf_dir):
    return language.identified(table(spark, sf_dir, "documents"))


def op8_bpe(spark, sf_dir):
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_quality(spark, sf_dir):
    return quality.judged(table(spark, sf_dir, "documents"))


def op10_secrets(spark, sf_dir):
    return secrets.scanned(table(spark, sf_dir, "documents"))


def op11_pivot_clusters(spark, sf_dir):
    return pivots.digests(table(spark, sf_dir, "embeddings"))


def op12_seed_dedup(spark, sf_dir):
    return seed_dedup.digests(table(spark, sf_dir, "documents"))


def op13_fill_in_middle(spark, sf_dir):
    return fim.digests(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_winnowing": op2_winnowing,
    "op3_near_dedup": op3_near_dedup,
    "op4_html": op4_html,
    "op5_packing": op5_packing,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_language": op7_language,
    "op8_bpe": op8_bpe,
    "op9_quality": op9_quality,
    "op10_secrets": op10_secrets,
    "op11_pivot_clusters": op11_pivot_clusters,
    "op12_seed_dedup": op12_seed_dedup,
    "op13_fill_in_middle": op13_fill_in_middle,
}

ORACLES = {
    "op3_near_dedup": near_dedup.ORACLE,
    "op6_suffix_dedup": suffix_dedup.ORACLE,
    "op9_quality": quality.ORACLE,
    "op11_pivot_clusters": pivots.ORACLE,
    "op12_seed_dedup": seed_dedup.ORACLE,
    "op13_fill_in_middle": fim.ORACLE,
}
