"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import (bpe, centroids, chat, forest, html_main, minhash, oracles, packing, pii, quality_rules, ranked_search, records,
                         substring, url_rules)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op5_quality_rules": quality_rules.op5_quality_rules,
        "op9_minhash": minhash.op9_minhash,
        "op1_main_text": html_main.op1_main_text,
        "op2_forest": forest.op2_forest,
        "op3_chat": chat.op3_chat,
        "op8_pii": pii.op8_pii,
        "op7_substring": substring.op7_substring,
        "op4_records": records.op4_records,
        "op6_bpe": bpe.op6_bpe,
        "op10_packing": packing.op10_packing,
        "op11_url_rules": url_rules.op11_url_rules,
        "op12_nra": ranked_search.op12_nra,
        "op13_centroids": centroids.op13_centroids,
    }


def oracle() -> dict[str, str]:
    return {"op2_forest": oracles.OP2, "op3_chat": chat.ORACLE, "op7_substring": oracles.OP7, "op9_minhash": oracles.OP9,
            "op11_url_rules": url_rules.ORACLE, "op12_nra": ranked_search.ORACLE, "op13_centroids": centroids.ORACLE}
