"""The queries of this package by name, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewatt.llm.decontam import op1_decontamination
from tidewatt.llm.fingerprints import op7_order_minhash
from tidewatt.llm.language import op9_language_scores
from tidewatt.llm.licences import OP10_SQL, op10_license_scan
from tidewatt.llm.lines import OP4_SQL, op4_line_dedup
from tidewatt.llm.near import OP8_SQL, op8_minhash_near_dedup
from tidewatt.llm.neighbours import op13_learned_partitions
from tidewatt.llm.packing import op5_best_fit_packing
from tidewatt.llm.quality import op6_quality
from tidewatt.llm.repair import OP12_SQL, op12_structure_repair
from tidewatt.llm.tokens import op2_token_counts
from tidewatt.llm.toxicity import op3_toxicity
from tidewatt.llm.trie import OP11_SQL, op11_prefix_trie

Query = Callable[[SparkSession, str], DataFrame]


def llm_queries() -> dict[str, Query]:
    found = (
        op1_decontamination,
        op2_token_counts,
        op3_toxicity,
        op4_line_dedup,
        op5_best_fit_packing,
        op6_quality,
        op7_order_minhash,
        op8_minhash_near_dedup,
        op9_language_scores,
        op10_license_scan,
        op11_prefix_trie,
        op12_structure_repair,
        op13_learned_partitions,
    )
    return {query.__name__: query for query in found}


def llm_oracles() -> dict[str, str]:
    """Exact SQL; the others are compared with brute force or libraries in the tests."""
    return {
        "op4_line_dedup": OP4_SQL,
        "op8_minhash_near_dedup": OP8_SQL,
        "op10_license_scan": OP10_SQL,
        "op11_prefix_trie": OP11_SQL,
        "op12_structure_repair": OP12_SQL,
    }
