"""The registered queries of this subpackage and the SQL twins of those that have one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from bloomledger.llm import (
    alignment,
    collocations,
    context_tree,
    decontamination,
    language_id,
    lines,
    mixing,
    near_dedup,
    pii,
    repeats,
    sharding,
    token_counts,
    winnowing,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_skip_chain_pii": pii.op1_skip_chain_pii,
    "op2_pareto_mix": mixing.op2_pareto_mix,
    "op3_token_counts": token_counts.op3_token_counts,
    "op4_table_sharding": sharding.op4_table_sharding,
    "op5_minhash_near_dedup": near_dedup.op5_minhash_near_dedup,
    "op6_suffix_dedup": repeats.op6_suffix_dedup,
    "op7_language_id": language_id.op7_language_id,
    "op8_qgram_decontamination": decontamination.op8_qgram_decontamination,
    "op9_winnowing": winnowing.op9_winnowing,
    "op10_context_tree_scores": context_tree.op10_context_tree_scores,
    "op11_token_alignment": alignment.op11_token_alignment,
    "op12_collocations": collocations.op12_collocations,
    "op13_line_dedup": lines.op13_line_dedup,
}

ORACLE_SQL: dict[str, str] = {
    "op2_pareto_mix": mixing.OP2_SQL,
    "op5_minhash_near_dedup": near_dedup.OP5_SQL,
    "op6_suffix_dedup": repeats.OP6_SQL,
    "op12_collocations": collocations.OP12_SQL,
    "op13_line_dedup": lines.OP13_SQL,
}
