"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from siftwork.llm import (
    bpe,
    decontaminate,
    exact_dedup,
    importance,
    jaccard_join,
    language_id,
    line_dedup,
    lm_score,
    period_runs,
    simhash_groups,
    substring_dedup,
    suffix_dedup,
    toxicity,
)


def queries() -> dict:
    return {
        "op1_toxicity": toxicity.op1_toxicity,
        "op2_bpe": bpe.op2_bpe,
        "op3_jaccard_join": jaccard_join.op3_jaccard_join,
        "op4_substring_dedup": substring_dedup.op4_substring_dedup,
        "op5_suffix_dedup": suffix_dedup.op5_suffix_dedup,
        "op6_decontamination": decontaminate.op6_decontamination,
        "op7_language_id": language_id.op7_language_id,
        "op8_line_dedup": line_dedup.op8_line_dedup,
        "op9_exact_dedup": exact_dedup.op9_exact_dedup,
        "op10_lm_score": lm_score.op10_lm_score,
        "op11_period_runs": period_runs.op11_period_runs,
        "op12_importance": importance.op12_importance,
        "op13_simhash": simhash_groups.op13_simhash,
    }


def oracle_sql() -> dict[str, str]:
    stated = (jaccard_join, substring_dedup, suffix_dedup, decontaminate, line_dedup, exact_dedup, importance)
    return {name: sql for module in stated for name, sql in module.ORACLE.items()}
