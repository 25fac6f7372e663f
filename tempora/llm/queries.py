"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from tempora.llm import (embedding_dedup, exact_dedup, jaccard_join, mixing, periodic_runs, pii,
                         quality, sentencepiece, sharding, substring_dedup, suffix_dedup, toxicity, whitening)

QUERIES = {
    "op1_suffix_dedup": suffix_dedup.op1_suffix_dedup,
    "op2_jaccard_join": jaccard_join.op2_jaccard_join,
    "op3_exact_dedup": exact_dedup.op3_exact_dedup,
    "op4_sharding": sharding.op4_sharding,
    "op5_embedding_dedup": embedding_dedup.op5_embedding_dedup,
    "op6_substring_dedup": substring_dedup.op6_substring_dedup,
    "op7_pii": pii.op7_pii,
    "op8_sentencepiece": sentencepiece.op8_sentencepiece,
    "op9_mixing": mixing.op9_mixing,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_whitening": whitening.op11_whitening,
    "op12_quality": quality.op12_quality,
    "op13_periodic_runs": periodic_runs.op13_periodic_runs,
    # what SQL can say of two results that it can't compute
    "sharding_law": sharding.sharding_law,
    "mixing_law": mixing.mixing_law,
}

ORACLE = {
    "op1_suffix_dedup": suffix_dedup.OP1_SQL,
    "op2_jaccard_join": jaccard_join.OP2_SQL,
    "op3_exact_dedup": exact_dedup.OP3_SQL,
    "op5_embedding_dedup": embedding_dedup.OP5_SQL,
    "op6_substring_dedup": substring_dedup.OP6_SQL,
    "sharding_law": sharding.LAW_SQL,
    "mixing_law": mixing.LAW_SQL,
}
