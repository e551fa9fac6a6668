"""Queries of the training-data operators, and their SQL."""

from __future__ import annotations

from lapwing.llm.byte_bpe import op3_byte_bpe
from lapwing.llm.decontaminate import OP4_SQL, op4_decontamination
from lapwing.llm.exact_dedup import OP6_SQL, op6_exact_dedup
from lapwing.llm.lm_scoring import op5_lm_scoring
from lapwing.llm.pii import op8_pii
from lapwing.llm.quality import op2_quality
from lapwing.llm.simhash import op10_simhash
from lapwing.llm.token_counts import op7_token_counts
from lapwing.llm.token_store import op9_token_store
from lapwing.llm.toxicity import op1_toxicity


def queries() -> dict:
    return {
        "op1_toxicity": op1_toxicity,
        "op2_quality": op2_quality,
        "op3_byte_bpe": op3_byte_bpe,
        "op4_decontamination": op4_decontamination,
        "op5_lm_scoring": op5_lm_scoring,
        "op6_exact_dedup": op6_exact_dedup,
        "op7_token_counts": op7_token_counts,
        "op8_pii": op8_pii,
        "op9_token_store": op9_token_store,
        "op10_simhash": op10_simhash,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_decontamination": OP4_SQL,
        "op6_exact_dedup": OP6_SQL,
    }
