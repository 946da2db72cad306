"""Queries of the training-data operators and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from .chat_format import OP9_SQL, op9_chat_formatting
from .conversation_repair import OP12_SQL, op12_conversation_repair
from .decontaminate import op2_decontamination
from .language_id import op13_language_id
from .line_dedup import OP1_SQL, op1_line_dedup
from .lm_scoring import OP3_SQL, op3_lm_scoring
from .mixing import op10_mixing
from .near_dedup import op6_minhash_near_dedup
from .quality_knn import op4_quality
from .resampling import OP11_SQL, op11_resampling
from .token_counts import op8_token_counts
from .topk_search import OP7_SQL, op7_exact_topk
from .toxicity import op5_toxicity

QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_decontamination": op2_decontamination,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_quality": op4_quality,
    "op5_toxicity": op5_toxicity,
    "op6_minhash_near_dedup": op6_minhash_near_dedup,
    "op7_exact_topk": op7_exact_topk,
    "op8_token_counts": op8_token_counts,
    "op9_chat_formatting": op9_chat_formatting,
    "op10_mixing": op10_mixing,
    "op11_resampling": op11_resampling,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_language_id": op13_language_id,
}

ORACLES = {
    "op1_line_dedup": OP1_SQL,
    "op3_lm_scoring": OP3_SQL,
    "op7_exact_topk": OP7_SQL,
    "op9_chat_formatting": OP9_SQL,
    "op11_resampling": OP11_SQL,
    "op12_conversation_repair": OP12_SQL,
}
