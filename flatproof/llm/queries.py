"""The registered queries of the operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from .chat import op8_chat_windows
from .decontamination import OP2_SQL, op2_decontamination
from .language_id import op13_language_id
from .mixing import OP10_SQL, op10_systematic_mix
from .quality import op3_quality_trees
from .simhash import op6_simhash
from .structure_repair import OP11_SQL, op11_structure_repair
from .substring_dedup import OP7_SQL, op7_substring_dedup
from .suffix_dedup import OP4_SQL, op4_suffix_dedup
from .tokens import op1_token_counts
from .topk import OP9_SQL, op9_binary_topk
from .url_templates import op5_url_templates
from .whitening import op12_embedding_whitening

QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_decontamination": op2_decontamination,
    "op3_quality_trees": op3_quality_trees,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_url_templates": op5_url_templates,
    "op6_simhash": op6_simhash,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_chat_windows": op8_chat_windows,
    "op9_binary_topk": op9_binary_topk,
    "op10_systematic_mix": op10_systematic_mix,
    "op11_structure_repair": op11_structure_repair,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_language_id": op13_language_id,
}

ORACLES = {
    "op2_decontamination": OP2_SQL,
    "op4_suffix_dedup": OP4_SQL,
    "op7_substring_dedup": OP7_SQL,
    "op9_binary_topk": OP9_SQL,
    "op10_systematic_mix": OP10_SQL,
    "op11_structure_repair": OP11_SQL,
}
