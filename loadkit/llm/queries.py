"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from loadkit.llm.decontaminate import op5_decontamination
from loadkit.llm.embedding_dedup import OP11_SQL, op11_embedding_dedup
from loadkit.llm.langid import op2_language_id
from loadkit.llm.lexical_search import OP13_SQL, op13_lexical_search
from loadkit.llm.line_dedup import OP4_SQL, op4_line_dedup
from loadkit.llm.packing import op7_best_fit_packing
from loadkit.llm.pii import op8_information_sanitiser
from loadkit.llm.quality import op3_quality_rules
from loadkit.llm.simhash import op1_simhash
from loadkit.llm.spelling import op12_spelling_variants
from loadkit.llm.suffix_dedup import OP10_SQL, op10_suffix_dedup
from loadkit.llm.tokens import op6_token_counts
from loadkit.llm.toxicity import op9_toxicity

QUERIES = {
    "op1_simhash": op1_simhash,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_embedding_dedup": op11_embedding_dedup,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_lexical_search": op13_lexical_search,
    "op2_language_id": op2_language_id,
    "op3_quality_rules": op3_quality_rules,
    "op4_line_dedup": op4_line_dedup,
    "op5_decontamination": op5_decontamination,
    "op6_token_counts": op6_token_counts,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_information_sanitiser": op8_information_sanitiser,
    "op9_toxicity": op9_toxicity,
}

#: The others rest on XXH64, learned models, token vocabularies, floating-point
#: spaces, patterns with positions, or packings; their tests hold brute-force versions.
ORACLES: dict[str, str] = {
    "op4_line_dedup": OP4_SQL,
    "op10_suffix_dedup": OP10_SQL,
    "op11_embedding_dedup": OP11_SQL,
    "op13_lexical_search": OP13_SQL,
}
