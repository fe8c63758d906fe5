"""Queries and SQL of this subpackage."""

from __future__ import annotations

from . import ann, chat, importance, jaccard, language, lexical, mixing, packing, private, quality, suffixes, token_counts, toxicity

QUERIES = {f.__name__: f for f in (ann.op1_additive_quantisation, packing.op2_packing, mixing.op3_mixing, chat.op4_preferences, suffixes.op5_suffix_dedup, token_counts.op6_token_counts, jaccard.op7_jaccard_components, language.op8_language_mixture, quality.op9_compression_bands, toxicity.op10_toxic_segments, lexical.op11_ranked_search, private.op12_personal_data, importance.op13_importance_resampling)}

SQL: dict[str, str] = {"op4_preferences": chat.OP4_SQL, "op11_ranked_search": lexical.OP11_SQL}
