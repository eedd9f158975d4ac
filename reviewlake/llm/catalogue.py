"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from reviewlake.llm import forest_search, html_extract, language_id, mixing, multi_index, ngram_join, packing, quality, sharding, token_counts


def queries() -> dict:
    return {
        "op1_projection_forest": forest_search.op1_projection_forest,
        "op2_token_counts": token_counts.op2_token_counts,
        "op3_ngram_jaccard": ngram_join.op3_ngram_jaccard,
        "op4_mix_sources": mixing.op4_mix_sources,
        "op5_vector_packing": packing.op5_vector_packing,
        "op6_hyperdimensional_lang": language_id.op6_hyperdimensional_lang,
        "op7_additive_quality": quality.op7_additive_quality,
        "op8_consensus_paths": html_extract.op8_consensus_paths,
        "op10_multi_index": multi_index.op10_multi_index,
        "op9_jump_shards": sharding.op9_jump_shards,
    }


def oracle_sql() -> dict:
    return {"op3_ngram_jaccard": ngram_join.OP3_SQL, "op4_mix_sources": mixing.OP4_SQL, "op9_jump_shards": sharding.OP9_SQL}
