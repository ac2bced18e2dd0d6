"""Queries of the training-data operators, and their oracle SQL."""

from __future__ import annotations

from gleanworks.llm.chat import OP11_SQL, op11_chat_format
from gleanworks.llm.filter_audit import OP13_SQL, op13_filter_audit
from gleanworks.llm.knn import OP6_SQL, op6_voronoi_knn
from gleanworks.llm.lm_score import op5_cross_entropy_difference
from gleanworks.llm.media import op10_flac
from gleanworks.llm.mixing import op9_entropy_mix
from gleanworks.llm.ngram_join import op3_ngram_join
from gleanworks.llm.packing import op2_best_fit_pack
from gleanworks.llm.repair import OP12_SQL, op12_structure_repair
from gleanworks.llm.sharding import op8_ring_shards
from gleanworks.llm.token_counts import op7_section_tokens
from gleanworks.llm.toxicity import op1_compression_toxicity
from gleanworks.llm.url_filter import OP4_SQL, op4_url_terms

QUERIES = {
    f.__name__: f
    for f in (
        op1_compression_toxicity, op2_best_fit_pack, op3_ngram_join, op4_url_terms, op5_cross_entropy_difference,
        op6_voronoi_knn, op7_section_tokens, op8_ring_shards, op9_entropy_mix, op10_flac,
        op11_chat_format, op12_structure_repair, op13_filter_audit,
    )
}
ORACLES = {"op4_url_terms": OP4_SQL, "op6_voronoi_knn": OP6_SQL, "op11_chat_format": OP11_SQL, "op12_structure_repair": OP12_SQL, "op13_filter_audit": OP13_SQL}
