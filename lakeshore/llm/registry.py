"""Queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from lakeshore.llm.bpe import op9_byte_level_bpe
from lakeshore.llm.chat_format import op13_chat_formatting
from lakeshore.llm.hard_negatives import op11_hard_negatives
from lakeshore.llm.html_text import op10_html_extraction
from lakeshore.llm.inverted_index import op3_embedding_near_dedup
from lakeshore.llm.ngram_join import op2_ngram_jaccard_join
from lakeshore.llm.oracle import ORACLE
from lakeshore.llm.packing import op7_best_fit_packing
from lakeshore.llm.quality import op6_quality_rules
from lakeshore.llm.tokens import op1_token_counts
from lakeshore.llm.toxicity import op5_toxicity
from lakeshore.llm.turn_repair import op12_conversation_repair
from lakeshore.llm.url_filter import op4_url_filters
from lakeshore.llm.warc import op8_warc

QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_ngram_jaccard_join": op2_ngram_jaccard_join,
    "op3_embedding_near_dedup": op3_embedding_near_dedup,
    "op4_url_filters": op4_url_filters,
    "op5_toxicity": op5_toxicity,
    "op6_quality_rules": op6_quality_rules,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_warc": op8_warc,
    "op9_byte_level_bpe": op9_byte_level_bpe,
    "op10_html_extraction": op10_html_extraction,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_chat_formatting": op13_chat_formatting,
}

__all__ = ["ORACLE", "QUERIES"]
