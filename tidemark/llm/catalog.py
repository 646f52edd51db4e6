"""The queries of this subpackage, one for each operator, and their SQL where SQL can express them."""

from __future__ import annotations

from tidemark.llm.collocations import op13_collocations
from tidemark.llm.decontaminate import op5_decontaminate
from tidemark.llm.embedding_dups import op12_embedding_dups
from tidemark.llm.html_extract import op8_html_extract
from tidemark.llm.language import op6_language
from tidemark.llm.mixing import OP1_SQL, op1_mixing
from tidemark.llm.ngram_join import op10_ngram_jaccard
from tidemark.llm.quality import op3_quality
from tidemark.llm.quality_rules import OP9_SQL, op9_quality_rules
from tidemark.llm.suffix_dedup import op4_suffix_dedup
from tidemark.llm.token_align import op11_token_align
from tidemark.llm.toxicity import op2_toxicity
from tidemark.llm.url_filter import op7_url_filter

LLM_QUERIES = {f.__name__: f for f in (
    op1_mixing, op2_toxicity, op3_quality, op4_suffix_dedup, op5_decontaminate, op6_language,
    op7_url_filter, op8_html_extract, op9_quality_rules, op10_ngram_jaccard, op11_token_align, op12_embedding_dups,
    op13_collocations)}
LLM_ORACLE_SQL = {"op1_mixing": OP1_SQL, "op9_quality_rules": OP9_SQL}
