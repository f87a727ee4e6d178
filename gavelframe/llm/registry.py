"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from gavelframe.llm import embedding_dedup, jaccard_join, kneser_ney, langid, licenses, mixing, sentencepiece_bpe, suffix_dedup, url_filter, winnowing

_MODULES = (langid, jaccard_join, embedding_dedup, sentencepiece_bpe, suffix_dedup, winnowing, url_filter, licenses, kneser_ney, mixing)
QUERIES = {name: f for m in _MODULES for name, f in m.QUERIES.items()}
SQL = {name: sql for m in _MODULES for name, sql in m.SQL.items()}
