"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from tidewater.llm import (
    chat_format, exact_dedup, hnsw, language_id, license_scan, mix_sources, near_dedup, ngram_join, phrases,
    sentencepiece_codec, toxicity, url_filter, whitening,
)

_MODULES = [license_scan, ngram_join, hnsw, toxicity, sentencepiece_codec, mix_sources, url_filter, exact_dedup, language_id, chat_format,
            near_dedup, whitening, phrases]

QUERIES = {name: fn for m in _MODULES for name, fn in m.QUERIES.items()}
ORACLE = {name: sql for m in _MODULES for name, sql in m.ORACLE.items()}
