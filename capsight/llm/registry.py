"""The registered queries of the operators, the pipeline, and their DuckDB oracles."""

from __future__ import annotations

import corpus_pipeline
from capsight.llm import (ann, bpe, embedding_dedup, exact_dedup, html_text, kd_shards, mixing, ngram_join, quality, secrets, url_filter, vector_codes,
                          whitening)

MODULES = (ann, embedding_dedup, url_filter, quality, ngram_join, bpe, html_text, mixing, secrets, kd_shards, vector_codes, whitening, exact_dedup)

QUERIES: dict = {"pipeline": corpus_pipeline.run}
ORACLES: dict = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
for module in MODULES:
    QUERIES |= module.QUERY
    ORACLES |= getattr(module, "ORACLE", {})
