"""Queries of this subpackage: name -> (function, DuckDB SQL or None)."""

from __future__ import annotations

import corpus_pipeline

from . import queries_corpus, queries_dedup, queries_output, queries_text

REGISTRY = {**queries_text.QUERIES, **queries_dedup.QUERIES, **queries_corpus.QUERIES, **queries_output.QUERIES,
            "pipeline": (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL)}
