"""Imports every operator, so that the registry is complete."""

from corpusflow.llm import codes, decontam, embeddings, fim, langid, line_dedup, near_dups, pieces, quality, secrets, toxicity, urls, warc  # noqa: F401
from corpusflow.llm.registry import LLM_QUERIES, LLM_SQL

__all__ = ["LLM_QUERIES", "LLM_SQL"]
