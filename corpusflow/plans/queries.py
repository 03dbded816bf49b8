"""Imports every query module so that the registry is complete."""

from __future__ import annotations

from corpusflow.plans import (corpus_queries, io_queries, lang_queries,  # noqa: F401
                              mix_queries, runlog_queries)
from corpusflow.plans.registry import QUERIES

__all__ = ["QUERIES"]
