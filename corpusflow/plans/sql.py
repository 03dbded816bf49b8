"""Shared fragments for the DuckDB oracle SQL of the registered queries.

The oracle is an independent formulation of the same semantics in plain SQL
(window functions, ``unnest``, ``generate_series``) used only for checking.
"""

from __future__ import annotations

from corpusflow.functions.text import PIECE_PATTERN, STRIP_PATTERN
from corpusflow.operators.tokens import DEFAULT_VOCAB


def token_ids_sql(text: str = "text", vocab: int = DEFAULT_VOCAB) -> str:
    return (f"list_transform(regexp_extract_all({text}, '{PIECE_PATTERN}'), "
            f"lambda p: ((('0x' || substr(md5(p), 1, 8))::BIGINT) % {vocab})::INTEGER)")


def filtered_docs_sql(language: str | None = "de", min_chars: int = 50) -> str:
    lang = f"AND lang = '{language}'" if language else ""
    return (f"SELECT doc_id, source, text, lang FROM documents "
            f"WHERE text IS NOT NULL AND text <> '' AND length(text) >= {min_chars} "
            f"AND length(regexp_replace(text, '{STRIP_PATTERN}', '', 'g')) >= {min_chars} {lang}")


def clean_docs_sql(language: str | None = "de", dedup: bool = True, min_chars: int = 50) -> str:
    f = filtered_docs_sql(language, min_chars)
    if not dedup:
        return f
    return (f"SELECT * FROM ({f}) fd WHERE doc_id IN "
            f"(SELECT min(doc_id) FROM ({f}) fw GROUP BY sha256(text))")


def tokens_sql(language: str | None = "de", dedup: bool = True) -> str:
    return (f"SELECT doc_id, source, lang, {token_ids_sql()} AS tokens "
            f"FROM ({clean_docs_sql(language, dedup)}) cd")


def chunks_sql(language: str | None = "de", dedup: bool = True, min_len: int = 256,
               max_len: int = 1024, target: int = 512, extra: int = 0) -> str:
    half, width = target // 2, target + extra
    return f"""
SELECT doc_id, source, lang, tokens, n,
       (row_number() OVER (PARTITION BY doc_id ORDER BY chunk_start) - 1)::BIGINT AS chunk_idx,
       chunk_start, chunk_len,
       tokens[chunk_start + 1 : chunk_start + chunk_len] AS chunk
FROM (
  SELECT doc_id, source, lang, tokens, n, 0 AS chunk_start, n AS chunk_len
  FROM (SELECT *, len(tokens)::BIGINT AS n FROM ({tokens_sql(language, dedup)}) t0) t1
  WHERE n >= {min_len} AND n <= {max_len}
  UNION ALL
  SELECT doc_id, source, lang, tokens, n, k * {half} AS chunk_start,
         least({width}, n - k * {half}) AS chunk_len
  FROM (SELECT *, unnest(generate_series(0, greatest(0, ceil((n - {width}) / {half}))::BIGINT)) AS k
        FROM (SELECT *, len(tokens)::BIGINT AS n FROM ({tokens_sql(language, dedup)}) t2) t3
        WHERE n > {max_len}) t4
  WHERE least({width}, n - k * {half}) >= {min_len}
) s"""
