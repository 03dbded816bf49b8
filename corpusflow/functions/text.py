"""Text expressions: strip/length (X5), digest (X6), whitespace pieces.

All are built-in Spark expressions so they stay inside whole-stage codegen, but for whitespace
pieces: ``str.split`` of an Arrow batch takes a tenth of the time of a regex with all these characters.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.isspace() accepts in the BMP,
# written as one regex class that Java regex and RE2 both read the same way.
WHITESPACE_CLASS = (
    r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
STRIP_PATTERN = f"^{WHITESPACE_CLASS}+|{WHITESPACE_CLASS}+$"
PIECE_PATTERN = "[^" + WHITESPACE_CLASS[1:-1] + "]+"

# Published byte-level pre-split pattern of GPT-2 style tokenizers (needs
# look-ahead, so Java regex only; there is no RE2 oracle for it).
# (?U): Unicode classes for \s, as in the published Python definition.
BYTE_LEVEL_PATTERN = (
    r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


def strip_ws(text: Column) -> Column:
    """Python ``str.strip()`` semantics (Unicode whitespace), not ``trim``."""
    return F.regexp_replace(text, STRIP_PATTERN, "")


def stripped_length(text: Column) -> Column:
    """Code-point length of the stripped text.

    Fast path: when neither the first nor the last character is whitespace
    the text is already stripped, so only texts with whitespace at an end pay
    for the regex over the whole text."""
    one_ws = "^" + WHITESPACE_CLASS + "$"
    clean_ends = (~F.substring(text, 1, 1).rlike(one_ws)) & (~F.substring(text, -1, 1).rlike(one_ws))
    return F.when(clean_ends, F.length(text)).otherwise(F.length(strip_ws(text)))


def nonempty(text: Column) -> Column:
    return text.isNotNull() & (text != F.lit(""))


def text_digest(text: Column) -> Column:
    """Digest of the raw text (no normalisation): the exact-dedup key."""
    return F.sha2(text, 256)


BLOCK_PIECES = 1 << 16


def split_texts(texts: pa.Array) -> Iterator[list[str]]:
    """Whitespace pieces of each text (null: none): ``str.split`` cuts at the characters of ``WHITESPACE_CLASS``."""
    return ((t.as_py() or "").split() for t in texts)


def _pieces(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        ends, blocks, flat, n = [0], [], [], 0
        for own in split_texts(texts):
            flat.extend(own)
            n += len(own)
            ends.append(n)
            if len(flat) >= BLOCK_PIECES:
                blocks.append(pa.array(flat, pa.string()))
                flat = []
        blocks.append(pa.array(flat, pa.string()))
        yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.concat_arrays(blocks))


def _n_pieces(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        yield pa.array([len(own) for own in split_texts(texts)], pa.int64())


def pieces(text: Column, pattern: str = PIECE_PATTERN) -> Column:
    """Order-preserving pieces of a text as ARRAY<STRING>, by default the
    maximal non-whitespace runs, i.e. Python ``str.split()``."""
    if pattern == PIECE_PATTERN:
        return F.arrow_udf(_pieces, "array<string>")(text)
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), 0)


def n_pieces(text: Column, pattern: str = PIECE_PATTERN) -> Column:
    """How many pieces a text has, as BIGINT; no piece leaves the count."""
    if pattern == PIECE_PATTERN:
        return F.arrow_udf(_n_pieces, "bigint")(text)
    return F.size(pieces(text, pattern)).cast("bigint")


def nonspace_chars(text: Column) -> Column:
    """Characters outside whitespace runs (= total length of all pieces)."""
    return F.length(F.regexp_replace(F.coalesce(text, F.lit("")), WHITESPACE_CLASS, ""))
