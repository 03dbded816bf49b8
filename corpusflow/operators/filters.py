"""Row predicates: non-empty (F1), minimum characters (F2), language equality
(F3), token-length guards (F6, F7 live in chunks), cadence (F9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.functions.text import nonempty, stripped_length


def keep_nonempty(df: DataFrame, text_col: str = "text") -> DataFrame:
    """drop null or empty text (pushed into the parquet scan)."""
    return df.filter(nonempty(F.col(text_col)))


def keep_min_chars(df: DataFrame, min_chars: int = 50, text_col: str = "text") -> DataFrame:
    """Unicode-stripped length in code points >= min_chars.

    The cheap raw length test runs first: stripping never lengthens a text,
    so texts already shorter are dropped without the regex."""
    t = F.col(text_col)
    return df.filter((F.length(t) >= min_chars) & (stripped_length(t) >= min_chars))


def keep_language(df: DataFrame, code: str | None, lang_col: str = "lang") -> DataFrame:
    """keep rows whose (detected or supplied) language equals ``code``;
    unknown (null) drops; a falsy code disables the filter."""
    if not code:
        return df
    return df.filter(F.col(lang_col) == F.lit(code))


def corpus_filters(df: DataFrame, min_chars: int = 50, language: str | None = None,
                   text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """F1 -> F2 -> F3 in the reference's cheap-first order."""
    df = keep_min_chars(keep_nonempty(df, text_col), min_chars, text_col)
    return keep_language(df, language, lang_col)


def on_cadence(step: Column, every: int, include_zero: bool = False) -> Column:
    """step % every == 0 (logging includes 0; eval/save need step > 0)."""
    hit = F.pmod(step, F.lit(every)) == 0
    return hit if include_zero else (step > 0) & hit
