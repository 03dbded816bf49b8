"""Fill-in-the-middle transformation by a counted-quantifier pattern.

A text is n tokens (``[A-Za-z]+|[^A-Za-z]``, so every character belongs to
one).  ``regexp_count`` gives n, a hash of the row's key two cuts a <= b, and
the row's own pattern ``unit{a}`` ``unit{b-a}`` rest takes prefix, middle and
suffix in one match; the replacement writes them in the order of the form.
The units repeat possessively: the matcher loops over them without a stack or
a way back, so a text of millions of tokens takes one pass.  All expressions
are built in; rows never leave their partition.

Defined results: a null text is an empty one; an empty text and one that holds
a marker stay plain, and so does the share ``plain_share`` of the others; a
null key hashes like an empty one; repeated rows give repeated results, as
the result depends on key and text alone; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import read_table
from corpusflow.llm.registry import query

TOKEN = "[A-Za-z]+|[^A-Za-z]"
UNIT = "(?:[A-Za-z]++|[^A-Za-z])"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_SHARE, SPM_SHARE = 10, 20  # per cent


def _hashes(key: Column, seed: str) -> list[Column]:
    """Four unsigned 32-bit integers of a key."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(docs: DataFrame, *, key: str, text: str, seed: str = "1", plain_share: int = PLAIN_SHARE, spm_share: int = SPM_SHARE,
                   markers: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> DataFrame:
    """Per row: key, n (tokens), form (plain, psm or spm), prefix_chars, middle_chars
    (null if plain), output (the transformed text)."""
    p, s, m = markers
    if len(set(markers)) < 3 or not all(re.fullmatch(r"<[A-Za-z_|]+>", x) for x in markers):
        raise ValueError("markers are three different names in angle brackets, so that none can start inside another or at a text's end")
    t = F.col("text")
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = rows.select("key", "text", F.regexp_count(t, F.lit(TOKEN)).cast("long").alias("n"), F.array(*_hashes(F.col("key"), seed)).alias("h"))
    n, h = F.col("n"), F.col("h")
    plain = (t == "") | t.contains(p) | t.contains(s) | t.contains(m) | (h[2] % 100 >= 100 - plain_share)
    rows = rows.select("key", "text", "n", F.least(h[0] % (n + 1), h[1] % (n + 1)).alias("a"), F.greatest(h[0] % (n + 1), h[1] % (n + 1)).alias("b"),
                       F.when(plain, "plain").when(h[3] % 100 < spm_share, "spm").otherwise("psm").alias("form"))
    a, b, form = F.col("a"), F.col("b"), F.col("form")
    pattern = F.concat(F.lit(rf"(?s)\A({UNIT}{{"), a.cast("string"), F.lit(rf"}}+)({UNIT}{{"), (b - a).cast("string"), F.lit(r"}+)(.*)\z"))
    order = F.when(form == "psm", F.lit(f"{p}$1{s}$3{m}$2")).otherwise(F.lit(f"{s}$3{p}$1{m}$2"))
    rows = rows.select("key", "n", "form", F.when(form == "plain", t).otherwise(F.regexp_replace(t, pattern, order)).alias("output"))
    part = _parts(markers)
    return rows.select(F.col("key").alias(key), "n", "form", F.length(part["prefix"]).cast("long").alias("prefix_chars"),
                       F.length(part["middle"]).cast("long").alias("middle_chars"), "output")


def _parts(markers: tuple[str, str, str]) -> dict[str, Column]:
    """Prefix, middle and suffix of a transformed ``output``; null if plain.  The
    texts hold no marker, so the output is cut exactly where one was put."""
    cut = F.split("output", "|".join(re.escape(x) for x in markers), -1)
    form = F.col("form")
    return {"prefix": F.when(form == "psm", F.get(cut, 1)).when(form == "spm", F.get(cut, 2)),
            "suffix": F.when(form == "psm", F.get(cut, 2)).when(form == "spm", F.get(cut, 1)),
            "middle": F.when(form != "plain", F.get(cut, 3))}


def restored(markers: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> Column:
    """The text before the transformation, from the columns output and form."""
    part = _parts(markers)
    return F.when(F.col("form") == "plain", F.col("output")).otherwise(F.concat(part["prefix"], part["middle"], part["suffix"]))


_SQL = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
                  sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS d FROM documents),
h AS (SELECT *, len(u)::BIGINT AS n, ('0x' || d[1:8])::BIGINT AS h1, ('0x' || d[9:16])::BIGINT AS h2,
             ('0x' || d[17:24])::BIGINT AS h3, ('0x' || d[25:32])::BIGINT AS h4 FROM t),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
             CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                  WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, array_to_string(u[1:a], '') AS pre, array_to_string(u[a + 1:b], '') AS mid, array_to_string(u[b + 1:n], '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(text) AS restored_sha256 FROM p"""


@query("op13_fill_in_middle", _SQL)
def op13_fill_in_middle(spark, sf_dir):
    out = fill_in_middle(read_table(spark, sf_dir, "documents"), key="doc_id", text="text")
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(), 256).alias("restored_sha256"))
