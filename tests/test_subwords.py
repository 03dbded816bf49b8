"""Subword ids against a plain merge loop and the published tokenizer."""

import base64
import os
import random

import pytest

from corpusflow.operators.subwords import MergeTable, encode_subwords, read_merge_table

FILES = "/opt/tokenizers"
SCHEMA = "doc_id long, text string, lang string"


def loop(piece: bytes, table: MergeTable) -> list[int]:
    """Join the leftmost pair of lowest rank, again and again."""
    ids = [table.single[b] for b in piece]
    while True:
        ranked = [(table.pairs[p], i) for i, p in enumerate(zip(ids, ids[1:])) if p in table.pairs]
        if not ranked:
            return ids
        (_, merged), at = min(ranked)
        ids[at:at + 2] = [merged]


def small_table() -> MergeTable:
    ids = {bytes([b]): b for b in range(256)}
    merges = [(b"a", b"b"), (b"ab", b"a"), (b"a", b"a"), (b"aa", b"aa"), (b" ", b"ab"), (b"b", b"aa"), (b"x", b"x"), (b"xx", b"xx")]
    for a, b in merges:
        ids.setdefault(a + b, len(ids))
    return MergeTable.from_merges(merges, ids)


def test_heap_equals_loop():
    table, rng = small_table(), random.Random(3)
    for _ in range(3000):
        piece = bytes(rng.choice(b"aaabbx ") for _ in range(rng.randint(0, 24)))
        assert table.ids(piece) == loop(piece, table), piece
    assert len(table.ids(b"x" * 400_001)) == 100_001  # long runs in one pass


def test_table_must_hold_all_bytes():
    with pytest.raises(ValueError):
        MergeTable.from_ranks({b"a": 0, b"b": 1})


TEXTS = ["Hello world", None, "", " ", "a  b\n\n c", "don't we'll it's", "Straße über naïve 日本語 \U0001f916\U0001f916", "x" * 3000, "12345 678", "\t\ttab", "word " * 30_000,
         "Hello world", "trailing   "]


@pytest.fixture(scope="module")
def table(spark):
    return read_merge_table(spark, f"{FILES}/byte_bpe_50k.tiktoken")


@pytest.mark.skipif(not os.path.exists(FILES), reason="no tokenizer files")
def test_both_files_give_one_table(spark, table):
    other = read_merge_table(spark, f"{FILES}/byte_bpe_50k.json")
    for text in ("Hello world", "unbelievably", " ", "\U0001f916", "aaaaaaaaaaaa"):
        assert table.ids(text.encode()) == other.ids(text.encode())


@pytest.mark.skipif(not os.path.exists(FILES), reason="no tokenizer files")
def test_texts_against_published_tokenizer(spark, table):
    import tiktoken
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(f"{FILES}/byte_bpe_50k.tiktoken", "rb"))}
    pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    model = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    rows = [(i, t, "en") for i, t in enumerate(TEXTS)] + [(None, "null key", None), (0, "Hello world", "de")]
    rows += [(1000 + i, f"text {i} the of and", "en") for i in range(700)]  # several batches, common pieces
    got = encode_subwords(spark.createDataFrame(rows, SCHEMA).repartition(3), table).collect()
    want = sorted((str(k), lang or "", model.encode_ordinary(t or "")) for k, t, lang in rows)
    assert sorted((str(r.doc_id), r.lang or "", r.tokens) for r in got) == want
    assert all(r.n_tokens == len(r.tokens) for r in got)


@pytest.mark.skipif(not os.path.exists(FILES), reason="no tokenizer files")
def test_all_documents_against_published_tokenizer(spark, table):
    import tiktoken
    from tests.conftest import SF_SMALL
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(f"{FILES}/byte_bpe_50k.tiktoken", "rb"))}
    pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    model = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    want = {r.doc_id: model.encode_ordinary(r.text or "") for r in docs.collect()}
    assert {r.doc_id: r.tokens for r in encode_subwords(docs, table).collect()} == want


@pytest.mark.skipif(not os.path.exists(FILES), reason="no tokenizer files")
def test_empty_frame_and_taken_names(spark, table):
    empty = spark.createDataFrame([], SCHEMA)
    assert encode_subwords(empty, table).count() == 0
    with pytest.raises(ValueError):
        encode_subwords(spark.createDataFrame([(1, "a", 2)], "doc_id long, text string, _row int"), table)


def test_batches_hold_each_piece_once(spark, monkeypatch):
    """Batches are cut by their pieces, longer rows stand alone, and the strings are written once per batch."""
    from corpusflow.operators import subwords

    found = {}
    stored = subwords.stored
    monkeypatch.setattr(subwords, "stored", lambda df, name, **options: found.setdefault(name, stored(df, name, **options)))
    monkeypatch.setattr(subwords, "BATCH_PIECES", 6)
    table = small_table()
    rows = [(i, t, [i], {"a": i}) for i, t in enumerate(["ab ab ab", None, "", "aba xx abab ab ab ab ab ab", "x", "ab"] * 3)] + [(None, "ab x", None, None), (2, "ab x", [], {})]
    docs = spark.createDataFrame(rows, "doc_id long, text string, more array<int>, `odd name` map<string, int>").coalesce(1)
    got = encode_subwords(docs, table).collect()

    def ids(text):
        return [i for n, word in enumerate((text or "").split(" ")) if word for i in loop((b" " if n else b"") + word.encode(), table)]
    want = sorted((str(k), m, d, ids(t)) for k, t, m, d in rows if k is not None)
    assert sorted((str(r.doc_id), r.more, r["odd name"], r.tokens) for r in got if r.doc_id is not None) == want
    assert [(r.tokens, r.n_tokens) for r in got if r.doc_id is None] == [(ids("ab x"), len(ids("ab x")))]
    assert set(found) == {"pieces", "piece-ids"}
    batches = found["pieces"].collect()
    assert all(len(set(b["_dictionary"])) == len(b["_dictionary"]) for b in batches)
    assert all(len(b["_rows"]) == 1 or sum(len(r["_codes"]) for r in b["_rows"]) <= 6 for b in batches)
    assert max(len(b["_rows"]) for b in batches) > 1
