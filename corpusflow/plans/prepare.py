"""End-to-end corpus preparation: unified source rows -> filters -> language
-> dedup -> train/validation split -> tokens -> chunks -> per-source caps ->
weighted interleave -> token budget -> packed training pairs -> batches.

Every step is one of the operators; the result is a set of lazy DataFrames
(only a few scalars - bucket ranges, the catalog, the stream length - reach
the driver).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.operators import mixing as M
from corpusflow.operators.chunks import chunk, first_pairs, pack_windows, pair_arrays
from corpusflow.operators.dedup import dedup_first, with_digest
from corpusflow.operators.filters import corpus_filters, keep_language
from corpusflow.operators.language import score_languages
from corpusflow.operators.ordering import ordinal, range_bucket
from corpusflow.operators.sizing import broadcast_if_small
from corpusflow.operators.subwords import MergeTable, encode_subwords
from corpusflow.operators.tokens import DEFAULT_VOCAB, encode_hashed
from corpusflow.plans.corpus import DEFAULT, Thresholds
from corpusflow.session import stored

# Up to this many digests of 64 bytes are broadcast.
MAX_BROADCAST_DIGESTS = 1_000_000


@dataclass(frozen=True)
class PrepareConfig:
    th: Thresholds = DEFAULT
    language: str | None = "de"
    dedup: bool = True
    # arrival order deciding the dedup survivor; ("doc_ord",) when doc_ord is
    # already a global order (one table whose rows carry the source)
    dedup_order: tuple = ("source_ord", "doc_ord")
    target_tokens: int | None = None
    weights: dict = field(default_factory=dict, hash=False)  # M1 override
    mode: str = "race"                                      # or "deterministic"
    seed: int = 0
    val_fraction: float = 0.05
    seq_len: int = 512
    stride: int | None = None
    batch_size: int = 16
    accumulation: int = 2
    compat_caps: bool = False
    vocab_size: int = DEFAULT_VOCAB
    id_fn: str = "md5"                                      # or "xxhash64" (cheaper)
    # subword ids by this table: lengths, budgets and windows count them
    merges: MergeTable | None = field(default=None, hash=False, repr=False)


@dataclass
class Prepared:
    train_windows: DataFrame   # window_id, x, y, batch_id, update_id
    mixed_chunks: DataFrame    # keys of chunks kept by caps and budget, mix order and offsets
    validation: DataFrame      # validation documents (split = 'val')
    report: DataFrame          # M6 per source
    consumed: DataFrame        # digests ``h`` of the documents that the mix took chunks of


def _doc_bucket(rows: DataFrame) -> Column:
    return range_bucket(rows, F.col("doc_ord"))


def clean(rows: DataFrame, cfg: PrepareConfig, profile: DataFrame | None = None) -> DataFrame:
    """Filters, language and dedup; adds the digest ``h``."""
    rows = corpus_filters(rows, cfg.th.min_chars, None)
    detect = bool(cfg.language) and profile is not None
    if cfg.language and not detect:  # a label may differ between equal texts: it goes first
        rows = keep_language(rows, cfg.language)
    rows = dedup_first(rows, list(cfg.dedup_order), enabled=cfg.dedup)
    if detect:  # detected language, F3 on it; equal texts get equal languages, so copies aren't scored
        # Scoring is the costliest step and the rows are read again later
        # (ordering pass, then ids): keep only the narrow result - keys of
        # documents detected as the wanted language - written once.
        keys = ["source_ord", "doc_ord"]
        scored = score_languages(rows.select(*keys, "text"), keys, profile)
        wanted = keep_language(scored.select(*keys, F.col("pred_lang").alias("lang")),
                               cfg.language).select(*keys).checkpoint()
        rows = rows.join(wanted, keys, "left_semi")
        if "lang" in rows.columns:
            rows = rows.withColumn("lang", F.lit(cfg.language))
    return with_digest(rows)


KEY = ["source_ord", "doc_ord", "chunk_idx"]


@dataclass
class Drawn:
    """``kept``: keys, lengths and mix order of the chunks that caps and budget let
    in; ``chunks_of(keys)``: the chunks, with their ids, of the documents of some keys."""
    kept: DataFrame
    chunks_of: Callable[[DataFrame], DataFrame]


def draw(docs: DataFrame, base: DataFrame, catalog: DataFrame, cfg: PrepareConfig, target_tokens: int | None) -> Drawn:
    """Chunks of ``docs``, mixed by weight under caps and a budget.

    Ordering work runs on narrow rows (keys and lengths): the ids are not
    computed there (column pruning drops the md5 transform).  Token arrays are built only for
    the chunks that survive caps and budget.  Subword ids, whose lengths need the
    ids, are computed once and stored; the ordering reads the lengths alone."""
    if cfg.merges is not None:
        docs = stored(encode_subwords(docs.select("source", "source_ord", "doc_ord", "text"), cfg.merges), "subwords")

    def chunk_rows(rows: DataFrame) -> DataFrame:
        toks = rows if cfg.merges is not None else encode_hashed(rows, "text", cfg.vocab_size, id_fn=cfg.id_fn).drop("text")
        return chunk(toks, cfg.th.min_length, cfg.th.max_length, cfg.th.target_length).withColumn(
            "chunk_idx", F.col("chunk_idx").cast("bigint"))

    ch = chunk_rows(docs).select("source", "doc_ord", "chunk_idx", "chunk_len")
    weights = M.normalize_weights(catalog, cfg.weights or None)
    caps = M.source_caps(weights, target_tokens, cfg.th.target_length, compat=cfg.compat_caps)
    order = [F.col("doc_ord"), F.col("chunk_idx")]
    w_rows = M.catalog_weights(weights)
    M.check_weights(dict(w_rows))
    arr = M.first_arrivals(ch, caps, order, _doc_bucket(base), "doc_ord", mode=cfg.mode, seed=cfg.seed, target_tokens=target_tokens)
    mixed = M.mix_order(arr, M.mix_bucket(w_rows), [F.col("source_ord"), F.col("doc_ord"), F.col("chunk_idx")])
    kept = M.budget_cut(mixed, target_tokens).withColumn("offset", F.col("mix_cum") - F.col("chunk_len"))

    def chunks_of(keys: DataFrame) -> DataFrame:
        wanted = keys.select("source_ord", "doc_ord").distinct()
        return chunk_rows(docs.join(wanted, ["source_ord", "doc_ord"], "left_semi")).select(*KEY, "chunk")
    # narrow; read for the stream length, the report and packing
    return Drawn(stored(kept, "kept-chunks"), chunks_of)


def prepare(rows: DataFrame, catalog: DataFrame, cfg: PrepareConfig,
            profile: DataFrame | None = None) -> Prepared:
    """``rows``: (source, source_ord, doc_ord, text[, lang]); ``catalog``:
    (source, source_ord, weight), one row per source."""
    docs = M.split_by_hash(clean(rows, cfg, profile), val_fraction=cfg.val_fraction)
    train = docs.filter(F.col("split") == "train")
    validation = docs.filter(F.col("split") == "val")
    drawn = draw(train, rows, catalog, cfg, cfg.target_tokens)
    kept = drawn.kept
    total = int(kept.agg(F.coalesce(F.sum("chunk_len"), F.lit(0))).first()[0])
    stream = kept.select(*KEY, "offset").join(drawn.chunks_of(kept), KEY, "inner")
    windows = pack_windows(stream, total, cfg.seq_len, cfg.stride)
    windows = (windows.withColumn("batch_id", F.floor(F.col("window_id") / cfg.batch_size).cast("bigint"))
               .withColumn("update_id", F.floor(F.col("batch_id") / cfg.accumulation).cast("bigint")))
    report = kept.groupBy("source").agg(F.count(F.lit(1)).alias("n_chunks"),
                                        F.sum("chunk_len").cast("bigint").alias("n_tokens"))
    used = kept.select("source_ord", "doc_ord").distinct()
    consumed = train.join(used, ["source_ord", "doc_ord"], "left_semi").select("h").distinct()
    return Prepared(windows, kept, validation, report, consumed)


def validation_pass(rows: DataFrame, catalog: DataFrame, cfg: PrepareConfig, consumed: DataFrame, samples: int = 10_000,
                    max_pairs: int | None = 100, profile: DataFrame | None = None) -> DataFrame:
    """M7 as it is run: a second pass over the same sources that remembers the first.

    Texts whose digest ``h`` is in ``consumed`` are out, so the two passes share no
    document; what is left is mixed under a budget of ``samples`` sequences of its own,
    and the first ``max_pairs`` pairs in mix order are kept.  They are chosen on
    narrow rows (keys and lengths); ids are built for those alone."""
    base = rows
    digests = stored(consumed.select("h").distinct(), "consumed")
    docs = clean(rows, cfg, profile).join(broadcast_if_small(digests, MAX_BROADCAST_DIGESTS), "h", "left_anti")
    drawn = draw(docs, base, catalog, cfg, samples * cfg.seq_len)
    picked = first_pairs(drawn.kept.select(*KEY, "mix_ord", "chunk_len"), ["mix_ord"], cfg.seq_len, max_pairs)
    picked = stored(picked, "picked-pairs")
    built = picked.join(drawn.chunks_of(picked), KEY)
    ordered = ordinal(built, [], [F.col("mix_ord"), F.col("pair_idx")], M.mix_bucket_of(F.col("mix_ord")), "sample_ord", materialize=False)
    return pair_arrays(ordered, cfg.seq_len).drop("chunk")
