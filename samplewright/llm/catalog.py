"""Registry of the training-data queries: each applies one operator to its whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from samplewright.llm import ball_search, bpe, decontam, html_text, minhash, oracle, pii, repeats, secret_scan, shards, spelling, token_files, topk, toxicity
from samplewright.llm.common import table
from samplewright.session import shared_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

RANK_FILE = "byte_bpe_multi_50k.tiktoken"
TOKENIZER_FILE = "byte_bpe_50k.json"
END_ID = 2


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@register("op1_minhash", oracle.NEAR_DUPLICATES)
def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents at similarity 0.85 of 5-word shingles."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


@register("op2_byte_bpe")
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every document, decode the ids, digest both."""
    ranks = bpe.Ranks.load(public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.decode(bpe.encode(docs, ranks).select("doc_id", "token_ids"), ranks)
    return coded.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(bpe.ids_csv(F.col("token_ids")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@register("op4_toxicity_chain")
def op4_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category probabilities of all documents by a chain fitted on the labels."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.classify(docs, table(spark, sf_dir, "labels")).select(
        "doc_id", F.round("p_low_quality", 6).alias("p_low_quality"), F.round("p_toxic", 6).alias("p_toxic"), "rejected")


@register("op3_pii")
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    rows = pii.with_pii(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "pii")

    def count(kind: str):
        return F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("pii", lambda s: s["rank"] < len(pii.BASE))
    return rows.select("doc_id", *[count(kind) for kind in pii.BASE],
                       F.sha2(pii.spans_text(base).cast("binary"), 256).alias("base_sha256"),
                       pii.spans_text(F.col("pii")).alias("spans"))


@register("op5_string_tiling")
def op5_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that cover half or more of a benchmark item's words."""
    return decontam.leaked_pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op9_lookup_shards")
def op9_lookup_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A shard of 64 for every document."""
    names = [f"shard-{i:03d}" for i in range(64)]
    return shards.assign(table(spark, sf_dir, "documents").select("doc_id", "source"), names)


@register("op10_secret_field")
def op10_secret_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    rows = secret_scan.with_secrets(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "secrets")

    def count(kind: str):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("secrets", lambda s: s["kind"] != "crf")
    return rows.select("doc_id", *[count(kind) for kind in ("assign", "access", "hex")],
                       F.sha2(secret_scan.spans_text(base).cast("binary"), 256).alias("base_sha256"),
                       secret_scan.spans_text(F.col("secrets")).alias("spans"))


@register("op6_repeats", oracle.REPEATS)
def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 400-byte strings that also start elsewhere."""
    rows = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    kept = (F.when(F.col("n_removed") == 0, F.col("whole_sha256"))
            .otherwise(F.sha2(F.coalesce("kept", F.lit("").cast("binary")), 256)))
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", kept.alias("kept_sha256"), "n_passage")


@register("op7_html_cut")
def op7_html_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_text.with_main_text(table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@register("op8_top_k", oracle.TOP_K)
def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 highest integer inner products of every fiftieth vector against all."""
    return topk.top_k(table(spark, sf_dir, "embeddings"))


@register("op13_token_files")
def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document written to entropy-coded files and read back from them."""
    path = shared_path(spark, f"token-files-{uuid.uuid4().hex}")
    with open(public_tokenizers.path(TOKENIZER_FILE), encoding="utf-8") as spec:
        token_files.write_ids(table(spark, sf_dir, "documents"), path, spec.read(), END_ID)
    return token_files.read_ids(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@register("op11_spelling_variants", oracle.SPELLING)
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent word, the frequent word it is one edit from, and the last of that chain."""
    return spelling.variants(table(spark, sf_dir, "documents"))


@register("op12_ball_search", oracle.RANKED_SEARCH)
def op12_ball_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest-scoring documents for each benchmark item."""
    return ball_search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
