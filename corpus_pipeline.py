"""A training corpus from raw documents, in five stages.

Each stage reads what its predecessor kept, all of it: documents that the toxicity chain
rejects go; one document of each near-duplicate group stays; documents that leak a
benchmark item go; personal data is replaced by its kind; texts become token ids, with
the bytes they decode to as proof.  ``run`` writes every stage's result to the shared
folder and hands the reread table on.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from samplewright.llm import bpe, decontam, minhash, pii, toxicity
from samplewright.llm.common import table, written

DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")
RANK_FILE = "byte_bpe_multi_50k.tiktoken"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*DOCUMENT)
    scored = toxicity.classify(docs, table(spark, sf_dir, "labels"))
    return scored.filter(~F.col("rejected")).select(*DOCUMENT)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*DOCUMENT)
    return minhash.deduplicated(docs, percent=80).select(*DOCUMENT)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*DOCUMENT)
    checked = decontam.with_leaks(docs, table(spark, sf_dir, "benchmark"))
    return checked.filter(F.size("leaks") == 0).select(*DOCUMENT)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans become their kind in brackets; ``n_chars`` follows the new text."""
    docs = docs.select(*DOCUMENT)
    clean = pii.redact(F.col("text"), F.col("pii"))
    found = pii.with_pii(docs).withColumn("text", clean)
    return found.withColumn("n_chars", F.when(F.size("pii") > 0, F.char_length("text").cast("long"))
                            .otherwise(F.col("n_chars"))).select(*DOCUMENT)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, and whether they decode to it."""
    ranks = bpe.Ranks.load(public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN)
    coded = bpe.decode(bpe.encode(docs, ranks), ranks)
    same = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return coded.select("doc_id", "lang", "source", "token_ids", F.size("token_ids").cast("long").alias("n_tokens"),
                        same.alias("round_trip"))


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("decontamination", drop_leaks),
          ("personal_data", redact_pii), ("byte_bpe", tokenize)]

#: No SQL has the trained classifier, the tiling or the merges; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*DOCUMENT)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, f"pipeline-{name}")
    return docs
