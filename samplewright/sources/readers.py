"""Sources and sinks for corpora and samples.

* S1 / S2: JSON Lines corpora with an explicit schema (no inference pass over
  the data); malformed lines land in ``_corrupt_record`` instead of failing.
* S3 / S4: ``count`` and a dense, stable position per row in file order.  The
  position needs no sort: rows are numbered inside each input split by
  ``monotonically_increasing_id`` and shifted by a per-split offset.
* S5: encoded samples written as parquet, partitioned by rank and sorted by
  batch, so a trainer's rank reads only its own files in batch order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CORRUPT = "_corrupt_record"
TEXT_SCHEMA = "text string"
MESSAGE_TYPE = "struct<role: string, content: string, tools: string, functions: string, tool_calls: string>"
CONVERSATION_SCHEMA = f"conversations array<{MESSAGE_TYPE}>"


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON Lines with an explicit schema; bad lines keep their raw text in ``_corrupt_record``.

    A JSON number or boolean in a string field is kept as its text (the
    reference coerces with ``str``); JSON ``null`` stays NULL.
    """
    return (spark.read.schema(f"{schema}, {CORRUPT} string")
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
            .json(path))


def read_text_corpus(spark: SparkSession, path: str) -> DataFrame:
    """``{"text": ...}`` lines -> ``doc_id, text, _corrupt_record`` (doc_id = file position)."""
    return positional_ids(read_jsonl(spark, path, TEXT_SCHEMA), "doc_id")


def read_conversations(spark: SparkSession, path: str) -> DataFrame:
    """``{"conversations": [{role, content, ...}]}`` lines -> ``conv_id, conversations, ...``."""
    return positional_ids(read_jsonl(spark, path, CONVERSATION_SCHEMA), "conv_id")


def positional_ids(df: DataFrame, id_col: str = "sample_id") -> DataFrame:
    """S4 support: a dense 0-based position per row following file order.

    Splits are ordered by ``(file path, start offset)``; rows inside a split keep
    their read order.  Per split only a count and the first row's id are aggregated.
    Offsets have two levels, splits inside their file and then files, and return to
    the rows by a join whose strategy Spark picks by measured size.
    """
    base = df.select("*", F.col("_metadata.file_path").alias("_f"),
                     F.col("_metadata.file_block_start").alias("_b"),
                     F.monotonically_increasing_id().alias("_m"))
    splits = base.groupBy("_f", "_b").agg(F.count(F.lit(1)).alias("_n"), F.min("_m").alias("_m0"))
    inside = Window.partitionBy("_f").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    files = splits.groupBy("_f").agg(F.sum("_n").alias("_fn"))
    over_files = Window.orderBy("_f").rowsBetween(Window.unboundedPreceding, -1)  # one narrow row per file
    starts = files.select("_f", F.coalesce(F.sum("_fn").over(over_files), F.lit(0)).alias("_foff"))
    offsets = splits.withColumn("_in", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(starts, "_f").select(
        "_f", "_b", "_m0", (F.col("_foff") + F.col("_in")).alias("_off"))
    out = base.join(offsets, ["_f", "_b"])
    return out.select((F.col("_off") + F.col("_m") - F.col("_m0")).cast("bigint").alias(id_col),
                      *[c for c in df.columns])


def lookup(df: DataFrame, position: int, id_col: str = "sample_id") -> DataFrame:
    """The sample at a position; with files written sorted by id, parquet min/max
    statistics let the scan skip every other row group."""
    return df.filter(F.col(id_col) == F.lit(int(position)))


def write_samples(samples: DataFrame, path: str, partition_col: str | None = "rank",
                  sort_cols: tuple[str, ...] = ("batch_id", "pos_in_batch"), mode: str = "overwrite",
                  batches_per_file: int = 1024) -> None:
    """Write encoded samples as parquet, one directory per rank, files of consecutive batches.

    A rank's batches are dealt in ranges of ``batches_per_file``, so each rank is written by
    many tasks; every range is one task's and sorted by batch in it, without a global sort.
    """
    cols = [c for c in sort_cols if c in samples.columns]
    if partition_col and partition_col in samples.columns:
        keys = [F.col(partition_col)]
        if cols:
            keys.append(F.floor(F.col(cols[0]) / F.lit(batches_per_file)))
        out = samples.repartition(*keys).sortWithinPartitions(partition_col, *cols)
        out.write.mode(mode).partitionBy(partition_col).parquet(path)
    else:
        samples.sortWithinPartitions(*cols).write.mode(mode).parquet(path)
