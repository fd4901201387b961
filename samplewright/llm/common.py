"""Small helpers shared by the training-data operators.

Word arrays travel as Arrow buffers and are processed with numpy inside a task,
a bounded slice of documents at a time; nothing here touches the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from samplewright.session import shared_path

SLICE_BYTES = 4 << 20
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts lineage, survives executor loss."""
    spark = df.sparkSession
    path = shared_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit changes every output bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def distinct_sorted(x: np.ndarray) -> np.ndarray:
    """Distinct values in order; sorting beats hashing for the arrays met here."""
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most ``most`` bytes of text, one row at least."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start, n = 0, len(sizes)
    while start < n:
        floor = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, floor + most, side="right")))
        yield start, stop
        start = stop


def offsets_of(lists: pa.Array) -> np.ndarray:
    """Offsets of a list array into its ``flatten()``; a null list is empty."""
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])


def word_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Offsets per text, a dictionary code per word, and the distinct words.

    Words are the runs between ASCII white space of the text with A-Z lower-cased;
    a null text has none.
    """
    words = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat, offsets = words.flatten(), offsets_of(words)
    coded = flat.dictionary_encode()
    codes, distinct = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
    blank = np.flatnonzero(pc.equal(distinct, "").to_numpy(zero_copy_only=False))
    if len(blank):  # leading and trailing white space
        kept = codes != blank[0]
        offsets = np.concatenate([[0], np.cumsum(kept)])[offsets]
        codes = codes[kept]
    return offsets, codes, distinct


def hash_words(distinct: pa.Array) -> np.ndarray:
    """A fixed 64-bit hash of each string."""
    if not len(distinct):
        return np.zeros(0, np.uint64)
    return mix(pd.util.hash_array(distinct.to_numpy(zero_copy_only=False), categorize=False))


def gram_hashes(offsets: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each window of ``n`` words that lies in one document, and its first word's index."""
    total = len(hashes)
    if total < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    room = total - n + 1
    out = np.zeros(room, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(n):
            out = out * MULTIPLIER + hashes[j:j + room]
        out = mix(out)
    inside = np.ones(room, bool)
    for end in range(1, n):  # windows that start fewer than n words before a document's end
        cut = offsets[1:] - end
        inside[cut[(cut >= 0) & (cut < room) & (cut >= offsets[:-1])]] = False
    return out[inside], np.flatnonzero(inside)


def list_array(offsets: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
