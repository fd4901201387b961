"""Benchmark decontamination by greedy string tiling (operator 5).

Texts become words with A-Z lower-cased and surrounding punctuation stripped.  A
document and a benchmark item are joined on seeds, their shared hashes of
``least`` consecutive words.  Seeds that follow each other on one diagonal are
maximal matches; the longest match of still unmarked words is marked again and
again, what a mark cuts off a match goes back as a shorter one, and tiling stops when
no match of ``least`` words is left.  An item leaks when its tiles cover at least
``coverage`` of its words, in whatever order they stand in the document.

The benchmark goes to the tasks in blocks of a checked number of words
(``BLOCK_WORDS``), each against all documents, one after the other: a block's leaks are
written before the next block is read, so driver and tasks hold one at a time and no
broadcast grows with the benchmark.

Defined results: null, empty and blank texts, and items of fewer than ``least`` words,
match nothing; items whose id is null or no whole number are left out; equal items are reported each; between equally long matches the one that
starts first in the document, then in the item, is marked.
"""

from __future__ import annotations

import heapq
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samplewright.llm.common import gram_hashes, hash_words, slices, word_codes, written

LEAST = 5
COVERAGE = 0.5
#: Words of the benchmark that one pass holds.
BLOCK_WORDS = 1_000_000
SIEVE = 1 << 22
PUNCTUATION = ".,;:!?\"'()[]{}<>|*%&$#@=/\\-_`~^+"
LEAK = "struct<item_id:bigint,n_words:int,covered:int,n_tiles:int>"


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets per text and a hash per word; words of punctuation alone are left out."""
    offsets, codes, distinct = word_codes(texts)
    bare = pc.utf8_trim(distinct, PUNCTUATION)
    hashes = hash_words(bare)[codes]
    kept = (pc.binary_length(bare).to_numpy(zero_copy_only=False) > 0)[codes]
    return np.concatenate([[0], np.cumsum(kept)])[offsets], hashes[kept]


def tile(doc_at: np.ndarray, item_at: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (document place, item place, length) from seed hits, parallel places."""
    order = np.lexsort((doc_at, item_at - doc_at))
    d, i = doc_at[order], item_at[order]
    new = np.ones(len(d), bool)
    new[1:] = (np.diff(d) != 1) | (np.diff(i) != 1)
    start = np.flatnonzero(new)
    length = np.diff(start, append=len(d)) + least - 1
    heap = [(-n, a, b) for n, a, b in zip(length.tolist(), d[start].tolist(), i[start].tolist())]
    heapq.heapify(heap)
    in_doc, in_item, tiles = set(), set(), []
    while heap:
        n, a, b = heapq.heappop(heap)
        free = [a + k not in in_doc and b + k not in in_item for k in range(-n)]
        if all(free):
            tiles.append((a, b, -n))
            in_doc.update(range(a, a - n))
            in_item.update(range(b, b - n))
            continue
        run = 0
        for k, ok in enumerate([*free, False]):
            if ok:
                run += 1
            else:
                if run >= least:
                    heapq.heappush(heap, (-run, a + k - run, b + k - run))
                run = 0
    return tiles


class Index:
    """Seeds of a block of items: sorted hashes, and the item and place of each."""

    def __init__(self, ids: np.ndarray, texts: pa.Array, least: int):
        offsets, words = word_hashes(texts)
        grams, first = gram_hashes(offsets, words, least)
        order = np.argsort(grams, kind="stable")
        self.ids, self.size = ids, np.diff(offsets)
        self.grams = grams[order]
        self.item = (np.searchsorted(offsets, first, side="right") - 1)[order]
        self.place = first[order] - offsets[self.item]
        self.least, self.sieve = least, None

    def leaks(self, texts: pa.Array, coverage: float) -> list[list[dict]]:
        """For each text, the items that it covers far enough."""
        if self.sieve is None:  # made in the task, once
            self.sieve = np.zeros(SIEVE, bool)
            self.sieve[(self.grams % np.uint64(SIEVE)).astype(np.int64)] = True
        offsets, words = word_hashes(texts)
        grams, first = gram_hashes(offsets, words, self.least)
        maybe = self.sieve[(grams % np.uint64(SIEVE)).astype(np.int64)]
        grams, first = grams[maybe], first[maybe]
        low, high = np.searchsorted(self.grams, grams, "left"), np.searchsorted(self.grams, grams, "right")
        hit = high > low
        low, high, first = low[hit], high[hit], first[hit]
        out: list[list[dict]] = [[] for _ in range(len(texts))]
        if not len(low):
            return out
        doc = np.searchsorted(offsets, first, side="right") - 1
        for start in np.flatnonzero(np.diff(doc, prepend=-1)):
            stop = start + int(np.searchsorted(doc[start:], doc[start], side="right"))
            n = (high - low)[start:stop]
            seeds = np.repeat(low[start:stop] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            places = np.repeat(first[start:stop] - offsets[doc[start]], n)
            items, at = self.item[seeds], self.place[seeds]
            order = np.argsort(items, kind="stable")
            items, at, places = items[order], at[order], places[order]
            for a in np.flatnonzero(np.diff(items, prepend=-1)):
                b = a + int(np.searchsorted(items[a:], items[a], side="right"))
                size = int(self.size[items[a]])
                reach = np.zeros(size + 1, np.int64)  # words in any seed: no tiling covers more
                np.add.at(reach, at[a:b], 1)
                np.add.at(reach, np.minimum(at[a:b] + self.least, size), -1)
                if np.count_nonzero(np.cumsum(reach[:-1])) < coverage * size:
                    continue
                tiles = tile(places[a:b], at[a:b], self.least)
                covered = sum(t[2] for t in tiles)
                if covered >= coverage * size:
                    out[doc[start]].append({"item_id": int(self.ids[items[a]]), "n_words": size,
                                            "covered": covered, "n_tiles": len(tiles)})
        return out


def _leaks(index: Index, coverage: float):
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("n_words", pa.int32()), ("covered", pa.int32()), ("n_tiles", pa.int32())]))

    @F.arrow_udf(f"array<{LEAK}>")
    def leaks(rows: pa.Array) -> pa.Array:
        out = [pa.array(index.leaks(rows.slice(a, b - a), coverage), kind) for a, b in slices(rows)]
        return pa.chunked_array(out, kind).combine_chunks()

    return leaks


def with_leaks(docs: DataFrame, benchmark: DataFrame, least: int = LEAST, coverage: float = COVERAGE,
               text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
               block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with ``leaks``: the benchmark items that each text covers, by item id."""
    items = written(benchmark.select(F.col(item_col).cast("string").try_cast("long").alias("id"), F.coalesce(item_text, F.lit("")).alias("text"),
                                     F.monotonically_increasing_id().alias("row")).filter("id is not null"), "benchmark")
    blocks = max(1, -(-(items.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0) // block_words))

    def leaks_of(block: int):
        part = items.filter(F.pmod(F.xxhash64("row"), F.lit(blocks)) == block).orderBy("id", "text").toArrow()
        texts = pa.chunked_array(part["text"].chunks, pa.string()).combine_chunks()
        return _leaks(Index(part["id"].to_numpy(), texts, least), coverage)(F.col(text_col))

    if blocks == 1:
        return docs.withColumn("leaks", F.array_sort(leaks_of(0)))
    keyed = written(docs.drop("leaks").withColumn("_row", F.monotonically_increasing_id()), "decontam-documents")
    found = [written(keyed.select("_row", leaks_of(b).alias("leaks")).filter(F.size("leaks") > 0), "decontam-leaks") for b in range(blocks)]
    leaks = reduce(DataFrame.unionByName, found).groupBy("_row").agg(F.array_sort(F.flatten(F.collect_list("leaks"))).alias("leaks"))
    none = F.array().cast(f"array<{LEAK}>")
    return keyed.join(leaks, "_row", "left").withColumn("leaks", F.coalesce("leaks", none)).drop("_row")


def leaked_pairs(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **how) -> DataFrame:
    """A row for each document and item that it leaks: ids, n_words, covered, n_tiles, coverage."""
    rows = with_leaks(docs.select(id_col, "text"), benchmark, **how)
    return (rows.select(id_col, F.explode("leaks").alias("leak")).select(id_col, "leak.*")
            .withColumn("coverage", F.round(F.col("covered") / F.col("n_words"), 6)))
