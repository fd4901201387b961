"""Exact top-k search by distributed histogram selection (operator 8).

Every query is scored against every candidate with the integer inner product of the
quantised vectors.  Rounds of global histograms close in on each query's kth largest
score: all scores inside the query's range are counted in ``BINS`` equal bins, the bin
that holds the kth becomes the next range, until the range is a single value.  A last
pass keeps what exceeds that value, and of what equals it the smallest ids.

Queries go out in blocks of a fixed number of components (``BLOCK``); candidates
are scanned where they lie and never move.  A task sends on, for each query, only
bins from its highest down to where its own count reaches k (lower ones cannot
hold the kth largest), and at most k rows in the last pass, so very many equal
scores cost no more than different ones.

Defined results: vectors that are null, empty or hold a null or non-finite component,
and rows of null id, take no part; a query meets candidates of its own dimension;
its own id is never its candidate; a query with fewer than k candidates returns them
all, one with none has no row; of ids that repeat, each row counts as a candidate, and
the query is one of its rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from samplewright.llm.common import offsets_of

BINS = 512
#: Components of the queries that one pass holds.
BLOCK = 1 << 20
#: Scores that a task holds at once.
SCORES = 1 << 21


def quantised(ids: pa.Array, vectors: pa.Array, scale: float) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By dimension, the ids and integer components of the rows that take part."""
    size = np.diff(offsets_of(vectors))
    flat = vectors.flatten()
    values = pc.fill_null(flat.cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    at = np.concatenate([[0], np.cumsum(size)])
    good = (size > 0) & (bad[at[1:]] == bad[at[:-1]]) & pc.is_valid(ids).to_numpy(zero_copy_only=False)
    keys = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False).astype(np.int64)
    out = {}
    for d in np.unique(size[good]):
        rows = np.flatnonzero(good & (size == d))
        out[int(d)] = keys[rows], np.floor(scale * values[at[rows][:, None] + np.arange(d)])
    return out


def scores(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Exact integer inner products, by float arithmetic where that is exact."""
    if queries.shape[1] * float(np.abs(queries).max()) * float(np.abs(candidates).max()) < 2 ** 53:
        return (queries @ candidates.T).astype(np.int64)
    return queries.astype(np.int64) @ candidates.astype(np.int64).T


def batches(parts: Iterator[pa.RecordBatch], dim: int, scale: float, queries: np.ndarray, own: np.ndarray):
    """(candidate ids, scores, usable) of bounded pieces of a partition; a query's own id is not usable."""
    step = max(1, SCORES // len(queries))
    for part in parts:
        ids, vectors = quantised(part.column(0), part.column(1), scale).get(dim, (np.zeros(0, np.int64), None))
        for a in range(0, len(ids), step):
            yield ids[a:a + step], scores(queries, vectors[a:a + step]), own[:, None] != ids[a:a + step][None, :]


def _histograms(own, queries, low, high, width, need, dim, scale):
    """Task function: counts of (query, bin) from the highest bin down to where ``need`` is reached."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(own), BINS), np.int64)
        for _, s, usable in batches(parts, dim, scale, queries, own):
            place = (s - low[:, None]) // width[:, None]
            inside = usable & (s >= low[:, None]) & (s < high[:, None])
            flat = (place + np.arange(len(own))[:, None] * BINS)[inside]
            counts += np.bincount(flat, minlength=counts.size).reshape(counts.shape)
        above = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1] - counts
        q, b = np.nonzero((counts > 0) & (above < need[:, None]))
        yield pa.RecordBatch.from_arrays([pa.array(q.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(counts[q, b])], ["q", "bin", "n"])
    return run


def _winners(own, queries, kth, k, dim, scale):
    """Task function: each query's best k candidates at or above its kth score, ties to smaller ids."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [np.zeros(0, np.int64)] * 3
        for ids, s, usable in batches(parts, dim, scale, queries, own):
            q, c = np.nonzero(usable & (s >= kth[:, None]))
            found = [np.concatenate([x, y]) for x, y in zip(kept, (q, ids[c], s[q, c]))]
            order = np.lexsort((found[1], -found[2], found[0]))
            q = found[0][order]
            first = np.searchsorted(q, q)
            best = order[np.arange(len(q)) - first < k]
            kept = [x[best] for x in found]
        yield pa.RecordBatch.from_arrays([pa.array(own[kept[0]]), pa.array(kept[1]), pa.array(kept[2])], ["query_id", "vec_id", "score"])
    return run


def _selected(vectors: DataFrame, own: np.ndarray, queries: np.ndarray, most: float, k: int, dim: int, scale: float) -> DataFrame:
    """The winners of one block of queries, up to k rows from each task."""
    reach = np.minimum(np.abs(queries).sum(axis=1) * most, 2.0 ** 62).astype(np.int64) + 1
    low, high, need = -reach, reach + 1, np.full(len(own), k)
    settled = np.zeros(len(own), bool)
    while not settled.all():
        width = np.maximum(-(-(high - low) // BINS), 1)
        counts = (vectors.mapInArrow(_histograms(own, queries, low, high, width, need, dim, scale), "q int, bin int, n bigint")
                  .groupBy("q", "bin").agg(F.sum("n").alias("n")))
        above = F.sum("n").over(Window.partitionBy("q").orderBy(F.desc("bin"))) - F.col("n")
        rows = counts.withColumn("above", above).toArrow()
        q, b, n, over = (rows[c].to_numpy() for c in ("q", "bin", "n", "above"))
        hit = (over < need[q]) & (over + n >= need[q])
        found = np.zeros(len(own), bool)
        found[q[hit]] = True
        low[q[hit]] += b[hit] * width[q[hit]]
        high[q[hit]] = low[q[hit]] + width[q[hit]]
        need[q[hit]] -= over[hit]
        settled = ~found | (width == 1)  # not found: fewer than k candidates, all stay
    return vectors.mapInArrow(_winners(own, queries, low, k, dim, scale), "query_id bigint, vec_id bigint, score bigint")


def top_k(embeddings: DataFrame, is_query: str = "vec_id % 50 = 0", k: int = 5, scale: float = 256.0,
          id_col: str = "vec_id", vector_col: str = "embedding", block: int = BLOCK) -> DataFrame:
    """Each query's k highest scores: query_id, rank from 1, vec_id, score."""
    vectors = embeddings.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    usable = vectors.filter("vec_id is not null and size(v) > 0 and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('inf'))")
    asked = usable.filter(F.expr(is_query)).groupBy("vec_id").agg(F.min("v").alias("v"))
    sizes = {r["d"]: (r["n"], r["most"]) for r in usable.groupBy(F.size("v").alias("d")).agg(
        F.count_if(F.expr(is_query)).alias("n"),
        F.max(F.array_max(F.transform("v", lambda x: F.abs(F.floor(x * scale))))).cast("double").alias("most")).collect()}
    found = None
    for dim, (n, most) in sorted(sizes.items()):
        blocks = -(-n * dim // block)
        for b in range(blocks):
            part = asked.filter((F.size("v") == dim) & (F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b)).toArrow()
            if not len(part):
                continue
            ids, queries = quantised(part["vec_id"].combine_chunks(), part["v"].combine_chunks(), scale)[dim]
            rows = _selected(vectors, ids, queries, most, k, dim, scale)
            found = rows if found is None else found.union(rows)
    if found is None:
        return embeddings.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
