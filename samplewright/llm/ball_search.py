"""Ranked lexical search with a sparse ball tree (operator 12).

A document is a sparse vector: for each term the part of the score that does not depend on the
query.  A query is the vector of its terms' weights, and the score is their inner product.
Documents are gathered in bundles of at most ``BUNDLE``; in each a balanced tree halves them by
two distant documents down to leaves of ``LEAF``.  A node has its centroid c and radius r, so no
document under it scores above q.c + |q| r for a query q.  Documents are zero wherever their
centroid is, so only the coordinates of q that c has count in |q|, and a node without any of
the query's terms has the bound zero.  Bounds are rounded up by more than floating-point sums can lose.  Leaves are visited best-first, scored exactly in 64-bit integers,
and left out only when their bound, or that of a node above, is below the kth score known.

Three passes use the written index.  The first finds, by the roots, each query's most
promising bundle.  The second searches just these, which gives every query a kth score to beat.
The third searches everything against it, so a bundle whose root cannot reach it costs no more
than its root, and a task sends on at most k rows a query.

Queries go out in blocks of a fixed number of bytes (``BLOCK``), a block after the other: only
the coordinates of the block's terms are indexed, and driver and tasks hold a block at a time.
Every document is indexed, whatever its size.

Defined results: texts that are null or have no term are no documents and no queries; of equal
scores the smaller id comes first and null ids last; rows that share an id are ranked each by itself;
each row of the queries has its own result, also where ids repeat or are null; no documents or
no queries give no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from samplewright.llm.bpe import gather
from samplewright.llm.common import list_array, offsets_of, slices, written

BUNDLE = 4096
LEAF = 32
#: Terms of the documents of a bundle, beyond which it is closed.
ENTRIES = 1 << 20
#: Bytes of the queries of a block.
BLOCK = 1 << 22
#: Bounds grow by this part and by one, far more than sums of doubles lose.
SLACK = 1e-9
NO_ID = np.int64(2 ** 63 - 1)

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A"):ord("Z") + 1] += 32
_IN_TERM = np.zeros(256, bool)
_IN_TERM[128:] = True
for _a, _b in ("09", "AZ", "az"):
    _IN_TERM[ord(_a):ord(_b) + 1] = True

BUNDLE_ROW = pa.schema([
    ("bundle", pa.int64()), ("root_codes", pa.binary()), ("root_values", pa.binary()), ("root_radius", pa.float64()),
    ("doc_ids", pa.list_(pa.int64())), ("starts", pa.binary()), ("codes", pa.binary()), ("impacts", pa.binary()),
    ("radii", pa.binary()), ("node_codes", pa.binary()), ("node_starts", pa.binary()), ("nodes", pa.binary()), ("values", pa.binary())])
ROOT = ("bundle", "root_codes", "root_values", "root_radius")
BUNDLE_DDL = ("bundle bigint, root_codes binary, root_values binary, root_radius double, doc_ids array<bigint>, starts binary, codes binary, "
              "impacts binary, radii binary, node_codes binary, node_starts binary, nodes binary, values binary")


def terms(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of the texts in order, and each text's number of terms."""
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]
    ends = ends - ends[0]
    inside = _IN_TERM[raw]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    cut = ends[1:-1][ends[1:-1] < len(raw)]
    opens[cut] = inside[cut]
    starts = np.flatnonzero(opens)
    kept = np.concatenate([[0], np.cumsum(inside)])
    bounds = np.append(kept[starts], kept[-1]).astype(np.int32)
    found = pa.StringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(_FOLD[raw[inside]]))
    return found, np.diff(np.searchsorted(starts, ends))


def _vectors(vocabulary: pa.Array):
    """Task function: doc_id, number of terms, and the vocabulary's terms with their occurrences."""
    size = max(len(vocabulary), 1)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = part.column(1).cast(pa.string())
            for a, b in slices(texts):
                found, counts = terms(texts.slice(a, b - a))
                code = pc.fill_null(pc.index_in(found, vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64)
                owner = np.repeat(np.arange(b - a), counts)[code >= 0]
                pairs, tf = np.unique(owner * size + code[code >= 0], return_counts=True)
                ends = np.searchsorted(pairs // size, np.arange(b - a + 1))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).slice(a, b - a), pa.array(counts.astype(np.int64)),
                     list_array(ends, pa.array((pairs % size).astype(np.int32))), list_array(ends, pa.array(tf.astype(np.int64)))],
                    ["doc_id", "n", "codes", "tfs"])
    return run


def impact(tf: np.ndarray, n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """The part of a term's score that depends on the document alone, in whole numbers."""
    m = 100 - 25 + (25 * n * documents) // length
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


class Tree:
    """A balanced tree over sparse rows: level l has 2**l nodes over equal shares of the reordered rows."""

    def __init__(self, starts: np.ndarray, codes: np.ndarray, values: np.ndarray, terms_: int, leaf: int = LEAF):
        rows = len(starts) - 1
        self.levels = max(0, math.ceil(math.log2(max(rows / leaf, 1))))
        self.order = np.arange(rows)
        self.room = np.zeros(terms_)
        for level in range(self.levels):
            for a, b in self.shares(level):
                self.halve(starts, codes, values, a, b)
        at, self.starts = gather(starts, self.order)
        self.codes, values = codes[at], values[at]
        found = [self.ball(a, b, values) for level in range(self.levels + 1) for a, b in self.shares(level)]
        self.radii = np.array([r for _, _, r in found])
        self.root = found[0]
        by_term = np.concatenate([c for c, _, _ in found])
        order = np.argsort(by_term, kind="stable")
        self.nodes = np.repeat(np.arange(len(found)), [len(c) for c, _, _ in found])[order].astype(np.int32)
        self.values = np.concatenate([v for _, v, _ in found])[order]
        self.node_codes, first = np.unique(by_term[order], return_index=True)
        self.node_starts = np.append(first, len(order)).astype(np.int64)

    def shares(self, level: int) -> list[tuple[int, int]]:
        cuts = [len(self.order) * i >> level for i in range((1 << level) + 1)]
        return list(zip(cuts, cuts[1:]))

    def products(self, starts, codes, values, rows, with_codes, with_values) -> np.ndarray:
        """Inner product of each of ``rows`` with one sparse vector; no row is empty."""
        self.room[with_codes] = with_values
        at, ends = gather(starts, rows)
        out = np.add.reduceat(values[at] * self.room[codes[at]], ends[:-1])
        self.room[with_codes] = 0
        return out

    def halve(self, starts, codes, values, a: int, b: int) -> None:
        """Rows a to b in two halves: those closer to one distant row, then those closer to another."""
        rows = self.order[a:b]
        at, ends = gather(starts, rows)
        norms = np.add.reduceat(values[at] ** 2, ends[:-1])
        centre_codes, inverse = np.unique(codes[at], return_inverse=True)
        centre = np.bincount(inverse, weights=values[at]) / len(rows)

        def row(i):
            return codes[starts[rows[i]]:starts[rows[i] + 1]], values[starts[rows[i]]:starts[rows[i] + 1]]

        p = int(np.argmax(norms - 2 * self.products(starts, codes, values, rows, centre_codes, centre)))
        to_p = self.products(starts, codes, values, rows, *row(p))
        q = int(np.argmax(norms - 2 * to_p))
        side = self.products(starts, codes, values, rows, *row(q)) - to_p
        self.order[a:b] = rows[np.argsort(side, kind="stable")]

    def ball(self, a: int, b: int, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Codes and values of the centroid of the reordered rows a to b, and a radius that no row exceeds."""
        at = slice(self.starts[a], self.starts[b])
        codes, inverse = np.unique(self.codes[at], return_inverse=True)
        centre = (np.bincount(inverse, weights=values[at]) / (b - a)).astype(np.float32)  # any centre will do, if the radius is to it
        wide = centre.astype(np.float64)
        ends = self.starts[a:b] - self.starts[a]
        far = wide @ wide + np.add.reduceat(values[at] * (values[at] - 2 * wide[inverse]), ends)
        lost = 1e-12 * (wide @ wide + np.add.reduceat(values[at] ** 2, ends).max())  # what the sums may cancel away
        return codes, centre, math.sqrt(max(float(far.max()), 0.0) + lost) * (1 + SLACK)


def _bundles(weight: np.ndarray, scale: np.ndarray, documents: int, length: int):
    """Task function: bundle rows from vectors (doc_id, n, codes, tfs)."""
    def row(number, docs, lists):
        starts = np.concatenate([[0], np.cumsum([len(c) for c, _ in lists])])
        codes, impacts = np.concatenate([c for c, _ in lists]), np.concatenate([v for _, v in lists])
        tree = Tree(starts, codes, impacts * scale[codes], len(weight))
        at, _ = gather(starts, tree.order)
        values = [TaskContext.get().partitionId() << 32 | number, tree.root[0].astype("<i4").tobytes(), tree.root[1].astype("<f4").tobytes(), tree.root[2],
                  [docs[i] for i in tree.order.tolist()], tree.starts.astype("<i8").tobytes(), tree.codes.astype("<i4").tobytes(),
                  impacts[at].astype("<i8").tobytes(), tree.radii.astype("<f8").tobytes(), tree.node_codes.astype("<i4").tobytes(),
                  tree.node_starts.astype("<i8").tobytes(), tree.nodes.astype("<i4").tobytes(), tree.values.astype("<f4").tobytes()]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, BUNDLE_ROW)], schema=BUNDLE_ROW)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, docs, lists, entries = 0, [], [], 0
        for part in parts:
            ids, n = part.column(0).to_pylist(), part.column(1).to_numpy(zero_copy_only=False)
            ends, codes = offsets_of(part.column(2)), part.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            values = impact(part.column(3).flatten().to_numpy(zero_copy_only=False), np.repeat(n, np.diff(ends)), documents, length)
            useful = (weight[codes] > 0) & (values > 0)
            for i in range(len(part)):
                mine = slice(ends[i], ends[i + 1])
                chosen = codes[mine][useful[mine]]
                if not len(chosen):
                    continue
                docs.append(ids[i])
                lists.append((chosen, values[mine][useful[mine]]))
                entries += len(chosen)
                if len(docs) >= BUNDLE or entries >= ENTRIES:
                    yield row(number, docs, lists)
                    number, docs, lists, entries = number + 1, [], [], 0
        if docs:
            yield row(number, docs, lists)
    return run


class Queries:
    """The queries of a block: their codes, integer weights, and coordinates in the tree's scale."""

    def __init__(self, lists: list[tuple[np.ndarray, np.ndarray]], scale: np.ndarray):
        self.codes = [c for c, _ in lists]
        self.weights = [w for _, w in lists]
        self.points = [w / scale[c] for c, w in lists]
        self.squares = [p * p for p in self.points]
        self.terms = len(scale)


def _raised(bound):
    return bound * (1 + SLACK) + 1


class Bundle:
    """One bundle's row, ready to be searched."""

    def __init__(self, row: dict):
        self.doc_ids = np.array([NO_ID if i is None else i for i in row["doc_ids"]], np.int64)
        self.null = np.array([i is None for i in row["doc_ids"]], bool)
        kinds = {"starts": "<i8", "codes": "<i4", "impacts": "<i8", "radii": "<f8", "node_codes": "<i4", "node_starts": "<i8", "nodes": "<i4", "values": "<f4"}
        for name, kind in kinds.items():
            setattr(self, name, np.frombuffer(row[name], kind))
        self.values = self.values.astype(np.float64)
        self.levels = (len(self.radii) + 1).bit_length() - 2
        self.visited = 0

    def leaf_bounds(self, codes: np.ndarray, point: np.ndarray, square: np.ndarray) -> np.ndarray:
        """For each leaf the least bound of the nodes from the root to it."""
        place = np.minimum(np.searchsorted(self.node_codes, codes), len(self.node_codes) - 1)
        known = self.node_codes[place] == codes
        at, ends = gather(self.node_starts, place[known])
        nodes, times = self.nodes[at], np.diff(ends)
        near = np.bincount(nodes, weights=self.values[at] * np.repeat(point[known], times), minlength=len(self.radii))
        size = np.sqrt(np.bincount(nodes, weights=np.repeat(square[known], times), minlength=len(self.radii)))
        bounds = _raised(near + size * (1 + SLACK) * self.radii) * (size > 0)
        out = bounds[:1]
        for level in range(1, self.levels + 1):
            out = np.minimum(np.repeat(out, 2), bounds[(1 << level) - 1:(2 << level) - 1])
        return out

    def search(self, codes, weights, point, square, k: int, least: int, room: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores of the best k at or above ``least``, ties to smaller ids."""
        bounds = self.leaf_bounds(codes, point, square)
        order = np.argsort(-bounds, kind="stable")
        rows, scores, done, some, n = np.zeros(0, np.int64), np.zeros(0, np.int64), 0, 1, len(self.doc_ids)
        room[codes] = weights
        while done < len(order) and bounds[order[done]] >= least:
            leaves = np.sort(order[done:done + some])
            leaves = leaves[bounds[leaves] >= least]
            first, stop = n * leaves >> self.levels, n * (leaves + 1) >> self.levels
            chosen = np.concatenate([np.arange(a, b) for a, b in zip(first.tolist(), stop.tolist())])
            at, ends = gather(self.starts, chosen)
            found = np.add.reduceat(room[self.codes[at]] * self.impacts[at], ends[:-1])
            good = found >= least
            rows, scores = np.concatenate([rows, chosen[good]]), np.concatenate([scores, found[good]])
            if len(rows) > k:
                best = np.lexsort((self.doc_ids[rows], -scores))[:k]
                rows, scores = rows[best], scores[best]
            if len(rows) == k:
                least = max(least, int(scores.min()))
            self.visited += len(leaves)
            done, some = done + some, 2 * some
        room[codes] = 0
        return rows, scores


def _rows(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for part in parts:
        for i in range(len(part)):
            yield part.slice(i, 1).to_pylist()[0]


def _root_bound(row: dict, queries: Queries, room: np.ndarray) -> np.ndarray:
    codes = np.frombuffer(row["root_codes"], "<i4")
    room[codes] = np.frombuffer(row["root_values"], "<f4")
    out = np.zeros(len(queries.codes))
    for q, (c, p, square) in enumerate(zip(queries.codes, queries.points, queries.squares)):
        centre = room[c]
        size = math.sqrt(float(square @ (centre > 0)))
        if size:
            out[q] = _raised(float(p @ centre) + size * (1 + SLACK) * row["root_radius"])
    room[codes] = 0
    return out


def _promising(queries: Queries):
    """Task function: for each query the bundle of the highest root bound in the task."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        room, best, where = np.zeros(queries.terms), np.zeros(len(queries.codes)), np.full(len(queries.codes), -1)
        for row in _rows(parts):
            bound = _root_bound(row, queries, room)
            better = bound > best
            best[better], where[better] = bound[better], row["bundle"]
        q = np.flatnonzero(where >= 0)
        yield pa.RecordBatch.from_arrays([pa.array(q.astype(np.int32)), pa.array(where[q]), pa.array(best[q])], ["q", "bundle", "bound"])
    return run


def _best(queries: Queries, names: np.ndarray, k: int, least: np.ndarray, only: dict[int, list[int]] | None):
    """Task function: name, doc_id, score of each query's best k in the task; ``only`` names bundles and their queries."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        room, wide = np.zeros(queries.terms, np.int64), np.zeros(queries.terms)
        kept: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        floor = least.copy()
        for row in _rows(parts):
            asked = np.flatnonzero(_root_bound(row, queries, wide) >= floor) if only is None else only.get(row["bundle"], [])
            if not len(asked):
                continue
            bundle = Bundle(row)
            for q in map(int, asked):
                rows, scores = bundle.search(queries.codes[q], queries.weights[q], queries.points[q], queries.squares[q], k, int(floor[q]), room)
                if len(rows):
                    mine = bundle.doc_ids[rows], bundle.null[rows], scores
                    mine = tuple(np.concatenate(x) for x in zip(kept[q], mine)) if q in kept else mine
                    best = np.lexsort((mine[1], mine[0], -mine[2]))[:k]
                    kept[q] = tuple(x[best] for x in mine)
                    if len(best) == k:
                        floor[q] = max(floor[q], int(kept[q][2].min()))
        for q, (ids, null, scores) in kept.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), names[q])), pa.array(ids, mask=null), pa.array(scores)], ["name", "doc_id", "score"])
    return run


def _block_queries(part: pa.Table) -> tuple[pa.Array, list[tuple[np.ndarray, np.ndarray]]]:
    """The block's distinct terms, and each query's codes and repeats."""
    found, counts = terms(pa.chunked_array(part["text"].chunks, pa.string()).combine_chunks())
    coded = found.dictionary_encode()
    ends = np.concatenate([[0], np.cumsum(counts)])
    codes = coded.indices.to_numpy(zero_copy_only=False)
    return coded.dictionary, [np.unique(codes[a:b], return_counts=True) for a, b in zip(ends, ends[1:])]


def ranked(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text: str = "text", block: int = BLOCK) -> DataFrame:
    """item_id, rank from 1, doc_id, score: each item's k documents of highest score above 0."""
    spark = docs.sparkSession
    asked = items.select(F.col(item_col).alias("item_id"), F.col(item_text).cast("string").alias("text"))
    asked = written(asked.filter("text is not null").withColumn("row", F.monotonically_increasing_id()), "ball-items")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).filter("text is not null")
    blocks = -(-(asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // block)
    found = None
    for b in range(blocks):
        part = asked.filter(F.pmod(F.xxhash64("row"), F.lit(blocks)) == b).select("row", "text").toArrow()
        if not len(part):
            continue
        vocabulary, lists = _block_queries(part)
        vectors = written(texts.mapInArrow(_vectors(vocabulary), "doc_id bigint, n bigint, codes array<int>, tfs array<bigint>").filter("n > 0"),
                          "ball-vectors", "zstd")
        documents, length = vectors.agg(F.count("*"), F.sum("n")).first()
        df = np.zeros(len(vocabulary), np.int64)
        for r in vectors.select(F.explode("codes").alias("code")).groupBy("code").agg(F.count("*").alias("df")).collect():
            df[r["code"]] = r["df"]
        weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
        scale = np.sqrt(np.maximum(weight, 1).astype(np.float64))
        queries = Queries([(c[weight[c] > 0], (weight[c] * n)[weight[c] > 0]) for c, n in lists], scale)
        index = written(vectors.mapInArrow(_bundles(weight, scale, documents, length or 1), BUNDLE_DDL), "ball-bundles", "zstd")
        first = index.select(*ROOT).mapInArrow(_promising(queries), "q int, bundle bigint, bound double")
        only: dict[int, list[int]] = {}
        for r in first.groupBy("q").agg(F.max_by("bundle", F.struct("bound", "bundle")).alias("bundle")).collect():
            only.setdefault(r["bundle"], []).append(r["q"])
        least, known = np.ones(len(lists), np.int64), index.filter(F.col("bundle").isin(list(only)))
        scores = known.mapInArrow(_best(queries, np.arange(len(lists)), k, least, only), "name bigint, doc_id bigint, score bigint")
        for r in scores.groupBy("name").agg(F.min("score").alias("kth"), F.count("*").alias("n")).filter(F.col("n") >= k).collect():
            least[r["name"]] = r["kth"]
        rows = written(index.mapInArrow(_best(queries, part["row"].to_numpy(), k, least, None), "name bigint, doc_id bigint, score bigint"), "ball-results")
        found = rows if found is None else found.union(rows)
    if found is None:
        kind = asked.schema["item_id"].dataType.simpleString()
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint")
    rank = F.row_number().over(Window.partitionBy("name").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    best = found.withColumn("rank", rank).filter(F.col("rank") <= k)
    return best.join(asked.select(F.col("row").alias("name"), "item_id"), "name").select("item_id", "rank", "doc_id", "score")
