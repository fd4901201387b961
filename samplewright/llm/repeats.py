"""Removal of repeated byte strings by threshold-bounded interval expansion (operator 6).

A byte goes when a string of ``length`` bytes that covers it also starts anywhere else.

Each string of that length holds an anchor, its ``GRAM``-byte gram of least hash, at
a place that depends on its bytes alone.  So a repeated string meets its other
occurrences at the anchors' hash, and anchors that occur once need no further look.
Around each repeated anchor, the bytes before it (backward) and from it on are its
context.  Contexts of one anchor, in the order of their backward bytes, are what a
Burrows-Wheeler transform lists as an interval.  Intervals are extended backward
breadth-first, by the value of their common prefix: each interval's members share that
many bytes before the anchor, the next members in order of the bytes behind it tell
how far two of them go on together, and where both reach ``length`` they are repeats.
An interval splits where its members' preceding bytes differ; single members and
lengths beyond the threshold end the expansion.

The same expansion has a second, shorter threshold (``PASSAGE``, some fifty words), which removes
nothing: it counts the bytes of passages that also start elsewhere but may be too short to go.
Anchors are chosen in windows of that length, so they serve both.

Whole copies are settled by a digest, one of them standing for all.  Equal contexts are
collapsed before they are shuffled and results are joined back, so the inside of a
passage that very many documents share costs one context in a batch.

Defined results: a null text is empty; texts shorter than the threshold keep all bytes;
matches never cross documents but may overlap within one; what is judged is the
input, not what is left.  Every row is a document of its own, under a key written once,
and gives one row: ids are only carried along, so they may be null or repeat with
equal or different texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samplewright.llm.common import list_array, mix, slices, written

LENGTH = 400
PASSAGE = 320
GRAM = 48
#: Places hashed at once.
CHUNK = 1 << 20
#: Contexts expanded at once; one anchor's contexts always go together.
ROWS = 20_000

_TABLE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0x5851F42D4C957F2D
CONTEXT = "h bigint, ctx binary, before binary, after binary, n int, key bigint, pos int"


def _powers(base: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.concatenate([[np.uint64(1)], np.cumprod(np.full(n - 1, base, np.uint64), dtype=np.uint64)])


def gram_hashes(raw: np.ndarray, gram: int) -> np.ndarray:
    """Rolling hash of the gram at each place, by prefix sums of powers modulo 2^64."""
    room = len(raw) - gram + 1
    if room <= 0:
        return np.zeros(0, np.uint64)
    out = np.empty(room, np.uint64)
    n = min(CHUNK, room) + gram
    up, down = _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)
    with np.errstate(over="ignore"):
        for a in range(0, room, CHUNK):
            part = _TABLE[raw[a:min(a + CHUNK, room) + gram - 1]]
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part * up[:len(part)], dtype=np.uint64)])
            size = len(part) - gram + 1
            out[a:a + size] = mix((sums[gram:] - sums[:-gram]) * down[:size])
    return out


def anchor_places(raw: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the anchors of all strings inside the texts that ``ends`` bounds, and their hashes."""
    hashes, width = gram_hashes(raw, gram), length - gram + 1
    found = [np.zeros(0, np.int64)]
    for a in range(0, max(len(raw) - length + 1, 0), CHUNK):
        part = hashes[a:a + CHUNK + width - 1]
        place = np.arange(len(part), dtype=np.uint64)
        # High bits choose, the place breaks ties: the rightmost of equal grams.
        key = (part & np.uint64(0xFFFFFFFFFF000000)) | (np.uint64(0xFFFFFF) - place)
        n = len(key) - width + 1
        grid = np.full(-(-len(key) // width) * width, np.iinfo(np.uint64).max, np.uint64)
        grid[:len(key)] = key
        grid = grid.reshape(-1, width)
        ahead = np.minimum.accumulate(grid, axis=1).reshape(-1)
        behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        least = np.minimum(behind[:n], ahead[width - 1:width - 1 + n])
        start = a + np.arange(n)
        least = least[start + length <= ends[np.searchsorted(ends, start, side="right")]]
        found.append(np.unique(a + (np.uint64(0xFFFFFF) - (least & np.uint64(0xFFFFFF))).astype(np.int64)))
    places = np.unique(np.concatenate(found))
    return places, hashes[places]


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes, and each text's offset; null is empty."""
    data = texts.fill_null("").cast(pa.binary())
    at = np.frombuffer(data.buffers()[1], np.int32)[data.offset:data.offset + len(data) + 1].astype(np.int64)
    return np.frombuffer(data.buffers()[2] or b"", np.uint8)[at[0]:at[-1]], at - at[0]


def _extract(length: int, gram: int):
    """Task function: the contexts of the marked places; of equal contexts near each other the bytes come once, with their count."""
    reach = length - gram
    kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.int64(), pa.int32())

    def batch(rows: list[list]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [[]] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["h", "ctx", "before", "after", "n", "key", "pos"])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, rows = {}, []
        for part in parts:
            for k, i in enumerate(part.column(0).to_pylist()):
                raw = part.column(1)[k].as_py().encode()
                for place, h in zip(part.column(2)[k].as_py(), part.column(3)[k].as_py()):
                    # Byte 0 ends short contexts, and 255 is no part of UTF-8.
                    before = raw[max(place - reach, 0):place][::-1].replace(b"\0", b"\xff")
                    after = raw[place:place + length].replace(b"\0", b"\xff")
                    ctx = hashlib.md5(len(before).to_bytes(4, "big") + before + after).digest()
                    if ctx in seen:
                        rows[seen[ctx]][4] += 1
                        rows.append([h, ctx, None, None, 0, i, place])
                    else:
                        seen[ctx] = len(rows)
                        rows.append([h, ctx, before, after, 1, i, place])
                    if len(rows) >= ROWS // 2:
                        yield batch(rows)
                        seen, rows = {}, []
        yield batch(rows)
    return run


def _matrix(strings: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    grid = np.frombuffer(b"".join(s.ljust(width, b"\0") for s in strings), np.uint8).reshape(-1, width)
    return grid, np.array([len(s) for s in strings])


def _common(grid: np.ndarray, size: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of rows ``a`` and ``b``, pair by pair."""
    out = np.empty(len(a), np.int64)
    for k in range(0, len(a), ROWS):
        same = grid[a[k:k + ROWS]] == grid[b[k:k + ROWS]]
        out[k:k + ROWS] = np.where(same.all(axis=1), grid.shape[1], same.argmin(axis=1))
    return np.minimum(out, np.minimum(size[a], size[b]))


def expand(h: np.ndarray, before: list[bytes], after: list[bytes], n: np.ndarray, lengths: tuple[int, ...]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each threshold, how far repeats reach before and behind each distinct context's anchor; 0 and 0 without any.

    ``n`` counts the occurrences of a context; one that occurs twice repeats as a whole.
    """
    left, left_size = _matrix(before, max(map(len, before)) or 1)
    right, right_size = _matrix(after, max(map(len, after)))
    reach = [(np.zeros(len(h), np.int64), np.zeros(len(h), np.int64)) for _ in lengths]
    for length, (reach_left, reach_right) in zip(lengths, reach):
        whole = (n > 1) & (left_size + right_size >= length)
        reach_left[whole], reach_right[whole] = left_size[whole], right_size[whole]
    order = np.lexsort((left.view(f"S{left.shape[1]}").ravel(), h))
    by_right = np.empty(len(h), np.int64)
    by_right[np.lexsort((right.view(f"S{right.shape[1]}").ravel(), h))] = np.arange(len(h))
    rows = order
    shared = np.full(len(rows), -1)  # bytes shared with the row before, -1 at an interval's first
    inside = np.flatnonzero(h[rows][1:] == h[rows][:-1]) + 1
    shared[inside] = _common(left, left_size, rows[inside - 1], rows[inside])
    while True:
        first = np.flatnonzero(shared < 0)
        size = np.diff(first, append=len(rows))
        keep = np.repeat(size > 1, size)
        rows, shared, size = rows[keep], shared[keep], size[size > 1]
        if not len(rows):
            return reach
        first = np.concatenate([[0], np.cumsum(size)[:-1]])
        interval = np.repeat(np.arange(len(size)), size)
        value = np.minimum.reduceat(np.where(shared < 0, np.iinfo(np.int64).max, shared), first)
        sorted_rows = rows[np.lexsort((by_right[rows], interval))]
        onward = np.zeros(len(rows) + 1, np.int64)
        pairs = np.flatnonzero(interval[1:] == interval[:-1]) + 1
        onward[pairs] = _common(right, right_size, sorted_rows[pairs - 1], sorted_rows[pairs])
        best = np.maximum(onward[:-1], onward[1:])
        for length, (reach_left, reach_right) in zip(lengths, reach):
            hit = value[interval] + best >= length
            repeated = sorted_rows[hit]
            reach_left[repeated] = np.maximum(reach_left[repeated], value[interval][hit])
            reach_right[repeated] = np.maximum(reach_right[repeated], best[hit])
        shared = np.where(shared == value[interval], -1, shared)


def _expand_task(lengths: tuple[int, int]):
    """Task function over rows sorted by anchor hash: ctx and, for both thresholds, the reach before and behind of repeated contexts."""
    def done(rows: dict[str, list]) -> pa.RecordBatch:
        places: dict[bytes, int] = {}
        for k, ctx in enumerate(rows["ctx"]):
            places.setdefault(ctx, k)
        at, count = list(places.values()), dict.fromkeys(places, 0)
        for ctx, n in zip(rows["ctx"], rows["n"]):
            count[ctx] += n
        reach = expand(np.array([rows["h"][k] for k in at]), [rows["before"][k] for k in at],
                       [rows["after"][k] for k in at], np.array(list(count.values())), lengths)
        hit = np.flatnonzero(reach[1][1])
        return pa.RecordBatch.from_arrays(
            [pa.array([rows["ctx"][at[k]] for k in hit], pa.binary()), *[pa.array(x[hit].astype(np.int32)) for pair in reach for x in pair]],
            ["ctx", "ahead", "behind", "short_ahead", "short_behind"])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {c: [] for c in ("h", "ctx", "before", "after", "n")}
        for part in parts:
            for c in held:
                held[c] += part.column(c).to_pylist()
            if len(held["h"]) >= ROWS and held["h"][0] != held["h"][-1]:
                cut = held["h"].index(held["h"][-1])
                yield done({c: v[:cut] for c, v in held.items()})
                held = {c: v[cut:] for c, v in held.items()}
        if held["h"]:
            yield done(held)
    return run


def _covered(size: int, starts: list[int], ends: list[int]) -> np.ndarray:
    step = np.zeros(size + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, ends, -1)
    return np.cumsum(step[:-1]) > 0


def cut_runs(raw: bytes, starts: list[int], ends: list[int]) -> tuple[int, int, bytes]:
    """Bytes and runs removed, and what is left."""
    gone = _covered(len(raw), starts, ends)
    runs = np.count_nonzero(np.diff(gone.astype(np.int8), prepend=np.int8(0)) == 1)
    return int(np.count_nonzero(gone)), runs, np.frombuffer(raw, np.uint8)[~gone].tobytes()


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, passage: int = PASSAGE, gram: int = GRAM) -> DataFrame:
    """For each document: id, n_bytes, n_removed, n_spans, kept (its remaining bytes; null where nothing or everything goes), whole_sha256, n_passage.

    ``n_removed`` is 0 for a document that stays whole and ``n_bytes`` for one that goes whole;
    ``n_passage`` counts the bytes covered by strings of ``passage`` bytes (at most ``length``) that also start elsewhere.
    """
    texts = written(docs.select(F.monotonically_increasing_id().alias("key"), F.col(id_col).alias("id"),
                                F.coalesce(F.col(text_col), F.lit("")).alias("text")), "texts", "zstd")
    digests = texts.select("key", "id", F.octet_length("text").cast("long").alias("n_bytes"), F.md5("text").alias("digest"),
                           F.sha2("text", 256).alias("whole_sha256"))
    groups = digests.groupBy("digest", "n_bytes").agg(F.min("key").alias("rep"), F.count("*").alias("copies"))
    info = written(digests.join(groups, ["digest", "n_bytes"]).select("key", "id", "n_bytes", "whole_sha256", "copies", (F.col("key") == F.col("rep")).alias("first")), "info")

    @F.arrow_udf("array<struct<h:bigint,pos:int>>")
    def anchors(rows: pa.Array) -> pa.Array:
        out = []
        for a, b in slices(rows):
            raw, at = _bytes_of(rows.slice(a, b - a))
            places, hashes = anchor_places(raw, at[1:], passage, gram)
            owner = np.searchsorted(at, places, side="right") - 1
            items = pa.StructArray.from_arrays([pa.array(hashes.view(np.int64)), pa.array((places - at[owner]).astype(np.int32))], ["h", "pos"])
            out.append(list_array(np.searchsorted(places, at), items))
        return pa.chunked_array(out, pa.list_(pa.struct([("h", pa.int64()), ("pos", pa.int32())]))).combine_chunks()

    seeds = written(texts.select("key", F.explode(anchors(F.col("text"))).alias("a")).select("key", "a.*"), "anchors", "zstd")
    # Written, so that the join reads plain shuffles, which Spark can split at a hot anchor.
    repeated = written(seeds.groupBy("h").agg(F.count("*").alias("m")).filter("m > 1").select("h"), "repeated")
    places = (seeds.join(repeated, "h").join(info.filter("first").select("key"), "key")
              .groupBy("key").agg(F.collect_list(F.struct("pos", "h")).alias("p")))
    marked = written(texts.join(places, "key").select("key", "text", "p.pos", "p.h"), "marked", "zstd")
    contexts = marked.mapInArrow(_extract(length, gram), CONTEXT)
    heads = contexts.filter("n > 0").select("h", "ctx", "before", "after", "n")
    reach = (heads.repartition(F.col("h")).sortWithinPartitions("h")
             .mapInArrow(_expand_task((length, passage)), "ctx binary, ahead int, behind int, short_ahead int, short_behind int"))
    spans = contexts.select("ctx", "key", "pos").join(reach, "ctx").groupBy("key").agg(F.collect_list(F.struct(
        (F.col("pos") - F.col("ahead")).alias("a"), (F.col("pos") + F.col("behind")).alias("b"),
        (F.col("pos") - F.col("short_ahead")).alias("c"), (F.col("pos") + F.col("short_behind")).alias("d"))).alias("s"))

    @F.arrow_udf("n_removed bigint, n_spans bigint, kept binary, n_passage bigint")
    def cut(rows: pa.Array, starts: pa.Array, ends: pa.Array, short_starts: pa.Array, short_ends: pa.Array) -> pa.Array:
        done = []
        for t, a, b, c, d in zip(rows, starts, ends, short_starts, short_ends):
            raw = t.as_py().encode()
            done.append((*cut_runs(raw, a.as_py(), b.as_py()), int(np.count_nonzero(_covered(len(raw), c.as_py(), d.as_py())))))
        columns = list(zip(*done)) or [[]] * 4
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int64())
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["n_removed", "n_spans", "kept", "n_passage"])

    partly = (marked.select("key", "text").join(spans, "key")
              .select("key", cut("text", "s.a", "s.b", "s.c", "s.d").alias("c")).select("key", "c.*"))
    gone, copied = [(F.col("copies") > 1) & (F.col("n_bytes") >= least) for least in (length, passage)]
    return info.join(partly, "key", "left").select(
        F.col("id").alias(id_col), "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(gone, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(~gone & (F.coalesce("n_removed", F.lit(0)) > 0), F.col("kept")).alias("kept"), "whole_sha256",
        F.when(copied, F.col("n_bytes")).otherwise(F.coalesce("n_passage", F.lit(0))).alias("n_passage"))
