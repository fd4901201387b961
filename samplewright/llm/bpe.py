"""Byte-level BPE encoding and decoding (operator 2).

A text is split by the tokenizer's pattern with one built-in regular expression
(texts with code points newer than the JVM's Unicode version by the regex module).
The distinct words of a bounded slice become byte arrays, and ranked merges are
folded over all of them at once: each round merges, in every word, the leftmost
adjacent pair of least rank, as looked up in the literal rank map, until no pair
has a rank.  Documents then take their words' ids by dictionary code.  Decoding
concatenates the ids' binary pieces.

No row leaves its partition: there is no shuffle, and a lost task is simply run again.

Defined results: a null text encodes as the empty text; the empty text has no ids;
null ids decode as the empty byte string; repeated rows give repeated results; other
columns pass through untouched, and an existing column of the output's name is replaced.
"""

from __future__ import annotations

import base64
import heapq
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samplewright.llm.common import list_array, offsets_of

#: White space as Unicode defines it; written out, since Java's ``\s`` is ASCII only.
SPACE = r"\t-\r\x20\x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
#: Code points that the JVM's Unicode version does not know; a newer one may call them letters.
UNKNOWN = r"\p{Cn}"
#: Rank that no pair of a vocabulary has.
NONE = np.int64(1) << 40
#: Words beyond this many bytes merge one at a time with a heap.
LONG_WORD = 256
SLICE_WORDS = 250_000


@dataclass
class Ranks:
    """The literal rank map: pieces by id, the id of each byte, the rank of each mergeable pair."""

    pieces: list[bytes]
    pattern: str
    of_byte: np.ndarray = field(init=False)
    pair_keys: np.ndarray = field(init=False)
    pair_ranks: np.ndarray = field(init=False)

    def __post_init__(self):
        rank = {piece: i for i, piece in enumerate(self.pieces) if piece}
        self.of_byte = np.array([rank[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for piece, i in rank.items():
            for cut in range(1, len(piece)):
                left, right = rank.get(piece[:cut]), rank.get(piece[cut:])
                if left is not None and right is not None:
                    pairs[left << 20 | right] = i
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_ranks = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int64)

    @classmethod
    def load(cls, path: str, pattern: str) -> "Ranks":
        """From a rank file: a line for each piece, base64 and id."""
        with open(path, "rb") as lines:
            ranks = {int(i): base64.b64decode(piece) for piece, i in map(bytes.split, lines)}
        return cls([ranks.get(i, b"") for i in range(max(ranks) + 1)], pattern)

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 20 | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NONE)


def java_pattern(pattern: str) -> str:
    """The splitting pattern with its white-space classes written out."""
    return pattern.replace(r"[^\s", f"[^{SPACE}").replace(r"\S", f"[^{SPACE}]").replace(r"\s", f"[{SPACE}]")


def merge_long(ids: np.ndarray, ranks: Ranks) -> list[int]:
    """Ranked merges of one word with a heap of pairs, leftmost first among equals."""
    sym, n = ids.tolist(), len(ids)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    pairs = dict(zip(ranks.pair_keys.tolist(), ranks.pair_ranks.tolist()))
    heap = [(pairs[k], i) for i in range(n - 1) if (k := sym[i] << 20 | sym[i + 1]) in pairs]
    heapq.heapify(heap)
    while heap:
        rank, i = heapq.heappop(heap)
        j = after[i] if sym[i] >= 0 else n
        if j >= n or pairs.get(sym[i] << 20 | sym[j]) != rank:
            continue  # one side has merged otherwise since
        sym[i], sym[j] = rank, -1
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
            if (k := sym[i] << 20 | sym[after[i]]) in pairs:
                heapq.heappush(heap, (pairs[k], i))
        if before[i] >= 0 and (k := sym[before[i]] << 20 | sym[i]) in pairs:
            heapq.heappush(heap, (pairs[k], before[i]))
    return [s for s in sym if s >= 0]


def fold_words(words: pa.Array, ranks: Ranks) -> tuple[np.ndarray, np.ndarray]:
    """Ids of each word: offsets and flat values.

    One merge per word and round keeps the order that ranked merging prescribes,
    also where a merge makes a pair of lower rank than its own.
    """
    data = words.cast(pa.binary())
    raw = np.frombuffer(data.buffers()[2] or b"", np.uint8)
    ends = np.frombuffer(data.buffers()[1], np.int32)[data.offset:data.offset + len(data) + 1].astype(np.int64)
    size = np.diff(ends)
    done: list[tuple[np.ndarray, np.ndarray]] = []
    for w in np.flatnonzero(size > LONG_WORD):
        merged = merge_long(ranks.of_byte[raw[ends[w]:ends[w + 1]]], ranks)
        done.append((np.full(len(merged), w), np.array(merged, np.int64)))
    owner = np.repeat(np.arange(len(size)), size)
    sym = ranks.of_byte[raw[ends[0]:ends[-1]]]
    short = (size <= LONG_WORD)[owner]
    owner, sym = owner[short], sym[short]
    rank = np.full(len(sym), NONE)
    if len(sym):
        rank[:-1] = np.where(owner[:-1] == owner[1:], ranks.lookup(sym[:-1], sym[1:]), NONE)
    while len(sym):
        starts = np.flatnonzero(np.diff(owner, prepend=-1))
        counts = np.diff(starts, append=len(sym))
        least = np.minimum.reduceat(rank, starts)
        over = np.repeat(least == NONE, counts)
        if over.any():
            done.append((owner[over], sym[over]))
            going = ~over
            owner, sym, rank, counts, least = owner[going], sym[going], rank[going], counts[least < NONE], least[least < NONE]
            if not len(sym):
                break
        hits = np.flatnonzero(rank == np.repeat(least, counts))
        hits = hits[np.diff(owner[hits], prepend=-1) > 0]
        sym[hits] = rank[hits]
        kept = np.ones(len(sym), bool)
        kept[hits + 1] = False
        moved = np.cumsum(kept) - 1
        owner, sym, rank, hits = owner[kept], sym[kept], rank[kept], moved[hits]
        for left in (hits, hits - 1):  # the pairs whose right or left side has changed
            left = left[left >= 0]
            right = np.minimum(left + 1, len(sym) - 1)
            same = (left < right) & (owner[left] == owner[right])
            rank[left] = np.where(same, ranks.lookup(sym[left], sym[right]), NONE)
    if not done:
        return np.zeros(len(size) + 1, np.int64), np.zeros(0, np.int32)
    owner = np.concatenate([o for o, _ in done])
    order = np.argsort(owner, kind="stable")
    flat = np.concatenate([s for _, s in done])[order].astype(np.int32)
    return np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(size)))]), flat


def gather(offsets: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes into a ragged array's values for its rows ``chosen``, and the rows' new offsets."""
    size = np.diff(offsets)[chosen]
    new = np.concatenate([[0], np.cumsum(size)])
    return np.arange(new[-1]) + np.repeat(offsets[:-1][chosen] - new[:-1], size), new


def encode_lists(words: pa.Array, ranks: Ranks) -> pa.Array:
    """Ids for each list of words, a bounded number of words at a time."""
    offsets, out, start = offsets_of(words), [], 0
    while start < len(words):
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + SLICE_WORDS, side="right")) - 1)
        part = words.slice(start, stop - start)
        coded = part.flatten().dictionary_encode()
        at, flat = fold_words(coded.dictionary, ranks)
        where, ends = gather(at, coded.indices.to_numpy(zero_copy_only=False))
        out.append(list_array(ends[offsets[start:stop + 1] - offsets[start]], pa.array(flat[where], pa.int32())))
        start = stop
    return pa.chunked_array(out, pa.list_(pa.int32())).combine_chunks()


def decode_lists(ids: pa.Array, pieces: pa.Array) -> pa.Array:
    """The binary pieces of each list of ids, concatenated."""
    offsets, out, start = offsets_of(ids), [], 0
    size = np.diff(np.frombuffer(pieces.buffers()[1], np.int32)[:len(pieces) + 1]).astype(np.int64)
    while start < len(ids):
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + 4 * SLICE_WORDS, side="right")) - 1)
        flat = ids.slice(start, stop - start).flatten()
        joined = pieces.take(flat)
        ends = np.concatenate([[0], np.cumsum(size[flat.to_numpy(zero_copy_only=False)])])
        ends = ends[offsets[start:stop + 1] - offsets[start]].astype(np.int32)
        out.append(pa.BinaryArray.from_buffers(pa.binary(), stop - start, [None, pa.py_buffer(ends), joined.buffers()[2]]))
        start = stop
    return pa.chunked_array(out, pa.binary()).combine_chunks()


def split_words(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(java_pattern(pattern)), F.lit(0))


def encode(df: DataFrame, ranks: Ranks, text_col: str = "text", ids_col: str = "token_ids") -> DataFrame:
    """``df`` with the ids of ``text_col``, each match of the pattern encoded by itself."""
    @F.arrow_udf("array<int>")
    def ids_of(words: pa.Array, newer: pa.Array) -> pa.Array:
        out = encode_lists(words, ranks)
        rows = np.flatnonzero(newer.is_valid().to_numpy(zero_copy_only=False)).tolist()
        if not rows:
            return out
        parts, done = [], 0
        for i in rows:
            split = pa.array([regex.findall(ranks.pattern, newer[i].as_py())], pa.list_(pa.string()))
            parts += [out.slice(done, i - done), encode_lists(split, ranks)]
            done = i + 1
        return pa.chunked_array([*parts, out.slice(done)], out.type).combine_chunks()

    text = F.col(text_col)
    newer = F.coalesce(text.rlike(UNKNOWN), F.lit(False))
    return df.withColumn(ids_col, ids_of(F.when(~newer, split_words(text, ranks.pattern)), F.when(newer, text)))


def decode(df: DataFrame, ranks: Ranks, ids_col: str = "token_ids", bytes_col: str = "decoded") -> DataFrame:
    """``df`` with the bytes that ``ids_col`` stands for; an id outside the vocabulary is an error."""
    binary = ranks.pieces

    @F.arrow_udf("binary")
    def bytes_of(ids: pa.Array) -> pa.Array:
        return decode_lists(ids, pa.array(binary, pa.binary()))

    return df.withColumn(bytes_col, bytes_of(F.col(ids_col)))


def ids_csv(ids: Column) -> Column:
    return F.array_join(ids.cast("array<string>"), ",")
