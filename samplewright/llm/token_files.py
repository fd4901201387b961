"""Token ids in binary files, coded by a static range asymmetric numeral system (operator 13).

Texts become ids once.  The ids of the whole corpus are counted, and the counts, scaled to
a power of two, are the one frequency table that all files share.  Documents are dealt by
ranges of their id, and each task packs its sorted documents into chunks of about
``CHUNK`` ids, a row of a Parquet file each:

=================== ==========================================================================
column              content
=================== ==========================================================================
part, chunk         number of the range, number of the chunk in it; ascending ids follow them
ahead, n_tokens     ids ahead of the chunk in its part, ids of the chunk
doc_ids, doc_tokens id and number of ids of each document, in order
words               the 32-bit words of all blocks, little endian
states, places      the checkpoints: ``LANES`` 64-bit states each, and the word they continue at
word_crcs, id_crcs  crc32 of each block's words, and of its ids as 32-bit little-endian integers
=================== ==========================================================================

``BLOCK`` ids make a block, coded independently of all others; id i of a block belongs to lane
i mod ``LANES``, and the lanes' words are interleaved in the order in which a decoder needs
them.  A checkpoint stands at every ``SEGMENT`` ids, so a chunk's segments are decoded side by
side, as rows of one array.  ``table`` holds the frequencies, ``index`` each part's first id.
Reading checks both checksums of every block and fails on a difference.

The ids are those of the tokenizers library.  Where its pre-tokenizer is the byte-level
one, texts are split at the same places with numpy (the library itself says to which class a
code point belongs) and only words not met before go through its merges; texts that hold an
added token, and other tokenizers, go through the library whole.

Defined results: a null text encodes as the empty text, which has the end id alone; rows of
null id come first; rows that share an id stand in the order of a checksum of their ids; repeated rows
are repeated; an empty table gives files without chunks; other columns are not read.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from samplewright.llm.bpe import gather
from samplewright.llm.common import slices, written

LANES = 32
BLOCK = 1 << 14
SEGMENT = 1 << 13
#: Ids at which a chunk is closed; a longer document is one chunk.
CHUNK = 1 << 20
#: Words whose ids a task remembers, and words that go through the library as one text.
REMEMBERED = 1 << 20
TOGETHER = 64
#: Bytes of text whose words are looked up at once, and of pieces split at once.
SLICE = 16 << 20
PIECE = 1 << 16
#: How byte-level vocabularies write a space.
BYTE_SPACE = "\u0120"
LETTER, NUMBER, OTHER, SPACE, UNKNOWN = range(5)
#: State that a lane starts from; states stay below 2**63.
LEAST = np.uint64(1 << 31)
LOW = np.uint64(0xFFFFFFFF)
WORD = np.uint64(32)

CHUNK_ROW = pa.schema([
    ("part", pa.int32()), ("chunk", pa.int32()), ("ahead", pa.int64()), ("n_tokens", pa.int64()),
    ("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int64())), ("words", pa.binary()), ("states", pa.binary()),
    ("places", pa.list_(pa.int64())), ("word_crcs", pa.list_(pa.int64())), ("id_crcs", pa.list_(pa.int64()))])
CHUNK_DDL = ("part int, chunk int, ahead bigint, n_tokens bigint, doc_ids array<bigint>, doc_tokens array<bigint>, words binary, "
             "states binary, places array<bigint>, word_crcs array<bigint>, id_crcs array<bigint>")


class TextEncoder:
    """The library's ids of many texts, each distinct word merged once."""

    def __init__(self, spec: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs as many tasks as there are cores
        self.library = Tokenizer.from_str(spec)
        self.library.no_padding()
        self.library.no_truncation()
        parts = json.loads(spec)
        split = parts.get("pre_tokenizer") or {}
        self.by_word = (parts.get("normalizer") is None and split.get("type") == "ByteLevel"
                        and not split.get("add_prefix_space") and split.get("use_regex", True))
        self.added = [t["content"] for t in parts.get("added_tokens") or []]
        self.kinds = np.full(0x110000, UNKNOWN, np.uint8)
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        self.opens = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.opens[[i for piece, i in vocabulary.items() if piece.startswith(BYTE_SPACE)]] = True
        most = max([end_id, *self.library.get_vocab().values()])
        self.total, self.kind_of_ids = np.zeros(most + 1, np.int64), "<u2" if most < 1 << 16 else "<u4"
        self.forget()

    def forget(self) -> None:
        self.seen: dict[str, int] = {}
        self.sizes, self.flat = np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def kind(self, char: str) -> int:
        """The pattern's class of a code point, as the library splits it."""
        for kind, before in ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!")):
            if len(self.library.pre_tokenizer.pre_tokenize_str(before + char)) == 1:
                return kind
        return SPACE

    def starts(self, raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte offset of each word of the concatenated texts, and each text's number of words."""
        at = np.flatnonzero((raw & 0xC0) != 0x80)
        point = raw[at].astype(np.int32)
        for bytes_, mark, bits in ((2, 0xC0, 0x1F), (3, 0xE0, 0x0F), (4, 0xF0, 0x07)):
            wide = np.flatnonzero((point >= mark) & (point < (mark | bits) + 1) & (raw[at] >= mark))
            value = raw[at[wide]].astype(np.int32) & bits
            for j in range(1, bytes_):
                value = value << 6 | raw[at[wide] + j] & 0x3F
            point[wide] = value
        n = len(point)
        kind = self.kinds[point]
        new = np.unique(point[kind == UNKNOWN])
        if len(new):
            self.kinds[new] = [self.kind(chr(p)) for p in new.tolist()]
            kind = self.kinds[point]
        first = np.zeros(n + 3, bool)
        first[np.searchsorted(at, ends[:-1])] = True
        first[n:] = True
        start = first[:n].copy()
        start[1:] |= kind[1:] != kind[:-1]
        last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~first[1:n]) if n else np.zeros(0, np.int64)
        start[last] = True  # the last of a run of spaces is a word of its own or, if plain, begins the next
        start[last[point[last] == 0x20] + 1] = False
        quote = np.flatnonzero(start[:-1] & (point[:-1] == ord("'")) & (kind[1:] == LETTER) & ~first[1:n]) if n else last
        if len(quote):
            one = point[quote + 1]
            two = np.where(first[quote + 2], 0, point[np.minimum(quote + 2, n - 1)])
            short = np.isin(one, [ord(c) for c in "stmd"])
            pair = np.isin(one << 16 | two, [ord(a) << 16 | ord(b) for a, b in ("re", "ve", "ll")])
            quote, size = quote[short | pair], np.where(short, 1, 2)[short | pair]
            start[quote + 1] = False
            after = quote + 1 + size
            start[after[after < n]] = True
        places = np.flatnonzero(start)
        return at[places], np.diff(np.searchsorted(at[places], ends))

    def fresh_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each word and all ids, by the library.

        A space and what follows is a word in any text, so many of them make up one text; its ids
        that begin with a space begin a word.
        """
        spaced = [len(w) > 1 and w[0] == " " and self.kinds[ord(w[1])] != SPACE for w in words]
        texts, alone = list(compress(words, spaced)), [w for w, s in zip(words, spaced) if not s]
        texts = ["".join(texts[i:i + TOGETHER]) for i in range(0, len(texts), TOGETHER)]
        lists = [e.ids for e in self.library.encode_batch_fast(texts + alone, add_special_tokens=False)]
        ids = np.fromiter(chain.from_iterable(lists), np.uint32)
        ends = np.cumsum([0, *map(len, lists)])
        opens = np.concatenate([np.flatnonzero(self.opens[ids[:ends[len(texts)]]]), ends[len(texts):]])
        if len(opens) != len(words) + 1:
            raise ValueError("the library splits words apart")
        sizes, starts, spaced = np.diff(opens), opens[:-1], np.array(spaced, bool)
        order = np.empty(len(words), np.int64)
        order[np.flatnonzero(spaced)] = np.arange(spaced.sum())
        order[np.flatnonzero(~spaced)] = np.arange(spaced.sum(), len(words))
        return sizes[order], ids[gather(np.append(starts, len(ids)), order)[0]]

    def word_ids(self, words: list[str]) -> np.ndarray:
        """Places of the words among those remembered; new ones go through the library."""
        if len(self.seen) + len(words) > REMEMBERED:
            self.forget()
        places = np.fromiter(map(self.seen.get, words, repeat(-1)), np.int64, len(words))
        unseen = np.flatnonzero(places < 0)
        if len(unseen):
            new = [words[i] for i in unseen.tolist()]
            places[unseen] = np.arange(len(self.seen), len(self.seen) + len(new))
            self.seen.update(zip(new, places[unseen].tolist()))
            sizes, flat = self.fresh_ids(new)
            self.sizes, self.flat = np.concatenate([self.sizes, sizes]), np.concatenate([self.flat, flat])
        return places

    def split_ids(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Number of ids of each text and all ids, a piece of texts without added tokens after the other."""
        ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
        raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]
        ends = ends - ends[0]
        pieces = list(slices(texts, PIECE))  # numpy's arrays then stay in the processor's cache
        split = [self.starts(raw[ends[a]:ends[b]], ends[a:b + 1] - ends[a]) for a, b in pieces]
        bounds = np.concatenate([*(at + ends[a] for (a, _), (at, _) in zip(pieces, split)), [len(raw)]]).astype(np.int32)
        words = pa.StringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds), pa.py_buffer(raw)).dictionary_encode()
        where, used = self.word_ids(words.dictionary.to_pylist()), words.indices.to_numpy(zero_copy_only=False)
        offsets = np.concatenate([[0], np.cumsum(self.sizes)])
        picked, word_ends = gather(offsets, where)
        self.add(self.flat[picked], np.repeat(np.bincount(used, minlength=len(where)), np.diff(word_ends)))
        done = 0
        for _, counts in split:
            mine = where[used[done:done + counts.sum()]]
            done += len(mine)
            picked, word_ends = gather(offsets, mine)
            yield np.diff(word_ends[np.concatenate([[0], np.cumsum(counts)])]), self.flat[picked]

    def add(self, ids: np.ndarray, times: np.ndarray | None = None) -> None:
        self.total += np.bincount(ids, times, minlength=len(self.total)).astype(np.int64)

    def encode(self, texts: pa.Array, end_id: int) -> pa.Array:
        """The ids of each text and the end id, as little-endian integers of ``kind``; ``total`` counts them all."""
        out = [pa.array([], pa.binary())]
        for a, b in slices(texts, SLICE):
            part = texts.slice(a, b - a)
            whole = np.full(len(part), not self.by_word)
            for token in self.added:
                whole |= pc.match_substring(part, token).to_numpy(zero_copy_only=False)
            edges = np.unique(np.concatenate([[0, len(part)], np.flatnonzero(np.diff(whole)) + 1])).tolist()
            for i, j in zip(edges, edges[1:]):
                for sizes, ids in self.whole_ids(part.slice(i, j - i)) if whole[i] else self.split_ids(part.slice(i, j - i)):
                    ends = np.cumsum(sizes + 1)
                    closed = np.full(ends[-1], end_id, self.kind_of_ids)
                    inner = np.ones(len(closed), bool)
                    inner[ends - 1] = False
                    closed[inner] = ids
                    bounds = np.concatenate([[0], closed.itemsize * ends]).astype(np.int32)
                    out.append(pa.BinaryArray.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(bounds), pa.py_buffer(closed)]))
            self.total[end_id] += len(part)
        return pa.concat_arrays(out)

    def whole_ids(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The same from the library alone."""
        for a, b in slices(texts, PIECE):
            lists = [e.ids for e in self.library.encode_batch_fast(texts.slice(a, b - a).to_pylist(), add_special_tokens=False)]
            ids = np.fromiter(chain.from_iterable(lists), np.uint32)
            self.add(ids)
            yield np.fromiter(map(len, lists), np.int64, len(lists)), ids


@dataclass
class Frequencies:
    """A frequency of at least one for every id that occurs; they add up to ``2 ** bits``."""

    ids: np.ndarray
    freq: np.ndarray
    bits: int

    @classmethod
    def of_counts(cls, counts: dict[int, int]) -> "Frequencies":
        ids = sorted(counts)
        bits = max(16, (4 * len(ids)).bit_length())
        total, room = max(sum(counts.values()), 1), (1 << bits) - len(ids)
        freq = [1 + counts[i] * room // total for i in ids]
        if ids:
            freq[max(range(len(ids)), key=lambda k: counts[ids[k]])] += (1 << bits) - sum(freq)
        return cls(np.array(ids, np.int64), np.array(freq, np.uint64), bits)

    def __post_init__(self):
        self.cum = np.concatenate([[0], np.cumsum(self.freq)]).astype(np.uint64)[:-1]
        self.place = np.zeros(int(self.ids.max(initial=0)) + 1, np.int32)
        self.place[self.ids] = np.arange(len(self.ids))


def encode_ids(ids: np.ndarray, table: Frequencies) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words, their number in each block, states and word places of the checkpoints."""
    n, rows = len(ids), -(-len(ids) // BLOCK)
    steps = BLOCK // LANES if rows > 1 else -(-n // SEGMENT) * SEGMENT // LANES  # one block takes no more than it needs
    grid = np.full(rows * steps * LANES, len(table.ids), np.int32)  # what pads a block leaves a state as it is
    grid[:n] = table.place[ids]
    grid = np.ascontiguousarray(grid.reshape(rows, steps, LANES).swapaxes(0, 1))
    freq, cum = np.append(table.freq, np.uint64(1 << table.bits)), np.append(table.cum, np.uint64(0))
    shift, limit = np.uint64(table.bits), np.uint64(63 - table.bits)
    state = np.full((rows, LANES), LEAST, np.uint64)
    sent, words = np.zeros(grid.shape, bool), np.zeros(grid.shape, np.uint32)
    apart = SEGMENT // LANES
    states = np.zeros((rows, steps // apart, LANES), np.uint64)
    for t in range(steps - 1, -1, -1):
        f = freq[grid[t]]
        full = np.greater_equal(state, f << limit, out=sent[t])
        words[t] = state  # the low half
        np.right_shift(state, WORD, out=state, where=full)
        times = state // f
        state += cum[grid[t]] + times * ((np.uint64(1) << shift) - f)  # times * 2**bits + remainder + cum
        if t % apart == 0:
            states[:, t // apart] = state
    sent, words = sent.swapaxes(0, 1), words.swapaxes(0, 1)
    counts = sent.reshape(rows, -1, apart * LANES).sum(axis=2)
    places = np.concatenate([[0], np.cumsum(counts)[:-1]])
    return words[sent], counts.sum(axis=1), states, places


def decode_ids(words: np.ndarray, states: np.ndarray, places: np.ndarray, table: Frequencies) -> np.ndarray:
    """Ids of all segments, each from its checkpoint; those of a last short segment are followed by others."""
    symbol = np.repeat(np.arange(len(table.ids), dtype=np.int32), table.freq.astype(np.int64))
    freq, base = table.freq[symbol].astype(np.uint32), np.arange(len(symbol), dtype=np.uint32) - table.cum[symbol].astype(np.uint32)
    state, at = states.reshape(-1, LANES).copy(), places.astype(np.int64).copy()
    out = np.zeros((SEGMENT // LANES, *state.shape), np.int32)
    mask, shift = np.uint64((1 << table.bits) - 1), np.uint64(table.bits)
    words = np.append(words, np.uint32(0)).astype(np.uint64)
    for t in range(len(out)):
        slot = (state & mask).astype(np.int32)
        out[t] = symbol[slot]
        state >>= shift
        state *= freq[slot]
        state += base[slot]
        short = state < LEAST
        taken = np.cumsum(short, axis=1, dtype=np.int32)
        where = np.minimum(at[:, None] + taken - short, len(words) - 1)
        state = np.where(short, state << WORD | words[where], state)
        at += taken[:, -1]
    return table.ids[out.swapaxes(0, 1).reshape(-1)]


def _crcs(values: np.ndarray, sizes: np.ndarray) -> list[int]:
    ends = np.cumsum(sizes).tolist()
    raw = values.astype("<u4")
    return [zlib.crc32(raw[a:b]) for a, b in zip([0, *ends], ends)]


def _block_sizes(n: int) -> np.ndarray:
    return np.minimum(BLOCK, n - np.arange(0, n, BLOCK))


def _pack(table: Frequencies, kind: str):
    """Task function: chunk rows from sorted documents (doc_id, ids)."""
    width = np.dtype(kind).itemsize

    def row(part, chunk, ahead, docs, sizes, pieces):
        ids = np.concatenate(pieces)
        words, per_block, states, places = encode_ids(ids, table)
        values = [part, chunk, ahead, len(ids), np.concatenate(docs), np.concatenate(sizes), words.astype("<u4").tobytes(),
                  states.astype("<u8").tobytes(), places, _crcs(words, per_block), _crcs(ids, _block_sizes(len(ids)))]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, CHUNK_ROW)], schema=CHUNK_ROW)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, chunk, ahead, size, docs, sizes, pieces = TaskContext.get().partitionId(), 0, 0, 0, [], [], []
        for batch in parts:
            lists = batch.column(1)
            ends = np.frombuffer(lists.buffers()[1], np.int32)[lists.offset:lists.offset + len(lists) + 1].astype(np.int64) // width
            ids, names, start = np.frombuffer(lists.buffers()[2], kind), np.array(batch.column(0).to_pylist(), object), 0
            while start < len(lists):
                stop = min(max(start, int(np.searchsorted(ends, ends[start] + CHUNK - size))), len(lists) - 1) + 1 if size < CHUNK else start + 1
                stop = min(stop, len(lists))
                docs.append(names[start:stop])
                sizes.append(np.diff(ends[start:stop + 1]))
                pieces.append(ids[ends[start]:ends[stop]].copy())
                size += len(pieces[-1])
                start = stop
                if size >= CHUNK:
                    yield row(part, chunk, ahead, docs, sizes, pieces)
                    chunk, ahead, size, docs, sizes, pieces = chunk + 1, ahead + size, 0, [], [], []
        if docs:
            yield row(part, chunk, ahead, docs, sizes, pieces)
    return run


def _unpack(table: Frequencies):
    """Task function: documents (part, doc_id, start in the part, n_tokens, ids) from chunk rows."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for row in (r for k in range(len(batch)) for r in batch.slice(k, 1).to_pylist()):
                words, n = np.frombuffer(row["words"], "<u4"), row["n_tokens"]
                states, places = np.frombuffer(row["states"], "<u8"), np.array(row["places"], np.int64)
                per_block = np.diff(np.append(places[::BLOCK // SEGMENT], len(words)))
                ids = decode_ids(words, states, places, table)[:n].astype("<u4")
                if _crcs(words, per_block) != row["word_crcs"] or _crcs(ids, _block_sizes(n)) != row["id_crcs"]:
                    raise ValueError(f"chunk {row['chunk']} of part {row['part']} does not match its checksums")
                sizes = np.array(row["doc_tokens"], np.int64)
                ends = np.concatenate([[0], np.cumsum(sizes)])
                lists = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(4 * ends), pa.py_buffer(ids)])
                for a, b in slices(lists):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(b - a, row["part"], np.int32)), pa.array(row["doc_ids"][a:b], pa.int64()),
                         pa.array(row["ahead"] + ends[a:b]), pa.array(sizes[a:b]), lists.slice(a, b - a).cast(pa.binary())],
                        ["part", "doc_id", "start", "n_tokens", "ids"])
    return run


def with_ids(docs: DataFrame, spec: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, row (a number of its own) and ids (little endian, end id last, 16 bits where the vocabulary allows) of every document.

    Each task ends with a row that has no ids but how often it met each: id_seen, n_seen.
    """
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, names = TextEncoder(spec, end_id), ["doc_id", "row", "ids", "id_seen", "n_seen"]
        longs = pa.list_(pa.int64())
        for part in parts:
            ids, none = encoder.encode(part.column(2).cast(pa.string()), end_id), pa.nulls(len(part), longs)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), ids, none, none], names)
        seen = np.flatnonzero(encoder.total)
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()),
                                          pa.array([seen], longs), pa.array([encoder.total[seen]], longs)], names)

    text = F.coalesce(F.make_valid_utf8(F.col(text_col).cast("string")), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), text.alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, row bigint, ids binary, id_seen array<bigint>, n_seen array<bigint>")


def counted(rows: DataFrame) -> dict[int, int]:
    """How often each id occurs; as many entries as the vocabulary has, at most."""
    seen = rows.select(F.explode(F.arrays_zip("id_seen", "n_seen")).alias("s")).groupBy("s.id_seen").agg(F.sum("s.n_seen").alias("n"))
    return {r["id_seen"]: r["n"] for r in seen.collect()}


def write_ids(docs: DataFrame, path: str, spec: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """The ids of all documents in files under ``path``, ascending by id; ``spec`` is the tokenizer's JSON."""
    spark = docs.sparkSession
    rows = written(with_ids(docs, spec, end_id, id_col, text_col), "token-ids", "zstd")
    table = Frequencies.of_counts(counted(rows))
    spark.createDataFrame([(table.bits, i, f) for i, f in zip(table.ids.tolist(), table.freq.tolist())],
                          "bits int, id bigint, freq bigint").coalesce(1).write.parquet(f"{path}/table")
    place = ("doc_id", F.crc32("ids"), "row")  # the row number lets ranges cut through one id
    dealt = rows.filter("ids is not null").select("doc_id", "ids", "row").repartitionByRange(*place).sortWithinPartitions(*place)
    kind = TextEncoder(spec, end_id).kind_of_ids
    dealt.select("doc_id", "ids").mapInArrow(_pack(table, kind), CHUNK_DDL).write.parquet(f"{path}/chunks", compression="none")
    parts = spark.read.schema(CHUNK_DDL).parquet(f"{path}/chunks").groupBy("part").agg(F.sum("n_tokens").alias("n_tokens"))
    ahead = F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    (parts.select("part", (ahead - F.col("n_tokens")).alias("first"), "n_tokens")  # a row for each file
     .coalesce(1).write.parquet(f"{path}/index"))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids (32-bit little endian) from the files."""
    rows = spark.read.schema("bits int, id bigint, freq bigint").parquet(f"{path}/table").orderBy("id").collect()
    table = Frequencies(np.array([r["id"] for r in rows], np.int64), np.array([r["freq"] for r in rows], np.uint64),
                        rows[0]["bits"] if rows else 16)
    chunks = spark.read.schema(CHUNK_DDL).parquet(f"{path}/chunks")
    index = spark.read.schema("part int, first bigint, n_tokens bigint").parquet(f"{path}/index").select("part", "first")
    docs = chunks.mapInArrow(_unpack(table), "part int, doc_id bigint, start bigint, n_tokens bigint, ids binary")
    return docs.join(index, "part").select("doc_id", (F.col("first") + F.col("start")).alias("start"), "n_tokens", "ids")
