"""Spelling variants by blocked Gram matrices (operator 11).

Words are counted over all texts.  Words that one edit can join have letter counts at a
squared distance of at most two, in the same or adjacent lengths: a replaced letter moves one
count, an inserted or deleted one changes one count.  So words fall into blocks by length and by
the counts of ``GROUPS`` groups of letters, and a block has to meet only itself and the few
blocks that one edit leads to.  Where they meet, a NumPy product of the two blocks' letter
counts gives all squared distances at once; pairs at most two apart are compared letter by
letter, and those exactly one edit apart are kept.

A block of more than ``BLOCK`` words is cut into parts by a hash of the word, each met by all
words that have to meet the block, so no task holds more than a part and one slice of the others.
Only true pairs leave a task.

A word's form is its most frequent near word, if that is frequent enough; forms are followed
to the last by joins that double the distance each round (written tables, a round for each
doubling of the longest chain, which is logarithmic in the largest count).

Defined results: a null text has no words; a null id counts as the empty string in the noise
hash; repeated rows count repeatedly; an empty table has no words; words of equal count are
ordered by code points; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samplewright.llm.common import mix, written

RUN = "[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LENGTH = 6
LEAST_COUNT = 5
RATIO = 5
#: One run in this many loses a code point.
NOISE = 199
#: Groups of letters (code point modulo GROUPS) whose counts, with the length, name a block.
GROUPS = 6
#: Words of a block's part, and words or letters of a slice that meets it.
BLOCK = 1024
SLICE = 1024
LETTERS = 1 << 22


def code_points(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All code points of the words, and each word's first place among them."""
    points = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), np.uint32)
    return points, np.concatenate([[0], np.cumsum(pc.utf8_length(words).to_numpy(zero_copy_only=False), dtype=np.int64)])


def _weights() -> np.ndarray:
    """An odd factor for each group; the sum of count times factor names the counts."""
    return mix(np.arange(1, GROUPS + 1, dtype=np.uint64)) | np.uint64(1)


def _dealt(visits: bool):
    """Task function: each word once at home, in its own block, and with ``visits`` once for each block that one edit may lead to.

    Of two blocks of one length only one's words visit the other; longer words visit shorter ones.
    """
    w, none = _weights(), np.uint64(0)
    moves = [(none, 0, None)]  # how the block's name and length change, and the group that loses a letter
    if visits:
        with np.errstate(over="ignore"):
            moves += [(w[j] - w[i], 0, i) for i in range(GROUPS) for j in range(i + 1, GROUPS)]
            moves += [(none - w[i], -1, i) for i in range(GROUPS)]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            yield from _places(part, w, moves)
    return run


def _places(part: pa.RecordBatch, w: np.ndarray, moves: list) -> Iterator[pa.RecordBatch]:
    words, n = part.column(0).cast(pa.string()), part.column(1)
    points, ends = code_points(words)
    size = np.diff(ends)
    owner = np.repeat(np.arange(len(words)), size)
    counts = np.bincount(owner * GROUPS + points % GROUPS, minlength=len(words) * GROUPS).reshape(-1, GROUPS)
    name = (counts.astype(np.uint64) * w).sum(axis=1, dtype=np.uint64)
    for offset, longer, loses in moves:
        rows = np.arange(len(words)) if loses is None else np.flatnonzero(counts[:, loses])
        yield pa.RecordBatch.from_arrays(
            [pa.array((size[rows] + longer).astype(np.int32)), pa.array((name[rows] + offset).view(np.int64)),
             pa.array(np.full(len(rows), loses is None)), words.take(pa.array(rows)), n.take(pa.array(rows))], ["length", "block", "home", "word", "n"])


class Words:
    """Words of one length as a matrix of code points, and their counts of the letters in ``alphabet``."""

    def __init__(self, points: np.ndarray, starts: np.ndarray, length: int):
        self.points = points[starts[:, None] + np.arange(length)]

    def letters(self, alphabet: np.ndarray) -> np.ndarray:
        rows, length = self.points.shape
        at = np.searchsorted(alphabet, self.points) + np.arange(rows)[:, None] * len(alphabet)
        kind = np.float32 if length < 2048 else np.float64  # sums of products stay exact
        return np.bincount(at.ravel(), minlength=rows * len(alphabet)).reshape(rows, -1).astype(kind)


def near_pairs(home: Words, other: Words, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows (home, other) exactly one edit apart; ``other`` has the same length or one code point more.

    ``same`` says that both are the same words: each pair then comes once.
    """
    alphabet = np.unique(np.concatenate([home.points.ravel(), other.points.ravel()]))
    a, b = home.letters(alphabet), other.letters(alphabet)
    distance = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * (a @ b.T)
    i, j = np.nonzero((distance <= 2) & (distance > 0))
    if same:
        i, j = i[i < j], j[i < j]
    length, step = home.points.shape[1], max(1, LETTERS // max(home.points.shape[1], 1))
    good = np.zeros(len(i), bool)
    for k in range(0, len(i), step):
        x, y = home.points[i[k:k + step]], other.points[j[k:k + step]]
        if y.shape[1] == length:
            good[k:k + step] = (x != y).sum(axis=1) == 1
        else:  # the same up to some place, and one further on from there
            front = np.cumprod(x == y[:, :-1], axis=1).sum(axis=1)
            back = np.cumprod((x == y[:, 1:])[:, ::-1], axis=1).sum(axis=1)
            good[k:k + step] = front + back >= length
    return i[good], j[good]


def _met(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function: (word, near, near_n) both ways, from rows sorted by block and part, those at home first."""
    place, home, home_words, home_n = None, None, None, None
    for batch in parts:
        length, block, part, at_home = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(4))
        words, n = batch.column(4).cast(pa.string()), batch.column(5)
        points, ends = code_points(words)
        turn = np.flatnonzero((length[1:] != length[:-1]) | (block[1:] != block[:-1]) | (part[1:] != part[:-1]) | (at_home[1:] != at_home[:-1])) + 1
        found = []
        for a, b in zip([0, *turn.tolist()], [*turn.tolist(), len(batch)]):
            here = (length[a], block[a], part[a])
            size = int(length[a])
            if at_home[a]:
                mine = Words(points, ends[a:b], size)
                if place == here:  # a part that goes on from the batch before
                    i, j = near_pairs(home, mine, False)
                    found.append((home_words.take(pa.array(i)), home_n.take(pa.array(i)), words.slice(a, b - a).take(pa.array(j)), n.slice(a, b - a).take(pa.array(j))))
                    home.points = np.concatenate([home.points, mine.points])
                    home_words = pa.concat_arrays([home_words, words.slice(a, b - a)])
                    home_n = pa.concat_arrays([home_n, n.slice(a, b - a)])
                else:
                    place, home, home_words, home_n = here, mine, words.slice(a, b - a), n.slice(a, b - a)
                if b - a > 1:
                    i, j = near_pairs(mine, mine, True)
                    found.append((words.take(pa.array(a + i)), n.take(pa.array(a + i)), words.take(pa.array(a + j)), n.take(pa.array(a + j))))
            elif place == here:
                own = np.diff(ends[a:b + 1])
                for longer in (0, 1):
                    rows = a + np.flatnonzero(own == size + longer)
                    step = max(1, min(SLICE, LETTERS // max(size, 1)))
                    for s in range(0, len(rows), step):
                        some = rows[s:s + step]
                        i, j = near_pairs(home, Words(points, ends[some], size + longer), False)
                        if len(i):
                            found.append((home_words.take(pa.array(i)), home_n.take(pa.array(i)), words.take(pa.array(some[j])), n.take(pa.array(some[j]))))
        if found:
            x, x_n, y, y_n = (pa.concat_arrays(c) for c in zip(*found))
            yield pa.RecordBatch.from_arrays([pa.concat_arrays([x, y]), pa.concat_arrays([y, x]), pa.concat_arrays([y_n, x_n])], ["word", "near", "near_n"])


def without_point(word: Column, draw: Column, noise: int = NOISE) -> Column:
    """``word`` without one code point if ``noise`` divides ``draw``, which also chooses the place."""
    length = F.char_length(word)
    at = F.pmod(draw, length).cast("int")
    cut = F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, length))
    return F.when(F.pmod(draw, F.lit(noise)) == 0, cut).otherwise(word)


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, noise: int = NOISE,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n: words of all texts that are long and frequent enough, after the noise."""
    runs = F.regexp_extract_all(F.col(text_col), F.lit(f"{RUN}{{{least_length},}}"), F.lit(0))
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("doc"), F.explode(runs).alias("run"))
    rows = rows.withColumn("run", F.translate("run", UPPER, LOWER))
    draw = F.crc32(F.encode(F.concat("doc", F.lit(":"), "run"), "UTF-8"))
    words = rows.select(without_point(F.col("run"), draw, noise).alias("word")).filter(F.char_length("word") >= least_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least_count)


def near_words(words: DataFrame) -> DataFrame:
    """word, near, near_n: all pairs of distinct words one edit apart, both ways; ``words`` is written (word, n)."""
    kind = "length int, block bigint, home boolean, word string, n bigint"
    sizes = words.select("word", "n").mapInArrow(_dealt(False), kind).groupBy("length", "block").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("cuts"))
    crowded = written(sizes.filter("cuts > 1"), "spelling-crowded")  # written, so that its size is known before the join is planned
    rows = words.select("word", "n").mapInArrow(_dealt(True), kind).join(crowded, ["length", "block"], "left").withColumn("cuts", F.coalesce("cuts", F.lit(1)))
    own = F.pmod(F.xxhash64("word"), "cuts").cast("int")
    later = F.when(own + 1 < F.col("cuts"), F.sequence(own + 1, F.col("cuts") - 1)).otherwise(F.array().cast("array<int>"))
    visits = F.when(F.col("home"), later).otherwise(F.sequence(F.lit(0), F.col("cuts") - 1))
    entries = F.concat(F.when(F.col("home"), F.array(F.struct(own.alias("part"), F.lit(True).alias("home"))))
                       .otherwise(F.array().cast("array<struct<part:int,home:boolean>>")),
                       F.transform(visits, lambda p: F.struct(p.alias("part"), F.lit(False).alias("home"))))
    entries = F.when((F.col("cuts") == 1), F.array(F.struct(F.lit(0).alias("part"), F.col("home").alias("home")))).otherwise(entries)
    dealt = rows.select("length", "block", F.explode(entries).alias("e"), "word", "n").select("length", "block", "e.part", "e.home", "word", "n")
    dealt = dealt.repartition("length", "block", "part").sortWithinPartitions("length", "block", "part", F.desc("home"))
    return dealt.mapInArrow(_met, "word string, near string, near_n bigint")


def variants(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, ratio: int = RATIO, noise: int = NOISE,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, form, root, n, n_near, form_n: every word, the word it is a variant of, and the last of that chain."""
    words = written(word_counts(docs, least_length, least_count, noise, id_col, text_col), "spelling-words")
    best = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("top"))
    rows = words.join(best, "word", "left").withColumn("n_near", F.coalesce("n_near", F.lit(0).cast("long")))
    follows = -F.col("top.m") >= ratio * F.col("n")
    rows = written(rows.select("word", "n", "n_near", F.when(follows, F.col("top.near")).alias("form"),
                               F.when(follows, -F.col("top.m")).alias("form_n")), "spelling-forms")
    links = rows.filter("form is not null").select("word", F.col("form").alias("root"))
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = links.join(ahead, "root", "left")
        links = written(step.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        if not links.filter("moved").head(1):
            break
        links = links.select("word", "root")
    roots = links.select("word", "root")
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
