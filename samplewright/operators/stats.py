"""Token statistics, next-token model and corpus loss.

The reference's training objective is next-token cross-entropy over labels
that are not -100.  At table level that becomes: causal pairs ``(cur, nxt)``
(P12) filtered by F4, a smoothed bigram model ``(c(a,b) + alpha) / (c(a) + alpha V)``
(A7), and masked mean negative log-likelihood per document or batch (A8, A1).

Scale notes:
* Pair counting is a plain ``groupBy`` with map-side partial aggregation, so
  a hot pair (say ``' ' -> 't'``) is combined before the shuffle.
* Scoring pre-aggregates ``(doc, cur, nxt) -> n`` before touching the model,
  so each distinct pair of a document is joined once however often it occurs.
* The model has at most ``V * V`` rows; Spark picks the join by its measured size.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from samplewright.functions import tokens as T
from samplewright.functions.batches import pieces
from samplewright.session import written

BYTES_VOCAB = 256 + T.BYTE_OFFSET        # 259 ids for the bytes tokenizer
VOCAB_SIZE = 6400                         # vocab tokenizer default (model config)
SMOOTHING = 1.0
MOST_CARRIED = 1 << 20                    # words that tasks may carry
ROOM = 64                                 # counters of a partition for each word wanted
WORD_SPLIT = f"[{T.PY_WHITESPACE}]+"
_OTHER_WHITESPACE = "".join(c for c in T.PY_WHITESPACE_CHARS if c != " ")


def words(text: Column) -> Column:
    """Python ``str.split()``: runs of white space separate, no empty words.

    Every white-space character is first mapped to a space with ``translate``
    (a per-character table lookup), so the split is on a literal single space,
    which avoids a regular expression over the whole text.
    """
    spaced = F.translate(text, _OTHER_WHITESPACE, " " * len(_OTHER_WHITESPACE))
    return F.filter(F.split(spaced, " ", -1), lambda w: w != "")


class Counters:
    """Counts of the most frequent of many words, with a bound on what was let go (Misra-Gries).

    Every true count lies between its counter (0 without one) and that plus ``lost``.
    """

    def __init__(self, room: int):
        self.room, self.count, self.lost = room, Counter(), 0

    def add(self, words: list[str]) -> None:
        self.count.update(words)
        if len(self.count) > 2 * self.room:
            self.shrink()

    def shrink(self) -> None:
        """Keep at most ``room`` words: take from every counter what the first one beyond has."""
        if len(self.count) > self.room:
            sizes = np.fromiter(self.count.values(), np.int64, len(self.count))
            cut = int(np.partition(sizes, len(sizes) - self.room - 1)[len(sizes) - self.room - 1])
            self.count = Counter({w: n - cut for w, n in self.count.items() if n > cut})
            self.lost += cut


def _counters(room: int):
    """Task function: at most ``room`` rows (token, count), and what was let go as the count of the null token."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = Counters(room)
        for part in parts:
            for texts in pieces(part.column(0)):
                for text in texts.to_pylist():
                    kept.add(text.split())
        kept.shrink()
        yield pa.RecordBatch.from_arrays([pa.array([*kept.count, None], pa.string()), pa.array([*kept.count.values(), kept.lost], pa.int64())], ["token", "count"])
    return run


def _counted(candidates: set[str]):
    """Task function: exact counts (token, count) of the candidates."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for part in parts:
            for texts in pieces(part.column(0)):
                for text in texts.to_pylist():
                    total.update(filter(candidates.__contains__, text.split()))
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["token", "count"])
    return run


TOKEN_COUNT = "token string, count bigint"


def word_counts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``token, count`` of every word; all distinct words of a partition are shuffled."""
    return df.select(F.explode(words(T.as_text(F.col(text_col)))).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("count"))


def frequent_words(df: DataFrame, k: int, text_col: str = "text", room: int | None = None) -> DataFrame:
    """``token, count``: exact counts of a set of words that holds the ``k`` most frequent.

    Each partition counts its own words in at most ``room`` counters (``ROOM`` for each of the ``k``),
    so no more rows are shuffled however many words there are.  Where no partition let anything
    go, the sums are the counts.  Otherwise the sums bound every count: what cannot reach the
    kth highest lower bound is no candidate, and a second scan counts the candidates.  Only where
    the bounds are too wide to tell (or leave too many) are all words counted.
    """
    room = room or ROOM * max(k, 1)
    texts = df.select(T.as_text(F.col(text_col)).alias("text"))
    sums = written(texts.mapInArrow(_counters(room), TOKEN_COUNT).groupBy("token").agg(F.sum("count").alias("count")), "word-counters")
    lost = sums.filter("token is null").agg(F.sum("count")).first()[0] or 0
    sums = sums.filter("token is not null")
    if not lost:
        return sums
    best = sums.orderBy(F.desc("count")).limit(k).agg(F.count("*"), F.min("count")).first()
    if best[0] < k or best[1] <= lost:
        return word_counts(df, text_col)
    chosen = sums.filter(F.col("count") + F.lit(lost) >= F.lit(best[1])).select("token")
    if chosen.count() > MOST_CARRIED:
        return word_counts(df, text_col)
    candidates = {r["token"] for r in chosen.collect()}
    return texts.mapInArrow(_counted(candidates), TOKEN_COUNT).groupBy("token").agg(F.sum("count").alias("count"))


def build_vocab(df: DataFrame, text_col: str = "text", vocab_size: int = VOCAB_SIZE) -> DataFrame:
    """The ``vocab_size - 3`` most frequent words get ids ``3..V-1``.

    Ranked by count descending, then word ascending.  The top-k is Spark's
    ``TakeOrderedAndProject`` (each partition keeps ``k`` rows), so nothing
    unbounded reaches one task; the final rank runs over at most ``k`` rows.
    """
    k = vocab_size - T.BYTE_OFFSET
    counts = frequent_words(df, k, text_col)
    top = counts.orderBy(F.col("count").desc(), F.col("token").asc()).limit(k)
    rank = Window.orderBy(F.col("count").desc(), F.col("token").asc())  # over <= k rows
    return top.select("token", (F.row_number().over(rank) + T.BYTE_OFFSET - 1).cast("int").alias("id"),
                      F.col("count").cast("bigint").alias("count"))


def vocab_encode(df: DataFrame, vocab: DataFrame, id_col: str = "doc_id",
                 text_col: str = "text", carry: int = MOST_CARRIED) -> DataFrame:
    """Word -> id; unknown -> 0.  Returns ``id_col, ids`` with ids in word order.

    A vocabulary of at most ``carry`` words goes to the tasks and words stay in their row, so
    nothing is shuffled; words meet a larger one in a join.
    """
    vocab = vocab.select("token", F.col("id").cast("int").alias("id"))
    known = {r["token"]: r["id"] for r in vocab.limit(carry + 1).collect()}
    if len(known) > carry:
        return _joined_ids(df, vocab, id_col, text_col)

    @F.arrow_udf("array<int>")
    def ids_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for texts in pieces(batch):
                yield pa.array([[known.get(w, T.PAD_ID) for w in text.split()] for text in texts.to_pylist()], pa.list_(pa.int32()))

    return df.select(id_col, ids_of(T.as_text(F.col(text_col))).alias("ids"))


def _joined_ids(df: DataFrame, vocab: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = written(df.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_id"), words(T.as_text(F.col(text_col))).alias("_w")), "words")
    met = rows.select("_row", F.posexplode("_w").alias("_pos", "token")).join(vocab, "token", "left")
    ids = met.groupBy("_row").agg(F.transform(F.array_sort(F.collect_list(F.struct("_pos", F.coalesce("id", F.lit(T.PAD_ID)).alias("id")))),
                                              lambda x: x["id"]).alias("ids"))
    return rows.join(ids, "_row", "left").select(F.col("_id").alias(id_col), F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))


def supervised_pairs(pairs: DataFrame) -> DataFrame:
    """keep positions whose target label is not -100."""
    return pairs.filter(F.col("nxt") != T.IGNORE_INDEX)


def pair_counts(pairs: DataFrame, group_cols: list[str] | None = None) -> DataFrame:
    """``group_cols, cur, nxt, n``: pairs counted per group (map-side combined)."""
    return pairs.groupBy(*(group_cols or []), "cur", "nxt").agg(F.count(F.lit(1)).alias("n"))


def fit_bigram(pairs: DataFrame | None = None, vocab_size: int = BYTES_VOCAB, alpha: float = SMOOTHING,
               counts: DataFrame | None = None) -> DataFrame:
    """``cur, nxt, pair_count, cur_count, prob, logp`` for every observed pair.

    Built from raw pairs or from already grouped ``counts`` (``cur, nxt, n`` per any
    grouping), so a pipeline that also scores per document reads its pairs once.
    ``cur_count`` is derived from the pair counts (at most ``V`` rows, joined by their size).
    """
    if counts is None:
        counts = pair_counts(pairs)
    pc = counts.groupBy("cur", "nxt").agg(F.sum("n").cast("bigint").alias("pair_count"))
    cc = pc.groupBy("cur").agg(F.sum("pair_count").cast("bigint").alias("cur_count"))
    model = pc.join(cc, "cur")
    prob = (F.col("pair_count") + F.lit(alpha)) / (F.col("cur_count") + F.lit(alpha * vocab_size))
    return model.select("cur", "nxt", "pair_count", "cur_count", prob.alias("prob"), F.log(prob).alias("logp"))


def score_counts(per: DataFrame, model: DataFrame, group_cols: list[str],
                 vocab_size: int = BYTES_VOCAB, alpha: float = SMOOTHING) -> DataFrame:
    """A8 on grouped counts ``group_cols, cur, nxt, n``: ``group_cols, n_tokens, sum_nll``.

    Unseen pairs get ``alpha``; unseen contexts the uniform ``1 / V``.
    """
    pair_side = model.select("cur", "nxt", "pair_count")
    uni_side = model.select("cur", "cur_count").distinct()
    scored = per.join(pair_side, ["cur", "nxt"], "left").join(uni_side, ["cur"], "left")
    prob = (F.coalesce("pair_count", F.lit(0)) + F.lit(alpha)) / \
           (F.coalesce("cur_count", F.lit(0)) + F.lit(alpha * vocab_size))
    return scored.groupBy(*group_cols).agg(
        F.sum("n").cast("bigint").alias("n_tokens"),
        F.sum(F.when(F.col("n") > 0, -F.log(prob) * F.col("n"))).alias("sum_nll"))


def score_pairs(pairs: DataFrame, model: DataFrame, group_cols: list[str],
                vocab_size: int = BYTES_VOCAB, alpha: float = SMOOTHING) -> DataFrame:
    """``group_cols, n_tokens, sum_nll`` of every group of ``pairs``.

    F4 applies inside: a pair whose target is -100 counts for nothing, and a group of
    such pairs alone has ``n_tokens`` 0 and a NULL sum.  Pairs are counted per
    ``(group, cur, nxt)`` first, so a hot pair is one row per group at the join.
    """
    labelled = F.when(F.col("nxt") != T.IGNORE_INDEX, F.col("nxt"))
    counts = pairs.withColumn("nxt", labelled).groupBy(*group_cols, F.when(F.col("nxt").isNotNull(), F.col("cur")).alias("cur"), "nxt").agg(
        F.count("nxt").alias("n"))
    return score_counts(counts, model, group_cols, vocab_size, alpha)


def masked_mean(sum_nll: Column, n_tokens: Column) -> Column:
    """A1: token-weighted mean; NULL when no label takes part (the reference gives NaN)."""
    return F.when(n_tokens > 0, sum_nll / n_tokens)
