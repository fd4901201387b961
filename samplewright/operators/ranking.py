"""Candidate ranking over a next-token table (G1-G6) and batch replies.

The next-token table comes from ``stats.fit_bigram``: for every context token
``cur`` a smoothed distribution over all ``V`` next tokens.  Logits are the
log-probabilities.  Processing order follows the generation library the
reference calls: repetition penalty, then temperature, top-k, top-p, draw.

Scale notes: the dense table has ``V * V`` rows (67,081 for the ``bytes`` tokenizer),
one row of ``V`` logits per context once grouped; Spark broadcasts it where its
measured size allows, and splits the hot context otherwise (all prompts end in the
same token).  Per prompt work is bounded by ``V`` candidates and ``max_new_tokens``
steps.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from samplewright.functions import tokens as T
from samplewright.operators import stats as ST
from samplewright.session import written

# ---------------------------------------------------------------------------
# The reference's generation settings and the library defaults.
TEMPERATURE = 0.7
TOP_P = 0.9
TOP_K = 50
REPETITION_PENALTY = 1.05
MAX_NEW_TOKENS = 128
# ---------------------------------------------------------------------------
#: Largest model that a task carries, and what one observed pair takes in it.
CARRY_BYTES = 64 << 20
ENTRY_BYTES = 12
#: Scores that a task holds at once, and prompts that wait for one copy of a context's row.
CELLS = 1 << 20
GROUP = 4096


def dense_model(model: DataFrame, vocab_size: int = ST.BYTES_VOCAB,
                alpha: float = ST.SMOOTHING) -> DataFrame:
    """Every ``(cur, nxt)`` of the observed contexts with its smoothed log-probability.

    Generated per context with ``explode(sequence(0, V - 1))`` (``V`` rows per
    context) and completed from the observed pairs by a left join.
    """
    ctx = model.select("cur", "cur_count").distinct()
    grid = ctx.select("cur", "cur_count", F.explode(F.sequence(F.lit(0), F.lit(vocab_size - 1))).alias("nxt"))
    j = grid.join(model.select("cur", "nxt", "pair_count"), ["cur", "nxt"], "left")
    prob = (F.coalesce("pair_count", F.lit(0)) + F.lit(alpha)) / (F.col("cur_count") + F.lit(alpha * vocab_size))
    return j.select("cur", "nxt", F.log(prob).alias("logit"))


def greedy_next(model: DataFrame) -> DataFrame:
    """G1: most likely next token per context (ties to the lower id)."""
    best = F.max_by(F.struct("nxt", "prob"), F.struct("pair_count", (-F.col("nxt")).alias("neg")))
    return model.groupBy("cur").agg(best.alias("b")).select("cur", F.col("b.nxt").alias("nxt"),
                                                             F.col("b.prob").alias("prob"))


def penalize(logit: Column, seen: Column, penalty: float = REPETITION_PENALTY) -> Column:
    """A token already present gets ``s / r`` if ``s > 0`` else ``s * r``."""
    return F.when(seen, F.when(logit > 0, logit / F.lit(penalty)).otherwise(logit * F.lit(penalty))) \
            .otherwise(logit)


def ranked_scores(scores: Column, temperature: float = 1.0) -> Column:
    """``ARRAY<STRUCT<neg, nxt, s>>`` of an id-indexed score array, best first (ties to the lower id)."""
    return F.array_sort(F.transform(scores, lambda x, i: F.struct(
        (-(x / F.lit(temperature))).alias("neg"), i.alias("nxt"), (x / F.lit(temperature)).alias("s"))))


def nucleus_array(scores: Column, temperature: float = TEMPERATURE, top_k: int = TOP_K,
                  top_p: float = TOP_P) -> Column:
    """G2 + G3b + G3 on an id-indexed score array: ``ARRAY<STRUCT<nxt, rank, prob>>``.

    Temperature, the ``top_k`` best (ties to the lower id), softmax over them with
    the maximum subtracted, the prefix whose strictly-better mass stays below
    ``top_p`` (never empty), renormalised.  Every intermediate is bound once.
    """
    def with_top(t):
        e_of = F.transform(t, lambda x: F.exp(x["s"] - F.element_at(t, 1)["s"]))
        return T.let(e_of, lambda e: T.let(F.aggregate(e, F.lit(0.0), lambda a, y: a + y), lambda z: T.let(
            F.transform(e, lambda x: x / z), lambda q: T.let(
                F.aggregate(q, F.struct(F.array().cast("array<double>").alias("out"), F.lit(0.0).alias("run")),
                            lambda acc, x: F.struct(F.concat(acc["out"], F.array(acc["run"])).alias("out"),
                                                    (acc["run"] + x).alias("run")))["out"],
                lambda better: T.let(
                    F.filter(F.transform(q, lambda x, i: F.struct(
                        F.element_at(t, i + 1)["nxt"].alias("nxt"), (i + 1).alias("rank"), x.alias("q"),
                        F.element_at(better, i + 1).alias("b"))), lambda c: c["b"] < F.lit(top_p)),
                    lambda kept: T.let(F.aggregate(kept, F.lit(0.0), lambda a, c: a + c["q"]), lambda tot: F.transform(
                        kept, lambda c: F.struct(c["nxt"].alias("nxt"), c["rank"].alias("rank"),
                                                 (c["q"] / tot).alias("prob")))))))))

    return T.let(F.slice(ranked_scores(scores, temperature), 1, top_k), with_top)


def nucleus_arrays(df: DataFrame, keys: list[str], scores_col: str, temperature: float = TEMPERATURE,
                   top_k: int = TOP_K, top_p: float = TOP_P) -> DataFrame:
    """``nucleus`` without exploding the ``V`` candidates or any window: rows ``keys, nxt, rank, prob``."""
    kept = df.select(*keys, F.explode(nucleus_array(F.col(scores_col), temperature, top_k, top_p)).alias("_c"))
    return kept.select(*keys, F.col("_c.nxt").alias("nxt"), F.col("_c.rank").alias("rank"),
                       F.col("_c.prob").alias("prob"))


def presence(seen: Column, vocab_size: int) -> Column:
    """For each id below ``vocab_size`` whether it is in the sorted array ``seen``: runs of absent ids between present ones."""
    inside = F.coalesce(F.filter(seen, lambda t: (t >= 0) & (t < vocab_size)), F.array().cast("array<int>"))

    def flags(ids: Column) -> Column:
        runs = F.transform(ids, lambda t, i: F.concat(F.array_repeat(F.lit(False), t - F.coalesce(F.get(ids, i - 1), F.lit(-1)) - 1), F.array(F.lit(True))))
        return F.concat(F.flatten(runs), F.array_repeat(F.lit(False), F.lit(vocab_size - 1) - F.coalesce(F.try_element_at(ids, F.lit(-1)), F.lit(-1))))

    return T.let(inside, flags)


def penalized_scores(prompts: DataFrame, contexts: DataFrame, keys: list[str],
                     ids_col: str = "prompt_ids", penalty: float = REPETITION_PENALTY,
                     vocab_size: int = ST.BYTES_VOCAB) -> DataFrame:
    """G4 per prompt as an id-indexed array ``scores`` over all ``V`` next tokens of its last token.

    The penalty is applied on the context's logit array inside each prompt row.  A
    prompt whose last token the model has never seen gets the uniform row, as does
    one without tokens.
    """
    p = prompts.select(*keys, F.array_sort(F.array_distinct(ids_col)).alias("_seen"),
                       F.try_element_at(F.col(ids_col), F.lit(-1)).alias("cur"))
    uniform = F.array_repeat(F.lit(-math.log(vocab_size)), vocab_size)
    j = p.join(contexts, "cur", "left").withColumn("logits", F.coalesce("logits", uniform))
    return j.select(*keys, F.zip_with("logits", presence(F.col("_seen"), vocab_size), lambda lp, seen: penalize(
        lp, seen, penalty)).alias("scores"))


def all_candidates(df: DataFrame, keys: list[str], scores_col: str) -> DataFrame:
    """Every ``(nxt, score)`` of an id-indexed score array per row, as rows with ``rank`` from 1."""
    out = df.select(*keys, F.posexplode(ranked_scores(F.col(scores_col))).alias("_i", "_t"))
    return out.select(*keys, (F.col("_i") + 1).alias("rank"), F.col("_t.nxt").alias("nxt"),
                      F.col("_t.s").alias("score"))


def draw_array(candidates: Column, u: Column) -> Column:
    """The first candidate, in rank order, whose cumulative probability exceeds ``u``.

    ``u`` is a deterministic uniform (hash of seed and keys), so a rerun draws the
    same token.  Falls back to the last kept candidate if rounding leaves the total
    just below ``u``.
    """
    zero = F.struct(F.lit(0.0).alias("run"), F.lit(None).cast("int").alias("nxt"))

    def step(acc: Column, c: Column) -> Column:
        run = acc["run"] + c["prob"]
        return F.struct(run.alias("run"), F.when(acc["nxt"].isNull() & (run > u), c["nxt"].cast("int"))
                        .otherwise(acc["nxt"]).alias("nxt"))

    return F.coalesce(F.aggregate(candidates, zero, step, lambda acc: acc["nxt"]),
                      F.element_at(candidates, -1)["nxt"].cast("int"))


def context_rows(dense: DataFrame) -> DataFrame:
    """``cur, logits``: one row per context with its ``V`` next-token logits in id order.

    At most ``V`` rows of ``V`` doubles; joined to prompts by the context token.
    """
    return dense.groupBy("cur").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("nxt", "logit"))), lambda x: x["logit"]).alias("logits"))


def context_lists(model: DataFrame, vocab_size: int = ST.BYTES_VOCAB, alpha: float = ST.SMOOTHING) -> DataFrame:
    """``cur, nxt, logits, rest``: per context its observed next tokens, their logits, and the logit of all others.

    A row has at most ``V`` entries, one for each observed pair.
    """
    scale = F.col("cur_count") + F.lit(alpha * vocab_size)
    entry = F.struct("nxt", F.log((F.col("pair_count") + F.lit(alpha)) / scale).alias("logit"))
    rows = model.groupBy("cur").agg(F.array_sort(F.collect_list(entry)).alias("e"), F.first(F.log(F.lit(alpha) / scale)).alias("rest"))
    return rows.select(F.col("cur").cast("int").alias("cur"), F.transform("e", lambda x: x["nxt"].cast("int")).alias("nxt"),
                       F.transform("e", lambda x: x["logit"]).alias("logits"), "rest")


@dataclass(frozen=True)
class Decoding:
    """How the next token is chosen: G4, then G1 for ``temperature <= 0`` or G2, G3b, G3 and G5."""

    vocab_size: int
    seed: int
    temperature: float
    top_k: int
    top_p: float
    penalty: float

    def draws(self, keys: list[str], step: int) -> np.ndarray | None:
        """A uniform draw for each prompt, the hash of seed, step and key; none are needed for the best token."""
        if self.temperature <= 0:
            return None
        return np.array([int(hashlib.md5(f"{self.seed}|{step}|{k}".encode()).hexdigest()[:8], 16) for k in keys]) / 4294967296.0

    def choose(self, scores: np.ndarray, seen: np.ndarray, u: np.ndarray | None) -> np.ndarray:
        """The next token of each row of ``scores`` (overwritten), ties to the lower id."""
        old = scores[seen]
        scores[seen] = np.where(old > 0, old / self.penalty, old * self.penalty)
        if u is None:
            return scores.argmax(axis=1)
        rows, k = len(scores), min(self.top_k, scores.shape[1])
        edge = np.partition(scores, scores.shape[1] - k, axis=1)[:, [scores.shape[1] - k]]
        over, level = scores > edge, scores == edge
        room = k - over.sum(axis=1)[:, None]
        best = np.nonzero(over | level & (np.cumsum(level, axis=1) <= room))[1].reshape(rows, k)
        s = np.take_along_axis(scores, best, axis=1)
        order = np.argsort(-s, axis=1, kind="stable")
        best, s = np.take_along_axis(best, order, axis=1), np.take_along_axis(s, order, axis=1)
        q = np.exp((s - s[:, :1]) / self.temperature)
        q /= q.sum(axis=1)[:, None]
        better = np.concatenate([np.zeros((rows, 1)), np.cumsum(q, axis=1)[:, :-1]], axis=1)
        kept = better < self.top_p
        q = np.where(kept, q, 0)
        passed = kept & (np.cumsum(q / q.sum(axis=1)[:, None], axis=1) > u[:, None])
        place = np.where(passed.any(axis=1), passed.argmax(axis=1), kept.sum(axis=1) - 1)
        return best[np.arange(rows), place]


def _seen(lists: list, vocab_size: int) -> np.ndarray:
    seen = np.zeros((len(lists), vocab_size), bool)
    sizes = [len(x) for x in lists]
    seen[np.repeat(np.arange(len(lists)), sizes), np.fromiter((t for x in lists for t in x), np.int64, sum(sizes))] = True
    return seen


class Carried:
    """A whole model in a task: contexts sorted, their next tokens and logits one after the other."""

    def __init__(self, lists: pa.Table, vocab_size: int):
        self.cur = lists["cur"].to_numpy()
        self.ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists["nxt"]).to_numpy())]).astype(np.int64)
        self.nxt, self.logits = (pc.list_flatten(lists[c]).to_numpy() for c in ("nxt", "logits"))
        self.rest, self.vocab_size = lists["rest"].to_numpy(), vocab_size

    def rows(self, last: np.ndarray) -> np.ndarray:
        """The ``V`` logits of each context; one that was never seen is uniform."""
        out = np.full((len(last), self.vocab_size), -math.log(self.vocab_size))
        if len(self.cur):
            place = np.minimum(np.searchsorted(self.cur, last), len(self.cur) - 1)
            for i in np.flatnonzero(self.cur[place] == last).tolist():
                a, b = self.ends[place[i]], self.ends[place[i] + 1]
                out[i] = self.rest[place[i]]
                out[i, self.nxt[a:b]] = self.logits[a:b]
        return out


def continuations(last: np.ndarray, seen: np.ndarray, keys: list[str], model: Carried, how: Decoding, max_new_tokens: int, eos_id: int) -> list[list[int]]:
    """New tokens after each prompt's ``last`` (-1 without any) until EOS (left out) or ``max_new_tokens``, all prompts a step at a time."""
    out, going = [[] for _ in keys], np.arange(len(keys))
    for step in range(max_new_tokens):
        nxt = how.choose(model.rows(last[going]), seen[going], how.draws([keys[i] for i in going], step))
        going, nxt = going[nxt != eos_id], nxt[nxt != eos_id]
        if not len(going):
            break
        last[going], seen[going, nxt] = nxt, True
        for i, t in zip(going.tolist(), nxt.tolist()):
            out[i].append(t)
    return out


def _carried_replies(prompts: DataFrame, key: Column, ids_col: str, model: Carried, how: Decoding, max_new_tokens: int, eos_id: int) -> DataFrame:
    room = max(1, CELLS // how.vocab_size)

    @F.arrow_udf("array<int>")
    def reply(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for key, last, ids in batches:
            for a in range(0, max(len(key), 1), room):
                keys, lists = key.slice(a, room).to_pylist(), ids.slice(a, room)
                seen = _seen(lists.to_pylist(), how.vocab_size)
                out = continuations(last.slice(a, room).to_numpy(zero_copy_only=False).astype(np.int64), seen, keys, model, how, max_new_tokens, eos_id)
                yield pa.array(out, pa.list_(pa.int32()))

    ids = F.coalesce(ids_col, F.array().cast("array<int>"))
    return prompts.withColumn("new_ids", reply(key, F.coalesce(F.try_element_at(ids, F.lit(-1)), F.lit(-1)), F.array_distinct(ids)))


STEP_SCHEMA = "_row bigint, _key string, _seen array<int>, new_ids array<int>, cur int, done boolean"


def _superstep(how: Decoding, step: int, last_step: bool, eos_id: int):
    """Task function: one more token for every prompt; a context's row comes before the prompts that wait for it."""
    room = max(1, CELLS // how.vocab_size)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, logits = None, None
        for batch in parts:
            cur, cut, is_prompt = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(3))
            turn = np.flatnonzero((cur[1:] != cur[:-1]) | (cut[1:] != cut[:-1]) | (is_prompt[1:] != is_prompt[:-1])) + 1
            for a, b in zip([0, *turn.tolist()], [*turn.tolist(), len(batch)]):
                here = (cur[a], cut[a])
                if place != here:
                    place, logits = here, np.full(how.vocab_size, -math.log(how.vocab_size))
                if not is_prompt[a]:
                    logits[:] = batch.column(9)[a].as_py()
                    logits[batch.column(7)[a].as_py()] = batch.column(8)[a].as_py()
                    continue
                for i in range(a, b, room):
                    part = batch.slice(i, min(room, b - i))
                    row, keys, seen, new = (part.column(c).to_pylist() for c in range(3, 7))
                    nxt = how.choose(np.tile(logits, (len(part), 1)), _seen(seen, how.vocab_size), how.draws(keys, step)).tolist()
                    ended = [t == eos_id for t in nxt]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(row, pa.int64()), pa.array(keys, pa.string()),
                         pa.array([s if t in s else s + [t] for s, t in zip(seen, nxt)], pa.list_(pa.int32())),
                         pa.array([x if e else x + [t] for x, t, e in zip(new, nxt, ended)], pa.list_(pa.int32())),
                         pa.array(nxt, pa.int32()), pa.array([e or last_step for e in ended])],
                        ["_row", "_key", "_seen", "new_ids", "cur", "done"])
    return run


def _routed_replies(prompts: DataFrame, key: Column, ids_col: str, contexts: DataFrame, how: Decoding, max_new_tokens: int, eos_id: int) -> DataFrame:
    """Replies by supersteps: in each round every unfinished prompt goes to the partition that holds its context's row.

    A round is one written table.  Only the rows of contexts that some prompt waits for move; a
    context that more than ``GROUP`` prompts wait for is cut, its row copied to each part.
    """
    prompts = written(prompts.withColumn("_row", F.monotonically_increasing_id()), "reply-prompts")
    ids, none = F.coalesce(ids_col, F.array().cast("array<int>")), F.array().cast("array<int>")
    state = prompts.select("_row", key.alias("_key"), F.array_distinct(ids).alias("_seen"), none.alias("new_ids"),
                           F.coalesce(F.try_element_at(ids, F.lit(-1)), F.lit(-1)).cast("int").alias("cur"), F.lit(max_new_tokens <= 0).alias("done"))
    state, finished = written(state, "reply-round"), []
    for step in range(max_new_tokens + 1):
        finished.append(state.filter("done").select("_row", "new_ids"))
        waiting = state.filter("not done")
        if step == max_new_tokens or not waiting.head(1):
            break
        crowds = waiting.groupBy("cur").agg(F.ceil(F.count("*") / GROUP).cast("int").alias("cuts")).filter("cuts > 1").collect()
        cuts = F.lit(1)
        for r in crowds:  # at most one for each context and GROUP prompts
            cuts = F.when(F.col("cur") == r["cur"], F.lit(r["cuts"])).otherwise(cuts)
        rows = contexts.join(waiting.select("cur").distinct(), "cur", "left_semi").withColumn("cut", F.explode(F.sequence(F.lit(0), cuts - 1)))
        asks = waiting.withColumn("cut", F.pmod(F.xxhash64("_row"), cuts).cast("int")).withColumn("prompt", F.lit(True)).drop("done")
        both = asks.unionByName(rows.withColumn("prompt", F.lit(False)), allowMissingColumns=True)
        dealt = both.repartition("cur", "cut").sortWithinPartitions("cur", "cut", "prompt").select(
            "cur", "cut", "prompt", "_row", "_key", "_seen", "new_ids", "nxt", "logits", "rest")
        state = written(dealt.mapInArrow(_superstep(how, step, step + 1 == max_new_tokens, eos_id), STEP_SCHEMA), "reply-round")
    replies = reduce(DataFrame.unionByName, finished)
    return prompts.join(replies, "_row").drop("_row")


def generate(prompts: DataFrame, model: DataFrame, keys: list[str], ids_col: str = "prompt_ids", seed: int = 42,
             temperature: float = TEMPERATURE, top_k: int = TOP_K, top_p: float = TOP_P,
             penalty: float = REPETITION_PENALTY, max_new_tokens: int = MAX_NEW_TOKENS,
             vocab_size: int = ST.BYTES_VOCAB, alpha: float = ST.SMOOTHING, eos_id: int = T.EOS_ID,
             carry_bytes: int = CARRY_BYTES) -> DataFrame:
    """U2 + G1-G6: ``prompts`` with ``new_ids``, the model's continuation of every prompt.

    A model (``stats.fit_bigram``) of at most ``carry_bytes`` goes to the tasks whole, and all
    prompts of a batch take a step together; prompts go to a larger one in supersteps, one
    written table a token.  Both give the same ids.  The draw of step ``i`` is the hash of
    ``seed``, ``i`` and the prompt's keys, so reruns agree; ``temperature <= 0`` takes the best
    token instead.  Null ids count as no tokens; a context never seen is uniform.
    """
    how = Decoding(vocab_size, seed, temperature, top_k, top_p, penalty)
    key = F.concat_ws(":", *[F.col(k).cast("string") for k in keys])
    contexts = written(context_lists(model, vocab_size, alpha), "reply-model")
    entries = contexts.agg(F.sum(F.size("nxt"))).first()[0] or 0
    if entries * ENTRY_BYTES > carry_bytes:
        return _routed_replies(prompts, key, ids_col, contexts, how, max_new_tokens, eos_id)
    return _carried_replies(prompts, key, ids_col, Carried(contexts.orderBy("cur").toArrow(), vocab_size), how, max_new_tokens, eos_id)


def reply_with(prompts: DataFrame, loader: Callable[[], Callable[[list[str]], list[str]]], prompt_col: str = "prompt",
               reply_col: str = "reply") -> DataFrame:
    """Replies of a user's own function, loaded once per task and called on batches of prompt texts."""
    @F.pandas_udf("string")
    def call(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        answer = loader()
        for texts in batches:
            yield pd.Series(answer(texts.tolist()))

    return prompts.withColumn(reply_col, call(F.col(prompt_col)))
