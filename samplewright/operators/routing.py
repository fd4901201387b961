"""Top-k routing and load-balance statistics over score vectors.

Per-row work (softmax, top-k, renormalisation, RMS scaling) is done with array
higher-order functions: narrow, no shuffle, no Python.  Statistics group by
expert (at most ``E`` keys, map-side combined) or by ``(group, expert)``.  Experts
themselves run as block functions over dispatched rows (``run_experts``), and
``combine`` adds a row's weighted results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from samplewright.functions.tokens import let

# ---------------------------------------------------------------------------
# Fixed values of the reference model configuration.
TOP_K = 2
N_EXPERTS = 4
AUX_ALPHA = 0.01
RMS_EPS = 1e-5
NORM_EPS = 1e-20
# ---------------------------------------------------------------------------
#: Vectors of a block that an expert maps at once.
BLOCK_ROWS = 4096


def softmax(scores: Column) -> Column:
    """Softmax of an array, maximum subtracted first; every intermediate is computed once."""
    return let(scores, lambda s: let(F.array_max(s), lambda m: let(
        F.transform(s, lambda x: F.exp(x - m)), lambda e: let(
            F.aggregate(e, F.lit(0.0), lambda a, x: a + x), lambda z: F.transform(e, lambda x: x / z)))))


def example_gate(dim: int, n_experts: int = N_EXPERTS) -> list[list[float]]:
    """A fixed gate of small weights, ``((7 i + 13 e) mod 11 - 5) / 20`` for component i and expert e."""
    return [[((i * 7 + e * 13) % 11 - 5) / 20.0 for i in range(dim)] for e in range(n_experts)]


def gate_scores(df: DataFrame, vec_col: str, gate: list[list[float]], out_col: str = "scores") -> DataFrame:
    """A9's scores: the dot product of the whole vector with each expert's gate row."""
    def dot(row: list[float]) -> Column:
        weights = F.array(*[F.lit(float(w)) for w in row])
        return F.aggregate(F.zip_with(vec_col, weights, lambda x, w: x.cast("double") * w), F.lit(0.0), lambda a, x: a + x)

    return df.withColumn(out_col, F.array(*[dot(row) for row in gate]))


def route(df: DataFrame, id_col: str, scores_col: str, k: int = TOP_K, n_experts: int = N_EXPERTS,
          keep: list[str] | None = None) -> DataFrame:
    """``probs`` (softmax over ``n_experts`` scores) and ``routes``
    (top ``k`` experts, ties to the lower index, weights renormalised by ``sum + 1e-20``)."""
    scores = F.transform(F.col(scores_col), lambda x: x.cast("double"))

    def top(probs: Column) -> Column:
        ranked = F.array_sort(F.transform(probs, lambda p, i: F.struct((-p).alias("neg"), i.alias("expert"), p.alias("p"))))
        return let(F.slice(ranked, 1, k), lambda best: let(
            F.aggregate(best, F.lit(0.0), lambda a, t: a + t["p"]) + F.lit(NORM_EPS), lambda total: F.struct(
                probs.alias("probs"), F.transform(best, lambda t: F.struct(
                    t["expert"].alias("expert"), t["p"].alias("p"), (t["p"] / total).alias("weight"))).alias("routes"))))

    rows = df.select(id_col, *(keep or []), let(softmax(scores), top).alias("_r"))
    return rows.select(id_col, *(keep or []), F.col("_r.probs").alias("probs"), F.col("_r.routes").alias("routes"))


def assignments(routed: DataFrame, id_col: str, keep: list[str] | None = None) -> DataFrame:
    """One row per ``(id, slot)``: ``expert, p, weight``.

    ``posexplode`` would have the optimizer filter on the array's size first, which computes it twice more.
    """
    return routed.select(id_col, *(keep or []), F.posexplode_outer("routes").alias("slot", "r")).filter("slot is not null").select(
        id_col, *(keep or []), "slot", F.col("r.expert").alias("expert"), F.col("r.p").alias("p"),
        F.col("r.weight").alias("weight"))


def expert_probs(routed: DataFrame, id_col: str, keep: list[str] | None = None) -> DataFrame:
    return routed.select(id_col, *(keep or []), F.posexplode_outer("probs").alias("expert", "p")).filter("expert is not null")


def _per_expert(routed: DataFrame, n_experts: int, groups: list[str]) -> DataFrame:
    """Per group and expert: rows ``t``, sum of probabilities ``p``, chosen count ``c``; one aggregation."""
    rows = routed.select(*groups, F.explode_outer(F.transform("probs", lambda p, i: F.struct(
        i.alias("expert"), p.alias("p"), F.exists("routes", lambda r: r["expert"] == i).cast("int").alias("hit")))).alias("x")).filter("x is not null")
    return rows.groupBy(*groups, F.col("x.expert").alias("expert")).agg(
        F.count(F.lit(1)).alias("t"), F.sum("x.p").alias("p"), F.sum("x.hit").alias("c"))


def load_balance(routed: DataFrame, id_col: str, n_experts: int = N_EXPERTS,
                 alpha: float = AUX_ALPHA) -> DataFrame:
    """A10: ``alpha * sum_e mean(p_e) * (E * share_e)``; share over all ``N * k`` assignments."""
    total = F.sum("c").over(Window.partitionBy())  # over at most E rows
    per = _per_expert(routed, n_experts, []).select((F.col("p") / F.col("t")).alias("pi"), (F.col("c") / total).alias("share"))
    return per.agg((F.lit(alpha) * F.sum(F.col("pi") * F.col("share") * F.lit(n_experts))).alias("aux_loss"))


def load_balance_seq(routed: DataFrame, id_col: str, group_col: str, k: int = TOP_K,
                     n_experts: int = N_EXPERTS, alpha: float = AUX_ALPHA) -> DataFrame:
    """Per group ``sum_e count_e / (T k / E) * mean p_e``, averaged over groups, times alpha."""
    per = _per_expert(routed, n_experts, [group_col])
    term = F.col("c") / (F.col("t") * F.lit(k) / F.lit(n_experts)) * F.col("p") / F.col("t")
    per_group = per.groupBy(group_col).agg(F.sum(term).alias("_seq_term"))
    return per_group.agg((F.avg("_seq_term") * F.lit(alpha)).alias("aux_loss"))


def expert_offsets(routed: DataFrame, id_col: str) -> DataFrame:
    """Rows per expert and their ``[start, end)`` offsets after sorting by expert."""
    counts = assignments(routed, id_col).groupBy("expert").agg(F.count(F.lit(1)).alias("n_rows"))
    w = Window.orderBy("expert")  # over at most E rows
    return counts.select("expert", F.col("n_rows").cast("bigint").alias("n_rows"),
                         (F.sum("n_rows").over(w) - F.col("n_rows")).cast("bigint").alias("start_offset"),
                         F.sum("n_rows").over(w).cast("bigint").alias("end_offset"))


def dispatch(assigned: DataFrame, id_col: str, n_experts: int = N_EXPERTS, tasks_per_expert: int = 8) -> DataFrame:
    """Grouped dispatch: each expert's rows in ``tasks_per_expert`` partitions, none shared by two experts.

    Range partitioning on ``(expert, salt)`` keeps an expert's rows adjacent, as a sort
    by expert would, without giving a popular expert to a single task.
    """
    salt = F.pmod(F.xxhash64(id_col), F.lit(tasks_per_expert)).cast("int")
    return (assigned.withColumn("_salt", salt)
            .repartitionByRange(n_experts * tasks_per_expert, "expert", "_salt").drop("_salt"))


def run_experts(dispatched: DataFrame, experts: Callable[[int, np.ndarray], np.ndarray], id_col: str, vec_col: str,
                block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``id_col, slot, weight, output``: each row's vector through its expert.

    ``experts(e, block)`` maps a block of at most ``block_rows`` vectors, one a row, to as many
    results.  Rows of one expert lie together after ``dispatch``, so blocks are long; a partition
    streams through, and no task holds an expert's rows.  A null vector has a null result.
    """
    kind = dispatched.schema[id_col].dataType.simpleString()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for start in range(0, len(part), block_rows):
                rows = part.slice(start, block_rows)
                expert, vectors = rows.column(2).to_numpy(zero_copy_only=False), rows.column(4)
                size = np.array([-1 if n is None else n for n in vectors.value_lengths().to_pylist()], np.int64)
                out: list = [None] * len(rows)
                for e, n in sorted(set(zip(expert.tolist(), size.tolist()))):
                    mine = np.flatnonzero((expert == e) & (size == n))
                    if n >= 0:
                        flat = vectors.take(pa.array(mine)).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                        for i, y in zip(mine.tolist(), experts(int(e), flat.reshape(len(mine), n))):
                            out[i] = y
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), rows.column(3), pa.array(out, pa.list_(pa.float64()))],
                                                 [id_col, "slot", "weight", "output"])

    rows = dispatched.select(id_col, "slot", "expert", "weight", F.col(vec_col).cast("array<double>").alias("v"))
    return rows.mapInArrow(run, f"{id_col} {kind}, slot int, weight double, output array<double>")


def combine(outputs: DataFrame, id_col: str) -> DataFrame:
    """A12's last step: ``id_col, combined``, the weighted sum of a row's expert results, in slot order."""
    parts = F.array_sort(F.collect_list(F.struct("slot", F.transform("output", lambda x: x * F.col("weight")).alias("y"))))  # k of them
    total = F.aggregate(F.slice("_p", 2, F.size("_p")), F.element_at("_p", 1)["y"], lambda a, p: F.zip_with(a, p["y"], lambda x, y: x + y))
    return outputs.groupBy(id_col).agg(parts.alias("_p")).select(id_col, total.alias("combined"))


def example_expert(expert: int, block: np.ndarray) -> np.ndarray:
    """A fixed expert of the shape of a gated unit: SiLU of each component times ``((7 j + 13 e) mod 11 - 5) / 5``."""
    h = block * (((np.arange(block.shape[1]) * 7 + expert * 13) % 11 - 5) / 5.0)
    return h / (1 + np.exp(-h))


def rms_normalize(vec: Column, eps: float = RMS_EPS, weight: Column | None = None):
    """``(x * rsqrt(mean(x^2) + eps) * weight, inv_rms)``."""
    x = F.transform(vec, lambda v: v.cast("double"))
    ms = F.aggregate(x, F.lit(0.0), lambda a, v: a + v * v) / F.size(x)
    inv = F.lit(1.0) / F.sqrt(ms + F.lit(eps))
    if weight is None:
        out = F.transform(x, lambda v: v * inv)
    else:
        out = F.transform(x, lambda v, i: v * inv * F.get(weight, i))
    return out, inv
