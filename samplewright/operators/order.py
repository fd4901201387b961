"""Ordering, sharding, batching and resume.

The reference draws a fresh permutation per epoch with an RNG whose state is
not saved, so a resumed run cannot know which samples were already seen.  Here
the order is a pure function of ``(seed, epoch, id)``: ``md5(seed|epoch|id)``
with ``id`` as tie-break.  Hence "already done" and "remaining" are always a
disjoint cover of the epoch, on any number of workers.

Scale notes:
* W1 never uses an unpartitioned window.  Rows are bucketed by the first
  ``bucket_hex`` hex digits of their digest (16**4 = 65,536 buckets by default;
  digests are uniform, so buckets are even and no key can be hot).  A per-bucket
  count (at most ``epochs * 16**bucket_hex`` rows, a proven bound) gives each
  bucket its offset, and ranks are computed inside each bucket.
* Everything after W1 is narrow (``explode`` of wrap-around copies, integer
  arithmetic) except materialising batches, which groups at most ``B`` rows.
* Step-level quantities (global step, accumulation group, log/save points) are
  closed-form expressions of ``(epoch, step, iters)``; no global window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PRETRAIN_BATCH = 32
SFT_BATCH = 16
PRETRAIN_ACCUMULATION = 8
SFT_ACCUMULATION = 1
PRETRAIN_EPOCHS = 1
SFT_EPOCHS = 2
PRETRAIN_LR = 5e-4
SFT_LR = 1e-6
LOG_INTERVAL = 100
PRETRAIN_SAVE_INTERVAL = 100
SFT_SAVE_INTERVAL = 500
DEFAULT_SEED = 42


def order_digest(seed: int, epoch: Column, key: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(seed).cast("string"), epoch.cast("string"), key.cast("string")))


def epoch_order(df: DataFrame, id_col: str, epochs=(0,), seed: int = DEFAULT_SEED,
                bucket_hex: int = 4, keep: list[str] | None = None) -> DataFrame:
    """Dense ``order_idx`` (0-based) of every id in every epoch.

    ``order_idx`` is the rank of ``(md5(seed|epoch|id), id)`` within the epoch.
    Returns ``id_col, keep..., epoch, order_idx, n_in_epoch``.
    """
    keep = list(keep or [])
    base = df.select(F.col(id_col), *keep, F.explode(F.array(*[F.lit(int(e)) for e in epochs])).alias("epoch"))
    digest = order_digest(seed, F.col("epoch"), F.col(id_col))
    base = base.withColumn("_h", digest).withColumn(
        "_bucket", F.conv(F.substring("_h", 1, bucket_hex), 16, 10).cast("int"))
    counts = base.groupBy("epoch", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("epoch").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("epoch", "_bucket",
                            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
                            F.sum("_n").over(Window.partitionBy("epoch")).alias("n_in_epoch"))
    inner = Window.partitionBy("epoch", "_bucket").orderBy("_h", id_col)
    ranked = base.withColumn("_rn", F.row_number().over(inner))
    # One row per epoch and bucket; Spark picks the join by its measured size.
    joined = ranked.join(offsets, ["epoch", "_bucket"])
    return joined.select(id_col, *keep, "epoch",
                         (F.col("_offset") + F.col("_rn") - 1).cast("bigint").alias("order_idx"),
                         F.col("n_in_epoch").cast("bigint").alias("n_in_epoch"))


def shard(order: DataFrame, n_samples: Column | int, world_size: int) -> DataFrame:
    """Distributed sharding with wrap-around padding to a multiple of ``world_size``.

    Position ``i`` of the padded list holds sample ``order_idx = i mod N``; rank
    ``r`` takes positions ``r, r + W, ...``.  Each sample appears at
    ``order_idx, order_idx + N, ...`` below ``ceil(N / W) * W``.
    Adds ``padded_idx, rank, pos`` (``pos`` = index within the rank's list).
    """
    n = F.lit(n_samples) if isinstance(n_samples, int) else n_samples
    total = F.ceil(n / F.lit(world_size)).cast("bigint") * F.lit(world_size)
    out = order.withColumn("padded_idx", F.explode(F.sequence(F.col("order_idx"), total - 1, n.cast("bigint"))))
    return out.withColumn("rank", F.pmod(F.col("padded_idx"), F.lit(world_size)).cast("int")) \
              .withColumn("pos", F.floor(F.col("padded_idx") / F.lit(world_size)).cast("bigint"))


def batch(sharded: DataFrame, batch_size: int, skip_batches: int = 0) -> DataFrame:
    """W3 + W4: ``batch_id = pos div B``, ``pos_in_batch = pos mod B``; skip the first k batches.

    ``filter(batch_id >= k)`` is exactly the skip-sampler rule: the short tail
    survives only when ``k`` does not exceed the number of full batches.
    """
    out = sharded.withColumn("batch_id", F.floor(F.col("pos") / F.lit(batch_size)).cast("bigint")) \
                 .withColumn("pos_in_batch", F.pmod(F.col("pos"), F.lit(batch_size)).cast("int"))
    if skip_batches:
        out = out.filter(F.col("batch_id") >= F.lit(int(skip_batches)))
    return out


def materialize_batches(batched: DataFrame, id_col: str) -> DataFrame:
    """One row per ``(epoch, rank, batch_id)`` with the ids in batch order (at most B per group)."""
    return batched.groupBy("epoch", "rank", "batch_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos_in_batch", id_col))),
                    lambda x: x[id_col]).alias("ids"),
        F.count(F.lit(1)).alias("n_samples"))


def attach_samples(plan: DataFrame, samples: DataFrame, id_col: str) -> DataFrame:
    """Index -> sample.  An equi-join on the id; wrap-around copies join their sample.

    Build and filter the plan on ids first (resume skips, rank selection), then
    attach the wide encoded samples, so skipped rows are never encoded or moved.
    """
    return plan.join(samples, id_col)


def remaining_after(plan: DataFrame, done: DataFrame) -> DataFrame:
    """Batches not yet done (left anti join on ``epoch, rank, batch_id``)."""
    return plan.join(done.select("epoch", "rank", "batch_id").distinct(), ["epoch", "rank", "batch_id"],
                     "left_anti")


def num_batches(n: Column, batch_size: int, skip_batches: Column | int = 0) -> Column:
    """``max(0, ceil(n / B) - skip)``."""
    skip = F.lit(skip_batches) if isinstance(skip_batches, int) else skip_batches
    return F.greatest(F.lit(0).cast("bigint"), F.ceil(n / F.lit(batch_size)).cast("bigint") - skip)


def rescale_step(step: Column, saved_world_size: Column, current_world_size: Column | int) -> Column:
    """``step * saved // current`` when the worker count changed."""
    cur = F.lit(current_world_size) if isinstance(current_world_size, int) else current_world_size
    return F.when(saved_world_size != cur, F.floor(step * saved_world_size / cur)).otherwise(step).cast("bigint")


def batches_table(samples: DataFrame, world_size: int, batch_size: int, epochs=(0,)) -> DataFrame:
    """Every batch of a plan from one count: ``epoch, rank, batch_id, iters, n_samples, n_in_epoch``.

    Each of ``W`` ranks holds ``ceil(N / W)`` samples in batches of ``B``, all full but the
    last, so what the batches are does not depend on the order of the samples.
    """
    n = samples.agg(F.count(F.lit(1)).alias("n_in_epoch")).filter("n_in_epoch > 0")
    per_rank = F.ceil(F.col("n_in_epoch") / F.lit(world_size)).cast("bigint")
    sized = n.select("n_in_epoch", per_rank.alias("_list"), F.ceil(per_rank / F.lit(batch_size)).cast("bigint").alias("iters"),
                     F.explode(F.array(*[F.lit(int(e)) for e in epochs])).alias("epoch"))
    ranked = sized.withColumn("rank", F.explode(F.sequence(F.lit(0), F.lit(world_size - 1))))
    every = ranked.withColumn("batch_id", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("iters") - 1)))
    return every.select("epoch", "rank", "batch_id", "iters",
                        F.least(F.lit(batch_size), F.col("_list") - F.col("batch_id") * batch_size).cast("bigint").alias("n_samples"),
                        "n_in_epoch")


def steps_table(samples: DataFrame, world_size: int, batch_size: int, epochs=(0,)) -> DataFrame:
    """One row per ``(epoch, step)`` of rank 0, with ``iters`` = batches in that epoch.

    ``step = batch_id + 1`` (steps are counted from ``start_step + 1`` and the
    first kept batch is ``start_step``).
    """
    return batches_table(samples, world_size, batch_size, epochs).filter("rank = 0").select(
        "epoch", (F.col("batch_id") + 1).cast("bigint").alias("step"), "iters", "n_samples")


def global_step(epoch: Column, step: Column, iters: Column) -> Column:
    """``epoch * iters + step``."""
    return (epoch * iters + step).cast("bigint")


def accumulation_group(epoch: Column, step: Column, iters: Column, epochs: Column | int,
                       accumulation: int) -> Column:
    """Id of the optimizer update a step contributes to, NULL if it never applies.

    An update happens at every step that is a multiple of ``A``.  Steps after the
    last boundary of an epoch join the first update of the next epoch; after the
    last epoch they never apply.  Boundaries before step ``s`` of epoch ``e``:
    ``e * floor(iters / A) + floor((s - 1) / A)``.
    """
    per_epoch = F.floor(iters / F.lit(accumulation))
    before = epoch * per_epoch + F.floor((step - 1) / F.lit(accumulation))
    total = (F.lit(epochs) if isinstance(epochs, int) else epochs) * per_epoch
    return F.when(before < total, before).cast("bigint")


def lr_at(current_step: Column, total_steps: Column, lr: float) -> Column:
    """A3: ``lr * (0.1 + 0.45 * (1 + cos(pi * step / total)))``."""
    return F.lit(lr) * (F.lit(0.1) + F.lit(0.45) * (F.lit(1.0) + F.cos(F.lit(3.141592653589793) * current_step / total_steps)))


def eta_minutes(elapsed_s: Column, step: Column, iters: Column) -> Column:
    """A4: ``elapsed / (step + 1) * iters // 60 - elapsed // 60``."""
    return F.floor(elapsed_s / (step + 1) * iters / 60) - F.floor(elapsed_s / 60)


def reported_loss(loss: Column, aux_loss: Column | float = 0.0, accumulation: int = 1) -> Column:
    """A5: the logged loss; the step divides ``loss + aux`` by ``A`` and the log multiplies back."""
    aux = F.lit(aux_loss) if isinstance(aux_loss, (int, float)) else aux_loss
    return (loss + aux) / F.lit(accumulation) * F.lit(accumulation)


def interval_or_last(step: Column, iters: Column, interval: int) -> Column:
    """``step % k == 0 or step == iters``."""
    return (F.pmod(step, F.lit(interval)) == 0) | (step == iters)
