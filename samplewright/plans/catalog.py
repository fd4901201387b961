"""Registry of named queries: each reads the given tables and returns a DataFrame.

``QUERIES[name](spark, sf_dir)`` builds the Spark plan; ``ORACLE[name]`` is the
independent DuckDB SQL for the same result (absent where the operation has no
SQL form).  Every computed column is aliased identically on both sides, arrays
are compared as comma-joined strings and floating values are rounded to six
places so that hashes are stable across engines.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from samplewright.functions import tokens as T
from samplewright.operators import pretrain
from samplewright.plans import duck as D
from samplewright.session import shared_path, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------------------
# Step 1: pretraining samples
# ---------------------------------------------------------------------------
PRE_L = T.PRETRAIN_MAX_LENGTH


def _pretrain_encode_sql(L: int) -> str:
    ids = D.pad(f"list_concat([1], {D.encode(D.as_text('text'), L - 2)}, [2])", L)
    return f"""
WITH s AS (SELECT doc_id, {ids} AS input_ids FROM documents)
SELECT doc_id,
       CAST(len(list_filter(input_ids, lambda x: x <> 0)) AS BIGINT) AS n_tokens,
       {D.csv('input_ids')} AS input_ids_csv,
       {D.csv("list_transform(input_ids, lambda x: CASE WHEN x = 0 THEN -100 ELSE x END)")} AS labels_csv,
       {D.csv("list_transform(input_ids, lambda x: CASE WHEN x <> 0 THEN 1 ELSE 0 END)")} AS mask_csv
FROM s"""


@register("pretrain_encode", _pretrain_encode_sql(PRE_L))
def q_pretrain_encode(spark, sf_dir):
    s = pretrain.encode_pretrain(table(spark, sf_dir, "documents"), max_length=PRE_L)
    return s.select(
        "doc_id",
        F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).cast("bigint").alias("n_tokens"),
        T.csv(F.col("input_ids")).alias("input_ids_csv"),
        T.csv(F.col("labels")).alias("labels_csv"),
        T.csv(F.col("attention_mask")).alias("mask_csv"),
    )


_FULL_TOKENS = (f"(strlen(t) - list_sum(list_transform(regexp_extract_all(t, '{D.SPECIAL}', 0), "
                f"lambda s: length(s) - 1)))")


@register("pretrain_token_stats", f"""
WITH d AS (SELECT {D.as_text('text')} AS t FROM documents),
n AS (SELECT CAST(coalesce({_FULL_TOKENS}, strlen(t)) AS BIGINT) AS n_full FROM d)
SELECT CAST(count(*) AS BIGINT) AS n_docs,
       CAST(sum(n_full) AS BIGINT) AS n_tokens_full,
       CAST(sum(least(n_full, {PRE_L - 2}) + 2) AS BIGINT) AS n_tokens_kept,
       CAST(sum({PRE_L} - least(n_full, {PRE_L - 2}) - 2) AS BIGINT) AS n_pad,
       CAST(sum(CASE WHEN n_full > {PRE_L - 2} THEN 1 ELSE 0 END) AS BIGINT) AS n_truncated,
       CAST(max(n_full) AS BIGINT) AS max_tokens_full
FROM n""")
def q_pretrain_token_stats(spark, sf_dir):
    return pretrain.token_stats(table(spark, sf_dir, "documents"), max_length=PRE_L)


# ---------------------------------------------------------------------------
# Step 2: conversations -> chat text -> SFT samples
# ---------------------------------------------------------------------------
from samplewright.functions import plugin as PL  # noqa: E402
from samplewright.operators import chat  # noqa: E402

SFT_L = T.SFT_MAX_LENGTH
AUGMENT = {"seed": 42, "epoch": 0, "ratio": chat.ADD_SYSTEM_RATIO}


def _messages(spark, sf_dir):
    return chat.messages_from_turns(table(spark, sf_dir, "conversations"))


def _q(s: str) -> str:
    """A DuckDB string literal (real newlines are kept inside the literal)."""
    return "'" + s.replace("'", "''") + "'"


def _duck_render(augment: dict | None = None, tail: str = "", source: str = "SELECT conv_id, turn, role, text AS content FROM conversations") -> str:
    """SQL that renders every conversation: columns conv_id, prompt, n_messages, ..."""
    if augment:
        flag = (f"(role0 IS DISTINCT FROM 'system' AND "
                f"{D.hash_unit(augment['seed'], augment['epoch'], 'conv_id')} < {augment['ratio']})")
        idx = f"CAST({D.hash_word(augment['seed'], augment['epoch'], 'conv_id', 1)} % 3 AS INTEGER)"
    else:
        flag, idx = "false", "CAST(0 AS INTEGER)"
    prompts = " ".join(f"WHEN {i} THEN {_q(p)}" for i, p in enumerate(chat.SYSTEM_PROMPTS))
    return f"""
WITH w AS (
  SELECT conv_id, turn, role, content,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS pos,
         lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS prev_role,
         lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role,
         first_value(role) OVER (PARTITION BY conv_id ORDER BY turn) AS role0
  FROM ({source})),
a AS (SELECT *, {flag} AS aug, {idx} AS aug_idx FROM w),
b AS (
  SELECT conv_id, pos, role, content, aug, aug_idx, role0,
    (CASE WHEN pos = 0 THEN
        CASE WHEN role = 'system' THEN {_q('<|im_start|>system' + chr(10))} || content || {_q('<|im_end|>' + chr(10))}
             WHEN aug THEN {_q('<|im_start|>system' + chr(10))} || (CASE aug_idx {prompts} END) || {_q('<|im_end|>' + chr(10))}
             ELSE {_q(chat.DEFAULT_SYSTEM_BLOCK)} END
     ELSE '' END) ||
    (CASE WHEN role = 'user' OR (role = 'system' AND pos > 0)
            THEN '<|im_start|>' || role || {_q(chr(10))} || coalesce(content, '') || {_q('<|im_end|>' + chr(10))}
          WHEN role = 'assistant'
            THEN {_q(chat.ASSISTANT_HEADER)} || coalesce(content, '') || {_q('<|im_end|>' + chr(10))}
          WHEN role = 'tool'
            THEN (CASE WHEN pos = 0 OR prev_role IS DISTINCT FROM 'tool' THEN '<|im_start|>user' ELSE '' END)
                 || {_q(chr(10) + '<tool_response>' + chr(10))} || coalesce(content, '') || {_q(chr(10) + '</tool_response>')}
                 || (CASE WHEN next_role IS DISTINCT FROM 'tool' THEN {_q('<|im_end|>' + chr(10))} ELSE '' END)
          ELSE '' END) AS block
  FROM a)
SELECT conv_id,
       string_agg(block, '' ORDER BY pos) || {_q(tail)} AS prompt,
       CAST(max(pos) + 1 + max(CASE WHEN pos = 0 AND aug THEN 1 ELSE 0 END) AS BIGINT) AS n_messages,
       CAST(coalesce(max(CASE WHEN role = 'user' AND content IS NOT NULL
                                   AND NOT (starts_with(content, '<tool_response>') AND ends_with(content, '</tool_response>'))
                              THEN pos END), max(pos))
            + max(CASE WHEN pos = 0 AND aug THEN 1 ELSE 0 END) AS BIGINT) AS last_query_index,
       CAST(max(CASE WHEN pos = 0 AND aug THEN 1 ELSE 0 END) AS INTEGER) AS augmented,
       max(CASE WHEN pos = 0 THEN aug_idx END) AS prompt_idx,
       max(CASE WHEN pos = 0 THEN role0 END) AS first_role
FROM b GROUP BY conv_id"""


def _duck_sft(L: int, augment: dict | None) -> str:
    header = "[1, " + ", ".join(str(b + 3) for b in b"assistant\n") + "]"
    span = D.SPAN_OPEN
    return f"""
WITH r AS ({_duck_render(augment)}),
s AS (SELECT conv_id, regexp_split_to_array(prompt, '{span}') AS gaps,
             regexp_extract_all(prompt, '{span}', 1) AS spans FROM r),
e AS (SELECT conv_id, list_transform(gaps, lambda g, i: {{'g': {D.encode('g')},
             's': CASE WHEN i <= len(spans) THEN {D.encode('spans[i]')} END}}) AS segs FROM s),
f AS (SELECT conv_id,
        list_slice(flatten(list_transform(segs, lambda x: list_concat(x.g,
            CASE WHEN x.s IS NULL THEN []::INTEGER[] ELSE list_concat({header}, x.s) END))), 1, {L}) AS ids,
        list_slice(flatten(list_transform(segs, lambda x: list_concat(
            list_transform(range(len(x.g)), lambda k: -100),
            CASE WHEN x.s IS NULL THEN []::INTEGER[]
                 ELSE list_concat(list_transform(range(11), lambda k: -100), x.s) END))), 1, {L}) AS lab
      FROM e)
SELECT conv_id, CAST(len(ids) AS BIGINT) AS n_tokens,
       CAST(len(list_filter(list_slice({D.pad('lab', L, -100)}, 2, {L}), lambda x: x <> -100)) AS BIGINT) AS n_supervised,
       {D.csv(D.pad('ids', L))} AS input_ids_csv,
       {D.csv(D.pad('lab', L, -100))} AS labels_csv,
       {D.csv(D.pad("list_transform(ids, lambda x: CASE WHEN x <> 0 THEN 1 ELSE 0 END)", L))} AS mask_csv
FROM f"""


def _sft_query(spark, sf_dir, L, augment):
    return _sft_shown(chat.sft_encode(_messages(spark, sf_dir), max_length=L, augment=augment))


def _sft_shown(samples):
    return samples.filter(F.col("error").isNull()).select(
        "conv_id", "n_tokens",
        chat.supervised_count(F.col("labels")).alias("n_supervised"),
        T.csv(F.col("input_ids")).alias("input_ids_csv"),
        T.csv(F.col("labels")).alias("labels_csv"),
        T.csv(F.col("attention_mask")).alias("mask_csv"))


@register("chat_render", f"""
SELECT conv_id, prompt, n_messages, CAST(length(prompt) AS BIGINT) AS prompt_chars
FROM ({_duck_render(None)})""")
def q_chat_render(spark, sf_dir):
    r = chat.render(_messages(spark, sf_dir))
    return r.select("conv_id", "prompt", "n_messages", F.length("prompt").cast("bigint").alias("prompt_chars"))


@register("system_augment", f"""
SELECT conv_id, augmented, prompt_idx, first_role,
       CAST(length(prompt) AS BIGINT) AS prompt_chars
FROM ({_duck_render(AUGMENT)})""")
def q_system_augment(spark, sf_dir):
    r = chat.render(_messages(spark, sf_dir), augment=AUGMENT)
    return r.select("conv_id", "augmented", "prompt_idx", "first_role",
                    F.length("prompt").cast("bigint").alias("prompt_chars"))


@register("sft_encode", _duck_sft(SFT_L, AUGMENT))
def q_sft_encode(spark, sf_dir):
    return _sft_query(spark, sf_dir, SFT_L, AUGMENT)


@register("sft_encode_4096", _duck_sft(4096, AUGMENT))
def q_sft_encode_4096(spark, sf_dir):
    return _sft_query(spark, sf_dir, 4096, AUGMENT)


def _marker_ids(text: str) -> list[int]:
    return PL.python_bytes_encoder()(text)


def _token_level(rows, ids, labels, L):
    """What ``sft_encode`` returns, from padded ids and token-level labels."""
    return rows.select("conv_id", "full", ids.alias("ids"), labels.alias("labels")).select(
        "conv_id", F.least(F.col("full"), F.lit(L)).cast("bigint").alias("n_tokens"),
        chat.supervised_count(F.col("labels")).alias("n_supervised"), T.csv(F.col("ids")).alias("input_ids_csv"),
        T.csv(F.col("labels")).alias("labels_csv"), T.csv(T.attention_mask(F.col("ids"))).alias("mask_csv"))


@register("sft_token_labels", _duck_sft(SFT_L, None))
def q_sft_token_labels(spark, sf_dir):
    """Labels by a scan of the ids for the encoded markers, without Python."""
    rows = chat.render(_messages(spark, sf_dir)).select("conv_id", T.encode(F.col("prompt")).alias("all"))
    rows = rows.select("conv_id", F.size("all").alias("full"), T.pad_right(F.slice("all", 1, SFT_L), SFT_L).alias("padded"))
    labels = PL.marker_label_expr(F.col("padded"), _marker_ids(chat.ASSISTANT_HEADER), _marker_ids("<|im_end|>\n"), SFT_L)
    return _token_level(rows, F.col("padded"), labels, SFT_L)


@register("sft_plugin", _duck_sft(SFT_L, None))
def q_sft_plugin(spark, sf_dir):
    """U1 + P17b: the same samples through a user's own encoder."""
    encode = PL.plugin_encoder(PL.python_bytes_encoder)
    rows = chat.render(_messages(spark, sf_dir)).select("conv_id", encode(F.col("prompt")).alias("all"))
    rows = rows.select("conv_id", F.size("all").alias("full"), T.pad_right(F.slice("all", 1, SFT_L), SFT_L).alias("padded"))
    labels = PL.marker_label_expr(F.col("padded"), _marker_ids(chat.ASSISTANT_HEADER), _marker_ids("<|im_end|>\n"), SFT_L)
    return _token_level(rows, F.col("padded"), labels, SFT_L)


@register("supervised_tokens", f"""
WITH s AS ({_duck_sft(SFT_L, AUGMENT)})
SELECT CAST(count(*) AS BIGINT) AS n_samples,
       CAST(sum(n_supervised) AS BIGINT) AS n_supervised,
       CAST(sum(CASE WHEN n_supervised = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_unsupervised_samples,
       CAST(sum(n_tokens) AS BIGINT) AS n_tokens
FROM s""")
def q_supervised_tokens(spark, sf_dir):
    s = _sft_query(spark, sf_dir, SFT_L, AUGMENT)
    return s.agg(F.count(F.lit(1)).alias("n_samples"),
                 F.sum("n_supervised").cast("bigint").alias("n_supervised"),
                 F.sum((F.col("n_supervised") == 0).cast("int")).cast("bigint").alias("n_unsupervised_samples"),
                 F.sum("n_tokens").cast("bigint").alias("n_tokens"))


@register("generation_prompt", f"""
SELECT conv_id, prompt, {D.csv(D.encode('prompt', T.MODEL_MAX_LENGTH))} AS prompt_ids_csv
FROM ({_duck_render(None, chat.GENERATION_PROMPT)})""")
def q_generation_prompt(spark, sf_dir):
    r = chat.render(_messages(spark, sf_dir), generation_prompt=True)
    return r.select("conv_id", "prompt",
                    T.csv(T.encode(F.col("prompt"), T.MODEL_MAX_LENGTH)).alias("prompt_ids_csv"))


@register("last_user_turn", f"""
SELECT conv_id, last_query_index, n_messages FROM ({_duck_render(None)})""")
def q_last_user_turn(spark, sf_dir):
    return chat.render(_messages(spark, sf_dir)).select("conv_id", "last_query_index", "n_messages")


# ---------------------------------------------------------------------------
# Step 3: order, shards, batches, resume, schedules
# ---------------------------------------------------------------------------
from samplewright.operators import order as O  # noqa: E402

PLAN_W = 3          # workers
PLAN_EPOCHS = (0, 1)


def _plan(spark, sf_dir, world_size=PLAN_W, batch_size=O.PRETRAIN_BATCH, epochs=PLAN_EPOCHS, skip=0):
    docs = table(spark, sf_dir, "documents")
    o = O.epoch_order(docs, "doc_id", epochs=epochs)
    return O.batch(O.shard(o, F.col("n_in_epoch"), world_size), batch_size, skip)


def _duck_plan(world_size=PLAN_W, batch_size=O.PRETRAIN_BATCH, epochs=PLAN_EPOCHS) -> str:
    ep = ", ".join(f"({e})" for e in epochs)
    return f"""
WITH o AS (
  SELECT doc_id, epoch,
         row_number() OVER (PARTITION BY epoch ORDER BY md5(concat_ws('|', '42', CAST(epoch AS VARCHAR),
                            CAST(doc_id AS VARCHAR))), doc_id) - 1 AS order_idx,
         count(*) OVER (PARTITION BY epoch) AS n
  FROM documents, (VALUES {ep}) e(epoch)),
p AS (SELECT doc_id, epoch, order_idx, n,
             unnest(range(order_idx, CAST(ceil(n / {world_size}.0) AS BIGINT) * {world_size}, n)) AS padded_idx
      FROM o)
SELECT doc_id, epoch, order_idx, n, padded_idx,
       CAST(padded_idx % {world_size} AS INTEGER) AS rank,
       CAST(padded_idx // {world_size} AS BIGINT) AS pos,
       CAST((padded_idx // {world_size}) // {batch_size} AS BIGINT) AS batch_id,
       CAST((padded_idx // {world_size}) % {batch_size} AS INTEGER) AS pos_in_batch
FROM p"""


@register("epoch_order", f"""
SELECT doc_id, epoch, CAST(order_idx AS BIGINT) AS order_idx FROM ({_duck_plan(1)})""")
def q_epoch_order(spark, sf_dir):
    return O.epoch_order(table(spark, sf_dir, "documents"), "doc_id", epochs=PLAN_EPOCHS) \
        .select("doc_id", "epoch", "order_idx")


@register("shard_assign", f"""
SELECT doc_id, epoch, CAST(padded_idx AS BIGINT) AS padded_idx, rank, pos FROM ({_duck_plan()})""")
def q_shard_assign(spark, sf_dir):
    return _plan(spark, sf_dir).select("doc_id", "epoch", "padded_idx", "rank", "pos")


@register("batch_plan", f"""
SELECT epoch, rank, batch_id, CAST(count(*) AS BIGINT) AS n_samples,
       string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY pos_in_batch) AS ids_csv
FROM ({_duck_plan()}) GROUP BY epoch, rank, batch_id""")
def q_batch_plan(spark, sf_dir):
    b = O.materialize_batches(_plan(spark, sf_dir), "doc_id")
    return b.select("epoch", "rank", "batch_id", "n_samples", T.csv(F.col("ids")).alias("ids_csv"))


RESUME_SKIP = 5   # batches of epoch 0 already done


@register("resume_remaining", f"""
WITH p AS ({_duck_plan(2)}),
b AS (SELECT epoch, rank, batch_id, count(*) AS c, max(n) AS n FROM p
      WHERE NOT (epoch = 0 AND batch_id < {RESUME_SKIP}) GROUP BY epoch, rank, batch_id)
SELECT epoch, rank, CAST(count(*) AS BIGINT) AS n_batches_remaining,
       CAST(sum(c) AS BIGINT) AS n_samples_remaining,
       CAST(greatest(0, ceil(ceil(max(n) / 2.0) / {O.PRETRAIN_BATCH}.0)
            - CASE WHEN epoch = 0 THEN {RESUME_SKIP} ELSE 0 END) AS BIGINT) AS n_batches_formula
FROM b GROUP BY epoch, rank""")
def q_resume_remaining(spark, sf_dir):
    # Which samples are left needs no order: every rank's batches are full but the last.
    plan = O.batches_table(table(spark, sf_dir, "documents"), 2, O.PRETRAIN_BATCH, PLAN_EPOCHS)
    done = plan.filter((F.col("epoch") == 0) & (F.col("batch_id") < RESUME_SKIP))
    rest = O.remaining_after(plan, done)
    return rest.groupBy("epoch", "rank").agg(
        F.count(F.lit(1)).alias("n_batches_remaining"),
        F.sum("n_samples").cast("bigint").alias("n_samples_remaining"),
        O.num_batches(F.ceil(F.max("n_in_epoch") / F.lit(2.0)), O.PRETRAIN_BATCH,
                      F.when(F.col("epoch") == 0, F.lit(RESUME_SKIP)).otherwise(F.lit(0)))
        .alias("n_batches_formula"))


def _duck_steps(world_size=PLAN_W, batch_size=O.PRETRAIN_BATCH, epochs=PLAN_EPOCHS) -> str:
    return f"""
SELECT epoch, batch_id + 1 AS step, max(batch_id + 1) OVER (PARTITION BY epoch) AS iters,
       count(*) AS n_samples
FROM ({_duck_plan(world_size, batch_size, epochs)}) WHERE rank = 0 GROUP BY epoch, batch_id"""


def _steps(spark, sf_dir, world_size=PLAN_W, batch_size=O.PRETRAIN_BATCH, epochs=PLAN_EPOCHS):
    return O.steps_table(table(spark, sf_dir, "documents"), world_size, batch_size, epochs)


@register("accumulation_groups", f"""
WITH s AS ({_duck_steps()})
SELECT epoch, CAST(step AS BIGINT) AS step, CAST(epoch * iters + step AS BIGINT) AS global_step,
       CAST(CASE WHEN epoch * (iters // {O.PRETRAIN_ACCUMULATION}) + (step - 1) // {O.PRETRAIN_ACCUMULATION}
                      < {len(PLAN_EPOCHS)} * (iters // {O.PRETRAIN_ACCUMULATION})
                 THEN epoch * (iters // {O.PRETRAIN_ACCUMULATION}) + (step - 1) // {O.PRETRAIN_ACCUMULATION}
            END AS BIGINT) AS update_id
FROM s""")
def q_accumulation_groups(spark, sf_dir):
    s = _steps(spark, sf_dir)
    return s.select("epoch", "step", O.global_step(F.col("epoch"), F.col("step"), F.col("iters")).alias("global_step"),
                    O.accumulation_group(F.col("epoch"), F.col("step"), F.col("iters"), len(PLAN_EPOCHS),
                                         O.PRETRAIN_ACCUMULATION).alias("update_id"))


@register("lr_schedule", f"""
WITH s AS ({_duck_steps()})
SELECT epoch, CAST(step AS BIGINT) AS step, CAST(epoch * iters + step AS BIGINT) AS global_step,
       round({O.PRETRAIN_LR} * (0.1 + 0.45 * (1 + cos(pi() * (epoch * iters + step) / ({len(PLAN_EPOCHS)} * iters)))), 12) AS lr
FROM s""")
def q_lr_schedule(spark, sf_dir):
    s = _steps(spark, sf_dir)
    g = O.global_step(F.col("epoch"), F.col("step"), F.col("iters"))
    return s.select("epoch", "step", g.alias("global_step"),
                    F.round(O.lr_at(g, F.lit(len(PLAN_EPOCHS)) * F.col("iters"), O.PRETRAIN_LR), 12).alias("lr"))


LOG_EVERY = 10
SECONDS_PER_STEP = 0.35   # modelled step time for the ETA column


@register("log_steps", f"""
WITH s AS ({_duck_steps(1, O.SFT_BATCH)})
SELECT epoch, CAST(step AS BIGINT) AS step, CAST(iters AS BIGINT) AS iters,
       CAST(floor(step * {SECONDS_PER_STEP} / (step + 1) * iters / 60) - floor(step * {SECONDS_PER_STEP} / 60) AS BIGINT) AS eta_min
FROM s WHERE step % {LOG_EVERY} = 0 OR step = iters""")
def q_log_steps(spark, sf_dir):
    s = _steps(spark, sf_dir, 1, O.SFT_BATCH)
    kept = s.filter(O.interval_or_last(F.col("step"), F.col("iters"), LOG_EVERY))
    elapsed = F.col("step") * F.lit(SECONDS_PER_STEP)
    return kept.select("epoch", "step", F.col("iters").cast("bigint").alias("iters"),
                       O.eta_minutes(elapsed, F.col("step"), F.col("iters")).cast("bigint").alias("eta_min"))


from samplewright.sources import manifest as MF  # noqa: E402

RUNS = (  # (run id, workers when saved, batch size, save interval)
    (MF.run_key("pretrain", 512), 2, O.PRETRAIN_BATCH, 5),
    (MF.run_key("full_sft", 512), 1, O.SFT_BATCH, 20),
)
RESUME_WORLD = 3


@register("resume_rescale", " UNION ALL ".join(f"""
SELECT * FROM (
  WITH s AS ({_duck_steps(ws, bs)}),
  m AS (SELECT '{run}' AS run_id, epoch, step, {ws} AS world_size, iters FROM s
        WHERE step % {every} = 0 OR step = iters),
  l AS (SELECT *, row_number() OVER (ORDER BY epoch DESC, step DESC) AS rn FROM m)
  SELECT run_id, CAST(epoch AS INTEGER) AS epoch, CAST(step AS BIGINT) AS step,
         CAST(world_size AS INTEGER) AS world_size,
         CAST(CASE WHEN world_size <> {RESUME_WORLD} THEN step * world_size // {RESUME_WORLD} ELSE step END AS BIGINT) AS start_step
  FROM l WHERE rn = 1)""" for run, ws, bs, every in RUNS))
def q_resume_rescale(spark, sf_dir):
    return MF.resume_point(MF.latest_progress(MF.read_manifest(spark, _saved_progress(spark, sf_dir))), RESUME_WORLD)


def _saved_steps(spark, sf_dir, run, ws, bs, every):
    s = _steps(spark, sf_dir, ws, bs)
    return s.filter(O.interval_or_last(F.col("step"), F.col("iters"), every)).select(
        F.lit(run).alias("run_id"), F.col("epoch").cast("int").alias("epoch"), "step", F.lit(ws).cast("int").alias("world_size"))


def _saved_progress(spark, sf_dir) -> str:
    """The saved steps of each run and epoch as commits to one log; each job tries twice, the second adds nothing."""
    path = shared_path(spark, f"manifest-{uuid.uuid4().hex}")
    for run, ws, bs, every in RUNS:
        steps = _saved_steps(spark, sf_dir, run, ws, bs, every)
        for epoch in PLAN_EPOCHS:
            for _ in range(2):
                MF.save_steps(spark, path, steps.filter(F.col("epoch") == epoch), f"{run}/epoch-{epoch}")
    return path


@register("progress_log", " UNION ALL ".join(f"""
SELECT '{run}' AS run_id, CAST(epoch AS INTEGER) AS epoch, CAST(step AS BIGINT) AS step, {ws} AS world_size
FROM ({_duck_steps(ws, bs)}) WHERE step % {every} = 0 OR step = iters""" for run, ws, bs, every in RUNS))
def q_progress_log(spark, sf_dir):
    """S6 + S7: every saved step, once, from a log to which each job committed twice."""
    return MF.read_manifest(spark, _saved_progress(spark, sf_dir)).select("run_id", "epoch", "step", "world_size")


from samplewright.sources import readers as R  # noqa: E402


@register("sample_files", f"""
WITH p AS ({_duck_plan(2, O.PRETRAIN_BATCH, (0,))}), s AS ({ORACLE["pretrain_encode"]})
SELECT p.rank, p.batch_id, p.pos_in_batch, p.doc_id, s.n_tokens, md5(s.input_ids_csv) AS ids_md5 FROM p JOIN s ON p.doc_id = s.doc_id""")
def q_sample_files(spark, sf_dir):
    """S5 + J1: the samples of an epoch written by rank in batch order, and read back."""
    plan = _plan(spark, sf_dir, world_size=2, epochs=(0,)).select("doc_id", "rank", "batch_id", "pos_in_batch")
    samples = pretrain.encode_pretrain(table(spark, sf_dir, "documents"), max_length=PRE_L)
    path = shared_path(spark, f"samples-{uuid.uuid4().hex}")
    R.write_samples(O.attach_samples(plan, samples, "doc_id"), path)
    return spark.read.parquet(path).select(
        "rank", "batch_id", "pos_in_batch", "doc_id",
        F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).cast("bigint").alias("n_tokens"),
        F.md5(T.csv(F.col("input_ids"))).alias("ids_md5"))


from samplewright.sources import lines as RL  # noqa: E402


@register("text_lines", """
SELECT row_number() OVER (ORDER BY doc_id) - 1 AS sample_id, md5(text) AS text_md5 FROM documents""")
def q_text_lines(spark, sf_dir):
    """S1 + S4: the documents as JSON Lines in order of id, read back with their positions."""
    path = shared_path(spark, f"lines-{uuid.uuid4().hex}")
    docs = table(spark, sf_dir, "documents")
    docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id").select("text").write.json(path)
    return R.read_text_corpus(spark, path).select(F.col("doc_id").alias("sample_id"), F.md5("text").alias("text_md5"))


def _indexed_documents(spark, sf_dir):
    """The documents as JSON Lines in order of id, and the index of their lines."""
    path = shared_path(spark, f"lines-{uuid.uuid4().hex}")
    docs = table(spark, sf_dir, "documents")
    docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id").select("text").write.json(path)
    return RL.build_index(spark, path, f"{path}-index")


@register("indexed_lines", """
SELECT row_number() OVER (ORDER BY doc_id) - 1 AS sample_id, md5(text) AS text_md5 FROM documents""")
def q_indexed_lines(spark, sf_dir):
    """S1 + S4: all lines read by the ranges of an index, numbered while they are read."""
    lines = RL.read_indexed(_indexed_documents(spark, sf_dir))
    return RL.parsed(lines, R.TEXT_SCHEMA, "sample_id").select("sample_id", F.md5("text").alias("text_md5"))


LOOKUP_STEP = 97


@register("sample_lookup", f"""
SELECT * FROM (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS sample_id, md5(text) AS text_md5 FROM documents) WHERE sample_id % {LOOKUP_STEP} = 0""")
def q_sample_lookup(spark, sf_dir):
    """Samples by position, from the only ranges that hold them; the positions wanted are every 97th."""
    index = _indexed_documents(spark, sf_dir)
    total = index.agg(F.sum("n_lines")).first()[0] or 0
    lines = RL.fetch(index, spark.range(0, total, LOOKUP_STEP), "id")
    return RL.parsed(lines, R.TEXT_SCHEMA, "sample_id").select("sample_id", F.md5("text").alias("text_md5"))


@register("conversation_lines", f"""
SELECT row_number() OVER (ORDER BY conv_id) - 1 AS conv_id, n_messages, md5(prompt) AS prompt_md5 FROM ({_duck_render(None)})""")
def q_conversation_lines(spark, sf_dir):
    """S2 + S2b: nested conversations written as JSON Lines, read by an index, and rendered."""
    path = shared_path(spark, f"conversations-{uuid.uuid4().hex}")
    turns = table(spark, sf_dir, "conversations")
    nested = turns.groupBy("conv_id").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))),
        lambda m: m.dropFields("turn")).alias("conversations"))
    nested.repartitionByRange("conv_id").sortWithinPartitions("conv_id").select("conversations").write.json(path)
    lines = RL.read_indexed(RL.build_index(spark, path, f"{path}-index"))
    rows = chat.render(chat.messages_from_nested(RL.parsed(lines, R.CONVERSATION_SCHEMA, "conv_id")))
    return rows.select("conv_id", "n_messages", F.md5("prompt").alias("prompt_md5"))


# ---------------------------------------------------------------------------
# Step 4: chat sessions, history, decoding
# ---------------------------------------------------------------------------
from samplewright.operators import history as H  # noqa: E402

_DUCK_STRIP = f"'{T.STRIP_PATTERN}'"


# Sessions as the given table lacks them: some questions become an exit command, blank or null.
def _eventful(df):
    user = F.col("role") == "user"
    return df.withColumn("text", F.when(user & (F.col("conv_id") % 5 == 0) & (F.col("turn") >= 2), F.lit(" \t/EXIT\n"))
                         .when(user & (F.col("conv_id") % 5 == 1) & (F.col("turn") >= 2), F.lit("/exit now"))
                         .when(user & (F.col("conv_id") % 5 == 2) & (F.col("turn") % 4 < 2), F.lit(" \u3000\n "))
                         .when(user & (F.col("conv_id") % 5 == 3), F.lit(None).cast("string")).otherwise(F.col("text")))


_DUCK_EVENTFUL = """
SELECT conv_id, turn, role, CASE WHEN role = 'user' AND conv_id % 5 = 0 AND turn >= 2 THEN ' ' || chr(9) || '/EXIT' || chr(10)
  WHEN role = 'user' AND conv_id % 5 = 1 AND turn >= 2 THEN '/exit now'
  WHEN role = 'user' AND conv_id % 5 = 2 AND turn % 4 < 2 THEN ' ' || chr(12288) || chr(10) || ' '
  WHEN role = 'user' AND conv_id % 5 = 3 THEN NULL ELSE text END AS text
FROM conversations"""


def _duck_live(source: str = "conversations") -> str:
    return f"""
WITH s AS (SELECT conv_id AS session, turn, role, text FROM {source} WHERE role IN ('user', 'assistant')),
m AS (SELECT session, turn, role,
             CASE WHEN role = 'user' THEN regexp_replace(coalesce(text, ''), {_DUCK_STRIP}, '', 'g') ELSE text END AS content
      FROM s),
e AS (SELECT *, max(CASE WHEN role = 'user' AND lower(content) IN ('/exit', '/quit') THEN 1 ELSE 0 END)
                OVER (PARTITION BY session ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ended
      FROM m)
SELECT session, turn, role, content FROM e WHERE ended = 0 AND NOT (role = 'user' AND content = '')"""


def _sessions(spark, sf_dir):
    # Bucketed form: no window ever holds a whole session.
    return H.live_messages_bucketed(H.sessions_from_turns(table(spark, sf_dir, "conversations")))


@register("session_end_filter", _duck_live(f"({_DUCK_EVENTFUL})"))
def q_session_end_filter(spark, sf_dir):
    """F2 + F3 over the sessions with derived exits, blanks and nulls."""
    sessions = H.sessions_from_turns(_eventful(table(spark, sf_dir, "conversations")))
    return H.live_messages_bucketed(sessions).select("session", "turn", "role", "content")


@register("unlimited_history", f"""
WITH k AS ({_duck_live(f"({_DUCK_EVENTFUL})")}),
f AS (SELECT session, turn, role,
             list('<|im_start|>' || role || chr(10) || coalesce(content, '') || '<|im_end|>' || chr(10))
               OVER (PARTITION BY session ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS blocks
      FROM k)
SELECT session, turn, CAST(len(blocks) AS BIGINT) AS n_messages,
       {_q(chat.DEFAULT_SYSTEM_BLOCK)} || array_to_string(blocks, '') || {_q(chat.GENERATION_PROMPT)} AS prompt
FROM f WHERE role = 'user'""")
def q_unlimited_history(spark, sf_dir):
    """W9 with h = 0: every earlier message stays."""
    sessions = H.sessions_from_turns(_eventful(table(spark, sf_dir, "conversations")))
    p = H.history_prompts_joined(H.live_messages_bucketed(sessions), 0)
    return p.select("session", "turn", "n_messages", "prompt")


@register("chat_history_prompts", f"""
WITH k AS ({_duck_live()}),
f AS (SELECT session, turn, role,
             list('<|im_start|>' || role || chr(10) || coalesce(content, '') || '<|im_end|>' || chr(10))
               OVER (PARTITION BY session ORDER BY turn ROWS BETWEEN {2 * H.HISTORY_TURNS} PRECEDING AND CURRENT ROW) AS blocks
      FROM k),
p AS (SELECT session, turn, CAST(len(blocks) AS BIGINT) AS n_messages,
             {_q(chat.DEFAULT_SYSTEM_BLOCK)} || array_to_string(blocks, '') || {_q(chat.GENERATION_PROMPT)} AS prompt
      FROM f WHERE role = 'user')
SELECT session, turn, n_messages, prompt, {D.csv(D.encode('prompt', T.MODEL_MAX_LENGTH))} AS prompt_ids_csv FROM p""")
def q_chat_history_prompts(spark, sf_dir):
    p = H.history_prompts_joined(_sessions(spark, sf_dir), H.HISTORY_TURNS)
    return p.select("session", "turn", "n_messages", "prompt", T.csv(F.col("prompt_ids")).alias("prompt_ids_csv"))


@register("decode_roundtrip", f"""
WITH e AS (SELECT doc_id, text, {D.encode(D.as_text('text'))} AS ids FROM documents),
d AS (SELECT doc_id, text, ids,
             regexp_replace(decode(unhex(array_to_string(list_transform(list_filter(ids, lambda x: x >= 3),
                 lambda x: lpad(hex(x - 3), 2, '0')), ''))), {_DUCK_STRIP}, '', 'g') AS decoded
      FROM e)
SELECT doc_id, CAST(len(ids) AS BIGINT) AS n_tokens, CAST(length(decoded) AS BIGINT) AS decoded_chars,
       CAST(decoded = regexp_replace({D.as_text('text')}, {_DUCK_STRIP}, '', 'g') AS INTEGER) AS roundtrip_ok
FROM d""")
def q_decode_roundtrip(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    e = docs.select("doc_id", T.as_text(F.col("text")).alias("text"), T.encode(T.as_text(F.col("text"))).alias("ids"))
    d = e.select("doc_id", "text", "ids", T.decode(F.col("ids")).alias("decoded"))
    return d.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
                    F.length("decoded").cast("bigint").alias("decoded_chars"),
                    (F.col("decoded") == T.py_strip(F.col("text"))).cast("int").alias("roundtrip_ok"))


# ---------------------------------------------------------------------------
# Step 6: vocabulary, next-token model, corpus and batch loss
# ---------------------------------------------------------------------------
from samplewright.operators import stats as ST  # noqa: E402

_DUCK_WORDS = f"list_filter(regexp_split_to_array({D.as_text('text')}, '{ST.WORD_SPLIT}'), lambda w: w <> '')"


def _duck_vocab(V=ST.VOCAB_SIZE) -> str:
    return f"""
WITH w AS (SELECT unnest({_DUCK_WORDS}) AS token FROM documents),
c AS (SELECT token, count(*) AS cnt FROM w GROUP BY token)
SELECT token, CAST(row_number() OVER (ORDER BY cnt DESC, token ASC) + 2 AS INTEGER) AS id,
       CAST(cnt AS BIGINT) AS count
FROM c ORDER BY cnt DESC, token ASC LIMIT {V - 3}"""


@register("vocab_build", _duck_vocab())
def q_vocab_build(spark, sf_dir):
    return ST.build_vocab(table(spark, sf_dir, "documents"))


@register("vocab_encode", f"""
WITH v AS ({_duck_vocab()}),
w AS (SELECT doc_id, unnest({_DUCK_WORDS}) AS token, generate_subscripts({_DUCK_WORDS}, 1) AS pos FROM documents),
j AS (SELECT w.doc_id, w.pos, coalesce(v.id, 0) AS id FROM w LEFT JOIN v ON w.token = v.token)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_words,
       CAST(sum(CASE WHEN id = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_unk,
       string_agg(CAST(id AS VARCHAR), ',' ORDER BY pos) AS ids_csv
FROM j GROUP BY doc_id""")
def q_vocab_encode(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    enc = ST.vocab_encode(docs, ST.build_vocab(docs))
    return enc.select("doc_id", F.size("ids").cast("bigint").alias("n_words"),
                      F.size(F.filter("ids", lambda x: x == 0)).cast("bigint").alias("n_unk"),
                      T.csv(F.col("ids")).alias("ids_csv"))


def _duck_pairs(L=PRE_L) -> str:
    ids = D.pad(f"list_concat([1], {D.encode(D.as_text('text'), L - 2)}, [2])", L)
    return f"""
SELECT doc_id, cur, nxt FROM (
  SELECT doc_id, input_ids[i] AS cur, CASE WHEN input_ids[i + 1] = 0 THEN -100 ELSE input_ids[i + 1] END AS nxt
  FROM (SELECT doc_id, {ids} AS input_ids FROM documents) s, range(1, {L}) r(i))
WHERE nxt <> -100"""


def _duck_all_pairs(L=PRE_L) -> str:
    """Pairs of whole texts in consecutive framed windows."""
    W = L - 2
    return f"""
SELECT doc_id, cur, nxt FROM (
  SELECT doc_id, CASE WHEN (i - 1) % {W} = 0 THEN 1 ELSE ids[i - 1] END AS cur, ids[i] AS nxt
  FROM (SELECT doc_id, ids, unnest(range(1, len(ids) + 1)) AS i FROM (SELECT doc_id, {D.encode(D.as_text('text'))} AS ids FROM documents))
  UNION ALL
  SELECT doc_id, CASE WHEN len(ids) = 0 THEN 1 ELSE ids[i] END AS cur, 2 AS nxt
  FROM (SELECT doc_id, ids, unnest(list_distinct(list_concat(range({W}, len(ids) + 1, {W}), [len(ids)]))) AS i
        FROM (SELECT doc_id, {D.encode(D.as_text('text'))} AS ids FROM documents)))
WHERE nxt <> 0"""


def _pairs(spark, sf_dir):
    """Pairs of the P10 samples, which are cut; target -100 included."""
    s = pretrain.encode_pretrain(table(spark, sf_dir, "documents"), max_length=PRE_L)
    return pretrain.causal_pairs(s)


def _all_pairs(spark, sf_dir):
    """Counted pairs of whole texts."""
    return pretrain.document_pair_counts(table(spark, sf_dir, "documents"), max_length=PRE_L)


def _duck_model() -> str:
    V, a = ST.BYTES_VOCAB, ST.SMOOTHING
    return f"""
WITH p AS ({_duck_all_pairs()}),
pc AS (SELECT cur, nxt, count(*) AS pair_count FROM p GROUP BY cur, nxt),
cc AS (SELECT cur, count(*) AS cur_count FROM p GROUP BY cur)
SELECT pc.cur, pc.nxt, pair_count, cur_count, (pair_count + {a}) / (cur_count + {a * V}) AS prob
FROM pc JOIN cc ON pc.cur = cc.cur"""


@register("bigram_fit", f"""
SELECT cur, nxt, CAST(pair_count AS BIGINT) AS pair_count, CAST(cur_count AS BIGINT) AS cur_count,
       round(prob, 6) AS prob, round(ln(prob), 6) AS logp
FROM ({_duck_model()})""")
def q_bigram_fit(spark, sf_dir):
    m = ST.fit_bigram(counts=_all_pairs(spark, sf_dir))
    return m.select("cur", "nxt", "pair_count", "cur_count", F.round("prob", 6).alias("prob"),
                    F.round("logp", 6).alias("logp"))


def _duck_doc_loss(pairs: str | None = None) -> str:
    V, a = ST.BYTES_VOCAB, ST.SMOOTHING
    return f"""
WITH m AS ({_duck_model()}),
u AS (SELECT DISTINCT cur, cur_count FROM m),
p AS ({pairs or _duck_all_pairs()}),
g AS (SELECT doc_id, cur, nxt, count(*) AS n FROM p GROUP BY doc_id, cur, nxt),
s AS (SELECT g.doc_id, g.n, (coalesce(m.pair_count, 0) + {a}) / (coalesce(u.cur_count, 0) + {a * V}) AS prob
      FROM g LEFT JOIN m ON g.cur = m.cur AND g.nxt = m.nxt LEFT JOIN u ON g.cur = u.cur)
SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_tokens, sum(-ln(prob) * n) AS sum_nll FROM s GROUP BY doc_id"""


def _model(spark, sf_dir):
    """The bigram model, at most ``V * V`` rows, written once to the shared folder: the
    scoring join, its unigram side and the ranking tables all read it."""
    path = shared_path(spark, f"bigram-{uuid.uuid4().hex}")
    ST.fit_bigram(counts=_all_pairs(spark, sf_dir)).write.parquet(path)
    return spark.read.parquet(path)


def _doc_loss(spark, sf_dir):
    return ST.score_counts(_all_pairs(spark, sf_dir), _model(spark, sf_dir), ["doc_id"])


def _sample_loss(spark, sf_dir):
    """Loss of the cut pretraining samples under the corpus model."""
    return ST.score_pairs(_pairs(spark, sf_dir), _model(spark, sf_dir), ["doc_id"])


@register("corpus_loss", f"""
SELECT doc_id, n_tokens, round(sum_nll / n_tokens, 6) AS loss, round(exp(sum_nll / n_tokens), 6) AS ppl
FROM ({_duck_doc_loss()})""")
def q_corpus_loss(spark, sf_dir):
    d = _doc_loss(spark, sf_dir)
    loss = ST.masked_mean(F.col("sum_nll"), F.col("n_tokens"))
    return d.select("doc_id", "n_tokens", F.round(loss, 6).alias("loss"), F.round(F.exp(loss), 6).alias("ppl"))


@register("loss_by_quality", f"""
SELECT l.quality, CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(d.n_tokens) AS BIGINT) AS n_tokens,
       round(sum(d.sum_nll) / sum(d.n_tokens), 6) AS loss
FROM ({_duck_doc_loss()}) d JOIN labels l ON d.doc_id = l.doc_id GROUP BY l.quality""")
def q_loss_by_quality(spark, sf_dir):
    d = _doc_loss(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id")
    return d.groupBy("quality").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").cast("bigint").alias("n_tokens"),
        F.round(ST.masked_mean(F.sum("sum_nll"), F.sum("n_tokens")), 6).alias("loss"))


@register("batch_loss", f"""
WITH d AS ({_duck_doc_loss(_duck_pairs())}),
b AS (SELECT doc_id, rank, batch_id FROM ({_duck_plan(1, O.PRETRAIN_BATCH, (0,))}))
SELECT b.rank, b.batch_id, CAST(sum(d.n_tokens) AS BIGINT) AS n_tokens,
       round(sum(d.sum_nll) / sum(d.n_tokens), 6) AS loss
FROM b JOIN d ON b.doc_id = d.doc_id GROUP BY b.rank, b.batch_id""")
def q_batch_loss(spark, sf_dir):
    plan = _plan(spark, sf_dir, world_size=1, epochs=(0,)).select("doc_id", "rank", "batch_id")
    d = O.attach_samples(plan, _sample_loss(spark, sf_dir), "doc_id")
    return d.groupBy("rank", "batch_id").agg(
        F.sum("n_tokens").cast("bigint").alias("n_tokens"),
        F.round(ST.masked_mean(F.sum("sum_nll"), F.sum("n_tokens")), 6).alias("loss"))


SFT_EPOCHS = (0, 1)


def _duck_sft_rows(epoch: int) -> str:
    return f"SELECT {epoch} AS epoch, * FROM ({_duck_sft(SFT_L, {**AUGMENT, 'epoch': epoch})})"


def _sft_rows(spark, sf_dir, epoch):
    s = chat.sft_encode(_messages(spark, sf_dir), max_length=SFT_L, augment={**AUGMENT, "epoch": epoch})
    return s.filter(F.col("error").isNull()).select(F.lit(epoch).alias("epoch"), "conv_id", "input_ids", "labels", "n_tokens")


@register("sft_loss", f"""
WITH m AS ({_duck_model()}),
u AS (SELECT DISTINCT cur, cur_count FROM m),
r AS (SELECT conv_id, string_split(input_ids_csv, ',')::INTEGER[] AS ids, string_split(labels_csv, ',')::INTEGER[] AS lab FROM ({_duck_sft(SFT_L, AUGMENT)})),
p AS (SELECT conv_id, ids[i] AS cur, lab[i + 1] AS nxt FROM r, range(1, {SFT_L}) x(i) WHERE lab[i + 1] <> -100),
g AS (SELECT conv_id, count(*) AS n, sum(-ln((coalesce(m.pair_count, 0) + {ST.SMOOTHING}) / (coalesce(u.cur_count, 0) + {ST.SMOOTHING * ST.BYTES_VOCAB}))) AS nll
      FROM p LEFT JOIN m ON p.cur = m.cur AND p.nxt = m.nxt LEFT JOIN u ON p.cur = u.cur GROUP BY conv_id)
SELECT r.conv_id, CAST(coalesce(g.n, 0) AS BIGINT) AS n_tokens, round(g.nll / g.n, 6) AS loss FROM r LEFT JOIN g ON r.conv_id = g.conv_id""")
def q_sft_loss(spark, sf_dir):
    """A1 over the assistant labels of SFT samples; NULL where a sample has none."""
    pairs = pretrain.causal_pairs(_sft_rows(spark, sf_dir, 0), "conv_id")
    d = ST.score_pairs(pairs, _model(spark, sf_dir), ["conv_id"])
    return d.select("conv_id", "n_tokens", F.round(ST.masked_mean(F.col("sum_nll"), F.col("n_tokens")), 6).alias("loss"))


@register("sft_plan", f"""
WITH c AS (SELECT DISTINCT conv_id AS doc_id FROM conversations),
p AS ({_duck_plan(2, O.SFT_BATCH, SFT_EPOCHS).replace("FROM documents,", "FROM c,").replace("WITH o AS", "WITH o AS", 1)}),
s AS ({" UNION ALL ".join(_duck_sft_rows(e) for e in SFT_EPOCHS)})
SELECT p.epoch, p.rank, p.batch_id, p.pos_in_batch, p.doc_id AS conv_id, s.n_tokens, s.n_supervised, md5(s.input_ids_csv) AS ids_md5
FROM p LEFT JOIN s ON p.doc_id = s.conv_id AND p.epoch = s.epoch""")
def q_sft_plan(spark, sf_dir):
    """Two SFT epochs of batches over two ranks, joined to the samples as each epoch draws them."""
    convs = table(spark, sf_dir, "conversations").select("conv_id").distinct()
    order = O.epoch_order(convs, "conv_id", epochs=SFT_EPOCHS)
    plan = O.batch(O.shard(order, F.col("n_in_epoch"), 2), O.SFT_BATCH)
    samples = _sft_rows(spark, sf_dir, SFT_EPOCHS[0])
    for e in SFT_EPOCHS[1:]:
        samples = samples.unionByName(_sft_rows(spark, sf_dir, e))
    ready = samples.select("epoch", "conv_id", "n_tokens", chat.supervised_count(F.col("labels")).alias("n_supervised"),
                           F.md5(T.csv(F.col("input_ids"))).alias("ids_md5"))
    # A sample that is missing shows as NULL instead of shortening the step.
    return plan.join(ready, ["epoch", "conv_id"], "left").select(
        "epoch", "rank", "batch_id", "pos_in_batch", "conv_id", "n_tokens", "n_supervised", "ids_md5")


# ---------------------------------------------------------------------------
# Step 7: routing statistics on embeddings, candidate ranking, batch replies
# ---------------------------------------------------------------------------
from samplewright.operators import ranking as RK  # noqa: E402
from samplewright.operators import routing as RT  # noqa: E402

_DUCK_PROBS = f"""
v AS (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS c, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings),
s AS (SELECT vec_id, label, e AS expert, sum(c * (((i * 7 + e * 13) % 11) - 5) / 20.0) AS x
      FROM v, range(0, {RT.N_EXPERTS}) r(e) GROUP BY vec_id, label, e),
m AS (SELECT *, exp(x - max(x) OVER (PARTITION BY vec_id)) AS e FROM s),
p AS (SELECT vec_id, label, expert, e / sum(e) OVER (PARTITION BY vec_id) AS p FROM m),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY p DESC, expert ASC) AS rk FROM p),
t AS (SELECT *, p / (sum(p) OVER (PARTITION BY vec_id) + {RT.NORM_EPS}) AS weight FROM r WHERE rk <= {RT.TOP_K})"""


def _routed(spark, sf_dir):
    scored = RT.gate_scores(table(spark, sf_dir, "embeddings"), "embedding", RT.example_gate(64))
    return RT.route(scored, "vec_id", "scores", keep=["label"])


@register("topk_route", f"""
WITH {_DUCK_PROBS}
SELECT vec_id, CAST(rk - 1 AS INTEGER) AS slot, CAST(expert AS INTEGER) AS expert,
       round(p, 6) AS p, round(weight, 6) AS weight FROM t""")
def q_topk_route(spark, sf_dir):
    a = RT.assignments(_routed(spark, sf_dir), "vec_id")
    return a.select("vec_id", "slot", "expert", F.round("p", 6).alias("p"), F.round("weight", 6).alias("weight"))


@register("load_balance", f"""
WITH {_DUCK_PROBS},
pi AS (SELECT expert, avg(p) AS pi FROM p GROUP BY expert),
ce AS (SELECT expert, count(*) * 1.0 / (SELECT count(*) FROM t) AS share FROM t GROUP BY expert)
SELECT round({RT.AUX_ALPHA} * sum(pi.pi * coalesce(ce.share, 0) * {RT.N_EXPERTS}), 9) AS aux_loss
FROM pi LEFT JOIN ce ON pi.expert = ce.expert""")
def q_load_balance(spark, sf_dir):
    return RT.load_balance(_routed(spark, sf_dir), "vec_id").select(F.round("aux_loss", 9).alias("aux_loss"))


@register("load_balance_seq", f"""
WITH {_DUCK_PROBS},
mp AS (SELECT label, expert, avg(p) AS mp, count(*) AS tn FROM p GROUP BY label, expert),
c AS (SELECT label, expert, count(*) AS c FROM t GROUP BY label, expert),
g AS (SELECT mp.label, sum(coalesce(c.c, 0) / (mp.tn * {RT.TOP_K} / {RT.N_EXPERTS}.0) * mp.mp) AS g
      FROM mp LEFT JOIN c ON mp.label = c.label AND mp.expert = c.expert GROUP BY mp.label)
SELECT round(avg(g) * {RT.AUX_ALPHA}, 9) AS aux_loss FROM g""")
def q_load_balance_seq(spark, sf_dir):
    return RT.load_balance_seq(_routed(spark, sf_dir), "vec_id", "label") \
        .select(F.round("aux_loss", 9).alias("aux_loss"))


@register("expert_offsets", f"""
WITH {_DUCK_PROBS},
c AS (SELECT CAST(expert AS INTEGER) AS expert, count(*) AS n FROM t GROUP BY expert)
SELECT expert, CAST(n AS BIGINT) AS n_rows, CAST(sum(n) OVER (ORDER BY expert) - n AS BIGINT) AS start_offset,
       CAST(sum(n) OVER (ORDER BY expert) AS BIGINT) AS end_offset FROM c""")
def q_expert_offsets(spark, sf_dir):
    return RT.expert_offsets(_routed(spark, sf_dir), "vec_id")


@register("expert_combine", f"""
WITH {_DUCK_PROBS},
h AS (SELECT t.vec_id, v.i AS dim, t.rk, t.weight, v.c * (((v.i * 7 + t.expert * 13) % 11) - 5) / 5.0 AS h FROM t JOIN v ON v.vec_id = t.vec_id)
SELECT vec_id, CAST(dim AS INTEGER) AS dim, round(sum(weight * (h / (1 + exp(-h)))), 6) + 0.0 AS value FROM h GROUP BY vec_id, dim""")
def q_expert_combine(spark, sf_dir):
    """A12 whole: rows dealt to their experts, run in blocks, and added up again by weight."""
    vectors = table(spark, sf_dir, "embeddings")
    scored = RT.gate_scores(vectors, "embedding", RT.example_gate(64))
    assigned = RT.assignments(RT.route(scored, "vec_id", "scores", keep=["embedding"]), "vec_id", keep=["embedding"])
    outputs = RT.run_experts(RT.dispatch(assigned, "vec_id"), RT.example_expert, "vec_id", "embedding")
    out = RT.combine(outputs, "vec_id").select("vec_id", F.posexplode("combined").alias("dim", "v"))
    return out.select("vec_id", "dim", F.round("v", 6).alias("value"))


@register("rms_normalize", f"""
WITH s AS (SELECT vec_id, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS x FROM embeddings),
r AS (SELECT vec_id, x, 1.0 / sqrt(list_sum(list_transform(x, lambda v: v * v)) / len(x) + {RT.RMS_EPS}) AS inv FROM s)
SELECT vec_id, CAST(generate_subscripts(x, 1) - 1 AS INTEGER) AS dim, round(unnest(x) * inv, 6) AS value,
       round(inv, 6) AS inv_rms FROM r""")
def q_rms_normalize(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    out, inv = RT.rms_normalize(F.col("embedding"))
    n = e.select("vec_id", out.alias("y"), inv.alias("inv"))
    return n.select("vec_id", F.posexplode("y").alias("dim", "v"), "inv").select(
        "vec_id", "dim", F.round("v", 6).alias("value"), F.round("inv", 6).alias("inv_rms"))


def _duck_dense() -> str:
    V, a = ST.BYTES_VOCAB, ST.SMOOTHING
    return f"""
mm AS ({_duck_model()}),
ctx AS (SELECT DISTINCT cur, cur_count FROM mm),
g AS (SELECT cur, cur_count, CAST(unnest(range(0, {V})) AS INTEGER) AS nxt FROM ctx),
d AS (SELECT g.cur, g.nxt, ln((coalesce(mm.pair_count, 0) + {a}) / (g.cur_count + {a * V})) AS logit
      FROM g LEFT JOIN mm ON g.cur = mm.cur AND g.nxt = mm.nxt),
dd AS (SELECT cur, nxt, logit FROM d UNION ALL
       SELECT c.i, n.i, -ln({V}) FROM range(0, {V}) c(i), range(0, {V}) n(i) WHERE c.i NOT IN (SELECT cur FROM ctx))"""


def _duck_nucleus(keys: str, src: str, score: str) -> str:
    """SQL CTEs k1..k5 for temperature / top-k / top-p over ``src`` partitioned by ``keys``."""
    T_, K, P = RK.TEMPERATURE, RK.TOP_K, RK.TOP_P
    return f"""
k1 AS (SELECT *, {score} / {T_} AS sc, row_number() OVER (PARTITION BY {keys} ORDER BY {score} / {T_} DESC, nxt ASC) AS rank FROM {src}),
k2 AS (SELECT *, exp(sc - max(sc) OVER (PARTITION BY {keys})) AS e FROM k1 WHERE rank <= {K}),
k3 AS (SELECT *, e / sum(e) OVER (PARTITION BY {keys}) AS q FROM k2),
k4 AS (SELECT *, coalesce(sum(q) OVER (PARTITION BY {keys} ORDER BY sc DESC, nxt ASC
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS better FROM k3),
k5 AS (SELECT *, q / sum(q) OVER (PARTITION BY {keys}) AS prob FROM k4 WHERE better < {P})"""


def _dense(spark, sf_dir):
    return RK.dense_model(_model(spark, sf_dir))


@register("greedy_next", f"""
WITH m AS ({_duck_model()}),
r AS (SELECT *, row_number() OVER (PARTITION BY cur ORDER BY pair_count DESC, nxt ASC) AS rn FROM m)
SELECT cur, nxt, round(prob, 6) AS prob FROM r WHERE rn = 1""")
def q_greedy_next(spark, sf_dir):
    g = RK.greedy_next(ST.fit_bigram(counts=_all_pairs(spark, sf_dir)))
    return g.select("cur", "nxt", F.round("prob", 6).alias("prob"))


@register("nucleus_candidates", f"""
WITH {_duck_dense()}, {_duck_nucleus('cur', 'd', 'logit')}
SELECT cur, nxt, CAST(rank AS INTEGER) AS rank, round(prob, 6) AS prob FROM k5""")
def q_nucleus_candidates(spark, sf_dir):
    n = RK.nucleus_arrays(RK.context_rows(_dense(spark, sf_dir)), ["cur"], "logits")
    return n.select("cur", "nxt", "rank", F.round("prob", 6).alias("prob"))




def _duck_prompt_ids() -> str:
    return f"""
hk AS ({_duck_live()}),
hf AS (SELECT session, turn, role,
              list('<|im_start|>' || role || chr(10) || coalesce(content, '') || '<|im_end|>' || chr(10))
                OVER (PARTITION BY session ORDER BY turn ROWS BETWEEN {2 * H.HISTORY_TURNS} PRECEDING AND CURRENT ROW) AS blocks
       FROM hk),
hp AS (SELECT session, turn,
              {D.encode(_q(chat.DEFAULT_SYSTEM_BLOCK) + " || array_to_string(blocks, '') || " + _q(chat.GENERATION_PROMPT), T.MODEL_MAX_LENGTH)} AS prompt_ids
       FROM hf WHERE role = 'user'),
pc AS (SELECT hp.session, hp.turn, d.nxt,
              CASE WHEN list_contains(hp.prompt_ids, d.nxt)
                   THEN (CASE WHEN d.logit > 0 THEN d.logit / {RK.REPETITION_PENALTY} ELSE d.logit * {RK.REPETITION_PENALTY} END)
                   ELSE d.logit END AS score
       FROM hp JOIN dd d ON d.cur = hp.prompt_ids[-1])"""


def _penalized(spark, sf_dir):
    """Penalised scores per prompt as an id-indexed array (narrow: no candidate rows)."""
    p = H.history_prompts_joined(_sessions(spark, sf_dir), H.HISTORY_TURNS)
    return RK.penalized_scores(p, RK.context_rows(_dense(spark, sf_dir)), ["session", "turn"])


@register("repetition_penalty", f"""
WITH {_duck_dense()}, {_duck_prompt_ids()},
r AS (SELECT *, row_number() OVER (PARTITION BY session, turn ORDER BY score DESC, nxt ASC) AS rank FROM pc)
SELECT session, turn, CAST(rank AS INTEGER) AS rank, nxt, round(score, 6) AS score FROM r""")
def q_repetition_penalty(spark, sf_dir):
    every = RK.all_candidates(_penalized(spark, sf_dir), ["session", "turn"], "scores")
    return every.select("session", "turn", "rank", "nxt", F.round("score", 6).alias("score"))


@register("sample_next", f"""
WITH {_duck_dense()}, {_duck_prompt_ids()}, {_duck_nucleus('session, turn', 'pc', 'score')},
c AS (SELECT *, sum(prob) OVER (PARTITION BY session, turn ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
             {D.hash_unit(42, 0, "concat_ws(':', CAST(session AS VARCHAR), CAST(turn AS VARCHAR))")} AS u FROM k5)
SELECT session, turn, CAST(coalesce(min(CASE WHEN cum > u THEN rank * 100000 + nxt END) % 100000, arg_max(nxt, rank)) AS INTEGER) AS nxt
FROM c GROUP BY session, turn""")
def q_sample_next(spark, sf_dir):
    kept = _penalized(spark, sf_dir).select("session", "turn", RK.nucleus_array(F.col("scores")).alias("kept"))
    u = T.hash_unit(42, 0, F.concat_ws(":", F.col("session").cast("string"), F.col("turn").cast("string")))
    return kept.select("session", "turn", RK.draw_array(F.col("kept"), u).alias("nxt"))


_DUCK_STEP = f"""
SELECT g.session, g.turn, g.step, g.seen, g.out, m.nxt,
       CASE WHEN list_contains(g.seen, m.nxt) THEN (CASE WHEN m.logit > 0 THEN m.logit / {RK.REPETITION_PENALTY} ELSE m.logit * {RK.REPETITION_PENALTY} END)
            ELSE m.logit END AS score
FROM gen g JOIN dd m ON m.cur = g.last WHERE g.step < {RK.MAX_NEW_TOKENS} AND NOT g.done"""

_DUCK_REPLY_START = """
SELECT session, turn, 0 AS step, CAST(list_distinct(prompt_ids) AS INTEGER[]) AS seen, CAST([] AS INTEGER[]) AS out,
       CAST(prompt_ids[-1] AS INTEGER) AS last, false AS done FROM hp"""


def _duck_replies(pick: str) -> str:
    """Recursive generation; ``pick`` gives session, turn, step, seen, out and the chosen token b."""
    return f"""
WITH RECURSIVE {_duck_dense().replace("dd AS (", "dd AS MATERIALIZED (")}, {_duck_prompt_ids()},
gen AS ({_DUCK_REPLY_START} UNION ALL
  SELECT session, turn, step + 1, list_append(seen, b), CASE WHEN b = 2 THEN out ELSE list_append(out, b) END, b, b = 2 FROM ({pick}))
SELECT session, turn, CAST(len(out) AS BIGINT) AS n_new, {D.csv('out')} AS new_ids_csv
FROM (SELECT *, row_number() OVER (PARTITION BY session, turn ORDER BY step DESC) AS rn FROM gen) WHERE rn = 1"""


def _replies(spark, sf_dir, temperature):
    p = H.history_prompts_joined(_sessions(spark, sf_dir), H.HISTORY_TURNS).select("session", "turn", "prompt_ids")
    g = RK.generate(p, _model(spark, sf_dir), ["session", "turn"], temperature=temperature)
    return g.select("session", "turn", F.size("new_ids").cast("bigint").alias("n_new"), T.csv(F.col("new_ids")).alias("new_ids_csv"))


@register("batch_reply", _duck_replies(f"""
SELECT session, turn, step, seen, out, CAST(arg_max(nxt, {{'s': score, 'n': -nxt}}) AS INTEGER) AS b
FROM ({_DUCK_STEP}) GROUP BY session, turn, step, seen, out"""))
def q_batch_reply(spark, sf_dir):
    """Greedy replies: temperature 0."""
    return _replies(spark, sf_dir, 0.0)


_DUCK_DRAWN = f"""
SELECT session, turn, step, seen, out,
       CAST(coalesce(min(CASE WHEN cum > {D.hash_unit(42, 'step', "concat_ws(':', CAST(session AS VARCHAR), CAST(turn AS VARCHAR))")} THEN rank * 100000 + nxt END) % 100000,
                     arg_max(nxt, rank)) AS INTEGER) AS b
FROM (SELECT *, sum(prob) OVER (PARTITION BY session, turn ORDER BY rank) AS cum
      FROM (SELECT *, q / sum(q) OVER (PARTITION BY session, turn) AS prob
            FROM (SELECT *, coalesce(sum(q) OVER (PARTITION BY session, turn ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS better
                  FROM (SELECT *, e / sum(e) OVER (PARTITION BY session, turn) AS q
                        FROM (SELECT *, exp(sc - max(sc) OVER (PARTITION BY session, turn)) AS e
                              FROM (SELECT *, score / {RK.TEMPERATURE} AS sc, row_number() OVER (PARTITION BY session, turn ORDER BY score DESC, nxt) AS rank
                                    FROM ({_DUCK_STEP})) WHERE rank <= {RK.TOP_K})))
            WHERE better < {RK.TOP_P}))
GROUP BY session, turn, step, seen, out"""


@register("batch_reply_sampled", _duck_replies(_DUCK_DRAWN))
def q_batch_reply_sampled(spark, sf_dir):
    """Sampled replies at the default temperature, top-k and top-p."""
    return _replies(spark, sf_dir, RK.TEMPERATURE)


WORD_V, WORD_NEW = ST.VOCAB_SIZE, 6
_DUCK_WORD_MODEL = f"""
v AS MATERIALIZED ({_duck_vocab()}),
dw AS (SELECT doc_id, unnest({_DUCK_WORDS}) AS token, generate_subscripts({_DUCK_WORDS}, 1) AS pos FROM documents),
di AS (SELECT doc_id, pos, coalesce(v.id, 0) AS id FROM dw LEFT JOIN v ON v.token = dw.token),
wp AS (SELECT coalesce(lag(id) OVER (PARTITION BY doc_id ORDER BY pos), 1) AS cur, id AS nxt FROM di
       UNION ALL SELECT coalesce(arg_max(id, pos), 1), 2 FROM documents LEFT JOIN di USING (doc_id) GROUP BY doc_id),
wm AS MATERIALIZED (SELECT cur, nxt, count(*) AS n FROM wp WHERE nxt <> 0 GROUP BY cur, nxt),
wc AS MATERIALIZED (SELECT cur, sum(n) AS n FROM wm GROUP BY cur),
qw AS (SELECT conv_id, turn, unnest({_DUCK_WORDS}) AS token, generate_subscripts({_DUCK_WORDS}, 1) AS pos FROM conversations WHERE role = 'user'),
hp AS (SELECT conv_id AS session, c.turn, list_concat([1], coalesce(ids, [])) AS prompt_ids FROM conversations c LEFT JOIN (
         SELECT conv_id, turn, list(coalesce(v.id, 0) ORDER BY pos) AS ids FROM qw LEFT JOIN v ON v.token = qw.token GROUP BY conv_id, turn) USING (conv_id, turn)
       WHERE role = 'user')"""
_DUCK_WORD_STEP = f"""
SELECT g.session, g.turn, g.step, g.seen, g.out, r.nxt,
       ln((coalesce(m.n, 0) + {ST.SMOOTHING}) / (coalesce(c.n, 0) + {ST.SMOOTHING * WORD_V}))
         * CASE WHEN list_contains(g.seen, r.nxt) THEN {RK.REPETITION_PENALTY} ELSE 1 END AS score
FROM gen g CROSS JOIN range(0, {WORD_V}) r(nxt) LEFT JOIN wc c ON c.cur = g.last LEFT JOIN wm m ON m.cur = g.last AND m.nxt = r.nxt
WHERE g.step < {WORD_NEW} AND NOT g.done"""


def _duck_word_replies(pick: str) -> str:
    return f"""
WITH RECURSIVE {_DUCK_WORD_MODEL},
gen AS ({_DUCK_REPLY_START} UNION ALL
  SELECT session, turn, step + 1, list_append(seen, b), CASE WHEN b = 2 THEN out ELSE list_append(out, b) END, b, b = 2 FROM ({pick.replace(_DUCK_STEP, _DUCK_WORD_STEP)}))
SELECT session, turn, CAST(len(out) AS BIGINT) AS n_new, {D.csv('out')} AS new_ids_csv
FROM (SELECT *, row_number() OVER (PARTITION BY session, turn ORDER BY step DESC) AS rn FROM gen) WHERE rn = 1"""


def _word_replies(spark, sf_dir, temperature):
    """Replies of the word model (V = 6,400) to every question, by supersteps over its partitions."""
    docs, V = table(spark, sf_dir, "documents"), WORD_V
    vocab = written(ST.build_vocab(docs), "vocab")
    ids = ST.vocab_encode(docs, vocab)
    pairs = ids.select(F.explode(F.arrays_zip(F.concat(F.array(F.lit(T.BOS_ID)), "ids").alias("cur"),
                                              F.concat("ids", F.array(F.lit(T.EOS_ID))).alias("nxt"))).alias("p")).select("p.*")
    model = written(ST.fit_bigram(pairs.filter(F.col("nxt") != T.PAD_ID), vocab_size=V), "word-model")
    asked = table(spark, sf_dir, "conversations").filter(F.col("role") == "user").select(F.struct("conv_id", "turn").alias("key"), "text")
    prompts = ST.vocab_encode(asked, vocab, "key").select(
        F.col("key.conv_id").alias("session"), F.col("key.turn").alias("turn"), F.concat(F.array(F.lit(T.BOS_ID)), "ids").alias("prompt_ids"))
    g = RK.generate(prompts, model, ["session", "turn"], temperature=temperature, max_new_tokens=WORD_NEW, vocab_size=V, carry_bytes=0)
    return g.select("session", "turn", F.size("new_ids").cast("bigint").alias("n_new"), T.csv(F.col("new_ids")).alias("new_ids_csv"))


@register("word_reply", _duck_word_replies(f"""
SELECT session, turn, step, seen, out, CAST(arg_max(nxt, {{'s': score, 'n': -nxt}}) AS INTEGER) AS b
FROM ({_DUCK_STEP}) GROUP BY session, turn, step, seen, out"""))
def q_word_reply(spark, sf_dir):
    """U2 with a model that no task carries, greedy."""
    return _word_replies(spark, sf_dir, 0.0)


@register("word_reply_sampled", _duck_word_replies(_DUCK_DRAWN))
def q_word_reply_sampled(spark, sf_dir):
    """U2 with a model that no task carries, sampled."""
    return _word_replies(spark, sf_dir, RK.TEMPERATURE)


@register("batch_reply_text")
def q_batch_reply_text(spark, sf_dir):
    """Greedy replies as text."""
    p = H.history_prompts_joined(_sessions(spark, sf_dir), H.HISTORY_TURNS).select("session", "turn", "prompt_ids")
    g = RK.generate(p, _model(spark, sf_dir), ["session", "turn"], temperature=0.0)
    return g.select("session", "turn", H.reply_text(F.col("new_ids")).alias("reply"))


# ---------------------------------------------------------------------------
# Step 8: streaming forms (same results as the batch queries)
# ---------------------------------------------------------------------------
from samplewright.streaming import stream as SS  # noqa: E402

DOCUMENTS_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CONVERSATIONS_SCHEMA = "conv_id long, turn long, role string, text string"


@register("stream_encode", ORACLE["pretrain_encode"])
def q_stream_encode(spark, sf_dir):
    s = SS.stream_encode(spark, SS.table_pattern(sf_dir, "documents"), DOCUMENTS_SCHEMA)
    path = SS.run_to_table(spark, s, "stream_encode")
    out = spark.read.schema(s.schema).parquet(path)
    return out.select(
        "doc_id",
        F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).cast("bigint").alias("n_tokens"),
        T.csv(F.col("input_ids")).alias("input_ids_csv"),
        T.csv(F.col("labels")).alias("labels_csv"),
        T.csv(F.col("attention_mask")).alias("mask_csv"))


NESTED_SCHEMA = "conv_id long, conversations array<struct<role: string, content: string>>"


@register("stream_sft", ORACLE["sft_encode"])
def q_stream_sft(spark, sf_dir):
    """T1 for conversations: written as nested rows, streamed, encoded per micro-batch."""
    base = shared_path(spark, f"stream-sft-{uuid.uuid4().hex}")
    turns = table(spark, sf_dir, "conversations")
    nested = turns.groupBy("conv_id").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))),
        lambda m: m.dropFields("turn")).alias("conversations"))
    nested.write.parquet(f"{base}/in")
    path = SS.stream_sft(spark, f"{base}/in", NESTED_SCHEMA, f"{base}/out", f"{base}/ckpt", max_length=SFT_L, augment=AUGMENT)
    return _sft_shown(spark.read.parquet(path))


@register("stream_history", ORACLE["chat_history_prompts"])
def q_stream_history(spark, sf_dir):
    s = SS.stream_history(spark, SS.table_pattern(sf_dir, "conversations"), CONVERSATIONS_SCHEMA)
    return _stream_prompts(spark, s, "stream_history")


def _stream_prompts(spark, stream, name):
    out = SS.latest_prompts(spark.read.schema(stream.schema).parquet(SS.run_to_table(spark, stream, name)))
    return out.select("session", "turn", "n_messages", "prompt",
                      T.csv(T.encode(F.col("prompt"), T.MODEL_MAX_LENGTH)).alias("prompt_ids_csv"))


ARRIVALS = 4


@register("stream_history_late", f"""
WITH k AS ({_duck_live(f"({_DUCK_EVENTFUL})")}),
f AS (SELECT session, turn, role,
             list('<|im_start|>' || role || chr(10) || coalesce(content, '') || '<|im_end|>' || chr(10))
               OVER (PARTITION BY session ORDER BY turn ROWS BETWEEN {2 * H.HISTORY_TURNS} PRECEDING AND CURRENT ROW) AS blocks FROM k),
p AS (SELECT session, turn, CAST(len(blocks) AS BIGINT) AS n_messages,
             {_q(chat.DEFAULT_SYSTEM_BLOCK)} || array_to_string(blocks, '') || {_q(chat.GENERATION_PROMPT)} AS prompt
      FROM f WHERE role = 'user')
SELECT session, turn, n_messages, prompt, {D.csv(D.encode('prompt', T.MODEL_MAX_LENGTH))} AS prompt_ids_csv FROM p""")
def q_stream_history_late(spark, sf_dir):
    """T2 with late turns: sessions with exits and blanks, whose turns arrive shuffled over four micro-batches."""
    base = shared_path(spark, f"stream-late-{uuid.uuid4().hex}")
    turns = _eventful(table(spark, sf_dir, "conversations"))
    arrival = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(ARRIVALS))
    files = turns.rdd.getNumPartitions()  # of an arrival: as many as its scan has tasks, read as one micro-batch
    for k in range(ARRIVALS):
        turns.filter(arrival == k).write.mode("append").parquet(base)
    return _stream_prompts(spark, SS.stream_history(spark, base, CONVERSATIONS_SCHEMA, max_files_per_trigger=files), "stream_history_late")


@register("stream_resume", ORACLE["pretrain_encode"])
def q_stream_resume(spark, sf_dir):
    """A run over what had arrived, then a second run from its checkpoint over the rest, each batch committed once."""
    base = shared_path(spark, f"stream-resume-{uuid.uuid4().hex}")
    docs = table(spark, sf_dir, "documents")
    for late in (0, 1):
        docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == late).write.mode("append").parquet(f"{base}/in")
        samples = SS.stream_encode(spark, f"{base}/in", DOCUMENTS_SCHEMA)
        out = SS.run_to_log(spark, samples, f"{base}/out", f"{base}/checkpoint")
    return out.select(
        "doc_id", F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).cast("bigint").alias("n_tokens"),
        T.csv(F.col("input_ids")).alias("input_ids_csv"), T.csv(F.col("labels")).alias("labels_csv"),
        T.csv(F.col("attention_mask")).alias("mask_csv"))


# Conversations with tools, derived from the given rows: the first message of some becomes a system
# message with tools or functions, replies get calls, later questions become tool results.
def _tool_turns(df):
    c, t, role = F.col("conv_id"), F.col("turn"), F.col("role")
    named = F.format_string('[{"type":"function","function":{"name":"f%d","tags":["a",%d]}}]', c, t)
    calls = F.format_string('[{"function":{"name":"look","arguments":{"x":%d,"y":[1,2.5]}}},{"name":"raw","arguments":"as is"}]', t)
    first = t == 0
    tooled = c % 4 < 2
    return df.select(
        "conv_id", "turn",
        F.when(first & tooled, "system").when(tooled & (role == "user") & (t % 3 > 0), "tool").otherwise(role).alias("role"),
        F.when(first & (c % 24 == 1), F.lit(None).cast("string")).when((role == "assistant") & (c % 3 == 0), F.lit(""))
        .when((role == "user") & (t == 3), F.lit("<tool_response>x</tool_response>")).otherwise(F.col("text")).alias("text"),
        F.when(first & (c % 8 == 0), named).when(first & (c % 8 == 4), F.lit("null")).when(first & (c % 16 == 1), F.lit("{bad")).alias("tools"),
        F.when(first & (c % 8 == 4), named).when(first & (c % 8 == 5), F.lit("")).alias("functions"),
        F.when((role == "assistant") & (c % 4 == 0), calls).when((role == "assistant") & (c % 20 == 5), F.lit('{"x":1')).alias("tool_calls"))


_DUCK_TOOLS = """
SELECT conv_id, turn, CASE WHEN turn = 0 AND conv_id % 4 < 2 THEN 'system' WHEN conv_id % 4 < 2 AND role = 'user' AND turn % 3 > 0 THEN 'tool' ELSE role END AS role,
  CASE WHEN turn = 0 AND conv_id % 24 = 1 THEN NULL WHEN role = 'assistant' AND conv_id % 3 = 0 THEN ''
       WHEN role = 'user' AND turn = 3 THEN '<tool_response>x</tool_response>' ELSE text END AS content,
  CASE WHEN turn = 0 AND conv_id % 4 = 0
       THEN chr(10) || '{"type": "function", "function": {"name": "f' || conv_id || '", "tags": ["a", ' || turn || ']}}' END AS tools_text,
  CASE WHEN role = 'assistant' AND conv_id % 4 = 0
       THEN '<tool_call>' || chr(10) || '{"name": "look", "arguments": {"x": ' || turn || ', "y": [1, 2.5]}}' || chr(10) || '</tool_call>' || chr(10)
            || '<tool_call>' || chr(10) || '{"name": "raw", "arguments": as is}' || chr(10) || '</tool_call>' END AS calls_text,
  turn = 0 AND conv_id % 16 = 1 AS bad_tools, role = 'assistant' AND conv_id % 20 = 5 AS bad_calls
FROM conversations"""

_DUCK_TOOL_BLOCKS = f"""
WITH s AS ({_DUCK_TOOLS}),
w AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS pos, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS prev_role,
             lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role FROM s)
SELECT conv_id, pos, role, content,
  CASE WHEN pos = 0 AND role = 'system' AND content IS NULL THEN 'null_system_content'
       WHEN pos = 0 AND role = 'system' AND bad_tools THEN 'bad_tools' WHEN role = 'assistant' AND bad_calls THEN 'bad_tool_calls' END AS error,
  coalesce((CASE WHEN pos > 0 THEN '' WHEN role = 'system' AND tools_text IS NOT NULL
          THEN {_q('<|im_start|>system' + chr(10))} || content || {_q(chr(10) * 2 + chat.TOOLS_PREAMBLE)} || tools_text || {_q(chat.TOOLS_POSTAMBLE)}
        WHEN role = 'system' THEN {_q('<|im_start|>system' + chr(10))} || content || {_q('<|im_end|>' + chr(10))} ELSE {_q(chat.DEFAULT_SYSTEM_BLOCK)} END) ||
  (CASE WHEN role = 'user' OR (role = 'system' AND pos > 0) THEN '<|im_start|>' || role || chr(10) || coalesce(content, '') || {_q('<|im_end|>' + chr(10))}
        WHEN role = 'assistant' THEN {_q(chat.ASSISTANT_HEADER)} || coalesce(content, '')
          || (CASE WHEN calls_text IS NULL THEN '' WHEN coalesce(content, '') <> '' THEN chr(10) || calls_text ELSE calls_text END) || {_q('<|im_end|>' + chr(10))}
        WHEN role = 'tool' THEN (CASE WHEN pos = 0 OR prev_role IS DISTINCT FROM 'tool' THEN '<|im_start|>user' ELSE '' END)
          || {_q(chr(10) + '<tool_response>' + chr(10))} || coalesce(content, '') || {_q(chr(10) + '</tool_response>')}
          || (CASE WHEN next_role IS DISTINCT FROM 'tool' THEN {_q('<|im_end|>' + chr(10))} ELSE '' END)
        ELSE '' END), '') AS block
FROM w"""


def _tool_messages(spark, sf_dir):
    return chat.messages_from_turns(_tool_turns(table(spark, sf_dir, "conversations")))


@register("tool_render", f"""
SELECT conv_id, string_agg(block, '' ORDER BY pos) AS prompt, CAST(max(pos) + 1 AS BIGINT) AS n_messages,
       CAST(coalesce(max(CASE WHEN role = 'user' AND content IS NOT NULL
              AND NOT (starts_with(content, '<tool_response>') AND ends_with(content, '</tool_response>')) THEN pos END), max(pos)) AS BIGINT) AS last_query_index
FROM ({_DUCK_TOOL_BLOCKS}) GROUP BY conv_id HAVING min(error) IS NULL""")
def q_tool_render(spark, sf_dir):
    """P14-P16 with tools, functions, calls, tool results and wrapped questions."""
    r = chat.render(_tool_messages(spark, sf_dir)).filter(F.col("error").isNull())
    return r.select("conv_id", "prompt", "n_messages", "last_query_index")


@register("tool_group", """
SELECT conv_id, turn,
  CASE WHEN turn = 0 AND conv_id % 8 IN (0, 4) THEN 'ok' WHEN turn = 0 AND conv_id % 16 = 1 THEN 'malformed' ELSE 'absent' END AS tools_status,
  CASE WHEN role = 'assistant' AND conv_id % 4 = 0 THEN 'ok' WHEN role = 'assistant' AND conv_id % 20 = 5 THEN 'malformed' ELSE 'absent' END AS calls_status
FROM conversations""")
def q_tool_group(spark, sf_dir):
    """P14's status of the tool fields of every message: ok, malformed or absent."""
    return chat.tool_status(_tool_messages(spark, sf_dir)).select("conv_id", "turn", "tools_status", "calls_status")


@register("quarantine_reasons", f"""
SELECT conv_id, min(error) AS reason FROM ({_DUCK_TOOL_BLOCKS}) GROUP BY conv_id HAVING min(error) IS NOT NULL""")
def q_quarantine_reasons(spark, sf_dir):
    """Conversations the template cannot render, with the reason; also from messages beyond the SFT cut."""
    r = chat.sft_encode(_tool_messages(spark, sf_dir))
    return r.filter(F.col("error").isNotNull()).select("conv_id", F.col("error").alias("reason"))


@register("step_log", f"""
WITH s AS ({_duck_steps(1, O.PRETRAIN_BATCH, (0,))}),
d AS ({_duck_doc_loss(_duck_pairs())}),
b AS (SELECT epoch, batch_id, doc_id FROM ({_duck_plan(1, O.PRETRAIN_BATCH, (0,))})),
l AS (SELECT b.epoch, b.batch_id + 1 AS step, sum(d.sum_nll) / sum(d.n_tokens) AS loss
      FROM b JOIN d ON b.doc_id = d.doc_id GROUP BY b.epoch, b.batch_id)
SELECT s.epoch, CAST(s.step AS BIGINT) AS step, CAST(s.epoch * s.iters + s.step AS BIGINT) AS global_step,
       round({O.PRETRAIN_LR} * (0.1 + 0.45 * (1 + cos(pi() * (s.epoch * s.iters + s.step) / (1 * s.iters)))), 12) AS lr,
       round((l.loss + 0.0) / {O.PRETRAIN_ACCUMULATION} * {O.PRETRAIN_ACCUMULATION}, 6) AS loss,
       CAST(CASE WHEN s.epoch * (s.iters // {O.PRETRAIN_ACCUMULATION}) + (s.step - 1) // {O.PRETRAIN_ACCUMULATION}
                      < 1 * (s.iters // {O.PRETRAIN_ACCUMULATION})
                 THEN s.epoch * (s.iters // {O.PRETRAIN_ACCUMULATION}) + (s.step - 1) // {O.PRETRAIN_ACCUMULATION} END AS BIGINT) AS update_id,
       CAST(s.step % {LOG_EVERY} = 0 OR s.step = s.iters AS INTEGER) AS logged,
       CAST(floor(s.step * {SECONDS_PER_STEP} / (s.step + 1) * s.iters / 60) - floor(s.step * {SECONDS_PER_STEP} / 60) AS BIGINT) AS eta_min
FROM s JOIN l ON s.epoch = l.epoch AND s.step = l.step""")
def q_step_log(spark, sf_dir):
    """The per-step table of a pretraining run: W7, A3, A1/A5, W8, F5, A4 on one row."""
    plan = _plan(spark, sf_dir, world_size=1, epochs=(0,))
    steps = _steps(spark, sf_dir, 1, O.PRETRAIN_BATCH, (0,))
    per_batch = O.attach_samples(plan.select("doc_id", "epoch", "batch_id"), _sample_loss(spark, sf_dir), "doc_id") \
        .groupBy("epoch", "batch_id").agg(ST.masked_mean(F.sum("sum_nll"), F.sum("n_tokens")).alias("batch_loss"))
    j = steps.join(per_batch.select("epoch", (F.col("batch_id") + 1).alias("step"), "batch_loss"), ["epoch", "step"])
    g = O.global_step(F.col("epoch"), F.col("step"), F.col("iters"))
    return j.select(
        "epoch", "step", g.alias("global_step"),
        F.round(O.lr_at(g, F.lit(1) * F.col("iters"), O.PRETRAIN_LR), 12).alias("lr"),
        F.round(O.reported_loss(F.col("batch_loss"), 0.0, O.PRETRAIN_ACCUMULATION), 6).alias("loss"),
        O.accumulation_group(F.col("epoch"), F.col("step"), F.col("iters"), 1, O.PRETRAIN_ACCUMULATION).alias("update_id"),
        O.interval_or_last(F.col("step"), F.col("iters"), LOG_EVERY).cast("int").alias("logged"),
        O.eta_minutes(F.col("step") * F.lit(SECONDS_PER_STEP), F.col("step"), F.col("iters")).cast("bigint").alias("eta_min"))
