"""Chat sessions: blank/exit filtering and bounded history prompts.

A session table has one row per message ``session, turn, role, text`` with
roles ``user`` / ``assistant``.  Every operation is a window partitioned by
``session`` and ordered by ``turn``; frames are bounded by ``2 * history_turns``
rows, so a very long session streams through its task with bounded memory.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from samplewright.functions import tokens as T
from samplewright.operators.chat import DEFAULT_SYSTEM_BLOCK, GENERATION_PROMPT

# ---------------------------------------------------------------------------
# Commands that end a session (compared after strip, any case),
# default history length and reply length.
EXIT_COMMANDS = ["/exit", "/quit"]
HISTORY_TURNS = 3
MAX_NEW_TOKENS = 128
# ---------------------------------------------------------------------------
#: Messages of a piece of a session's text.
PIECE_ROWS = 256

py_strip = T.py_strip


def sessions_from_turns(df: DataFrame, session_col: str = "conv_id", turn_col: str = "turn",
                        role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Session messages: only ``user`` / ``assistant`` rows take part in a chat loop."""
    return df.filter(F.col(role_col).isin("user", "assistant")).select(
        F.col(session_col).alias("session"), F.col(turn_col).alias("turn"),
        F.col(role_col).alias("role"), F.col(text_col).alias("text"))


def live_messages(sessions: DataFrame) -> DataFrame:
    """F2 + F3: strip questions, drop blank ones, and end each session at ``/exit``/``/quit``.

    The exit row and every later row of its session are dropped; a blank
    question is skipped without ending the session.
    """
    w = Window.partitionBy("session").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    q = F.when(F.col("role") == "user", py_strip(F.coalesce(F.col("text"), F.lit("")))).otherwise(F.col("text"))
    is_exit = (F.col("role") == "user") & F.lower(F.col("content")).isin(*EXIT_COMMANDS)
    marked = sessions.withColumn("content", q).withColumn(
        "_ended", F.max(is_exit.cast("int")).over(w))
    return marked.filter((F.col("_ended") == 0) & ~((F.col("role") == "user") & (F.col("content") == ""))) \
                 .drop("_ended", "text")


def _two_level_prefix(df: DataFrame, key: str, order: str, value: str, agg, out: str,
                      bucket_rows: int, inclusive: bool) -> DataFrame:
    """Running ``agg`` (F.sum / F.max) of ``value`` per ``key`` in ``order`` without a
    window over a whole key: inside buckets of ``bucket_rows`` order values, then over
    the per-bucket totals (one row per bucket), joined back on ``(key, bucket)``."""
    b = df.withColumn("_bk", F.floor(F.col(order) / F.lit(bucket_rows)))
    end = 0 if inclusive else -1
    inside = Window.partitionBy(key, "_bk").orderBy(order).rowsBetween(Window.unboundedPreceding, end)
    b = b.withColumn("_in", agg(value).over(inside))
    totals = b.groupBy(key, "_bk").agg(agg(value).alias("_bt"))
    before = Window.partitionBy(key).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(key, "_bk", agg("_bt").over(before).alias("_bs"))
    j = b.join(starts, [key, "_bk"])
    if agg is F.sum:
        combined = F.coalesce(F.col("_bs"), F.lit(0)) + F.coalesce(F.col("_in"), F.lit(0))
    else:
        combined = F.greatest(F.coalesce(F.col("_bs"), F.col("_in")), F.coalesce(F.col("_in"), F.col("_bs")))
    return j.withColumn(out, combined).drop("_bk", "_in", "_bs")


def live_messages_bucketed(sessions: DataFrame, bucket_rows: int = 1024) -> DataFrame:
    """F2 + F3 like ``live_messages`` without a window over a whole session.

    ``turn`` values must be unique integers per session (gaps allowed).  Adds
    ``live_pos``, the dense 0-based position among the kept messages.
    """
    q = F.when(F.col("role") == "user", py_strip(F.coalesce(F.col("text"), F.lit("")))).otherwise(F.col("text"))
    m = sessions.withColumn("content", q).withColumn(
        "_exit", ((F.col("role") == "user") & F.lower(F.col("content")).isin(*EXIT_COMMANDS)).cast("int"))
    m = _two_level_prefix(m, "session", "turn", "_exit", F.max, "_ended", bucket_rows, inclusive=True)
    live = m.filter((F.col("_ended") == 0) & ~((F.col("role") == "user") & (F.col("content") == ""))) \
            .drop("_ended", "_exit", "text").withColumn("_one", F.lit(1))
    live = _two_level_prefix(live, "session", "turn", "_one", F.sum, "_cnt", bucket_rows, inclusive=False)
    return live.withColumn("live_pos", F.col("_cnt").cast("bigint")).drop("_one", "_cnt")


def _block() -> Column:
    return F.concat(F.lit("<|im_start|>"), F.col("role"), F.lit("\n"),
                    F.coalesce(F.col("content"), F.lit("")), F.lit("<|im_end|>\n"))


def history_rope(messages: DataFrame, piece_rows: int = PIECE_ROWS) -> tuple[DataFrame, DataFrame]:
    """W9 for ``h = 0`` in size of the input: the texts of all sessions in pieces, and what each prompt is made of.

    ``session, piece, text`` has the blocks of ``piece_rows`` consecutive live messages; a prompt
    ``session, turn, n_messages, piece, tail`` is the pieces before its own and then ``tail``.
    No window or group holds more than a piece.
    """
    m = messages.select("session", "turn", "role", "live_pos", F.floor(F.col("live_pos") / piece_rows).alias("piece"), _block().alias("block"))
    pieces = m.groupBy("session", "piece").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("live_pos", "block"))), lambda x: x["block"]), "").alias("text"))
    so_far = Window.partitionBy("session", "piece").orderBy("live_pos").rowsBetween(-piece_rows, 0)
    prompts = m.withColumn("tail", F.collect_list("block").over(so_far)).filter(F.col("role") == "user").select(
        "session", "turn", (F.col("live_pos") + 1).cast("bigint").alias("n_messages"), "piece", F.array_join("tail", "").alias("tail"))
    return pieces, prompts


def rope_prompts(pieces: DataFrame, prompts: DataFrame, max_prompt_tokens: int = T.MODEL_MAX_LENGTH) -> DataFrame:
    """The whole text of every prompt of a rope; a row is as long as its session so far."""
    earlier = prompts.filter("piece > 0").select("session", "turn", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("piece") - 1)).alias("piece"))
    heads = earlier.join(pieces, ["session", "piece"]).groupBy("session", "turn").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("piece", "text"))), lambda x: x["text"]), "").alias("head"))
    prompt = F.concat(F.lit(DEFAULT_SYSTEM_BLOCK), F.coalesce("head", F.lit("")), "tail", F.lit(GENERATION_PROMPT))
    return (prompts.join(heads, ["session", "turn"], "left").select("session", "turn", "n_messages", prompt.alias("prompt"))
            .withColumn("prompt_ids", T.encode(F.col("prompt"), max_prompt_tokens)))


def history_prompts_joined(messages: DataFrame, history_turns: int = HISTORY_TURNS,
                           max_prompt_tokens: int = T.MODEL_MAX_LENGTH) -> DataFrame:
    """W9 like ``history_prompts`` without a window over a whole session.

    ``messages`` come from ``live_messages_bucketed`` (dense ``live_pos``).  Each
    question is exploded into its ``2h + 1`` frame positions and joined to the
    messages on ``(session, live_pos)``; the regrouping per question holds at most
    ``2h + 1`` rows.  ``h = 0`` keeps every earlier message: prompts are put together from
    the pieces of ``history_rope``.
    """
    if not history_turns:
        return rope_prompts(*history_rope(messages), max_prompt_tokens)
    k = 2 * int(history_turns)
    blocks = messages.select("session", "live_pos", _block().alias("block"))
    questions = messages.filter(F.col("role") == "user").select(
        "session", "turn", F.col("live_pos").alias("q_pos"),
        F.explode(F.sequence(F.lit(0), F.lit(k))).alias("back"))
    wanted = questions.withColumn("live_pos", F.col("q_pos") - F.col("back")).filter(F.col("live_pos") >= 0)
    framed = wanted.join(blocks, ["session", "live_pos"]).groupBy("session", "turn").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("live_pos", "block"))), lambda x: x["block"])
        .alias("_blocks"))
    prompt = F.concat(F.lit(DEFAULT_SYSTEM_BLOCK), F.array_join("_blocks", ""), F.lit(GENERATION_PROMPT))
    return framed.select("session", "turn", F.size("_blocks").cast("bigint").alias("n_messages"),
                         prompt.alias("prompt")) \
                 .withColumn("prompt_ids", T.encode(F.col("prompt"), max_prompt_tokens))


def history_prompts(messages: DataFrame, history_turns: int = HISTORY_TURNS,
                    max_prompt_tokens: int = T.MODEL_MAX_LENGTH) -> DataFrame:
    """W9 + P16 + P11b: the prompt sent for every question.

    Before a question the session holds at most ``2 * h`` earlier messages (the
    trim happens after each answer), so the prompt is the frame ``2h`` rows
    preceding the question plus the question; ``h = 0`` keeps everything.
    Returns ``session, turn, n_messages, prompt, prompt_ids`` (ids cut at the
    tokenizer limit).
    """
    if history_turns:
        frame = Window.partitionBy("session").orderBy("turn").rowsBetween(-2 * int(history_turns), 0)
    else:
        frame = Window.partitionBy("session").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    block = F.concat(F.lit("<|im_start|>"), F.col("role"), F.lit("\n"),
                     F.coalesce(F.col("content"), F.lit("")), F.lit("<|im_end|>\n"))
    framed = messages.select("session", "turn", "role",
                             F.collect_list(block).over(frame).alias("_blocks"))
    questions = framed.filter(F.col("role") == "user")
    prompt = F.concat(F.lit(DEFAULT_SYSTEM_BLOCK), F.array_join("_blocks", ""), F.lit(GENERATION_PROMPT))
    return questions.select("session", "turn", F.size("_blocks").cast("bigint").alias("n_messages"),
                            prompt.alias("prompt")) \
                    .withColumn("prompt_ids", T.encode(F.col("prompt"), max_prompt_tokens))


def reply_text(generated_ids: Column, prompt_len: Column | None = None,
               eos_id: int = T.EOS_ID) -> Column:
    """G6 tail + P4: keep new tokens up to the first EOS, decode without specials, strip."""
    ids = generated_ids if prompt_len is None else F.slice(generated_ids, prompt_len + 1, F.lit(1 << 30))
    stop = F.array_position(ids, F.lit(eos_id))
    cut = F.when(stop > 0, F.slice(ids, 1, (stop - 1).cast("int"))).otherwise(ids)
    return py_strip(T.decode(cut, strip=False))
