"""Structured Streaming forms.

T1 encodes arriving documents with exactly the batch expressions (stateless).
Conversations (one row each, with their list of messages) are encoded per
micro-batch.  T2 keeps the turns of each session as state, whatever order they arrive in:
a turn that comes late revises the prompts that it belongs to, and the last revision of each
prompt is the batch result.  ``late_turns`` says how far back a turn may come, and only that
much and the ``2h`` messages before it stay; ``ttl_ms`` drops sessions that fell silent.  T3 is
the checkpoint: a restarted query continues from its committed offsets and state, and
``trigger(availableNow=True)`` processes what has arrived and stops.  ``run_to_log`` commits each
micro-batch once, by its number, so a batch that is repeated after a failure adds nothing.

Checkpoints and sink tables live under the session's ``spark.checkpoint.dir``
(a shared folder on a cluster), never in a machine-local temporary folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from samplewright.functions import tokens as T
from samplewright.operators import chat, pretrain
from samplewright.operators.chat import DEFAULT_SYSTEM_BLOCK, GENERATION_PROMPT
from samplewright.operators.history import EXIT_COMMANDS, HISTORY_TURNS
from samplewright.session import shared_path
from samplewright.sources.manifest import CommitLog

PROMPT_SCHEMA = "session long, turn long, revision long, n_messages long, prompt string"
PROMPT_COLUMNS = pd.Index([c.split()[0] for c in PROMPT_SCHEMA.split(", ")])
STATE_SCHEMA = "turns array<long>, roles array<string>, texts array<string>, revision long, ended long"


def run_to_table(spark: SparkSession, stream: DataFrame, name: str, output_mode: str = "append",
                 checkpoint: str | None = None, path: str | None = None) -> str:
    """Run a streaming query until the available input is processed; return its sink path.

    Reusing ``checkpoint``/``path`` continues a previous run without redoing work (T3).
    """
    tag = f"{name}-{uuid.uuid4().hex[:12]}"
    path = path or shared_path(spark, f"stream-out/{tag}")
    checkpoint = checkpoint or shared_path(spark, f"stream-ckpt/{tag}")
    q = (stream.writeStream.format("parquet").outputMode(output_mode)
         .option("checkpointLocation", checkpoint).option("path", path)
         .trigger(availableNow=True).start())
    _finish(q)
    return path


def _finish(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def run_to_log(spark: SparkSession, stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """T3 with each micro-batch committed once: what the log holds after the available input.

    A batch that failed between its commit and the checkpoint comes again under its number and
    finds itself committed; one that failed before has left nothing that is read.
    """
    log, name = CommitLog(spark, path, stream.schema), checkpoint.rstrip("/").rsplit("/", 1)[-1]
    _finish(stream.writeStream.foreachBatch(lambda rows, batch: log.commit(rows, f"{name}/{batch}"))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    return log.rows()


def file_stream(spark: SparkSession, source_dir: str, schema: str, file_glob: str | None = None,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """A parquet file source over a directory; ``file_glob`` selects which arriving files count."""
    reader = spark.readStream.schema(schema)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(source_dir)


def table_pattern(base: str, name: str) -> str:
    """The source path of a table that is one parquet file or a folder of them: as a pattern, a stream takes either."""
    return f"{base.rstrip('/')}/{{{name}.parquet}}"


def stream_encode(spark: SparkSession, source_dir: str, schema: str, file_glob: str | None = None,
                  max_length: int = T.PRETRAIN_MAX_LENGTH) -> DataFrame:
    """Documents arriving as parquet files -> pretraining samples (same columns as batch)."""
    return pretrain.encode_pretrain(file_stream(spark, source_dir, schema, file_glob), max_length=max_length)


def stream_sft(spark: SparkSession, source_dir: str, schema: str, path: str, checkpoint: str,
               file_glob: str | None = None, max_length: int = T.SFT_MAX_LENGTH, augment: dict | None = None,
               max_files_per_trigger: int | None = None) -> str:
    """Nested conversations (``conv_id, conversations``) arriving as parquet files -> SFT samples under ``path``.

    Each micro-batch is encoded by the batch operator into its own folder, which a
    repeated micro-batch overwrites, so a restart neither loses nor doubles samples.
    """
    def encode(rows: DataFrame, batch: int) -> None:
        samples = chat.sft_encode(chat.messages_from_nested(rows), max_length=max_length, augment=augment)
        samples.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    q = (file_stream(spark, source_dir, schema, file_glob, max_files_per_trigger).writeStream
         .foreachBatch(encode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    _finish(q)
    return path


def revised_prompts(turns: list[tuple], arrived: set[int], ended: int | None, history_turns: int) -> list[tuple]:
    """``(turn, n_messages, prompt)`` of the questions that the arrived turns belong to.

    ``turns`` are all known ``(turn, role, text)`` in order, ``ended`` the turn of a known exit.
    A question that is no longer part of the session has neither number nor prompt.
    """
    live, dead, exits = [], [], ended
    for turn, role, text in turns:
        content = text if role != "user" else ("" if text is None else text.strip())
        if role == "user" and content.lower() in EXIT_COMMANDS:
            exits = turn if exits is None else min(exits, turn)
        if exits is not None and turn >= exits or role == "user" and not content:
            dead += [turn] if role == "user" else []
        else:
            live.append((turn, role, content or ""))
    first, keep, out = min(arrived), 2 * history_turns, []
    reach = 0  # live messages since the last that arrived
    for i, (turn, role, _) in enumerate(live):
        reach = 0 if turn in arrived else reach + 1
        if role == "user" and turn >= first and (not keep or reach <= keep):
            shown = live[max(0, i - keep):i + 1] if keep else live[:i + 1]
            blocks = "".join(f"<|im_start|>{r}\n{c}<|im_end|>\n" for _, r, c in shown)
            out.append((turn, len(shown), DEFAULT_SYSTEM_BLOCK + blocks + GENERATION_PROMPT))
    return out + [(turn, None, None) for turn in dead if turn >= first]


def _is_exit(role: str, text: str | None) -> bool:
    return role == "user" and text is not None and text.strip().lower() in EXIT_COMMANDS


def _history_fn(history_turns: int, late_turns: int | None, ttl_ms: int | None):
    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState):
        if state.hasTimedOut:
            state.remove()
            return
        turns, roles, texts, revision, ended = state.get if state.exists else ([], [], [], 0, None)
        known, arrived = dict(zip(turns, zip(roles, texts))), {}
        for part in pdfs:
            said = (x if isinstance(x, str) else None for x in part["text"].tolist())  # a null may come as NaN
            arrived.update((int(t), (r, x)) for t, r, x in zip(part["turn"].tolist(), part["role"].tolist(), said))
        known.update(arrived)
        order = sorted(known)
        out = revised_prompts([(t, *known[t]) for t in order], set(arrived), ended, history_turns)
        exits = [t for t, (r, x) in arrived.items() if _is_exit(r, x)]
        ended = min([e for e in [ended, *exits] if e is not None], default=None)
        kept = _still_needed(order, known, ended, history_turns, late_turns)
        state.update((kept, [known[t][0] for t in kept], [known[t][1] for t in kept], revision + 1, ended))
        if ttl_ms:
            state.setTimeoutDuration(ttl_ms)
        if out:
            rows = np.empty((len(out), len(PROMPT_COLUMNS)), dtype=object)  # one block: a frame for each session is dear
            rows[:] = [(key[0], t, revision, n, p) for t, n, p in out]
            yield pd.DataFrame(rows, columns=PROMPT_COLUMNS)
    return fn


def _still_needed(order: list[int], known: dict, ended: int | None, history_turns: int, late_turns: int | None) -> list[int]:
    """Turns that a late one or a later question can still need: those in reach, and the ``2h`` messages before them."""
    if late_turns is None or not history_turns:
        return order
    floor = order[-1] - late_turns
    early = [t for t in order if t < floor and (ended is None or t < ended) and (known[t][0] != "user" or (known[t][1] or "").strip())]
    return early[-2 * history_turns:] + [t for t in order if t >= floor]


def stream_history(spark: SparkSession, source_dir: str, schema: str, file_glob: str | None = None,
                   history_turns: int = HISTORY_TURNS, max_files_per_trigger: int | None = None,
                   late_turns: int | None = None, ttl_ms: int | None = None) -> DataFrame:
    """Per-session bounded history -> revisions of the prompt of every question (see ``latest_prompts``).

    The last revisions equal batch W9 + F2 + F3 on what has arrived, in whatever order it came.
    With ``late_turns`` the state forgets turns further back than that; a turn that is later
    still is taken with what is left.  ``ttl_ms`` drops the state of a session that has been silent for
    so long; its timeouts keep an ``availableNow`` run from ending, so give it to continuous queries.
    """
    src = file_stream(spark, source_dir, schema, file_glob, max_files_per_trigger)
    msgs = src.filter(F.col("role").isin("user", "assistant")).select(
        F.col("conv_id").alias("session"), "turn", "role", "text")
    return msgs.groupBy("session").applyInPandasWithState(
        _history_fn(history_turns, late_turns, ttl_ms), PROMPT_SCHEMA, STATE_SCHEMA, "append",
        GroupStateTimeout.ProcessingTimeTimeout if ttl_ms else GroupStateTimeout.NoTimeout)


def latest_prompts(revisions: DataFrame) -> DataFrame:
    """``session, turn, n_messages, prompt``: the last revision of every question that is still part of its session."""
    last = F.max_by(F.struct("n_messages", "prompt"), "revision").alias("p")
    return revisions.groupBy("session", "turn").agg(last).select("session", "turn", "p.*").filter("prompt is not null")
