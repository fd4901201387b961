"""Conversations: augmentation, chat rendering, assistant-only labels.

Messages are kept in long form, one row per message:
``conv_id, turn, role, content, tools, functions, tool_calls``.
Rendering has two levels.  Windows over buckets of a conversation's turns give
each message its neighbours and a lower bound of its start; one row per bucket
settles the edges, so no task ever holds a whole conversation.  Each message then
renders its own block, and one aggregation per conversation joins the blocks.  For
SFT only blocks that can reach the first ``max_length`` tokens are collected (at
most ``13 * max_length`` characters), while flags, counts and errors always come
from all messages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from samplewright.functions import tokens as T
from samplewright.functions.pyjson import TOOL_RESULT, tool_fields

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference (system prompts for augmentation,
# the chat template's literal text).
SYSTEM_PROMPTS = [
    "你是一个知识丰富的AI，尽力为用户提供准确的信息。",
    "你是一个专业的AI助手，请提供有价值的回答。",
    "You are a helpful AI assistant.",
]
ADD_SYSTEM_RATIO = 0.2
DEFAULT_SYSTEM_BLOCK = "<|im_start|>system\nYou are a helpful assistant<|im_end|>\n"
TOOLS_PREAMBLE = (
    "# Tools\n\nYou may call one or more functions to assist with the user query.\n\n"
    "You are provided with function signatures within <tools></tools> XML tags:\n<tools>"
)
TOOLS_POSTAMBLE = (
    "\n</tools>\n\nFor each function call, return a json object with function name and "
    "arguments within <tool_call></tool_call> XML tags:\n<tool_call>\n"
    "{\"name\": <function-name>, \"arguments\": <args-json-object>}\n</tool_call><|im_end|>\n"
)
GENERATION_PROMPT = "<|im_start|>assistant\n"
NO_THINKING = "<think>\n\n</think>\n\n"
ASSISTANT_HEADER = "<|im_start|>assistant\n"
TOOL_RESPONSE_OPEN = "<tool_response>"
TOOL_RESPONSE_CLOSE = "</tool_response>"
# ---------------------------------------------------------------------------

# Closed-or-open assistant span; group 1 is the supervised text (end marker included).
SPAN_PATTERN = r"(?s)<\|im_start\|>assistant\n(.*?(?:<\|im_end\|>\n|\z))"
SPECIAL_PATTERN = r"<\|(?:im_start|im_end|endoftext)\|>"
HEADER_TOKENS = len(ASSISTANT_HEADER.encode("utf-8")) - len("<|im_start|>") + 1  # 11


# ---------------------------------------------------------------------------
# Shapes of conversation input
# ---------------------------------------------------------------------------
def messages_from_turns(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                        role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Long-form turn table -> standard message columns (absent JSON fields are NULL)."""
    cols = set(df.columns)
    opt = lambda c: F.col(c).cast("string") if c in cols else F.lit(None).cast("string")
    return df.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("bigint").alias("turn"),
        F.col(role_col).alias("role"), F.col(text_col).cast("string").alias("content"),
        opt("tools").alias("tools"), opt("functions").alias("functions"),
        opt("tool_calls").alias("tool_calls"))


def messages_from_nested(df: DataFrame, id_col: str = "conv_id",
                         list_col: str = "conversations") -> DataFrame:
    """``ARRAY<STRUCT<role, content, ...>>`` -> one row per message (``posexplode``)."""
    fields = {f.name for f in df.schema[list_col].dataType.elementType.fields}
    get = lambda m, c: m[c].cast("string") if c in fields else F.lit(None).cast("string")
    exploded = df.select(F.col(id_col).alias("conv_id"), F.posexplode(list_col).alias("turn", "m"))
    return exploded.select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"), get(F.col("m"), "role").alias("role"),
        get(F.col("m"), "content").alias("content"), get(F.col("m"), "tools").alias("tools"),
        get(F.col("m"), "functions").alias("functions"),
        get(F.col("m"), "tool_calls").alias("tool_calls"))


def empty_conversations(nested: DataFrame, id_col: str = "conv_id",
                        list_col: str = "conversations") -> DataFrame:
    """Quarantine rows of the nested form that the template cannot render (empty list)."""
    return nested.filter(F.coalesce(F.size(list_col), F.lit(0)) <= 0).select(
        F.col(id_col).alias("conv_id"), F.lit("empty_conversation").alias("reason"))


# ---------------------------------------------------------------------------
# System-prompt augmentation (decision per conversation)
# ---------------------------------------------------------------------------
def augmentation(conv_id: Column, first_role: Column, seed: int = 42, epoch: int = 0,
                 ratio: float = ADD_SYSTEM_RATIO):
    """(augmented flag, prompt index) from md5(seed|epoch|conv_id).

    The reference draws with an unseeded ``random``; here the draw is a pure
    function of ``(seed, epoch, id)`` so that reruns and resumes agree.
    """
    u = T.hash_unit(seed, epoch, conv_id, part=0)
    flag = (~first_role.eqNullSafe(F.lit("system"))) & (u < F.lit(float(ratio)))
    idx = F.pmod(T.hash_word(seed, epoch, conv_id, part=1), F.lit(len(SYSTEM_PROMPTS))).cast("int")
    return flag, idx


def _prompt_choice(idx: Column) -> Column:
    expr = F.when(idx == 0, F.lit(SYSTEM_PROMPTS[0]))
    for i, p in enumerate(SYSTEM_PROMPTS[1:], start=1):
        expr = expr.when(idx == i, F.lit(p))
    return expr


# ---------------------------------------------------------------------------
# Per-message blocks, then ordered concatenation
# ---------------------------------------------------------------------------
def _with_tool_fields(messages: DataFrame) -> DataFrame:
    """Attach U3 results; only rows carrying tool metadata go through Python."""
    needs = F.col("tools").isNotNull() | F.col("functions").isNotNull() | F.col("tool_calls").isNotNull()
    with_py = messages.filter(needs).withColumn(
        "tj", tool_fields("tools", "functions", "tool_calls", "content"))
    plain = messages.filter(~needs).withColumn("tj", F.lit(None).cast(TOOL_RESULT))
    return plain.unionByName(with_py)


# Shortest possible block per role beyond its content (characters), for the prefilter.
_MIN_BLOCK = {"user": len("<|im_start|>user\n<|im_end|>\n"),
              "assistant": len(ASSISTANT_HEADER + "<|im_end|>\n"),
              "system": len("<|im_start|>system\n<|im_end|>\n"),
              "tool": len("\n" + TOOL_RESPONSE_OPEN + "\n\n" + TOOL_RESPONSE_CLOSE)}


def _lower_block_length(role: Column, content: Column) -> Column:
    """A lower bound of a message's rendered length that needs no neighbours."""
    n = F.coalesce(F.length(content), F.lit(0))
    body = F.lit(0)
    for r, k in _MIN_BLOCK.items():
        body = F.when(role == r, F.lit(k) + n).otherwise(body)
    return body


def tool_status(messages: DataFrame) -> DataFrame:
    """``conv_id, turn, tools_status, calls_status``, each ok, malformed or absent.

    Absent covers NULL, an empty text, JSON null and an empty list.
    """
    m = _with_tool_fields(messages)

    def status(text: str, error: str) -> Column:
        return (F.when(F.col(f"tj.{error}").isNotNull(), "malformed")
                .when(F.col(f"tj.{text}").isNotNull(), "ok").otherwise("absent"))

    return m.select("conv_id", "turn", status("tools_text", "tools_error").alias("tools_status"),
                    status("calls_text", "calls_error").alias("calls_status"))


def located(m: DataFrame, bucket_rows: int = 1024) -> DataFrame:
    """Each message with ``pos`` (0-based), ``prev_role, next_role, role0`` and ``bound``.

    ``turn`` may be any integers, unique in a conversation.  ``bound`` is at most
    the character offset of the message's block.  Windows span ``bucket_rows`` turn
    values; the bucket table holds one row per bucket and returns on the partitioning
    that the windows already have, so a message's text is shuffled once here.
    """
    bucket = F.floor(F.col("turn") / F.lit(bucket_rows))
    low = _lower_block_length(F.col("role"), F.col("content"))
    inside = Window.partitionBy("conv_id", "_bk").orderBy("turn")
    rows = m.withColumns({"_bk": bucket, "_low": low}).select(
        "*", (F.row_number().over(inside) - 1).alias("_rn"), F.lag("role").over(inside).alias("_prev"),
        F.lead("role").over(inside).alias("_next"),
        F.coalesce(F.sum("_low").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_in"))
    totals = m.select("conv_id", "turn", "role", bucket.alias("_bk"), low.alias("_low")).groupBy("conv_id", "_bk").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("_low").alias("_len"),
        F.min_by(F.struct("role"), "turn").alias("_first"), F.max_by(F.struct("role"), "turn").alias("_last"))
    over = Window.partitionBy("conv_id").orderBy("_bk")
    before = over.rowsBetween(Window.unboundedPreceding, -1)
    edges = totals.select(
        "conv_id", "_bk", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"),
        F.coalesce(F.sum("_len").over(before), F.lit(0)).alias("_start"),
        F.lag("_last").over(over)["role"].alias("_before"), F.lead("_first").over(over)["role"].alias("_after"),
        F.first("_first").over(over)["role"].alias("role0"))
    j = rows.join(edges, ["conv_id", "_bk"])
    return j.withColumns({
        "pos": (F.col("_off") + F.col("_rn")).cast("bigint"),
        "prev_role": F.when(F.col("_rn") == 0, F.col("_before")).otherwise(F.col("_prev")),
        "next_role": F.when(F.col("_rn") == F.col("_n") - 1, F.col("_after")).otherwise(F.col("_next")),
        "bound": F.col("_start") + F.col("_in"),
    }).drop("_bk", "_low", "_rn", "_prev", "_next", "_in", "_n", "_off", "_start", "_before", "_after")


def message_blocks(messages: DataFrame, augment: dict | None = None, cut_chars: int | None = None,
                   bucket_rows: int = 1024) -> DataFrame:
    """Render every message's block of the chat template.

    Returns ``conv_id, pos, turn, role, content, prev_role, block, error, ...`` where
    ``pos`` is the 0-based position in the conversation.  The header (system block,
    default block or tools block) is part of the block at ``pos = 0``.  With
    ``cut_chars`` the block is NULL where it cannot start before that character
    offset, and otherwise cut to ``cut_chars``; every message keeps its row.
    """
    m = located(_with_tool_fields(messages), bucket_rows)
    role = F.col("role")
    content = F.coalesce(F.col("content"), F.lit(""))
    first = F.col("pos") == 0
    tools_text = F.col("tj.tools_text")
    tools_used = first & (role == "system") & tools_text.isNotNull()

    if augment:
        aug_flag, aug_idx = augmentation(F.col("conv_id"), F.col("role0"), **augment)
    else:
        aug_flag, aug_idx = F.lit(False), F.lit(0)

    header = (
        F.when(tools_used, F.concat(F.lit("<|im_start|>system\n"), F.col("content"), F.lit("\n\n"),
                                    F.lit(TOOLS_PREAMBLE), tools_text, F.lit(TOOLS_POSTAMBLE)))
        .when(role == "system", F.concat(F.lit("<|im_start|>system\n"), F.col("content"),
                                         F.lit("<|im_end|>\n")))
        .when(aug_flag, F.concat(F.lit("<|im_start|>system\n"), _prompt_choice(aug_idx),
                                 F.lit("<|im_end|>\n")))
        .otherwise(F.lit(DEFAULT_SYSTEM_BLOCK))
    )
    opens_user = first | ~F.col("prev_role").eqNullSafe(F.lit("tool"))
    closes_user = ~F.col("next_role").eqNullSafe(F.lit("tool"))
    body = (
        F.when((role == "user") | ((role == "system") & ~first),
               F.concat(F.lit("<|im_start|>"), role, F.lit("\n"), content, F.lit("<|im_end|>\n")))
        .when(role == "assistant",
              F.concat(F.lit(ASSISTANT_HEADER), content, F.coalesce(F.col("tj.calls_text"), F.lit("")),
                       F.lit("<|im_end|>\n")))
        .when(role == "tool",
              F.concat(F.when(opens_user, F.lit("<|im_start|>user")).otherwise(F.lit("")),
                       F.lit("\n" + TOOL_RESPONSE_OPEN + "\n"), content, F.lit("\n" + TOOL_RESPONSE_CLOSE),
                       F.when(closes_user, F.lit("<|im_end|>\n")).otherwise(F.lit(""))))
        .otherwise(F.lit(""))
    )
    block = F.when(first, F.concat(header, body)).otherwise(body)
    error = (
        F.when(first & (role == "system") & F.col("content").isNull(), F.lit("null_system_content"))
        .when(first & (role == "system") & F.col("tj.tools_error").isNotNull(), F.col("tj.tools_error"))
        .when((role == "assistant") & F.col("tj.calls_error").isNotNull(), F.col("tj.calls_error"))
    )
    out = m.select("conv_id", "pos", "turn", "role", "content", "prev_role",
                   F.coalesce(block, F.lit("")).alias("block"), error.alias("error"),
                   aug_flag.alias("augmented"), aug_idx.alias("prompt_idx"),
                   F.col("role0").alias("first_role"), "bound")
    if cut_chars is None:
        return out.drop("bound")
    near = F.when(F.col("bound") < int(cut_chars), F.substring("block", 1, int(cut_chars)))
    return out.withColumn("block", near).drop("bound")


def _is_genuine_user(role: Column, content: Column) -> Column:
    wrapped = content.startswith(TOOL_RESPONSE_OPEN) & content.endswith(TOOL_RESPONSE_CLOSE)
    return (role == "user") & content.isNotNull() & ~F.coalesce(wrapped, F.lit(False))


def render(messages: DataFrame, augment: dict | None = None, generation_prompt: bool = False,
           enable_thinking: bool | None = None, cut_chars: int | None = None) -> DataFrame:
    """P16 (+P13, P16g, P16h): one row per conversation.

    Columns: ``conv_id, prompt, n_messages, last_query_index, augmented,
    prompt_idx, first_role, injected, error``.  All but the prompt cover every
    message, also beyond ``cut_chars``.
    """
    blocks = message_blocks(messages, augment=augment, cut_chars=cut_chars)
    shown = F.when(F.col("block") != "", F.struct("pos", "block"))
    agg = blocks.groupBy("conv_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(shown)),
                                 lambda x: x["block"]), "").alias("prompt"),
        F.max("pos").alias("_last"),
        F.max(F.when(_is_genuine_user(F.col("role"), F.col("content")), F.col("pos"))).alias("_lq"),
        F.max(F.when(F.col("pos") == 0, F.col("augmented").cast("int"))).alias("augmented"),
        F.max(F.when(F.col("pos") == 0, F.col("prompt_idx"))).alias("prompt_idx"),
        F.max(F.when(F.col("pos") == 0, F.col("first_role"))).alias("first_role"),
        F.max(F.coalesce(F.col("content"), F.lit("")).rlike(SPECIAL_PATTERN).cast("int")).alias("injected"),
        F.min("error").alias("error"),
    )
    prompt = F.col("prompt")
    if generation_prompt:
        tail = GENERATION_PROMPT + (NO_THINKING if enable_thinking is False else "")
        prompt = F.concat(prompt, F.lit(tail))
    if cut_chars is not None:
        prompt = F.substring(prompt, 1, int(cut_chars))
    shift = F.col("augmented")  # a prepended system message moves every index by one
    return agg.select(
        "conv_id", prompt.alias("prompt"), (F.col("_last") + 1 + shift).cast("bigint").alias("n_messages"),
        (F.coalesce(F.col("_lq"), F.col("_last")) + shift).cast("bigint").alias("last_query_index"),
        "augmented", "prompt_idx", "first_role", "injected", "error")


# ---------------------------------------------------------------------------
# Assistant-only labels and SFT samples
# ---------------------------------------------------------------------------
def segment_ids(prompt: Column) -> Column:
    """Encode a rendered chat as ``ARRAY<STRUCT<g: ids of the unsupervised gap, s: ids of span>>``.

    Gaps come from ``split`` on the span pattern, spans from its group 1; the
    assistant header between them is implied (11 tokens, never supervised).
    With the ``bytes`` tokenizer token-level and string-level marker search are
    equivalent, and pieces never straddle a gap/span boundary.  Gaps and spans
    are zipped first (the last gap has no span), so each regular expression runs
    once per chat rather than once per segment inside the lambda.
    """
    zipped = F.arrays_zip(F.split(prompt, SPAN_PATTERN, -1).alias("gap"),
                          F.regexp_extract_all(prompt, F.lit(SPAN_PATTERN), 1).alias("span"))
    return F.transform(zipped, lambda z: F.struct(
        T.encode(z["gap"]).alias("g"),
        F.when(z["span"].isNotNull(), T.encode(z["span"])).alias("s")))


def sft_arrays(segments: Column, max_length: int):
    """(input_ids, labels) before padding, both cut to ``max_length``."""
    header = F.array(*[F.lit(x) for x in [T.BOS_ID] + [b + T.BYTE_OFFSET for b in b"assistant\n"]])
    ignore = lambda n: F.array_repeat(F.lit(T.IGNORE_INDEX), n)
    empty = F.array().cast("array<int>")
    ids = F.flatten(F.transform(segments, lambda e: F.concat(
        e["g"], F.when(e["s"].isNull(), empty).otherwise(F.concat(header, e["s"])))))
    labels = F.flatten(F.transform(segments, lambda e: F.concat(
        ignore(F.size(e["g"])),
        F.when(e["s"].isNull(), empty).otherwise(F.concat(ignore(F.lit(HEADER_TOKENS)), e["s"])))))
    return F.slice(ids, 1, max_length), F.slice(labels, 1, max_length)


def sft_encode(messages: DataFrame, max_length: int = T.SFT_MAX_LENGTH,
               augment: dict | None = None) -> DataFrame:
    """Conversations -> ``conv_id, input_ids, labels, attention_mask, n_tokens, injected, error``.

    ``max_length`` is the plain ``[:L]`` cut of P11 (nothing reserved).  Labels
    are computed on the rendered text before the cut; slicing full labels equals
    labelling sliced ids.  Padding positions get label -100.
    """
    cut = T.LONGEST_SPECIAL * max_length
    rendered = render(messages, augment=augment, cut_chars=cut)
    seg = rendered.select("conv_id", "injected", "error", segment_ids(F.col("prompt")).alias("seg"))
    arrs = seg.select("conv_id", "injected", "error", *[
        c.alias(n) for c, n in zip(sft_arrays(F.col("seg"), max_length), ("ids", "lab"))])
    return arrs.select(
        "conv_id",
        T.pad_right(F.col("ids"), max_length).alias("input_ids"),
        T.pad_right(F.col("lab"), max_length, T.IGNORE_INDEX).alias("labels"),
        T.mask_after_pad(F.col("ids"), max_length).alias("attention_mask"),
        F.size("ids").cast("bigint").alias("n_tokens"),
        "injected", "error")


def supervised_count(labels: Column) -> Column:
    """A2: labels that take part in the loss after the causal shift (first label unused)."""
    return F.size(F.filter(F.slice(labels, 2, F.size(labels) - 1),
                           lambda x: x != T.IGNORE_INDEX)).cast("bigint")
