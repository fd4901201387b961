"""SQL fragments for the DuckDB oracle.

The oracle re-derives every registered query independently in plain SQL over
the same parquet views.  These helpers only spell the ``bytes`` tokenizer and a
few recurring expressions in DuckDB syntax; they never touch Spark.
"""

from __future__ import annotations

PIECE = r"(?s)<\|(?:im_start|im_end|endoftext)\|>|."
SPECIAL = r"<\|(?:im_start|im_end|endoftext)\|>"
# Closed-or-open assistant span (group 1 = supervised text); header consumed.
SPAN_OPEN = r"(?s)<\|im_start\|>assistant\n(.*?(?:<\|im_end\|>\n|\z))"


def utf8_ids(cp: str) -> str:
    return (
        f"CASE WHEN {cp} < 128 THEN [{cp} + 3] "
        f"WHEN {cp} < 2048 THEN [({cp} >> 6) + 195, ({cp} & 63) + 131] "
        f"WHEN {cp} < 65536 THEN [({cp} >> 12) + 227, (({cp} >> 6) & 63) + 131, ({cp} & 63) + 131] "
        f"ELSE [({cp} >> 18) + 243, (({cp} >> 12) & 63) + 131, (({cp} >> 6) & 63) + 131, ({cp} & 63) + 131] END"
    )


def encode(text: str, max_tokens: int | None = None) -> str:
    """``bytes`` encoding of a SQL text expression as a DuckDB INT list."""
    src = text if max_tokens is None else f"substring({text}, 1, {13 * int(max_tokens)})"
    pieces = f"regexp_extract_all({src}, '{PIECE}', 0)"
    if max_tokens is not None:
        pieces = f"list_slice({pieces}, 1, {int(max_tokens)})"
    body = (
        f"flatten(list_transform({pieces}, lambda p: CASE p WHEN '<|endoftext|>' THEN [0] "
        f"WHEN '<|im_start|>' THEN [1] WHEN '<|im_end|>' THEN [2] ELSE {utf8_ids('unicode(p)')} END))"
    )
    if max_tokens is not None:
        body = f"list_slice({body}, 1, {int(max_tokens)})"
    return f"CAST({body} AS INTEGER[])"


def pad(ids: str, length: int, value: int = 0) -> str:
    return f"list_concat({ids}, list_transform(range(greatest(0, {length} - len({ids}))), lambda x: {value}))"


def csv(ids: str) -> str:
    return f"array_to_string({ids}, ',')"


def as_text(col: str) -> str:
    return f"coalesce(CAST({col} AS VARCHAR), 'None')"


def hash_unit(seed, epoch, key: str, part: int = 0) -> str:
    start = 1 + 8 * part
    return (f"(('0x' || substr(md5(concat_ws('|', CAST({seed} AS VARCHAR), CAST({epoch} AS VARCHAR), "
            f"CAST({key} AS VARCHAR))), {start}, 8))::BIGINT / 4294967296.0)")


def hash_word(seed, epoch, key: str, part: int = 0) -> str:
    start = 1 + 8 * part
    return (f"(('0x' || substr(md5(concat_ws('|', CAST({seed} AS VARCHAR), CAST({epoch} AS VARCHAR), "
            f"CAST({key} AS VARCHAR))), {start}, 8))::BIGINT)")
