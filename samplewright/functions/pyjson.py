"""Python-style JSON for tool schemas and tool calls (Arrow-batched UDF).

The chat template prints tools and call arguments with Python ``json.dumps``
spacing (``", "`` and ``": "``), original key order and non-ASCII kept.  Spark's
``to_json`` is compact and ``VARIANT`` sorts keys, so this one formatting step is
a vectorised pandas UDF.  It only ever sees rows that carry tool metadata: the
caller filters them out first, and for tables without such columns Catalyst
removes the UDF branch altogether.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

TOOL_RESULT = T.StructType([
    T.StructField("tools_text", T.StringType()),
    T.StructField("tools_error", T.StringType()),
    T.StructField("calls_text", T.StringType()),
    T.StructField("calls_error", T.StringType()),
])

_MISSING = object()


def _dumps(value) -> str:
    return json.dumps(value, ensure_ascii=False)


def _decode(raw):
    """JSON-decode a string field; malformed text is kept as the raw string."""
    if raw is None:
        return None
    try:
        return json.loads(raw)
    except (json.JSONDecodeError, ValueError):
        return raw


def _jinja_str(value) -> str:
    if value is _MISSING:
        return ""
    if value is None:
        return "None"
    if isinstance(value, bool):
        return "True" if value else "False"
    return value if isinstance(value, str) else str(value)


def render_tools(tools_raw, functions_raw):
    """(text, error): one ``\\n`` + JSON line per tool, or None when no tools apply."""
    chosen = _decode(tools_raw) or _decode(functions_raw)
    if not chosen:
        return None, None
    if not isinstance(chosen, list) or not all(isinstance(t, dict) for t in chosen):
        return None, "bad_tools"
    return "".join("\n" + _dumps(t) for t in chosen), None


def render_calls(calls_raw, content):
    """(text, error): the ``<tool_call>`` blocks of one assistant message."""
    calls = _decode(calls_raw)
    if not calls:
        return None, None
    if not isinstance(calls, list):
        return None, "bad_tool_calls"
    has_content = isinstance(content, str) and content != ""
    out = []
    for i, call in enumerate(calls):
        if not isinstance(call, dict):
            return None, "bad_tool_calls"
        if call.get("function"):
            call = call["function"]
            if not isinstance(call, dict):
                return None, "bad_tool_calls"
        if "arguments" not in call:
            return None, "bad_tool_calls"
        if (i == 0 and has_content) or i > 0:
            out.append("\n")
        args = call["arguments"]
        args_text = args if isinstance(args, str) else _dumps(args)
        out.append('<tool_call>\n{"name": "' + _jinja_str(call.get("name", _MISSING))
                   + '", "arguments": ' + args_text + "}\n</tool_call>")
    return "".join(out), None


@F.pandas_udf(TOOL_RESULT)
def tool_fields(tools: pd.Series, functions: pd.Series, tool_calls: pd.Series,
                content: pd.Series) -> pd.DataFrame:
    rows = []
    for t, f, c, m in zip(tools, functions, tool_calls, content):
        t = None if t is None or (isinstance(t, float) and pd.isna(t)) else t
        f = None if f is None or (isinstance(f, float) and pd.isna(f)) else f
        c = None if c is None or (isinstance(c, float) and pd.isna(c)) else c
        m = None if m is None or (isinstance(m, float) and pd.isna(m)) else m
        tt, te = render_tools(t, f)
        ct, ce = render_calls(c, m)
        rows.append((tt, te, ct, ce))
    return pd.DataFrame(rows, columns=["tools_text", "tools_error", "calls_text", "calls_error"])
