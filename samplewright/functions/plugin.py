"""U1 + P17b: user-supplied tokenizers (Arrow-batched UDFs).

The built-in ``bytes`` tokenizer runs as SQL expressions.  A user's own encoder
(for example a BPE file loaded with ``tokenizers``) plugs in here: the loader
runs once per task (iterator UDF), texts arrive in Arrow batches, ids leave as
``ARRAY<INT>``.  With a merged vocabulary the string-level span method of P17
is not exact (a reply starting with a newline can merge with the header), so
labels are found by scanning the ids for the encoded marker sequences.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from samplewright.functions import tokens as T
from samplewright.functions.batches import pieces


def plugin_encoder(loader: Callable[[], Callable[[str], list[int]]]):
    """Return an Arrow UDF ``text -> ARRAY<INT>`` around ``loader()``, called once per task.

    ``loader`` must be picklable and return ``encode(text) -> list[int]``
    (no special tokens added).  The ids of a batch leave piece by piece.
    """

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        fn = loader()
        for batch in batches:
            for texts in pieces(batch):
                yield pa.array([None if t is None else np.asarray(fn(t), dtype=np.int32) for t in texts.to_pylist()], pa.list_(pa.int32()))

    return encode


def _marker_places(ids: np.ndarray, marker: list[int]) -> np.ndarray:
    """Every place where ``marker`` stands in ``ids``."""
    if len(ids) < len(marker):
        return np.zeros(0, np.int64)
    return np.flatnonzero((np.lib.stride_tricks.sliding_window_view(ids, len(marker)) == marker).all(axis=1))


def marker_labels(ids: np.ndarray, start: list[int], end: list[int], max_length: int) -> np.ndarray:
    """Token-level assistant spans: after each start marker, up to and including the next end marker.

    Markers are found by comparing all windows at once; a reply is paired with its end
    by binary search, and start markers inside a reply do not open another.
    """
    opens, closes = _marker_places(ids, start) + len(start), _marker_places(ids, end)
    nearest = np.searchsorted(closes, opens)
    stops = np.append(closes + len(end), len(ids))[nearest]
    labels = np.full(len(ids), T.IGNORE_INDEX, dtype=np.int32)
    free = 0
    for a, b in zip(opens.tolist(), stops.tolist()):
        if a - len(start) >= free:
            labels[a:min(b, max_length)] = ids[a:min(b, max_length)]
            free = b
    return labels


def token_labels(start_ids: list[int], end_ids: list[int], max_length: int):
    """P17b as a pandas UDF over padded ``ARRAY<INT>`` ids."""

    @F.pandas_udf("array<int>")
    def labels(ids: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else marker_labels(np.asarray(x, dtype=np.int32), start_ids,
                                                                   end_ids, max_length) for x in ids])

    return labels


def marker_label_expr(ids: Column, start: list[int], end: list[int], max_length: int) -> Column:
    """P17b without Python: the same labels as ``marker_labels`` from array functions.

    Markers are compared where their first id stands; one fold over the few start markers pairs
    each with the next end and skips those inside a reply; the labels are joined from runs of -100
    and slices of the ids, so the cost is that of the ids once, not once for every reply.
    """
    def places(marker: list[int], x: Column) -> Column:
        last = F.size(x) - len(marker)
        here = F.filter(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: (F.get(x, i) == marker[0])
                        & (F.slice(x, i + 1, F.lit(len(marker))) == F.array(*[F.lit(t) for t in marker])))
        return F.when(last >= 0, here).otherwise(F.array().cast("array<int>"))

    def segments(x: Column, closes: Column) -> Column:
        def step(acc: Column, o: Column) -> Column:
            nearest = F.try_element_at(F.filter(closes, lambda c: c >= o + len(start)), F.lit(1))
            stop = F.least(F.coalesce(nearest + len(end), F.size(x)), F.size(x))
            opened = F.struct(stop.alias("free"), F.concat(acc["spans"], F.array(F.struct(
                acc["free"].alias("gap"), (o + len(start)).alias("a"), stop.alias("b")))).alias("spans"))
            return F.when(o >= acc["free"], opened).otherwise(acc)

        nothing = F.struct(F.lit(0).alias("free"), F.array().cast("array<struct<gap:int,a:int,b:int>>").alias("spans"))
        found = F.aggregate(places(start, x), nothing, step)
        return T.let(found, lambda f: F.concat(
            F.flatten(F.transform(f["spans"], lambda s: F.concat(
                F.array_repeat(F.lit(T.IGNORE_INDEX), s["a"] - s["gap"]), F.slice(x, s["a"] + 1, s["b"] - s["a"])))),
            F.array_repeat(F.lit(T.IGNORE_INDEX), F.size(x) - f["free"])))

    def cut(labels: Column) -> Column:
        return F.concat(F.slice(labels, 1, max_length), F.array_repeat(F.lit(T.IGNORE_INDEX), F.size(labels) - max_length))

    return T.let(ids, lambda x: T.let(places(end, x), lambda closes: T.let(segments(x, closes), cut)))


def sft_plugin_arrays(prompt: Column, encode_udf, start_ids: list[int], end_ids: list[int],
                      max_length: int, pad_id: int = T.PAD_ID):
    """(input_ids, labels, attention_mask) for a rendered chat with a plug-in tokenizer.

    Cut to ``max_length`` (nothing reserved), pad, then scan the padded ids, as the
    reference does.  Only the encoder runs in Python.
    """
    ids = T.pad_right(F.slice(encode_udf(prompt), 1, max_length), max_length, pad_id)
    return ids, marker_label_expr(ids, start_ids, end_ids, max_length), T.attention_mask(ids)


def python_bytes_encoder() -> Callable[[str], list[int]]:
    """The built-in ``bytes`` tokenizer written as a plain Python encoder (a plug-in example)."""
    import re
    pattern = re.compile("(" + "|".join(re.escape(s) for s in T.SPECIAL_TOKENS) + ")")

    def encode(text: str) -> list[int]:
        out: list[int] = []
        for part in pattern.split(text):
            if part in T.SPECIAL_TOKENS:
                out.append(T.SPECIAL_TOKENS[part])
            elif part:
                out.extend(b + T.BYTE_OFFSET for b in part.encode("utf-8"))
        return out

    return encode
