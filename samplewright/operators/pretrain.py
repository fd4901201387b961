"""Pretraining samples (P10) and the causal shift.

One narrow projection per document: no shuffle, no Python.  The per-document
cost is bounded by ``max_length`` because the text is cut before any
per-character work (see ``tokens.encode``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samplewright.functions import tokens as T
from samplewright.functions.batches import pieces

SPECIAL_PATTERN = r"<\|(?:im_start|im_end|endoftext)\|>"


def encode_pretrain(df: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                    max_length: int = T.PRETRAIN_MAX_LENGTH) -> DataFrame:
    """P10 = P1 -> P3 -> P5 -> P6 -> P7 -> P8 -> P9.

    Returns ``id, input_ids, labels, attention_mask`` (arrays of ``max_length``).
    ``input_ids`` is computed once; labels and mask derive from it in a second
    projection so the encoder is not evaluated three times.
    """
    ids = T.encode(T.as_text(F.col(text_col)), max_length - 2)
    core = df.select(F.col(id_col), T.frame(ids).alias("_core"))
    return core.select(
        id_col,
        T.pad_right(F.col("_core"), max_length).alias("input_ids"),
        T.labels_after_pad(F.col("_core"), max_length).alias("labels"),
        T.mask_after_pad(F.col("_core"), max_length).alias("attention_mask"),
    )


def full_token_count(text):
    """Number of ``bytes`` tokens of a whole text, without materialising the ids.

    Every UTF-8 byte is one token except inside a special marker, which is one
    token for its whole length.
    """
    specials = F.regexp_extract_all(text, F.lit(SPECIAL_PATTERN), 0)
    special_chars = F.aggregate(specials, F.lit(0), lambda acc, s: acc + F.length(s) - 1)
    return (F.octet_length(text) - special_chars).cast("bigint")


def token_stats(df: DataFrame, text_col: str = "text",
                max_length: int = T.PRETRAIN_MAX_LENGTH) -> DataFrame:
    """Per-corpus token statistics of the pretraining samples (one output row).

    ``n_tokens_full`` counts tokens of the whole texts; ``n_kept`` what survives
    the ``max_length - 2`` cut; ``n_truncated`` how many documents lose tokens.
    """
    text = T.as_text(F.col(text_col))
    per_doc = df.select(full_token_count(text).alias("n_full"))
    kept = F.least(F.col("n_full"), F.lit(max_length - 2))
    return per_doc.agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum("n_full").cast("bigint").alias("n_tokens_full"),
        F.sum(kept + 2).cast("bigint").alias("n_tokens_kept"),
        F.sum(F.lit(max_length) - kept - 2).cast("bigint").alias("n_pad"),
        F.sum((F.col("n_full") > max_length - 2).cast("int")).cast("bigint").alias("n_truncated"),
        F.max("n_full").cast("bigint").alias("max_tokens_full"),
    )


def causal_pairs(samples: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per predicted position ``(id, pos, cur, nxt)``.

    Token ``t`` predicts label ``t+1``; the first label is never used.
    Positions whose target label is ``-100`` are kept (F4 filters them).
    """
    return samples.select(
        id_col,
        F.posexplode(F.arrays_zip(
            F.slice("input_ids", 1, F.size("input_ids") - 1).alias("cur"),
            F.slice("labels", 2, F.size("labels") - 1).alias("nxt"),
        )).alias("pos", "pair"),
    ).select(id_col, "pos", F.col("pair.cur").alias("cur"), F.col("pair.nxt").alias("nxt"))


# Markers as byte strings with their ids, for the in-task pair counts.
_MARKERS = tuple((marker.encode(), i) for marker, i in T.SPECIAL_TOKENS.items())
_VOCAB = 256 + T.BYTE_OFFSET


def _window_pairs(text: str, inner: int) -> np.ndarray:
    """``cur * V + nxt`` of every causal pair of a text cut into framed windows of ``inner`` tokens."""
    raw = text.encode()
    ids = np.frombuffer(raw, np.uint8).astype(np.int64) + T.BYTE_OFFSET
    if b"<|" in raw:
        kept = np.ones(len(ids), bool)
        for marker, i in _MARKERS:
            at = raw.find(marker)
            while at >= 0:
                ids[at] = i
                kept[at + 1:at + len(marker)] = False
                at = raw.find(marker, at + len(marker))
        ids = ids[kept]
    cur, nxt = np.concatenate([[T.BOS_ID], ids]), np.concatenate([ids, [T.EOS_ID]])
    cuts = np.arange(inner, len(ids), inner)  # a window ends before and the next begins at each
    ends = ids[cuts - 1] * _VOCAB + T.EOS_ID
    cur[cuts] = T.BOS_ID
    return np.concatenate([cur * _VOCAB + nxt, ends])


def document_pair_counts(df: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                         max_length: int = T.PRETRAIN_MAX_LENGTH) -> DataFrame:
    """P12 + F4 over whole texts: ``id, cur, nxt, n`` per distinct pair of a document.

    A text is cut into consecutive windows of ``max_length - 2`` tokens, each framed by
    BOS and EOS, with no remainder lost; targets equal to the pad id are not labels.
    Counting happens inside the row, so only distinct pairs leave it, and those of a batch
    leave piece by piece.
    """
    kind = pa.list_(pa.struct([("cur", pa.int32()), ("nxt", pa.int32()), ("n", pa.int64())]))

    def of_piece(texts: pa.Array) -> pa.Array:
        keys, n, ends = [], [], [0]
        for text in texts:
            pairs = np.sort(_window_pairs(text.as_py(), max_length - 2))
            first = np.flatnonzero(np.diff(pairs, prepend=-1))
            labelled = pairs[first] % _VOCAB != T.PAD_ID
            keys.append(pairs[first][labelled])
            n.append(np.diff(first, append=len(pairs))[labelled])
            ends.append(ends[-1] + len(keys[-1]))
        flat, total = (np.concatenate([*x, np.zeros(0, np.int64)]) for x in (keys, n))
        items = pa.StructArray.from_arrays([pa.array((flat // _VOCAB).astype(np.int32)), pa.array((flat % _VOCAB).astype(np.int32)),
                                            pa.array(total)], fields=list(kind.value_type))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), items)

    @F.arrow_udf("array<struct<cur:int,nxt:int,n:bigint>>")
    def counts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield from map(of_piece, pieces(batch))

    return df.select(id_col, F.explode(counts(T.as_text(F.col(text_col)))).alias("_p")).select(id_col, "_p.*")
