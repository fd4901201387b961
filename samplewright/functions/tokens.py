"""Token-level Column functions (P1-P9, P11, P12) for the built-in ``bytes`` tokenizer.

The ``bytes`` tokenizer splits text into special markers or single code points;
a special marker becomes its fixed id, every UTF-8 byte ``b`` of a code point
becomes ``b + 3``.  Everything here is a pure Column expression, so it runs
inside the JVM (no Python worker) and composes into one projection.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from samplewright.functions.batches import pieces as batch_pieces

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference tokenizer configuration.
PAD_ID = 0          # "<|endoftext|>", also the unknown-token id
BOS_ID = 1          # "<|im_start|>"
EOS_ID = 2          # "<|im_end|>"
IGNORE_INDEX = -100
SPECIAL_TOKENS = {"<|endoftext|>": 0, "<|im_start|>": 1, "<|im_end|>": 2}
MODEL_MAX_LENGTH = 32768
PRETRAIN_MAX_LENGTH = 512
SFT_MAX_LENGTH = 340
# Characters removed by Python's str.strip() (the reference strips decoded replies
# and typed questions).
PY_WHITESPACE = (r"\t\n\x{0B}\x{0C}\r\x{1C}\x{1D}\x{1E}\x{1F} \x{85}\x{A0}\x{1680}"
                 r"\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
# ---------------------------------------------------------------------------

STRIP_PATTERN = f"^[{PY_WHITESPACE}]+|[{PY_WHITESPACE}]+$"
# The same characters as a plain set, for trim (which only looks at both ends).
PY_WHITESPACE_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
                       + "".join(chr(c) for c in range(0x2000, 0x200B))
                       + "\u2028\u2029\u202f\u205f\u3000")

BYTE_OFFSET = 3
# One special marker or one code point.
PIECE_PATTERN = r"(?s)<\|(?:im_start|im_end|endoftext)\|>|."
LONGEST_SPECIAL = max(len(s) for s in SPECIAL_TOKENS)  # 13 characters


def py_strip(text: Column) -> Column:
    """Python ``str.strip()``: remove leading and trailing white space.

    ``trim`` with an explicit character set inspects only the two ends of the
    string (a regular expression would scan every character).
    """
    return F.trim(text, F.lit(PY_WHITESPACE_CHARS))


def as_text(col: Column) -> Column:
    """Coerce to string; a missing value becomes the four letters ``None``."""
    return F.coalesce(col.cast("string"), F.lit("None"))


def byte_string(text: Column) -> Column:
    """The text's UTF-8 bytes as a string with one character per byte (Latin-1 view).

    Special markers are ASCII and survive unchanged, so splitting this string
    into markers and single characters yields exactly the ``bytes`` tokens.
    """
    return F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")


def _byte_piece_id(piece: Column) -> Column:
    """A byte piece (1-2 storage bytes) -> byte + 3; a marker piece -> its fixed id."""
    special = None
    for text, tid in SPECIAL_TOKENS.items():
        cond = piece == F.lit(text)
        special = F.when(cond, F.lit(tid)) if special is None else special.when(cond, F.lit(tid))
    return F.when(F.octet_length(piece) <= 2, F.ascii(piece) + BYTE_OFFSET).otherwise(special)


def pieces(text: Column) -> Column:
    """Split text into special markers and single code points."""
    return F.regexp_extract_all(text, F.lit(PIECE_PATTERN), 0)


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` (a one-element transform acts as ``let``).

    Separate projections are not enough where a lambda uses the value: the optimizer may inline a
    column that is referenced once, and the lambda then evaluates it again for each element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def _plain_ids(b: Column) -> Column:
    """Ids of a byte-view string holding no marker: one byte per character."""
    return F.when(F.length(b) == 0, F.array().cast("array<int>")).otherwise(
        F.transform(F.split(b, "", -1), lambda p: F.ascii(p) + BYTE_OFFSET))


def _ids_of_byte_string(b: Column) -> Column:
    """Ids of a byte-view string.  Without any ``<|`` every piece is one byte, and a
    plain per-character ``split`` (much cheaper than the marker regex) yields them."""
    return let(b, lambda v: F.when(F.instr(v, "<|") == 0, _plain_ids(v))
                .otherwise(F.transform(pieces(v), _byte_piece_id)))


def encode(text: Column, max_tokens: int | None = None) -> Column:
    """Text -> ARRAY<INT> ids, no added specials; optionally P5 right truncation.

    Works on the byte view of the text (``byte_string``, computed once per value):
    a per-character split when no marker can occur, otherwise the marker regex,
    then one ``transform`` to ids.  With a bound ``n`` the text is cut before any
    per-character work: ``n`` tokens span at most ``13 n`` characters (the longest
    marker), and exactly ``n`` bytes when no ``<|`` occurs.
    """
    if max_tokens is None:
        return _ids_of_byte_string(byte_string(text))
    n = int(max_tokens)
    if n <= 0:
        return F.array().cast("array<int>")
    wide = byte_string(F.substring(text, 1, LONGEST_SPECIAL * n))
    return let(wide, lambda w: F.when(F.instr(w, "<|") == 0, _plain_ids(F.substring(w, 1, n))).otherwise(
        F.transform(F.slice(pieces(w), 1, n), _byte_piece_id)))


def frame(ids: Column) -> Column:
    """[BOS] + ids + [EOS]."""
    return F.concat(F.array(F.lit(BOS_ID)), ids, F.array(F.lit(EOS_ID)))


def pad_right(ids: Column, length: int, value: int = PAD_ID) -> Column:
    """Right-pad with ``value`` to ``length`` (never cuts)."""
    return F.concat(ids, F.array_repeat(F.lit(value), F.greatest(F.lit(0), F.lit(length) - F.size(ids))))


def pretrain_labels(ids: Column) -> Column:
    """Labels are the ids with every PAD-valued id replaced by -100 (by value)."""
    return F.transform(ids, lambda x: F.when(x == PAD_ID, F.lit(IGNORE_INDEX)).otherwise(x))


def attention_mask(ids: Column) -> Column:
    """1 where the id is not PAD, else 0."""
    return F.transform(ids, lambda x: (x != PAD_ID).cast("int"))


def labels_after_pad(core: Column, length: int) -> Column:
    """P7 + P8 from the unpadded ids: PAD-valued ids -> -100 (by value).

    When ``core`` holds no PAD id (the usual case: only a literal
    ``<|endoftext|>`` in the text produces one) this is a plain concatenation;
    otherwise the by-value rule is applied element-wise.
    """
    pad = F.greatest(F.lit(0), F.lit(length) - F.size(core))
    fast = F.concat(core, F.array_repeat(F.lit(IGNORE_INDEX), pad))
    return F.when(F.array_contains(core, PAD_ID), pretrain_labels(pad_right(core, length))).otherwise(fast)


def mask_after_pad(core: Column, length: int) -> Column:
    """P7 + P9 from the unpadded ids: 1 for non-PAD ids, 0 for PAD (padding included)."""
    pad = F.greatest(F.lit(0), F.lit(length) - F.size(core))
    fast = F.concat(F.array_repeat(F.lit(1), F.size(core)), F.array_repeat(F.lit(0), pad))
    return F.when(F.array_contains(core, PAD_ID), attention_mask(pad_right(core, length))).otherwise(fast)


def _text_of(ids: pa.Array) -> pa.Array:
    """The text of each list of ids: byte ids as UTF-8, invalid sequences as U+FFFD; null stays null."""
    flat = ids.flatten().to_numpy(zero_copy_only=False)
    size = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(size)])
    kept = (flat >= BYTE_OFFSET) & (flat < BYTE_OFFSET + 256)
    raw = (flat[kept] - BYTE_OFFSET).astype(np.uint8).tobytes()
    ends = np.concatenate([[0], np.cumsum(kept)])[ends]
    valid = ids.is_valid().to_pylist()
    return pa.array([raw[a:b].decode("utf-8", "replace") if ok else None for a, b, ok in zip(ends, ends[1:], valid)], pa.string())


def decode(ids: Column, strip: bool = True) -> Column:
    """Ids -> text, specials skipped, then surrounding white space stripped.

    One Arrow pass: the byte ids of a piece of a batch become one byte string, of which each row
    reads its part.  A lambda per id measured slower.
    """
    @F.arrow_udf("string")
    def text_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for lists in batch_pieces(batch):
                yield _text_of(lists)

    return py_strip(text_of(ids)) if strip else text_of(ids)


def csv(ids: Column) -> Column:
    """Array of ints as a comma-joined string (stable form for comparisons)."""
    return F.array_join(ids, ",")


def hash_unit(seed: Column | int, epoch: Column | int, key: Column, part: int = 0) -> Column:
    """Deterministic uniform draw in [0, 1) from md5(seed|epoch|key).

    ``part`` selects which 8-hex-digit slice of the digest is used, so several
    independent draws can come from one digest.
    """
    digest = F.md5(F.concat_ws("|", F.lit(seed) if isinstance(seed, int) else seed,
                              F.lit(epoch) if isinstance(epoch, int) else epoch,
                              key.cast("string")))
    word = F.conv(F.substring(digest, 1 + 8 * part, 8), 16, 10).cast("double")
    return word / F.lit(4294967296.0)


def hash_word(seed: Column | int, epoch: Column | int, key: Column, part: int = 0) -> Column:
    """The same 32-bit word as ``hash_unit`` as a BIGINT."""
    digest = F.md5(F.concat_ws("|", F.lit(seed) if isinstance(seed, int) else seed,
                              F.lit(epoch) if isinstance(epoch, int) else epoch,
                              key.cast("string")))
    return F.conv(F.substring(digest, 1 + 8 * part, 8), 16, 10).cast("bigint")
