"""Secret scans with a linear-chain conditional random field (operator 10).

Base patterns find assigned values, access keys and long hexadecimal strings.  The
field adds secrets of other shapes: a text is cut into tokens, each described by
categories of its shape, its neighbours and its file, and every token is tagged
outside, begin or inside by Viterbi decoding.  Weights are fitted by maximum likelihood
on windows around tokens of a bounded sample of documents (``SAMPLE``), labelled by the
base patterns, and on the same windows with secrets of other makes in their place, so that
length and mixture count and not the makes that the patterns know.  Everything is scanned;
a tagged string without letters or digits, or with dots or slashes as addresses have, is dropped.

Viterbi runs exactly over chunks: a max-plus matrix for each chunk of tokens, a pass
over the chunk matrices, then the path inside each chunk, so one very long text
costs no more steps than many short ones of its size.

Defined results: null and empty texts have no spans; places are code points, ends
exclusive; base spans always stay, and a tagged span that overlaps one is dropped in
its favour; spans come by start, then kind as listed in ``KINDS``, then end;
without any labelled secret in the sample the field adds nothing.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samplewright.llm.common import distinct_sorted, slices

# The base patterns and the least length that a match of each needs.
ASSIGN = re.compile(rb"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"api_key", b"apikey")
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ("assign", "access", "hex", "crf")

#: Documents that the field is fitted on, at most: half that hold a base pattern, half any.
SAMPLE = 1_000
#: Tokens on either side of a training window's middle, and windows a document gives at most.
REACH, WINDOWS = 8, 4
#: Tokens in a chunk of exact decoding.
CHUNK = 512
#: Sizes of the categories of a token; see ``describe``.
SIZES = (40, 20, 8, 20, 12, 40, 40, 12)
#: The category of the keyword and the separator before a token.
CONTEXT = 4
CODES = "array<struct<codes:array<int>,tag:int>>"
SPAN = "struct<start:int,kind:string,end:int>"

_BYTES = np.arange(256)
DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
UPPER = (_BYTES >= 65) & (_BYTES <= 90)
LOWER = (_BYTES >= 97) & (_BYTES <= 122)
HIGH = _BYTES >= 128
SYMBOL = np.isin(_BYTES, list(b"+/_.=-"))
#: Part of a token; `=` joins tokens only inside base patterns.
PART = (DIGIT | UPPER | LOWER | HIGH | SYMBOL) & (_BYTES != 61)
HEX = DIGIT | ((_BYTES >= 97) & (_BYTES <= 102))


class Tokens:
    """Tokens of a slice of texts: bytes, text ends, token starts and ends, first token of each text."""

    def __init__(self, texts: pa.Array):
        data = texts.cast(pa.binary()) if not pa.types.is_binary(texts.type) else texts
        data = data.fill_null(b"")
        at = np.frombuffer(data.buffers()[1], np.int32)[data.offset:data.offset + len(data) + 1].astype(np.int64)
        self.raw = np.frombuffer(data.buffers()[2] or b"", np.uint8)[at[0]:at[-1]]
        self.at = at - at[0]
        self.start, self.end = self.runs(PART)
        self.first = np.searchsorted(self.start, self.at)
        self.points = np.concatenate([[0], np.cumsum((self.raw & 0xC0) != 0x80, dtype=np.int32)])

    def runs(self, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the maximal runs of bytes of a kind, within texts."""
        inside = np.zeros(len(self.raw) + 1, np.int8)
        inside[:-1] = kind[self.raw]
        step = np.diff(inside, prepend=np.int8(0))
        start, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        cuts = self.at[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(self.raw))]
        cuts = distinct_sorted(cuts[(inside[cuts] == 1) & (inside[cuts - 1] == 1)])
        if len(cuts):  # a text ends inside a run of the slice
            start, end = (np.sort(np.concatenate([x, cuts]), kind="stable") for x in (start, end))
        return start, end

    def text_of(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.at, place, side="right") - 1

    def counts(self, kind: np.ndarray) -> np.ndarray:
        """Bytes of a kind in each token."""
        total = np.concatenate([[0], np.cumsum(kind[self.raw], dtype=np.int32)])
        return total[self.end] - total[self.start]

    def keywords(self) -> np.ndarray:
        """Places where a keyword starts."""
        low, places = self.raw.tobytes().lower(), []
        for word in KEYWORDS:
            place = low.find(word)
            while place >= 0:
                places.append(place)
                place = low.find(word, place + 1)
        return np.unique(np.array(places, np.int64))

    def base(self, keywords: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """Base matches: text, kind, start, end, start of the secret; places in the slice."""
        found = []
        for doc in np.unique(self.text_of(keywords)):
            a = int(self.at[doc])
            for m in ASSIGN.finditer(self.raw[a:self.at[doc + 1]].tobytes()):
                if m.end(1) - m.start(1) >= LEAST["assign"]:
                    found.append((int(doc), 0, a + m.start(), a + m.end(), a + m.start(1)))
        start, end = self.runs(DIGIT | UPPER)
        for a, b in zip(start[long := end - start >= LEAST["access"]], end[long]):
            for m in ACCESS.finditer(self.raw[a:b].tobytes()):
                if m.end() - m.start() >= LEAST["access"]:
                    found.append((int(self.text_of(a)), 1, int(a + m.start()), int(a + m.end()), int(a + m.start())))
        start, end = self.runs(HEX)
        long = end - start >= LEAST["hex"]
        found += [(int(self.text_of(a)), 2, int(a), int(b), int(a)) for a, b in zip(start[long], end[long])]
        return found


def describe(tokens: Tokens, keywords: np.ndarray) -> np.ndarray:
    """Category codes of each token: shape, neighbours and file features, a column for each of ``SIZES``."""
    size = tokens.end - tokens.start
    if not len(size):
        return np.zeros((0, len(SIZES)), np.int16)
    digits, upper, lower = (tokens.counts(k) for k in (DIGIT, UPPER, LOWER))
    length = np.searchsorted([4, 8, 12, 16, 20, 24, 32], size, side="right")
    digit = np.where(digits == 0, 0, np.where(digits == size, 4, np.searchsorted([0.25, 0.6], digits / size, side="right") + 1))
    case = np.where(upper == 0, 0, np.where(lower == 0, 3, np.where(upper == 1, 1, 2)))
    flags = ((tokens.counts(SYMBOL) > 0) * 4 + (tokens.counts(HEX) == size) * 2 + (tokens.counts(HIGH) > 0))
    kind = np.select([DIGIT, UPPER, LOWER], [1, 2, 3], 0).astype(np.int8)[tokens.raw]
    change = np.concatenate([[0], np.cumsum(np.diff(kind) != 0, dtype=np.int32)])
    turns = np.searchsorted([2, 4, 7, 11], change[np.maximum(tokens.end - 1, tokens.start)] - change[tokens.start], side="right")
    keyed = np.zeros(len(size), bool)
    keyed[np.clip(np.searchsorted(tokens.start, keywords, side="right") - 1, 0, None)] = True
    assign = np.concatenate([[0], np.cumsum(np.isin(tokens.raw, list(b"=:")), dtype=np.int32)])
    quote = np.concatenate([[0], np.cumsum(np.isin(tokens.raw, list(b"\"'`")), dtype=np.int32)])
    gap = np.concatenate([[0], tokens.end[:-1]])
    joint = 2 * (assign[tokens.start] > assign[gap]) + (quote[tokens.start] > quote[gap])
    before = np.where(np.roll(keyed, 1), 2, np.where(np.roll(keyed, 2), 1, 0))
    opens = np.zeros(len(size), bool)
    opens[tokens.first[tokens.first < len(size)]] = True
    before[opens], joint[opens] = 0, 0
    shape = length * 5 + digit
    doc = tokens.text_of(tokens.start)
    marks = np.add.reduceat(np.concatenate([np.isin(tokens.raw, list(b"=:{};")), [False]]).astype(np.int32),
                            tokens.at[:-1])[doc] / np.maximum(np.diff(tokens.at)[doc], 1)
    file = np.searchsorted([0.002, 0.01, 0.03], marks, side="right") * 3 + np.searchsorted([1000, 10000], np.diff(tokens.at)[doc], side="right")
    previous, following = np.roll(shape, 1), np.roll(shape, -1)
    previous[opens] = 0
    following[np.roll(opens, -1)] = 0
    return np.stack([shape, case * 5 + digit, flags, turns * 4 + np.minimum(length // 2, 3), before * 4 + joint,
                     previous, following, file], axis=1).astype(np.int16)


def tags_of(tokens: Tokens, base: list[tuple[int, int, int, int, int]]) -> np.ndarray:
    """Tags by the base patterns: 0 outside, 1 begin, 2 inside."""
    tags = np.zeros(len(tokens.start), np.int8)
    for _, _, _, end, secret in sorted(base, key=lambda m: -m[1]):
        a, b = np.searchsorted(tokens.end, secret, side="right"), np.searchsorted(tokens.start, end)
        tags[a:b] = 2
        tags[a:a + 1] = 1
    return tags


class Field:
    """Weights: for each category a table by code and tag; transitions; scores of a first tag."""

    def __init__(self, tables: list[np.ndarray], moves: np.ndarray, first: np.ndarray):
        self.tables, self.moves, self.first = tables, moves, first

    def emissions(self, codes: np.ndarray) -> np.ndarray:
        return sum((t[codes[..., k]] for k, t in enumerate(self.tables)), np.zeros((*codes.shape[:-1], 3)))

    def decode(self, codes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The best tag of each token; ``first``: the first token of each text, and the end."""
        n = len(codes)
        if not n:
            return np.zeros(0, np.int8)
        score = self.emissions(codes)
        opens = np.zeros(n, bool)
        opens[first[:-1][np.diff(first) > 0]] = True
        width = -(-n // CHUNK)
        padded = np.zeros((width * CHUNK, 3))
        padded[:n] = score
        step = padded.reshape(width, CHUNK, 3)
        fresh = np.zeros(width * CHUNK, bool)
        fresh[:n] = opens
        fresh = fresh.reshape(width, CHUNK)
        # A text's first token scores alike from every state: texts follow each other in one chain.
        def arcs(t: int) -> np.ndarray:
            out = self.moves + step[:, t, None, :]
            if fresh[:, t].any():
                out[fresh[:, t]] = (self.first + step[fresh[:, t], t])[:, None, :]
            return out

        reach = np.where(np.eye(3, dtype=bool), 0.0, -np.inf) + np.zeros((width, 3, 3))
        for t in range(CHUNK):  # best score into each tag from each state before the chunk
            arc = arcs(t)
            best = reach[:, :, 0, None] + arc[:, None, 0]
            for tag in (1, 2):
                np.maximum(best, reach[:, :, tag, None] + arc[:, None, tag], out=best)
            reach = best
        state, into = np.zeros(3), np.zeros((width, 3))
        for c in range(width):
            into[c] = state
            state = (state[:, None] + reach[c]).max(axis=0)
            state -= state.max()
        now, back = into, np.zeros((CHUNK, width, 3), np.int8)
        for t in range(CHUNK):
            arc = arcs(t)
            best = now[:, 0, None] + arc[:, 0]
            for tag in (1, 2):
                ways = now[:, tag, None] + arc[:, tag]
                back[t][ways > best] = tag
                np.maximum(best, ways, out=best)
            now = best
        # The tag before each chunk, from the last chunk to the first.
        trail = np.tile(np.arange(3, dtype=np.int8), (width, 1))
        for t in range(CHUNK - 1, -1, -1):
            trail = np.take_along_axis(back[t], trail, axis=1)
        last = np.zeros(width, np.int8)
        last[-1] = int(now[-1].argmax())
        for c in range(width - 1, 0, -1):
            last[c - 1] = trail[c, last[c]]
        tags = np.zeros((width, CHUNK), np.int8)
        tag = last
        for t in range(CHUNK - 1, -1, -1):
            tags[:, t] = tag
            tag = np.take_along_axis(back[t], tag[:, None], axis=1)[:, 0]
        return tags.reshape(-1)[:n]


FORBIDDEN = -1e4


def fit_field(codes: np.ndarray, tags: np.ndarray, rounds: int = 80, l2: float = 1e-3) -> Field:
    """Maximum likelihood by full-batch Adam over windows of equal length; forward and backward sums are exact."""
    n, length, k = codes.shape
    ends = np.cumsum([0, *SIZES])
    theta = np.zeros((ends[-1] + 4, 3))
    flat = codes.astype(np.int64) + ends[:-1]
    gold = np.eye(3)[tags]
    pairs = np.einsum("nti,ntj->ij", gold[:, :-1], gold[:, 1:])
    m, v = np.zeros_like(theta), np.zeros_like(theta)

    def forbid(x: np.ndarray) -> Field:
        moves, first = x[ends[-1]:ends[-1] + 3].copy(), x[-1].copy()
        moves[0, 2] = first[2] = FORBIDDEN
        return Field([x[a:b] for a, b in zip(ends, ends[1:])], moves, first)

    for r in range(1, rounds + 1):
        field = forbid(theta)
        score = field.emissions(codes)
        ahead, behind = np.zeros_like(score), np.zeros_like(score)
        ahead[:, 0] = score[:, 0] + field.first
        for t in range(1, length):
            ahead[:, t] = np.logaddexp.reduce(ahead[:, t - 1, :, None] + field.moves, axis=1) + score[:, t]
            s = length - 1 - t
            behind[:, s] = np.logaddexp.reduce(field.moves + (score[:, s + 1] + behind[:, s + 1])[:, None, :], axis=2)
        total = np.logaddexp.reduce(ahead[:, -1], axis=1)
        belief = np.exp(ahead + behind - total[:, None, None])
        both = np.exp(ahead[:, :-1, :, None] + field.moves + (score + behind)[:, 1:, None, :] - total[:, None, None, None])
        error = (belief - gold) / n
        grad = np.zeros_like(theta)
        for tag in range(3):
            grad[:ends[-1], tag] = np.bincount(flat.reshape(-1), np.repeat(error[..., tag].reshape(-1), k), ends[-1])
        grad[ends[-1]:-1] = (both.sum(axis=(0, 1)) - pairs) / n
        grad[-1] = error[:, 0].sum(axis=0)
        grad += l2 * theta
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta -= 0.15 * (m / (1 - 0.9 ** r)) / (np.sqrt(v / (1 - 0.999 ** r)) + 1e-8)
    return forbid(theta)


def training_windows(texts: pa.Array) -> list[list[dict]]:
    """For each text, windows of token codes and tags around its secrets and around evenly spread tokens."""
    tokens = Tokens(texts)
    keywords = tokens.keywords()
    codes, tags, out = describe(tokens, keywords), tags_of(tokens, tokens.base(keywords)), []
    for a, b in zip(tokens.first, tokens.first[1:]):
        middles = np.unique(np.concatenate([a + np.flatnonzero(tags[a:b] == 1)[:WINDOWS // 2],
                                            np.linspace(a, max(b - 1, a), WINDOWS // 2).astype(np.int64)]))
        rows = []
        for mid in middles if b - a > 2 * REACH else []:
            start = min(max(mid - REACH, a), b - 2 * REACH - 1)
            rows += [{"codes": codes[t].tolist(), "tag": int(tags[t])} for t in range(start, start + 2 * REACH + 1)]
        out.append(rows)
    return out


def varied(codes: np.ndarray, tags: np.ndarray, times: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """The windows that hold a secret, with secrets of other makes: other lengths, alphabets and mixtures, many turns, half without context.

    The base patterns know three makes; what they have in common with others is length and mixture.
    """
    rng = np.random.default_rng(len(codes))
    chosen = np.flatnonzero((tags == 1).any(axis=1))
    out, marks = np.repeat(codes[chosen], times, axis=0), np.repeat(tags[chosen], times, axis=0)
    row, at = np.nonzero(marks == 1)
    n = len(row)
    length, digit, case = rng.integers(4, 8, n), rng.integers(1, 3, n), rng.integers(0, 4, n)
    shape = length * 5 + digit
    made = [shape, case * 5 + digit, rng.choice([0, 4], n), rng.integers(3, 5, n) * 4 + np.minimum(length // 2, 3)]
    for column, values in enumerate(made):
        out[row, at, column] = values
    out[row, at, CONTEXT] *= rng.integers(0, 2, n)
    later, sooner = at + 1 < out.shape[1], at > 0
    out[row[later], at[later] + 1, 5] = shape[later]
    out[row[sooner], at[sooner] - 1, 6] = shape[sooner]
    return out, marks


def fitted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Field | None:
    """The field fitted on the sample; None if no sampled text holds a base secret."""
    kind = pa.list_(pa.struct([("codes", pa.list_(pa.int32())), ("tag", pa.int32())]))

    @F.arrow_udf(CODES)
    def windows(texts: pa.Array) -> pa.Array:
        return pa.chunked_array([pa.array(training_windows(texts.slice(a, b - a)), kind) for a, b in slices(texts)], kind).combine_chunks()

    likely = F.col(text_col).rlike(r"AKIA[A-Z0-9]{16}|[0-9a-f]{24}|(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]")
    keyed = docs.filter(F.col(id_col).isNotNull()).select(id_col, F.coalesce(likely, F.lit(False)).alias("likely"))
    keyed = keyed.withColumn("h", F.xxhash64(id_col))
    picked = (keyed.filter("likely").orderBy("h").limit(sample // 2)
              .union(keyed.orderBy("h").limit(sample // 2)).select(id_col).distinct())
    rows = (docs.select(id_col, text_col).join(F.broadcast(picked), id_col)
            .select(F.xxhash64(id_col).alias("h"), windows(F.col(text_col)).alias("w")).orderBy("h").select("w").toArrow())
    lists = rows["w"].combine_chunks()
    flat = lists.flatten()
    if not len(flat):
        return None
    length = 2 * REACH + 1
    tags = flat.field("tag").to_numpy(zero_copy_only=False).reshape(-1, length)
    codes = flat.field("codes").flatten().to_numpy(zero_copy_only=False).reshape(-1, length, len(SIZES))
    # Each window also once without its separators and keywords, so that shape alone can tell a secret.
    bare = codes.copy()
    bare[..., CONTEXT] = 0
    others, marks = varied(codes, tags)
    return fit_field(np.concatenate([codes, bare, others]), np.concatenate([tags, tags, marks])) if (tags == 1).any() else None


def plausible(made: bytes) -> bool:
    """Whether a tagged string has letters and digits and is no address, path, file name or version."""
    return (re.search(rb"[A-Za-z]", made) is not None and re.search(rb"[0-9]", made) is not None
            and b"." not in made and b"//" not in made and not made.startswith(b"/"))


def scan(texts: pa.Array, field: Field | None) -> list[list[dict]]:
    """The spans of each text."""
    tokens = Tokens(texts)
    keywords = tokens.keywords()
    found = [(doc, kind, a, b) for doc, kind, a, b, _ in tokens.base(keywords)]
    if field is not None:
        tags = field.decode(describe(tokens, keywords), tokens.first)
        taken = np.zeros(len(tokens.raw) + 1, np.int32)
        for _, _, a, b in found:
            taken[a] += 1
            taken[b] -= 1
        taken = np.concatenate([[0], np.cumsum(np.cumsum(taken)[:-1] > 0, dtype=np.int32)])
        for t in np.flatnonzero(tags == 1):
            stop = t + 1
            while stop < len(tags) and tags[stop] == 2:
                stop += 1
            a, b = int(tokens.start[t]), int(tokens.end[stop - 1])
            if taken[b] == taken[a] and plausible(tokens.raw[a:b].tobytes()):
                found.append((int(tokens.text_of(a)), 3, a, b))
    out: list[list[dict]] = [[] for _ in range(len(texts))]
    for doc, kind, a, b in sorted(found, key=lambda x: (x[2], x[1], x[3])):
        zero = tokens.points[tokens.at[doc]]
        out[doc].append({"start": int(tokens.points[a] - zero), "kind": KINDS[kind], "end": int(tokens.points[b] - zero)})
    return out


def with_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """``docs`` with ``secrets``: all spans of each text."""
    field = fitted(docs, id_col, text_col, sample)
    kind = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32())]))

    @F.arrow_udf(f"array<{SPAN}>")
    def spans(texts: pa.Array) -> pa.Array:
        return pa.chunked_array([pa.array(scan(texts.slice(a, b - a), field), kind) for a, b in slices(texts)], kind).combine_chunks()

    return docs.withColumn("secrets", spans(F.col(text_col)))


def spans_text(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

