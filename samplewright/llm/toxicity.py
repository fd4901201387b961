"""Toxicity by classifier chains (operator 4).

Categories are predicted one after the other by linear (logistic) models over word
and word-prefix presence; each later model also sees the earlier categories'
probabilities.  While training, those probabilities come from out-of-fold models, so
a later model meets the same kind of estimate that it will meet when scoring.

The models are fitted on a bounded sample of the labelled rows (``SAMPLE``, chosen by a hash
of the id); rows leave Spark only as hashed feature numbers.  Everything is scored: a
task turns each distinct word into its weights once and sums them per document.

Defined results: a null, empty or blank text has no features and gets the models'
intercepts; a null label leaves that row out of that category's model; a category of
one class only gets a constant model; with no labelled rows all probabilities are 0
and nothing is rejected; repeated ids are scored row by row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samplewright.llm.common import hash_words, list_array, mix, offsets_of, slices, word_codes

#: Labelled rows that the models are fitted on, at most.
SAMPLE = 6_000
#: Features that the models weigh, at most: those most associated with a category.
SELECTED = 4_096
#: Least association, in standard deviations, and least rows of a weighed feature.
LEAST_Z, LEAST_ROWS = 4.0, 5
#: Word prefixes that are features beside whole words, in characters.
PREFIXES = (4, 5)
THRESHOLD = 0.5
PUNCTUATION = ".,;:!?\"'()[]{}<>|*%&$#@=/\\-_`~^+"


def feature_numbers(distinct: pa.Array) -> np.ndarray:
    """For each word, its feature numbers: the whole word, then each prefix."""
    bare = pc.utf8_trim(pc.utf8_lower(distinct), PUNCTUATION)
    columns = [hash_words(bare)]
    for k, n in enumerate(PREFIXES, 1):
        columns.append(mix(hash_words(pc.utf8_slice_codeunits(bare, 0, n)) + np.uint64(k)))
    return np.stack(columns, axis=1).view(np.int64)


def row_features(texts: pa.Array, of: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature numbers of each text, by row: the rows and the numbers.

    With ``of`` (sorted), the numbers are places in it, and others are left out.
    """
    offsets, codes, distinct = word_codes(texts)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    numbers = feature_numbers(distinct)
    if of is None:
        of = np.unique(numbers)
    if not len(of) or not len(codes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    places = np.minimum(np.searchsorted(of, numbers), len(of) - 1)
    places[of[places] != numbers] = -1
    some = (places >= 0).any(axis=1)[codes]
    owner, places = owner[some], places[codes[some]]
    keys = (owner[:, None] * len(of) + places)[places >= 0]
    keys = np.unique(keys)
    return keys // len(of), keys % len(of)


@dataclass
class Linear:
    """Logistic model: hashed feature weights, weights of earlier probabilities, intercept."""

    numbers: np.ndarray
    weights: np.ndarray
    chain: np.ndarray
    bias: float

    def scores(self, sums: np.ndarray, earlier: np.ndarray) -> np.ndarray:
        z = sums + earlier @ self.chain + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_linear(rows: np.ndarray, cols: np.ndarray, n: int, width: int, earlier: np.ndarray, y: np.ndarray,
               rounds: int = 150, l2: float = 2e-4) -> tuple[np.ndarray, np.ndarray, float]:
    """Logistic regression by full-batch Adam on presence features; deterministic."""
    if len(y) == 0 or y.min() == y.max():
        rate = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.0
        return np.zeros(width), np.zeros(earlier.shape[1]), float(np.log(max(rate, 1e-12) / max(1 - rate, 1e-12)))
    order = np.argsort(cols, kind="stable")
    by_col_rows, by_col = rows[order], cols[order]
    theta = np.zeros(width + earlier.shape[1] + 1)
    theta[-1] = np.log(y.mean() / (1 - y.mean()))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, rounds + 1):
        z = np.bincount(rows, theta[cols], n) + earlier @ theta[width:-1] + theta[-1]
        err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / n
        grad = np.concatenate([np.bincount(by_col, err[by_col_rows], width), earlier.T @ err, [err.sum()]])
        grad[:-1] += l2 * theta[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta -= 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return theta[:width], theta[width:-1], float(theta[-1])


def selected(numbers: np.ndarray, rows: np.ndarray, cols: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Places of the features most associated with a category, by the z-score of their rows' labels."""
    best = np.zeros(len(numbers))
    for y in labels.T:
        known = ~np.isnan(y)
        rate = y[known].mean() if known.any() else 0.0
        if 0 < rate < 1:
            n = np.bincount(cols, known[rows], len(numbers))
            hits = np.bincount(cols, np.where(known, y, 0)[rows], len(numbers))
            z = np.abs(hits - n * rate) / np.sqrt(np.maximum(n, 1) * rate * (1 - rate))
            best = np.maximum(best, np.where(n >= LEAST_ROWS, z, 0))
    order = np.argsort(-best, kind="stable")[:SELECTED]
    return np.sort(order[best[order] >= LEAST_Z])


def fit_chain(ids: np.ndarray, rows: np.ndarray, features: np.ndarray, labels: np.ndarray, folds: int = 3) -> list[Linear]:
    """One model for each column of ``labels`` (NaN: not labelled), in order.

    ``rows`` and ``features`` are parallel: the distinct feature numbers of each row.
    A row's fold is its id's hash.
    """
    n = len(ids)
    numbers, cols = np.unique(features, return_inverse=True)
    chosen = selected(numbers, rows, cols, labels)
    place = np.full(len(numbers), -1)
    place[chosen] = np.arange(len(chosen))
    kept = place[cols] >= 0 if len(cols) else np.zeros(0, bool)
    rows, cols, numbers = rows[kept], place[cols[kept]], numbers[chosen]
    fold = (mix(ids.astype(np.uint64)) % np.uint64(folds)).astype(np.int64)
    earlier, models = np.zeros((n, 0)), []

    def fitted(use: np.ndarray, y: np.ndarray) -> Linear:
        at, inside = np.cumsum(use) - 1, use[rows]
        w, c, b = fit_linear(at[rows[inside]], cols[inside], int(use.sum()), len(numbers), earlier[use], y[use])
        return Linear(numbers, w, c, b)

    for k in range(labels.shape[1]):
        y, use = labels[:, k], ~np.isnan(labels[:, k])
        models.append(fitted(use, y))
        out = np.zeros(n)
        for f in range(folds if k + 1 < labels.shape[1] else 0):
            model = fitted(use & (fold != f), y)
            sums = np.bincount(rows, model.weights[cols], n)
            out = np.where(fold == f, model.scores(sums, earlier), out)
        earlier = np.column_stack([earlier, out])
    return models


def labelled_sample(docs: DataFrame, labels: DataFrame, categories: dict[str, str], sample: int = SAMPLE,
                    id_col: str = "doc_id", text_col: str = "text"):
    """(ids, rows, features, labels) of at most ``sample`` labelled rows, those of least id hash."""
    picked = (labels.filter(F.col(id_col).isNotNull())
              .select(id_col, *[F.expr(e).cast("double").alias(f"label_{c}") for c, e in categories.items()])
              .orderBy(F.xxhash64(id_col), *[f"label_{c}" for c in categories]).limit(sample))

    @F.arrow_udf("array<bigint>")
    def numbers(texts: pa.Array) -> pa.Array:
        out = []
        for start, stop in slices(texts):
            part = texts.slice(start, stop - start)
            of = np.unique(feature_numbers(word_codes(part)[2]))
            rows, places = row_features(part, of)
            out.append(list_array(np.searchsorted(rows, np.arange(stop - start + 1)), pa.array(of[places] if len(of) else places)))
        return pa.chunked_array(out, pa.list_(pa.int64())).combine_chunks()

    table = (docs.select(id_col, text_col).join(F.broadcast(picked), id_col)
             .select(id_col, numbers(F.col(text_col)).alias("features"), *[f"label_{c}" for c in categories])
             .orderBy(F.xxhash64(id_col), *[f"label_{c}" for c in categories]).toArrow())
    lists = table["features"].combine_chunks()
    offsets = offsets_of(lists)
    y = np.column_stack([table[f"label_{c}"].to_numpy().astype(float) for c in categories])
    return (table[id_col].to_numpy().astype(np.int64), np.repeat(np.arange(len(lists)), np.diff(offsets)),
            lists.flatten().to_numpy(zero_copy_only=False), y)


def score(docs: DataFrame, models: list[Linear], categories: list[str], text_col: str = "text") -> DataFrame:
    """``docs`` with a column p_<category> for each model of the chain."""
    kind = pa.struct([(f"p_{c}", pa.float64()) for c in categories])

    @F.arrow_udf(", ".join(f"p_{c} double" for c in categories))
    def chain(texts: pa.Array) -> pa.Array:
        out = []
        for start, stop in slices(texts):
            rows, places = row_features(texts.slice(start, stop - start), models[0].numbers)
            earlier = np.zeros((stop - start, 0))
            for model in models:
                sums = np.bincount(rows, model.weights[places], stop - start) if len(rows) else np.zeros(stop - start)
                earlier = np.column_stack([earlier, model.scores(sums, earlier)])
            out.append(pa.StructArray.from_arrays([pa.array(earlier[:, k]) for k in range(len(categories))], fields=list(kind)))
        return pa.chunked_array(out, kind).combine_chunks()

    names = [f"p_{c}" for c in categories]
    return docs.withColumn("_chain", chain(F.col(text_col))).withColumns(
        {n: F.col(f"_chain.{n}") for n in names}).drop("_chain")


def classify(docs: DataFrame, labels: DataFrame, categories: dict[str, str] | None = None, sample: int = SAMPLE,
             threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with p_<category> for each category and ``rejected``: the last category's reaches the threshold.

    ``categories`` names the chain in order, each with a SQL expression over ``labels``.
    """
    categories = categories or {"low_quality": "1 - quality", "toxic": "toxic"}
    models = fit_chain(*labelled_sample(docs, labels, categories, sample, id_col, text_col))
    scored = score(docs, models, list(categories), text_col)
    return scored.withColumn("rejected", F.col(f"p_{list(categories)[-1]}") >= threshold)
