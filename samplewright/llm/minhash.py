"""MinHash near-duplicate groups by fast similarity sketching (operator 1).

A document's set holds its distinct word shingles as 64-bit hashes.  A sketch has
``bins`` coordinates.  In round i each element is hashed to a bin and a value; a
bin keeps the least (round, value) it meets.  The first ``bins`` rounds choose the
bin by hash, the next ``bins`` rounds place every element in bin ``i - bins``, so
every coordinate of a non-empty set fills.  Rounds after the one that fills a
set's last bin are not needed.  Equal coordinates have the probability of the sets'
Jaccard similarity, with Chernoff-type concentration.

Coordinates are banded; documents that share a band are candidates, and every link
is confirmed on the full sets.  With 125 coordinates in 25 bands of 5, a pair at
similarity 0.85 shares no band with probability 4e-7, at 0.8 with 5e-5.

Identical sets are joined through one representative.  Buckets are not expanded into
pairs: their members are compared with one of them, the star, that with the least
share of shingles that no other candidate has, and linked groups are contracted.  Of
the pairs across groups that still share a bucket, only those are compared whose
differences from the star could cancel out far enough, so a bucket of copies costs its
size and no link between groups is lost.

Defined results: a null or blank text has the empty set and is linked with nothing; a
text of fewer words than a shingle has its whole word sequence as one; repeated
texts link; other columns do not matter.  Rows of null id are linked with nothing, have
a null component and stay; rows that repeat an id stay or go together.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samplewright.llm.common import gram_hashes, hash_words, list_array, mix, slices, word_codes, written

WORDS = 5
BINS, BAND = 125, 5


def shingle_sets(texts: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Each text's sorted distinct shingle hashes: offsets and flat values."""
    offsets, codes, distinct = word_codes(texts)
    hashes = hash_words(distinct)[codes]
    grams, first = gram_hashes(offsets, hashes, words)
    owner = np.searchsorted(offsets, first, side="right") - 1
    size = np.diff(offsets)
    for few in np.flatnonzero((size > 0) & (size < words)):
        own = hashes[offsets[few]:offsets[few + 1]]
        whole, _ = gram_hashes(np.array([0, len(own)]), own, len(own))
        grams, owner = np.append(grams, whole + np.uint64(len(own))), np.append(owner, few)
    order = np.lexsort((grams, owner))
    grams, owner = grams[order], owner[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    grams, owner = grams[new], owner[new]
    return np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(size)))]), grams


def sketches(offsets: np.ndarray, elements: np.ndarray, bins: int = BINS) -> np.ndarray:
    """One row of ``bins`` coordinates for each non-empty set, by rounds of hashed bin placement."""
    size = np.diff(offsets)
    sets = np.flatnonzero(size)
    out = np.full((len(sets), bins), np.iinfo(np.uint64).max, np.uint64)
    row = np.repeat(np.arange(len(sets)), size[sets])
    open_rows = np.ones(len(sets), bool)
    for i in range(2 * bins):
        going = open_rows[row]
        if not going.any():
            break
        row, elements = row[going], elements[going]
        with np.errstate(over="ignore"):
            h = mix(elements + np.uint64(i + 1) * np.uint64(0xD1B54A32D192ED03))
        place = (h % np.uint64(bins)).astype(np.int64) if i < bins else np.full(len(row), i - bins)
        # The round fills the high byte, so earlier rounds always win a bin.
        value = (h >> np.uint64(8)) | (np.uint64(i) << np.uint64(56))
        np.minimum.at(out.reshape(-1), row * bins + place, value)
        open_rows = (out == np.iinfo(np.uint64).max).any(axis=1)
    return out


def band_keys(rows: np.ndarray, band: int = BAND) -> np.ndarray:
    """A 64-bit key for each band of each sketch, distinct between bands."""
    n, bins = rows.shape
    parts = rows.reshape(n, bins // band, band)
    with np.errstate(over="ignore"):
        keys = np.arange(1, bins // band + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)
        for j in range(band):
            keys = mix(keys * np.uint64(0x9FB21C651E98DF25) + parts[:, :, j])
    return keys


def _sketched(docs: DataFrame, id_col: str, text_col: str, words: int, bins: int, band: int) -> DataFrame:
    @F.arrow_udf("struct<n:bigint,lo:bigint,hi:bigint,bands:array<bigint>>")
    def sketch(texts: pa.Array) -> pa.Array:
        out = []
        for start, stop in slices(texts):
            offsets, flat = shingle_sets(texts.slice(start, stop - start), words)
            size = np.diff(offsets)
            some = np.flatnonzero(size)
            sums = np.zeros((2, len(size)), np.uint64)
            keys = np.zeros((0, bins // band), np.uint64)
            if len(some):
                sums[0, some] = np.add.reduceat(flat, offsets[some])
                sums[1, some] = np.add.reduceat(mix(flat), offsets[some])
                keys = band_keys(sketches(offsets, flat, bins), band)
            lists = list_array(np.concatenate([[0], np.cumsum((size > 0) * (bins // band))]), pa.array(keys.reshape(-1).view(np.int64)))
            out.append(pa.StructArray.from_arrays(
                [pa.array(size.astype(np.int64)), pa.array(sums[0].view(np.int64)), pa.array(sums[1].view(np.int64)), lists],
                ["n", "lo", "hi", "bands"]))
        kind = pa.struct([("n", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64()), ("bands", pa.list_(pa.int64()))])
        return pa.chunked_array(out, kind).combine_chunks()

    return docs.select(F.col(id_col).alias("id"), sketch(F.col(text_col)).alias("s")).select("id", "s.*")


def _shared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) with their sets' sizes and what they share: a, b, na, nb, both."""
    left = sets.select(F.col("id").alias("a"), F.col("els").alias("left"))
    right = sets.select(F.col("id").alias("b"), F.col("els").alias("right"))
    both = F.size(F.array_intersect("left", "right")).cast("long")
    return pairs.join(left, "a").join(right, "b").select(
        "a", "b", F.size("left").cast("long").alias("na"), F.size("right").cast("long").alias("nb"), both.alias("both"))


def components(edges: DataFrame) -> DataFrame:
    """Each vertex of ``edges`` (a, b) with the smallest vertex it can reach, as (id, root).

    Alternates linking every vertex's larger neighbours and its smaller ones to its
    least neighbour, until a fixed point; each round is a written table.
    """
    def mark(df: DataFrame):
        return df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()

    links = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = mark(links)
    while True:
        sides = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = sides.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = sides.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lows = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lows, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"),
                                             F.col("m").alias("b")).filter("a <> b").distinct()
        links = written(small, "links")
        before, seen = seen, mark(links)
        if before == seen:
            return links.select(F.col("a").alias("id"), F.col("b").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85,
                    words: int = WORDS, bins: int = BINS, band: int = BAND) -> DataFrame:
    """A row for each document: its id, n_shingles and component_id, the least id reachable by links."""
    rows = written(_sketched(docs, id_col, text_col, words, bins, band), "sketch")
    # Identical sets link without comparison; only the smallest document of each goes on.
    same = rows.filter("n > 0 and id is not null").groupBy("n", "lo", "hi").agg(F.min("id").alias("rep"), F.first("bands").alias("bands"))
    keys = written(same.select("rep", F.explode("bands").alias("key")), "bands")
    # Written, so that the join reads plain shuffles, which Spark can split at a hot key.
    shared = written(keys.groupBy("key").agg(F.count("*").alias("m")).filter("m > 1").select("key"), "shared")
    buckets = written(keys.join(shared, "key"), "buckets")
    wanted = buckets.select(F.col("rep").alias(id_col)).distinct()

    @F.arrow_udf("array<bigint>")
    def elements(texts: pa.Array) -> pa.Array:
        out = []
        for start, stop in slices(texts):
            offsets, flat = shingle_sets(texts.slice(start, stop - start), words)
            out.append(list_array(offsets, pa.array(flat.view(np.int64))))
        return pa.chunked_array(out, pa.list_(pa.int64())).combine_chunks()

    sets = written(docs.select(id_col, text_col).join(wanted, id_col, "left_semi")
                   .select(F.col(id_col).alias("id"), elements(F.col(text_col)).alias("els")), "sets")
    # Shingles that one candidate alone has are in no intersection, but in every union.
    alone = (sets.select("id", F.explode("els").alias("e")).groupBy("e").agg(F.count("*").alias("m"), F.min("id").alias("id"))
             .filter("m = 1").groupBy("id").agg(F.count("*").alias("u")))
    sizes = sets.select("id", F.size("els").alias("n")).distinct().join(alone, "id", "left").select(
        F.col("id").alias("rep"), "n", F.coalesce("u", F.lit(0)).alias("u"))
    able = 100 * (F.col("n") - F.col("u")) >= percent * F.col("n")
    members = written(buckets.join(sizes.filter(able), "rep").select("key", "rep", "n", "u"), "members")

    linked = 100 * F.col("both") >= percent * (F.col("na") + F.col("nb") - F.col("both"))
    stars = written(members.groupBy("key").agg(F.min(F.struct(F.expr("u / n").alias("x"), "rep")).alias("star"))
                    .select("key", F.col("star.rep").alias("star")), "stars")
    placed = written(members.join(stars, "key").filter("rep <> star"), "placed")
    compared = written(_shared(placed.select(F.col("star").alias("a"), F.col("rep").alias("b")).distinct(), sets), "compared")
    links = compared.filter(linked).select("a", "b")
    group = components(links)
    # Across groups: with d shingles of difference from the star, u of them nobody else's, two members differ
    # in at least d + d' - 2 min(d - u, d' - u') shingles, which the similarity bounds.
    apart = compared.select(F.col("a").alias("star"), F.col("b").alias("rep"), (F.col("na") + F.col("nb") - 2 * F.col("both")).alias("d"))
    roots = group.select(F.col("id").alias("rep"), "root")
    rest = written(placed.join(apart, ["star", "rep"]).join(roots, "rep", "left").join(
        roots.toDF("star", "star_root"), "star", "left").select(
        "key", "rep", "n", F.coalesce("root", "rep").alias("root"), F.coalesce("star_root", "star").alias("star_root"),
        "d", (F.col("d") - F.col("u")).alias("v")), "rest")
    # Every pair across groups has a member that its star does not link.
    one = rest.filter("root <> star_root").select("key", *[F.col(c).alias(f"{c}1") for c in ("rep", "n", "root", "d", "v")])
    two = rest.select("key", *[F.col(c).alias(f"{c}2") for c in ("rep", "n", "root", "d", "v")])
    differ = F.col("d1") + F.col("d2") - 2 * F.least("v1", "v2")
    pairs = (one.join(two, "key").filter("root1 <> root2")
             .filter((100 + percent) * differ <= (100 - percent) * (F.col("n1") + F.col("n2")))
             .filter(100 * F.least("n1", "n2") >= percent * F.greatest("n1", "n2"))
             .select(F.least("rep1", "rep2").alias("a"), F.greatest("rep1", "rep2").alias("b")).distinct())
    more = written(_shared(pairs, sets).filter(linked).select("a", "b"), "links")
    group = components(links.union(more))
    rep = written(same.select("n", "lo", "hi", "rep").join(group, F.col("rep") == F.col("id"), "left").select(
        "n", "lo", "hi", F.coalesce("root", "rep").alias("component_id")), "reps")
    return (rows.select("id", "n", "lo", "hi").join(rep, ["n", "lo", "hi"], "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                    F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id")))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` that stay: the smallest document of each group, and all that have no group."""
    groups = near_duplicates(docs, id_col, text_col, **how)
    return docs.join(groups.filter(F.col(id_col) != F.col("component_id")).select(id_col), id_col, "left_anti")

