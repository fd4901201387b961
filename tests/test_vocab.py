"""Frequent words from bounded counters, and ids by a carried or joined vocabulary."""

import random

import pytest
from pyspark.sql import functions as F

from samplewright.operators import stats as ST


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(8)
    pool = [f"w{i}" for i in range(900)] + ["é", "中文", "w"]
    weights = [1 / (i + 1) for i in range(len(pool))]
    spaces = [" ", "  ", "\n", "　", "\x1c", "\t"]
    rows = [(i, rng.choice(spaces).join(rng.choices(pool, weights, k=rng.randrange(80)))) for i in range(300)] + [(400, None), (401, ""), (402, " \n")]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(7).cache()


def ranked(counts, k):
    return [tuple(r) for r in counts.orderBy(F.desc("count"), "token").limit(k).select("token", "count").collect()]


@pytest.mark.parametrize("room", [2000, 200, 60, 5])
def test_candidates_hold_the_most_frequent(texts, room):
    """With counters for all words, for some, and for too few to tell."""
    want = ranked(ST.word_counts(texts), 25)
    assert ranked(ST.frequent_words(texts, 25, room=room), 25) == want


def test_counters_bound_every_count():
    rng, kept, true = random.Random(1), ST.Counters(20), {}
    for _ in range(200):
        words = [f"w{int(rng.expovariate(0.05))}" for _ in range(40)]
        kept.add(words)
        for w in words:
            true[w] = true.get(w, 0) + 1
    kept.shrink()
    assert len(kept.count) <= 20 and kept.lost
    assert all(kept.count[w] <= n <= kept.count[w] + kept.lost for w, n in true.items())


def test_counters_shuffle_no_more_than_their_room(texts):
    rows = texts.select(F.coalesce("text", F.lit("None")).alias("text")).mapInArrow(ST._counters(10), ST.TOKEN_COUNT)
    assert rows.count() <= 7 * 11


def test_ids_by_join_equal_those_of_a_carried_vocabulary(texts):
    vocab = ST.build_vocab(texts, vocab_size=100)
    both = [{r.doc_id: r.ids for r in ST.vocab_encode(texts, vocab, carry=carry).collect()} for carry in (1000, 10)]
    assert both[0] == both[1] and len(both[0]) == 303 and both[0][401] == both[0][402] == []
    words = {r.token: r.id for r in vocab.collect()}
    want = {r.doc_id: [words.get(w, 0) for w in ("None" if r.text is None else r.text).split()] for r in texts.collect()}
    assert both[0] == want
