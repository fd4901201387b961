"""Pieces of Arrow batches: tasks turn no more than a piece into Python objects, whatever a batch holds."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from samplewright.functions import batches as B
from samplewright.functions import plugin as PL
from samplewright.functions import tokens as T
from samplewright.operators import pretrain
from samplewright.operators import ranking as RK
from samplewright.operators import stats as ST


def test_pieces_are_bounded_and_keep_every_row():
    texts = pa.array(["abc", None, "", "x" * 50, "de", "f" * 9, "g"])
    for rows in (texts, texts.slice(2), pa.array([[1, 2], None, [], list(range(40)), [5]], pa.list_(pa.int32())), texts.slice(0, 0)):
        for most in (1, 4, 10, 1000):
            parts = list(B.pieces(rows, most))
            assert [x for p in parts for x in p.to_pylist()] == rows.to_pylist() and parts
            for p in parts:
                size = sum(len(x or "") * (4 if pa.types.is_list(rows.type) else 1) for x in p.to_pylist())
                assert size <= most or sum(1 for x in p.to_pylist() if x) == 1 and p[0].as_py()


def arrays_of(udf, columns):
    """The result arrays of an iterator UDF's function for one batch."""
    return list(udf.func(iter([columns])))


def captured(monkeypatch):
    made = []
    plain = F.arrow_udf

    def arrow_udf(kind):
        def deco(fn):
            made.append(plain(kind)(fn))
            return made[-1]
        return deco
    monkeypatch.setattr(F, "arrow_udf", arrow_udf)
    return made


@pytest.fixture
def texts():
    return pa.array([f"<|im_start|>word{i % 7} " * (1 + i % 3) + "x" * 200_000 for i in range(20)])


def test_plugin_ids_of_a_batch_leave_in_pieces(spark, texts):
    parts = arrays_of(PL.plugin_encoder(PL.python_bytes_encoder), texts)
    encode = PL.python_bytes_encoder()
    assert len(parts) > 2 and max(len(p.flatten()) for p in parts) <= B.PIECE_BYTES
    assert [x for p in parts for x in p.to_pylist()] == [encode(t) for t in texts.to_pylist()]


def test_pair_counts_of_a_batch_leave_in_pieces(spark, texts, monkeypatch):
    made = captured(monkeypatch)
    pretrain.document_pair_counts(spark.createDataFrame([(1, "a")], "doc_id long, text string"))
    parts = arrays_of(made[0], texts)
    assert len(parts) > 2
    for i, row in enumerate(x for p in parts for x in p.to_pylist()):
        pairs = pretrain._window_pairs(texts[i].as_py(), T.PRETRAIN_MAX_LENGTH - 2)
        keys, n = np.unique(pairs, return_counts=True)
        V = pretrain._VOCAB
        assert [(r["cur"] * V + r["nxt"], r["n"]) for r in row] == [(k, c) for k, c in zip(keys.tolist(), n.tolist()) if k % V]


def test_word_ids_of_a_batch_leave_in_pieces(spark, texts, monkeypatch):
    made = captured(monkeypatch)
    vocab = spark.createDataFrame([("<|im_start|>word1", 5, 1)], "token string, id int, count long")
    ST.vocab_encode(spark.createDataFrame([(1, "a")], "doc_id long, text string"), vocab)
    parts = arrays_of(made[0], texts)
    assert len(parts) > 2
    assert [x for p in parts for x in p.to_pylist()] == [[5 if w == "<|im_start|>word1" else 0 for w in t.split()] for t in texts.to_pylist()]


def test_replies_of_a_batch_leave_in_pieces(spark, monkeypatch):
    made = captured(monkeypatch)
    monkeypatch.setattr(RK, "CELLS", 3 * ST.BYTES_VOCAB)
    pairs = spark.createDataFrame([(5, 6), (6, 7), (7, 8), (8, 2)], "cur int, nxt int")
    prompts = spark.createDataFrame([(1, [5])], "k long, prompt_ids array<int>")
    RK.generate(prompts, ST.fit_bigram(pairs), ["k"], temperature=0.0)
    parts = list(made[0].func(iter([(pa.array([str(i) for i in range(8)]), pa.array([5, 6, 7, 8] * 2, pa.int32()),
                                     pa.array([[5], [6], [7], [8]] * 2, pa.list_(pa.int32())))])))
    assert [len(p) for p in parts] == [3, 3, 2]
    assert [x for p in parts for x in p.to_pylist()] == [[6, 7, 8], [7, 8], [8], []] * 2


def test_decoded_texts_of_a_batch_leave_in_pieces(spark, monkeypatch):
    made = captured(monkeypatch)
    T.decode(F.col("ids"), strip=False)
    ids = pa.array([[3 + ord("a")] * 100_000, None, [], [0, 3 + ord("b"), 2]] * 5, pa.list_(pa.int32()))
    parts = arrays_of(made[0], ids)
    assert len(parts) > 1 and [x for p in parts for x in p.to_pylist()] == ["a" * 100_000, None, "", "b"] * 5
