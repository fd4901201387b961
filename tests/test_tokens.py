"""Pretraining encode goldens (FIXTURES section 3, L = 8) and decode."""

from pyspark.sql import functions as F

from samplewright.functions import tokens as T
from samplewright.operators import pretrain

CASES = [
    ("hi", [1, 107, 108, 2, 0, 0, 0, 0], [1, 107, 108, 2, -100, -100, -100, -100], [1, 1, 1, 1, 0, 0, 0, 0]),
    ("abcdefghij", [1, 100, 101, 102, 103, 104, 105, 2], [1, 100, 101, 102, 103, 104, 105, 2], [1] * 8),
    ("", [1, 2, 0, 0, 0, 0, 0, 0], [1, 2] + [-100] * 6, [1, 1] + [0] * 6),
    ("a<|endoftext|>b", [1, 100, 0, 101, 2, 0, 0, 0], [1, 100, -100, 101, 2, -100, -100, -100],
     [1, 1, 0, 1, 1, 0, 0, 0]),
    (None, [1, 81, 114, 113, 104, 2, 0, 0], [1, 81, 114, 113, 104, 2, -100, -100], [1, 1, 1, 1, 1, 1, 0, 0]),
]


def test_pretrain_goldens(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in pretrain.encode_pretrain(df, max_length=8).collect()}
    for i, (_, ids, labels, mask) in enumerate(CASES):
        assert rows[i]["input_ids"] == ids
        assert rows[i]["labels"] == labels
        assert rows[i]["attention_mask"] == mask


def test_encode_bytes_and_specials(spark):
    texts = ["é", "😀", "<|im_start|>x<|im_end|>", "<|<|im_start|>", "日本"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(T.encode(F.col("t"))).collect()]
    for t, ids in zip(texts, got):
        expect = []
        rest = t
        while rest:
            for s, i in T.SPECIAL_TOKENS.items():
                if rest.startswith(s):
                    expect.append(i)
                    rest = rest[len(s):]
                    break
            else:
                expect.extend(b + 3 for b in rest[0].encode("utf-8"))
                rest = rest[1:]
        assert ids == expect, t


def test_truncated_encode_equals_prefix(spark):
    texts = ["x" * 50, "<|im_end|>" * 30, "ab<|endoftext|>" * 20, "é" * 40]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select(T.encode(F.col("t")).alias("full"), T.encode(F.col("t"), 17).alias("cut")).collect()
    for r in rows:
        assert r["cut"] == r["full"][:17]


def test_decode_roundtrip_and_strip(spark):
    df = spark.createDataFrame([("  héllo wörld \n",), ("　x ",)], "t string")
    rows = df.select(T.decode(T.encode(F.col("t"))).alias("d"), "t").collect()
    for r in rows:
        assert r["d"] == r["t"].strip()


def test_decode_skips_specials(spark):
    df = spark.createDataFrame([([1, 107, 108, 2, 0],)], "ids array<int>")
    assert df.select(T.decode(F.col("ids"))).first()[0] == "hi"
