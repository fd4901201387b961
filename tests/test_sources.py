"""JSON Lines sources, positions, lookup, sample writer, plug-in tokenizers."""

import json
import os

import pytest
from pyspark.sql import functions as F

from samplewright.functions import plugin as PL
from samplewright.functions import tokens as T
from samplewright.operators import chat, pretrain
from samplewright.sources import readers as R

SF = "/root/testdata/sf0.001"


def write_lines(path, lines):
    with open(path, "w", encoding="utf-8") as f:
        for line in lines:
            f.write(line + "\n")


def test_text_corpus_positions_and_corrupt(spark, tmp_path):
    d = tmp_path / "corpus"
    d.mkdir()
    write_lines(d / "a.jsonl", [json.dumps({"text": "hi"}), json.dumps({"text": 5}), "{not json",
                                json.dumps({"text": None})])
    write_lines(d / "b.jsonl", [json.dumps({"text": f"row{i}"}) for i in range(3)])
    df = R.read_text_corpus(spark, str(d)).orderBy("doc_id").collect()
    assert [r["doc_id"] for r in df] == list(range(7))
    assert [r["text"] for r in df][:2] == ["hi", "5"]
    assert df[2]["_corrupt_record"] == "{not json"
    assert df[3]["text"] is None
    assert [r["text"] for r in df][4:] == ["row0", "row1", "row2"]
    enc = pretrain.encode_pretrain(R.read_text_corpus(spark, str(d)), max_length=8)
    none_row = enc.filter(F.col("doc_id") == 3).first()
    assert none_row["input_ids"] == [1, 81, 114, 113, 104, 2, 0, 0]
    assert R.lookup(R.read_text_corpus(spark, str(d)), 5, "doc_id").first()["text"] == "row1"


def test_conversations_jsonl(spark, tmp_path):
    p = tmp_path / "sft.jsonl"
    write_lines(p, [json.dumps({"conversations": [{"role": "user", "content": "hi"},
                                                  {"role": "assistant", "content": "yo"}]}),
                    json.dumps({"conversations": []})])
    nested = R.read_conversations(spark, str(p))
    assert [r["conv_id"] for r in chat.empty_conversations(nested).collect()] == [1]
    r = chat.render(chat.messages_from_nested(nested)).collect()
    assert len(r) == 1 and r[0]["prompt"].endswith("<|im_start|>assistant\nyo<|im_end|>\n")


def test_write_samples(spark, tmp_path):
    df = spark.createDataFrame([(r, b, p, [1, 2]) for r in range(2) for b in range(3) for p in range(2)],
                               "rank int, batch_id long, pos_in_batch int, input_ids array<int>")
    out = str(tmp_path / "samples")
    R.write_samples(df, out)
    assert {"_SUCCESS", "rank=0", "rank=1"} <= set(os.listdir(out))
    back = spark.read.parquet(out)
    assert back.count() == 12 and back.filter("rank = 1").count() == 6


def test_write_samples_splits_ranks(spark, tmp_path):
    df = spark.range(4000).selectExpr("cast(id % 2 as int) rank", "id div 20 batch_id", "cast(id % 20 as int) pos_in_batch").repartition(4)
    out = str(tmp_path / "samples")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as large data would have it
    try:
        R.write_samples(df, out, batches_per_file=10)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = [f for f in os.listdir(f"{out}/rank=0") if f.endswith(".parquet")]
    assert len(files) > 1  # a rank is written by several tasks
    for f in files:
        batches = [(r.batch_id, r.pos_in_batch) for r in spark.read.parquet(f"{out}/rank=0/{f}").collect()]
        by_range = {}
        for b in batches:
            by_range.setdefault(b[0] // 10, []).append(b)
        assert batches == sorted(batches) and all(len(v) == 100 for v in by_range.values())


def test_marker_labels_pairs_and_cuts():
    import numpy as np
    start, end = [1, 9], [2, 13]
    ids = np.array([1, 9, 5, 1, 9, 6, 2, 13, 7, 1, 9, 8, 8])
    assert PL.marker_labels(ids, start, end, 100).tolist() == [-100, -100, 5, 1, 9, 6, 2, 13, -100, -100, -100, 8, 8]
    assert PL.marker_labels(ids, start, end, 7).tolist() == [-100, -100, 5, 1, 9, 6, 2] + [-100] * 6
    assert PL.marker_labels(ids[:1], start, end, 7).tolist() == [-100]


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data missing")
def test_plugin_encoder_equals_builtin(spark):
    enc = PL.plugin_encoder(PL.python_bytes_encoder)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bad = docs.select((enc(F.col("text")) == T.encode(F.col("text"))).alias("eq")).filter(~F.col("eq"))
    assert bad.count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data missing")
def test_plugin_sft_equals_builtin(spark):
    msgs = chat.messages_from_turns(spark.read.parquet(f"{SF}/conversations.parquet"))
    L = 340
    builtin = chat.sft_encode(msgs, max_length=L).select(
        "conv_id", F.col("input_ids").alias("a_ids"), F.col("labels").alias("a_lab"),
        F.col("attention_mask").alias("a_mask"))
    enc = PL.plugin_encoder(PL.python_bytes_encoder)
    start = PL.python_bytes_encoder()("<|im_start|>assistant\n")
    end = PL.python_bytes_encoder()("<|im_end|>\n")
    ids, labels, mask = PL.sft_plugin_arrays(F.col("prompt"), enc, start, end, L)
    plug = chat.render(msgs).select("conv_id", ids.alias("b_ids"), labels.alias("b_lab"), mask.alias("b_mask"))
    j = builtin.join(plug, "conv_id")
    assert j.count() == builtin.count() > 0
    assert j.filter((F.col("a_ids") != F.col("b_ids")) | (F.col("a_lab") != F.col("b_lab"))
                    | (F.col("a_mask") != F.col("b_mask"))).count() == 0
