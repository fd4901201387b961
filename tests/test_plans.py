"""Physical-plan properties that the scale design relies on (checked on executed plans)."""

import os

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data missing")


def executed(spark, name):
    df = E.queries()[name](spark, SF)
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_pretrain_encode_is_narrow_and_pruned(spark):
    plan = executed(spark, "pretrain_encode")
    assert "Exchange" not in plan
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_sft_has_no_whole_conversation_window_and_no_python(spark):
    """Every window in the SFT plan is bounded: inside a bucket of turns, or over the
    per-bucket totals of a conversation; nothing runs in Python for plain turn tables."""
    plan = executed(spark, "sft_encode")
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("_bk" in line for line in windows)
    assert "EvalPython" not in plan
    assert plan.split("== Initial Plan ==")[0].count("Scan parquet") <= 2


def test_epoch_order_has_no_single_partition_exchange(spark):
    plan = executed(spark, "epoch_order")
    assert "SinglePartition" not in plan


def test_corpus_loss_broadcasts_the_bounded_model(spark):
    plan = executed(spark, "corpus_loss")
    assert "SortMergeJoin" not in plan
    assert "BroadcastHashJoin" in plan


@pytest.mark.parametrize("name", ["accumulation_groups", "lr_schedule", "log_steps"])
def test_step_tables_need_one_count(spark, name):
    plan = executed(spark, name).split("== Initial Plan ==")[0]
    assert "Window" not in plan and plan.count("Scan parquet") == 1 and "md5" not in plan


def test_vocab_encode_shuffles_no_words(spark):
    from samplewright.operators import stats as ST
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    df = ST.vocab_encode(docs, ST.build_vocab(docs))
    df.write.format("noop").mode("overwrite").save()
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_replies_join_nothing(spark):
    assert "NestedLoop" not in executed(spark, "batch_reply")
