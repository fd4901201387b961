"""Commit log: concurrent writers, repeated jobs, stores with a rename, versions; exactly-once streaming sink."""

import os
import threading

import pytest

from samplewright.sources import manifest as MF
from samplewright.streaming import stream as SS

ROW = "run_id string, epoch int, step long, world_size int"


def test_two_writers_lose_and_double_nothing(spark, tmp_path):
    path, errors = str(tmp_path / "log"), []

    def write(worker):
        try:
            for step in range(8):
                MF.save_progress(spark, path, "run", worker % 2, step, 2)  # workers 0 and 2 save the same steps
        except Exception as failed:  # noqa: BLE001
            errors.append(failed)

    threads = [threading.Thread(target=write, args=(w,)) for w in range(3)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors
    rows = sorted(tuple(r) for r in MF.read_manifest(spark, path).collect())
    assert rows == sorted(("run", e, s, 2) for e in range(2) for s in range(8))
    log = MF.manifest_log(spark, path).entries().collect()
    assert sorted(r.version for r in log) == list(range(1, 17)) and len({r.token for r in log}) == 16
    assert not [f for f in os.listdir(f"{path}/log") if f.endswith("draft")]


def test_tables_are_committed_once_and_whole(spark, tmp_path):
    path = str(tmp_path / "log")
    log = MF.CommitLog(spark, path, ROW)
    assert log.rows().count() == 0 and MF.start_for(spark, path, "a") == (0, 0)
    steps = spark.range(100).selectExpr("'a' run_id", "cast(0 as int) epoch", "id step", "cast(4 as int) world_size")
    assert log.commit(steps, "job-1") == 1
    assert log.commit(steps, "job-1") == 1  # tried again
    steps.write.parquet(f"{path}/data/left-by-a-dead-job")
    assert log.commit([{"run_id": "b", "epoch": 1, "step": 7, "world_size": 1}], "job-2") == 2
    assert log.rows().count() == 101 and log.rows(version=1).filter("run_id = 'b'").count() == 0
    assert MF.start_for(spark, path, "a", current_world_size=8) == (0, 49)


def test_a_version_is_never_replaced(spark, tmp_path):
    log = MF.CommitLog(spark, str(tmp_path / "log"), ROW)
    place = f"{tmp_path}/log/log/00000000000000000001.json"
    assert log._put(place, "one") and not log._put(place, "two")
    with open(place) as f:
        assert f.read() == "one"


def test_a_repeated_micro_batch_adds_nothing(spark, tmp_path):
    src, out, ckpt = (str(tmp_path / n) for n in ("src", "out", "ckpt"))
    for k in range(3):
        spark.range(k * 10, k * 10 + 10).selectExpr("id doc_id", "concat('text ', id) text").coalesce(1).write.mode("append").parquet(src)
    schema = "doc_id long, text string"
    stream = SS.file_stream(spark, src, schema, max_files_per_trigger=1)
    log, fail = MF.CommitLog(spark, out, stream.schema), [True]

    def sink(rows, batch):  # dies between its second commit and the checkpoint
        log.commit(rows, f"ckpt/{batch}")
        if batch == 1 and fail.pop():
            raise RuntimeError("lost")

    query = stream.writeStream.foreachBatch(sink).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    with pytest.raises(Exception, match="lost"):
        query.awaitTermination()
    assert log.rows().count() == 20
    rows = SS.run_to_log(spark, SS.file_stream(spark, src, schema, max_files_per_trigger=1), out, ckpt)
    assert sorted(r.doc_id for r in rows.collect()) == list(range(30))
    spark.range(30, 35).selectExpr("id doc_id", "'new' text").write.mode("append").parquet(src)
    rows = SS.run_to_log(spark, SS.file_stream(spark, src, schema), out, ckpt)
    assert sorted(r.doc_id for r in rows.collect()) == list(range(35))
