"""Line index: positions over many files and splits, single reads, files opened by a lookup."""

import json
import os
import random

from pyspark.sql import functions as F

from samplewright.sources import lines as RL
from samplewright.sources import readers as R


def corpus(folder, seed=3, files=4):
    rng, every = random.Random(seed), []
    os.makedirs(folder)
    for k in range(files):
        with open(f"{folder}/part-{k}.jsonl", "w", encoding="utf-8", newline="") as f:
            for i in range(rng.randrange(1, 400)):
                kind = rng.random()
                if kind < 0.1:
                    f.write(rng.choice(["\n", "  \n", "\t\r\n"]))  # blank lines have no position
                    continue
                line = "{bad" if kind < 0.15 else json.dumps({"text": f"é{k}-{i} " * rng.randrange(30)}, ensure_ascii=rng.random() < 0.5)
                every.append(line)
                f.write(line + rng.choice(["\n", "\r\n"]))
            if k == 1:
                every.append(json.dumps({"text": "no line end"}))
                f.write(every[-1])
    return every


def test_positions_over_small_splits(spark, tmp_path):
    every = corpus(tmp_path / "c")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")  # as large files would be cut
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        index = RL.build_index(spark, str(tmp_path / "c"), str(tmp_path / "index"), every=50)
        rows = index.orderBy("first").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(rows) > 8 and sum(r.n_lines for r in rows) == len(every) and all(r.n_lines <= 50 for r in rows)
    got = {r.position: r.value.rstrip("\r") for r in RL.read_indexed(index).collect()}
    assert got == dict(enumerate(every))
    parsed = RL.parsed(RL.read_indexed(index), R.TEXT_SCHEMA, "doc_id").orderBy("doc_id").collect()
    for r, line in zip(parsed, every):
        if line == "{bad":
            assert r.text is None and r["_corrupt_record"].rstrip("\r") == "{bad"
        else:
            assert r.text == json.loads(line)["text"] and r["_corrupt_record"] is None
    same = R.read_text_corpus(spark, str(tmp_path / "c")).select("doc_id", "text")
    assert same.exceptAll(RL.parsed(RL.read_indexed(index), R.TEXT_SCHEMA, "doc_id").select("doc_id", "text")).count() == 0


def test_lookup_opens_only_what_it_needs(spark, tmp_path):
    every = corpus(tmp_path / "c", seed=5)
    index = RL.build_index(spark, str(tmp_path / "c"), str(tmp_path / "index"), every=16)
    asked = spark.createDataFrame([(3,), (4,), (4,), (None,), (-1,), (10 ** 9,), (len(every) - 1,)], "position long")
    got = {r.position: r.value.rstrip("\r") for r in RL.fetch(index, asked).collect()}
    assert got == {i: every[i] for i in (3, 4, len(every) - 1)}
    touched = RL.wanted_ranges(index, asked).collect()
    assert len(touched) == 2 and len({r.file for r in touched}) == 2 and max(r.n_lines for r in touched) <= 16
    for r in touched:  # the other files are not even there
        keep = {os.path.basename(t.file) for t in touched}
    for f in os.listdir(tmp_path / "c"):
        if f.endswith("jsonl") and f not in keep:
            os.truncate(tmp_path / "c" / f, 0)
    assert RL.fetch(index, asked).count() == 3


def test_reading_by_index_needs_no_second_scan(spark, tmp_path):
    corpus(tmp_path / "c", seed=7)
    index = RL.build_index(spark, str(tmp_path / "c"), str(tmp_path / "index"))
    plan = RL.read_indexed(index)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan text" not in plan and plan.count("FileScan parquet") == 1 and "Window" not in plan
    os.makedirs(tmp_path / "none")
    (tmp_path / "none" / "a.jsonl").write_text("\n \n")
    empty = RL.build_index(spark, str(tmp_path / "none"), str(tmp_path / "none-index"))
    assert RL.read_indexed(empty).count() == 0 and RL.fetch(empty, spark.range(3), "id").count() == 0
    assert RL.parsed(RL.read_indexed(index), R.TEXT_SCHEMA, "id").filter(F.col("id") == 0).count() == 1
