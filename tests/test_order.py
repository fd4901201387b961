"""Order, shards, batches, resume, schedules (FIXTURES section 3)."""


from pyspark.sql import functions as F

from samplewright.operators import order as O
from samplewright.sources import manifest as MF


def plan(spark, n, world, batch=None, skip=0, epochs=(0,)):
    df = spark.range(n).withColumnRenamed("id", "sid")
    o = O.epoch_order(df, "sid", epochs=epochs)
    s = O.shard(o, F.col("n_in_epoch"), world)
    return O.batch(s, batch, skip) if batch else s


def test_order_is_dense_and_matches_global_sort(spark):
    rows = O.epoch_order(spark.range(3000).withColumnRenamed("id", "sid"), "sid", epochs=(0, 1)).collect()
    for e in (0, 1):
        got = {r["sid"]: r["order_idx"] for r in rows if r["epoch"] == e}
        import hashlib
        expect = sorted(range(3000), key=lambda i: (hashlib.md5(f"42|{e}|{i}".encode()).hexdigest(), i))
        assert [got[i] for i in expect] == list(range(3000))


def test_shards_wrap_around(spark):
    rows = plan(spark, 10, 3).collect()
    by_rank = {}
    for r in sorted(rows, key=lambda r: r["pos"]):
        by_rank.setdefault(r["rank"], []).append(r["order_idx"])
    assert by_rank == {0: [0, 3, 6, 9], 1: [1, 4, 7, 0], 2: [2, 5, 8, 1]}
    rows = plan(spark, 2, 5).collect()
    assert sorted((r["rank"], r["order_idx"]) for r in rows) == [(0, 0), (1, 1), (2, 0), (3, 1), (4, 0)]


def test_batches_and_skip(spark):
    def batches(skip):
        b = O.materialize_batches(plan(spark, 10, 1, 4, skip), "sid").collect()
        return sorted(len(r["ids"]) for r in b), {r["batch_id"] for r in b}
    assert batches(1) == ([2, 4], {1, 2})
    assert batches(2) == ([2], {2})
    assert batches(3) == ([], set())
    assert batches(9) == ([], set())
    df = spark.createDataFrame([(10, s) for s in (1, 2, 3, 9)], "n long, skip long")
    assert [r[0] for r in df.select(O.num_batches(F.col("n"), 4, F.col("skip"))).collect()] == [2, 1, 0, 0]


def test_resume_split_is_a_partition(spark):
    full = plan(spark, 103, 2, 8)
    done = full.filter(F.col("batch_id") < 3)
    rest = O.remaining_after(full, done)
    assert rest.count() + done.count() == full.count()
    assert rest.join(done, ["sid", "rank", "pos"]).count() == 0


def test_rescale(spark):
    df = spark.createDataFrame([(100, 4, 8), (100, 3, 2), (100, 2, 2)], "step long, saved int, cur int")
    got = [r[0] for r in df.select(O.rescale_step(F.col("step"), F.col("saved"), F.col("cur"))).collect()]
    assert got == [50, 150, 100]


def test_accumulation_carry_over(spark):
    df = spark.createDataFrame([(e, s, 10) for e in (0, 1) for s in range(1, 11)], "epoch int, step long, iters long")
    g = {(r["epoch"], r["step"]): r["u"] for r in df.select(
        "epoch", "step", O.accumulation_group(F.col("epoch"), F.col("step"), F.col("iters"), 2, 4).alias("u")).collect()}
    assert [g[(0, s)] for s in range(1, 11)] == [0, 0, 0, 0, 1, 1, 1, 1, 2, 2]
    assert [g[(1, s)] for s in range(1, 11)] == [2, 2, 2, 2, 3, 3, 3, 3, None, None]


def test_interval_lr_eta(spark):
    df = spark.range(1, 251).withColumnRenamed("id", "step")
    kept = [r[0] for r in df.filter(O.interval_or_last(F.col("step"), F.lit(250), 100)).collect()]
    assert kept == [100, 200, 250]
    lr = spark.createDataFrame([(0,), (50,), (100,)], "s long").select(
        O.lr_at(F.col("s"), F.lit(100), 5e-4)).collect()
    assert [round(r[0], 12) for r in lr] == [5e-4, 2.75e-4, 5e-5]
    eta = spark.createDataFrame([(600.0, 99, 1000)], "e double, s long, i long").select(
        O.eta_minutes(F.col("e"), F.col("s"), F.col("i"))).first()[0]
    assert eta == 90


def test_manifest_roundtrip(spark, tmp_path):
    path = str(tmp_path / "manifest")
    run = MF.run_key("pretrain", 512)
    assert MF.start_for(spark, path, run) == (0, 0)
    MF.save_progress(spark, path, run, 0, 100, world_size=4)
    MF.save_progress(spark, path, run, 1, 20, world_size=4)
    MF.save_progress(spark, path, MF.run_key("full_sft", 512, True), 0, 7, world_size=1)
    assert MF.start_for(spark, path, run, current_world_size=8) == (1, 10)
    assert MF.start_for(spark, path, "full_sft_512_moe") == (0, 7)
