"""Randomised property checks: many generated cases per Spark job, compared with
brute-force Python models of the reference behaviour (SURVEY section 5.2)."""

import math
import random

from pyspark.sql import functions as F

from samplewright.functions import plugin as PL
from samplewright.functions import tokens as T
from samplewright.operators import chat
from samplewright.operators import order as O
from test_chat import SCHEMA, expected_labels

ALPHABET = ["a", "b", " ", "\n", "é", "日", "😀", "<", "|", ">", "　", "<|im_start|>", "<|im_end|>",
            "<|endoftext|>", "assistant", "<|im_start|>assistant\n", "<|im_end|>\n"]


def rand_text(rng, n):
    return "".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, n)))


def test_encode_matches_python_encoder(spark):
    rng = random.Random(7)
    texts = [rand_text(rng, 40) for _ in range(400)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", T.encode(F.col("t")).alias("ids"), T.encode(F.col("t"), 9).alias("cut"),
                     T.decode(T.encode(F.col("t"))).alias("dec")).collect()
    py = PL.python_bytes_encoder()
    for r in rows:
        t = texts[r["i"]]
        assert r["ids"] == py(t), t
        assert r["cut"] == py(t)[:9], t
        plain = "".join(ch for ch in t)
        for s in T.SPECIAL_TOKENS:
            plain = plain.replace(s, "")
        if plain == t:
            assert r["dec"] == t.strip(), t


def test_sft_labels_match_token_scan(spark):
    rng = random.Random(11)
    roles = ["user", "assistant", "system", "tool", "user", "assistant"]
    rows = []
    for cid in range(150):
        for turn in range(rng.randint(1, 6)):
            rows.append((cid, turn, rng.choice(roles), rand_text(rng, 25), None, None, None))
    msgs = spark.createDataFrame(rows, SCHEMA)
    for L in (24, 96):
        for r in chat.sft_encode(msgs, max_length=L).collect():
            assert r["labels"] == expected_labels(r["input_ids"], L)
            assert r["attention_mask"] == [int(x != 0) for x in r["input_ids"]]


def simulate_plan(n, w, b, skip):
    """Wrap-around sharding then the skip-batch rule, on order positions 0..n-1."""
    total = math.ceil(n / w) * w
    padded = [i % n for i in range(total)]
    out = {}
    for r in range(w):
        mine = padded[r:total:w]
        batches = [mine[k:k + b] for k in range(0, len(mine), b)]
        full = [x for x in batches if len(x) == b]
        kept = full[skip:] + ([batches[-1]] if batches and len(batches[-1]) < b and len(full) >= skip else [])
        out[r] = kept
    return out


def test_shards_and_batches_match_simulation(spark):
    rng = random.Random(3)
    cases = [(rng.randint(1, 40), rng.randint(1, 8), rng.randint(1, 6), rng.randint(0, 5)) for _ in range(60)]
    parts = []
    for k, (n, w, b, skip) in enumerate(cases):
        df = spark.range(n).withColumnRenamed("id", "sid").withColumn("case", F.lit(k))
        o = O.epoch_order(df, "sid", keep=["case"])
        parts.append(O.batch(O.shard(o, F.col("n_in_epoch"), w), b, skip).select(
            "case", "rank", "batch_id", "pos_in_batch", "order_idx"))
    allp = parts[0]
    for p in parts[1:]:
        allp = allp.unionByName(p)
    got = {}
    for r in allp.collect():
        got.setdefault(r["case"], {}).setdefault(r["rank"], {}).setdefault(r["batch_id"], []).append(
            (r["pos_in_batch"], r["order_idx"]))
    for k, (n, w, b, skip) in enumerate(cases):
        want = simulate_plan(n, w, b, skip)
        have = {rk: [[x for _, x in sorted(v)] for _, v in sorted(bs.items())] for rk, bs in got.get(k, {}).items()}
        assert {rk: v for rk, v in want.items() if v} == have, (n, w, b, skip)
    counts = spark.createDataFrame([(k, n, w, b, skip) for k, (n, w, b, skip) in enumerate(cases)],
                                   "k int, n long, w long, b int, skip long")
    for b in {c[2] for c in cases}:
        sub = counts.filter(F.col("b") == b).select(
            "k", O.num_batches(F.ceil(F.col("n") / F.col("w")), b, F.col("skip")).alias("nb")).collect()
        for r in sub:
            n, w, _, skip = cases[r["k"]]
            assert all(len(v) == r["nb"] for v in simulate_plan(n, w, b, skip).values()), cases[r["k"]]


def test_accumulation_matches_loop_simulation(spark):
    rng = random.Random(5)
    cases = [(rng.randint(1, 30), rng.randint(1, 9), rng.randint(1, 3)) for _ in range(80)]
    rows = [(k, e, s, iters, epochs, a) for k, (iters, a, epochs) in enumerate(cases)
            for e in range(epochs) for s in range(1, iters + 1)]
    df = spark.createDataFrame(rows, "k int, epoch int, step long, iters long, epochs int, a int")
    got = {}
    for (iters, a, epochs) in set(cases):
        sub = df.filter((F.col("iters") == iters) & (F.col("a") == a) & (F.col("epochs") == epochs))
        for r in sub.select("epoch", "step", O.accumulation_group(F.col("epoch"), F.col("step"), F.col("iters"),
                                                                    epochs, a).alias("u")).collect():
            got[(iters, a, epochs, r["epoch"], r["step"])] = r["u"]
        # simulate: gradients accumulate until a step divisible by a; then an update is applied
        pending, update = [], 0
        want = {}
        for e in range(epochs):
            for s in range(1, iters + 1):
                pending.append((e, s))
                if s % a == 0:
                    for key in pending:
                        want[key] = update
                    pending, update = [], update + 1
        for key in pending:
            want[key] = None
        for (e, s), u in want.items():
            assert got[(iters, a, epochs, e, s)] == u, (iters, a, epochs, e, s)


def test_buckets_equal_one_window(spark):
    """Two-level neighbours and bounds equal those of one window per conversation,
    including tool groups, unknown roles, gaps and a conversation spanning many buckets."""
    rng = random.Random(23)
    roles = ["user", "assistant", "tool", "tool", "system", "wizard", "user", "assistant"]
    rows = []
    for cid in range(120):
        for turn in range(rng.randint(1, 9)):
            rows.append((cid, turn, rng.choice(roles), rand_text(rng, 12), None, None, None))
    for turn in range(3000):  # one long conversation: crosses several 1024-row buckets
        rows.append((999, turn, rng.choice(roles), rand_text(rng, 3), None, None, None))
    msgs = spark.createDataFrame(rows, SCHEMA)
    cols = ["conv_id", "pos", "role0", "prev_role", "next_role", "bound"]
    gapped = msgs.withColumn("turn", F.col("turn") * 3 + 7)
    one = chat.located(msgs, bucket_rows=10**9).select(cols)
    for other in (chat.located(msgs, bucket_rows=64), chat.located(gapped, bucket_rows=100)):
        assert one.exceptAll(other.select(cols)).count() == 0 and one.count() == msgs.count()
    whole = {r["conv_id"]: r["prompt"] for r in chat.render(msgs).collect()}
    for cut in (400, 3000):
        got = {r["conv_id"]: r["prompt"] for r in chat.render(msgs, cut_chars=cut).collect()}
        assert got == {c: p[:cut] for c, p in whole.items()}
