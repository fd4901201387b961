"""Routing goldens (FIXTURES section 3) and ranking invariants."""

from pyspark.sql import functions as F

from samplewright.operators import routing as RT


def test_zero_scores(spark):
    df = spark.createDataFrame([(i, [0.0, 0.0, 0.0, 0.0], i % 2) for i in range(6)], "id long, s array<double>, g int")
    r = RT.route(df, "id", "s", keep=["g"])
    a = RT.assignments(r, "id").collect()
    assert all((x["slot"], x["expert"]) in ((0, 0), (1, 1)) for x in a)
    assert all(abs(x["weight"] - 0.5) < 1e-12 for x in a)
    assert abs(RT.load_balance(r, "id").first()[0] - 0.01) < 1e-12
    assert abs(RT.load_balance_seq(r, "id", "g").first()[0] - 0.01) < 1e-12


def test_weights_sum_to_one_and_offsets(spark):
    df = spark.createDataFrame([(i, [float(i % 3), 1.0, -float(i), 0.5]) for i in range(20)], "id long, s array<double>")
    r = RT.route(df, "id", "s")
    sums = r.select(F.aggregate("routes", F.lit(0.0), lambda a, x: a + x["weight"]).alias("w")).collect()
    assert all(abs(x["w"] - 1.0) < 1e-9 for x in sums)
    off = RT.expert_offsets(r, "id").orderBy("expert").collect()
    assert off[-1]["end_offset"] == 40
    assert all(a["end_offset"] == b["start_offset"] for a, b in zip(off, off[1:]))


def test_rms(spark):
    df = spark.createDataFrame([([3.0, 4.0],)], "v array<double>")
    out, inv = RT.rms_normalize(F.col("v"), eps=0.0)
    row = df.select(out.alias("o"), inv.alias("i")).first()
    assert abs(row["i"] - 1 / (12.5 ** 0.5)) < 1e-12


def test_replies_equal_the_expression_forms(spark):
    """The first generated token equals the one ranked and drawn by expressions; unseen contexts stay in."""
    from samplewright.functions import tokens as T
    from samplewright.operators import ranking as RK
    from samplewright.operators import stats as ST
    pairs = spark.createDataFrame([(5, 6), (5, 6), (5, 7), (6, 5), (6, 9), (7, 5), (9, 2)] * 3, "cur int, nxt int")
    model = ST.fit_bigram(pairs)
    prompts = spark.createDataFrame([(1, [5, 6]), (2, [7, 7, 5]), (3, [200]), (4, [])], "k int, prompt_ids array<int>")
    contexts = RK.context_rows(RK.dense_model(model))
    scores = RK.penalized_scores(prompts, contexts, ["k"])
    assert scores.count() == 4
    u = T.hash_unit(42, 0, F.col("k"))
    drawn = {r.k: r.nxt for r in scores.select("k", RK.draw_array(RK.nucleus_array(F.col("scores")), u).alias("nxt")).collect()}
    sampled = {r.k: r.new_ids for r in RK.generate(prompts, model, ["k"], max_new_tokens=1).collect()}
    assert {k: [v] if v != 2 else [] for k, v in drawn.items()} == sampled
    best = {r.k: r.nxt for r in RK.all_candidates(scores, ["k"], "scores").filter("rank = 1").collect()}
    greedy = {r.k: r.new_ids for r in RK.generate(prompts, model, ["k"], temperature=0, max_new_tokens=1).collect()}
    assert {k: [v] if v != 2 else [] for k, v in best.items()} == greedy
    every = RK.all_candidates(scores, ["k"], "scores")
    assert every.count() == 4 * ST.BYTES_VOCAB
    said = RK.reply_with(spark.createDataFrame([("a",), ("b",)], "prompt string"), lambda: lambda texts: [t.upper() for t in texts])
    assert sorted(r.reply for r in said.collect()) == ["A", "B"]


def test_pair_scores_keep_groups_without_labels(spark):
    from samplewright.operators import stats as ST
    pairs = spark.createDataFrame([(1, 5, 6), (1, 5, -100), (2, 5, -100), (3, 9, 9)], "g int, cur int, nxt int")
    model = ST.fit_bigram(ST.supervised_pairs(pairs.select("cur", "nxt")))
    got = {r.g: (r.n_tokens, r.sum_nll) for r in ST.score_pairs(pairs, model, ["g"]).collect()}
    assert got[1][0] == 1 and got[2] == (0, None) and got[3][0] == 1
    big = {r.g: r.n_tokens for r in ST.score_pairs(pairs, model, ["g"], vocab_size=6400).collect()}
    assert big == {1: 1, 2: 0, 3: 1}


def test_dispatch_splits_experts_without_mixing(spark):
    """A12 physical form: an expert has several partitions, and no partition holds two experts."""
    df = spark.createDataFrame([(i, [float(i % 5), float(i % 3), 0.5, -1.0]) for i in range(200)],
                               "id long, s array<double>")
    moved = RT.dispatch(RT.assignments(RT.route(df, "id", "s"), "id"), "id")
    tagged = moved.withColumn("pid", F.spark_partition_id())
    rows = {(r["pid"], r["expert"]) for r in tagged.select("pid", "expert").distinct().collect()}
    assert len(rows) > len({e for _, e in rows})


def _word_model(spark, seed=5, vocab=40, n=600):
    import random

    from samplewright.operators import stats as ST
    rng = random.Random(seed)
    pairs = [(min(int(rng.expovariate(0.15)), vocab - 5), min(int(rng.expovariate(0.1)), vocab - 5)) for _ in range(n)]
    return ST.fit_bigram(spark.createDataFrame(pairs, "cur int, nxt int"), vocab_size=vocab)


def test_supersteps_equal_a_carried_model(spark, monkeypatch):
    """The same ids from a model that no task carries, also where one context's prompts are cut into parts."""
    import random

    from samplewright.operators import ranking as RK
    rng, vocab = random.Random(2), 40
    model = _word_model(spark, vocab=vocab)
    rows = [(k, [rng.randrange(vocab) for _ in range(rng.randrange(12))] + ([3] if k % 2 else []), f"p{k}") for k in range(60)]
    rows += [(100, None, "null"), (101, [], "empty"), (102, [39], "unseen context"), (103, [3], None), (103, [3], None)]
    prompts = spark.createDataFrame(rows, "k int, prompt_ids array<int>, cur string").repartition(3)
    for temperature in (0.0, 0.7):
        how = {"vocab_size": vocab, "temperature": temperature, "max_new_tokens": 7, "top_k": 12}
        want = sorted((r.k, r.new_ids) for r in RK.generate(prompts, model, ["k"], **how).collect())
        assert len(want) == len(rows) and max(len(i) for _, i in want) == 7
        for group in (4096, 3):
            monkeypatch.setattr(RK, "GROUP", group)
            got = RK.generate(prompts, model, ["k"], carry_bytes=0, **how)
            assert got.columns == [*prompts.columns, "new_ids"]
            assert sorted((r.k, r.new_ids) for r in got.collect()) == want
    assert RK.generate(prompts.limit(0), model, ["k"], carry_bytes=0, vocab_size=vocab).count() == 0
    assert {tuple(r.new_ids) for r in RK.generate(prompts, model, ["k"], carry_bytes=0, vocab_size=vocab, max_new_tokens=0).collect()} == {()}


def test_choice_of_the_next_token_against_sorting():
    """Ties, penalties and cuts as by sorting all candidates."""
    import numpy as np

    from samplewright.operators import ranking as RK
    rng = np.random.default_rng(4)
    for top_k, top_p in ((5, 0.9), (50, 0.5), (200, 1.1), (1, 0.9)):
        how = RK.Decoding(64, 1, 0.7, top_k, top_p, 1.3)
        scores = np.round(rng.normal(-2, 1, (40, 64)), 1)
        seen, u = rng.random((40, 64)) < 0.2, rng.random(40)
        got = how.choose(scores.copy(), seen, u)
        best = RK.Decoding(64, 1, 0.0, top_k, top_p, 1.3).choose(scores.copy(), seen, None)
        for i in range(40):
            s = np.where(seen[i], np.where(scores[i] > 0, scores[i] / 1.3, scores[i] * 1.3), scores[i])
            order = sorted(range(64), key=lambda t: (-s[t], t))
            assert best[i] == order[0]
            order = order[:top_k]
            q = np.exp((s[order] - s[order[0]]) / 0.7)
            q /= q.sum()
            kept = [j for j in range(len(order)) if q[:j].sum() < top_p]
            p = q[kept] / q[kept].sum()
            chosen = next((order[j] for j in kept if p[:j + 1].sum() > u[i]), order[kept[-1]])
            assert got[i] == chosen


def test_presence_of_tokens(spark):
    from samplewright.operators import ranking as RK
    rows = [([],), (None,), ([0],), ([4],), ([0, 1, 4],), ([2, 3, 9, 500],), ([-1, 2],)]
    df = spark.createDataFrame(rows, "s array<int>")
    got = [r[0] for r in df.select(RK.presence(F.col("s"), 5)).collect()]
    assert got == [[t in (s or []) for t in range(5)] for (s,) in rows]


def test_each_gate_product_is_computed_once(spark):
    """The optimised plans hold one product for each expert, wherever scores and probabilities are used."""
    df = spark.createDataFrame([(i, [float(i), 1.0, 2.0], i % 2) for i in range(9)], "id long, v array<float>, g int")
    routed = RT.route(RT.gate_scores(df, "v", RT.example_gate(3)), "id", "scores", keep=["g"])
    plans = [RT.assignments(routed, "id"), RT.expert_offsets(routed, "id"), RT.expert_probs(routed, "id"),
             RT.load_balance(routed, "id"), RT.load_balance_seq(routed, "id", "g"), routed]
    for plan in plans:
        assert plan._jdf.queryExecution().optimizedPlan().toString().count("zip_with(") == RT.N_EXPERTS


def test_experts_run_in_blocks_and_are_added_up(spark):
    import numpy as np
    rng, rows = np.random.default_rng(1), []
    for i in range(300):
        size = 3 if i % 7 else 2
        rows += [(i, s, (i * 3 + s) % 4, 0.25 + 0.5 * s, None if i == 5 else [float(x) for x in rng.normal(size=size)]) for s in range(2)]
    df = spark.createDataFrame(rows, "id long, slot int, expert int, weight double, v array<double>")

    def expert(e, block):
        assert len(block) <= 16
        return block * (e + 1)

    out = RT.run_experts(RT.dispatch(df, "id"), expert, "id", "v", block_rows=16)
    got = {r.id: r.combined for r in RT.combine(out, "id").collect()}
    assert len(got) == 300 and got[5] is None
    for i in range(300):
        if i != 5:
            mine = [r for r in rows if r[0] == i]
            want = sum(np.array(v) * (e + 1) * w for _, _, e, w, v in mine)
            assert np.allclose(got[i], want)
    tasks = out.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert len(tasks) > 4 and max(t["count"] for t in tasks) < 150  # no task has a whole expert
