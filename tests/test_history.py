"""Chat sessions: history bound, blank questions and exit commands."""

from samplewright.operators import history as H


def sessions(spark, rows):
    return spark.createDataFrame(rows, "session long, turn long, role string, text string")


def test_history_h1(spark):
    rows = [(1, 0, "user", "U1"), (1, 1, "assistant", "A1"), (1, 2, "user", "U2"),
            (1, 3, "assistant", "A2"), (1, 4, "user", "U3")]
    p = H.history_prompts(H.live_messages(sessions(spark, rows)), history_turns=1).orderBy("turn").collect()
    bodies = [[b for b in ("U1", "A1", "U2", "A2", "U3") if f"\n{b}<|im_end|>" in r["prompt"]] for r in p]
    assert bodies == [["U1"], ["U1", "A1", "U2"], ["U2", "A2", "U3"]]
    p0 = H.history_prompts(H.live_messages(sessions(spark, rows)), history_turns=0).orderBy("turn").collect()
    assert [r["n_messages"] for r in p0] == [1, 3, 5]


def test_blank_and_exit(spark):
    rows = [(1, 0, "user", "  "), (1, 1, "user", "hi"), (1, 2, "assistant", "yo"),
            (1, 3, "user", " /EXIT "), (1, 4, "user", "after"),
            (2, 0, "user", "/exit now"), (2, 1, "assistant", "ok")]
    live = H.live_messages(sessions(spark, rows)).orderBy("session", "turn").collect()
    assert [(r["session"], r["turn"]) for r in live] == [(1, 1), (1, 2), (2, 0), (2, 1)]


def test_bucketed_paths_equal_window_paths(spark):
    import random
    rng = random.Random(9)
    words = ["hi", "  ", "", "/exit", " /QUIT ", "/exit now", "yo", None, "a b"]
    rows = []
    for sid in range(60):
        for turn in range(rng.randint(1, 12)):
            if rng.random() < 0.1:
                continue  # gaps in turn numbers
            rows.append((sid, turn, rng.choice(["user", "assistant"]), rng.choice(words)))
    for turn in range(2600):  # one long session crossing several buckets
        rows.append((999, turn, "user" if turn % 2 == 0 else "assistant", f"m{turn}"))
    s = sessions(spark, rows)
    a = H.live_messages(s).select("session", "turn", "role", "content")
    b = H.live_messages_bucketed(s).select("session", "turn", "role", "content")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    for h in (1, 3):
        pa = H.history_prompts(H.live_messages(s), h).select("session", "turn", "n_messages", "prompt", "prompt_ids")
        pb = H.history_prompts_joined(H.live_messages_bucketed(s), h).select(
            "session", "turn", "n_messages", "prompt", "prompt_ids")
        assert pa.count() == pb.count() > 0
        assert pa.exceptAll(pb).count() == 0 and pb.exceptAll(pa).count() == 0


def test_rope_equals_the_window_form(spark, monkeypatch):
    """Unlimited histories from pieces, with pieces of one, few and all messages; no window over a session."""
    rows = [(s, t * (1 + s % 3), "user" if t % 2 == 0 else "assistant", f"m{t}" if t % 5 else " ") for s in range(6) for t in range(1 + 7 * s)]
    sessions = spark.createDataFrame(rows, "session long, turn long, role string, text string")
    want = H.history_prompts(H.live_messages(sessions), 0).select("session", "turn", "n_messages", "prompt", "prompt_ids")
    live = H.live_messages_bucketed(sessions)
    for rows_of_piece in (1, 3, 256):
        got = H.rope_prompts(*H.history_rope(live, rows_of_piece)).select(*want.columns)
        assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0
    pieces, prompts = H.history_rope(live, 4)
    assert prompts.columns == ["session", "turn", "n_messages", "piece", "tail"]
    plan = H.history_prompts_joined(live, 0)._jdf.queryExecution().optimizedPlan().toString()
    assert "unboundedpreceding$(), currentrow$())) AS _w" not in plan and "session#" in plan
    windows = [line for line in plan.splitlines() if "Window [" in line and "collect_list" in line]
    assert windows and all("piece#" in line for line in windows)
