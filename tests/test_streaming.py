"""Streaming: resume from a checkpoint without redoing work (T3); state across micro-batches."""

import os

import pytest

from samplewright.operators import history as H
from samplewright.streaming import stream as SS

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CONVS = "conv_id long, turn long, role string, text string"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data missing")
def test_resume_processes_only_new_files(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    src = str(tmp_path / "src")
    docs.filter("doc_id % 2 = 0").coalesce(1).write.parquet(src + "/part1")
    ckpt, out = str(tmp_path / "ckpt"), str(tmp_path / "out")
    SS.run_to_table(spark, SS.stream_encode(spark, src + "/*", DOCS), "t", checkpoint=ckpt, path=out)
    first = spark.read.parquet(out).count()
    docs.filter("doc_id % 2 = 1").coalesce(1).write.parquet(src + "/part2")
    SS.run_to_table(spark, SS.stream_encode(spark, src + "/*", DOCS), "t", checkpoint=ckpt, path=out)
    total = spark.read.parquet(out)
    assert first == docs.filter("doc_id % 2 = 0").count()
    assert total.count() == docs.count() == total.select("doc_id").distinct().count()


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data missing")
def test_history_state_across_micro_batches(spark, tmp_path):
    conv = spark.read.parquet(f"{SF}/conversations.parquet")
    src = str(tmp_path / "conv")
    conv.filter("turn < 2").coalesce(1).write.parquet(src + "/a")
    conv.filter("turn >= 2").coalesce(1).write.parquet(src + "/b")
    s = SS.stream_history(spark, src + "/*", CONVS, max_files_per_trigger=1)
    got = SS.latest_prompts(spark.read.parquet(SS.run_to_table(spark, s, "h")))
    want = H.history_prompts(H.live_messages(H.sessions_from_turns(conv))).select(
        "session", "turn", "n_messages", "prompt")
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


class State:
    """A group's state without a query."""

    def __init__(self):
        self.value, self.hasTimedOut, self.ttl = None, False, None

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def update(self, value):
        self.value = value

    def remove(self):
        self.value = None

    def setTimeoutDuration(self, ms):
        self.ttl = ms


def arrive(fold, state, rows):
    import pandas as pd
    return list(fold((7,), iter([pd.DataFrame(rows, columns=["turn", "role", "text"])]), state))


def made_session(rng, n):
    """Turns with blanks, nulls, gaps and now and then an exit."""
    out = []
    for turn in sorted(rng.sample(range(3 * n), n)):
        role = rng.choice(["user", "user", "assistant"])
        text = rng.choice(["hi", " a question ", "", " \t", None, f"text {turn}", "/exit now"] + (["/QUIT "] if rng.random() < 0.1 else []))
        out.append((turn, role, text))
    return out


@pytest.mark.parametrize("h", [1, 3, 0])
def test_any_order_of_arrival_gives_the_batch_prompts(spark, h):
    import random
    rng, rows, want = random.Random(h), [], {}
    for session in range(40):
        turns = made_session(rng, rng.randrange(1, 25))
        rows += [(session, *t) for t in turns]
        fold, state, revisions = SS._history_fn(h, None, None), State(), {}
        rng.shuffle(turns)
        while turns:  # a micro-batch of one to four turns
            n = rng.randrange(1, 5)
            now, turns = turns[:n], turns[n:]
            for out in arrive(fold, state, now):
                for r in out.itertuples():
                    revisions[r.turn] = (None if r.prompt is None else (int(r.n_messages), r.prompt))
        want.update({(session, t): p for t, p in revisions.items() if p is not None})
    table = spark.createDataFrame(rows, "session long, turn long, role string, text string")
    batch = H.history_prompts_joined(H.live_messages_bucketed(table), h)
    got = {(r.session, r.turn): (r.n_messages, r.prompt) for r in batch.collect()}
    assert got == want and got


def test_state_stays_bounded_and_empties():
    """With a bound on lateness a long session keeps what can still matter; a timeout removes it."""
    fold, state = SS._history_fn(2, 10, 60_000), State()
    for turn in range(500):
        arrive(fold, state, [(turn, "user" if turn % 2 == 0 else "assistant", f"m{turn}")])
        assert len(state.value[0]) <= 4 + 11
    assert state.ttl == 60_000
    late = arrive(fold, state, [(495, "assistant", "said late")])
    assert late[0]["turn"].tolist() == [496, 498] and "said late" in late[0]["prompt"][0]
    assert arrive(fold, state, [(501, "user", " /EXIT ")])[0]["prompt"].tolist() == [None]
    assert arrive(fold, state, [(502, "user", "after")])[0]["prompt"].tolist() == [None]
    state.hasTimedOut = True
    assert list(fold((7,), iter([]), state)) == [] and not state.exists


@pytest.mark.parametrize("files", [0, 1, 3])
def test_streams_take_a_table_that_is_a_file_or_a_folder(spark, tmp_path, files):
    import pandas as pd

    from samplewright.plans import catalog
    docs = pd.DataFrame({"doc_id": range(12), "text": [f"text {i}" for i in range(12)], "lang": "en", "source": "s", "n_chars": 6})
    turns = pd.DataFrame({"conv_id": [i // 4 for i in range(12)], "turn": [i % 4 for i in range(12)],
                          "role": ["user", "assistant"] * 6, "text": [f"said {i}" for i in range(12)]})
    for name, rows in (("documents", docs), ("conversations", turns)):
        if files:
            spark.createDataFrame(rows).repartition(files).write.parquet(str(tmp_path / f"{name}.parquet"))
        else:
            rows.to_parquet(tmp_path / f"{name}.parquet", index=False)
    for stream, batch in (("stream_encode", "pretrain_encode"), ("stream_history", "chat_history_prompts")):
        got, want = (catalog.QUERIES[q](spark, str(tmp_path)) for q in (stream, batch))
        assert got.count() == want.count() > 0
        assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_late_arrivals_are_written_and_read_by_all_tasks(spark, tmp_path, monkeypatch):
    import pandas as pd

    from samplewright.plans import catalog
    turns = pd.DataFrame({"conv_id": [i // 5 for i in range(400)], "turn": [i % 5 for i in range(400)],
                          "role": ["user" if i % 5 % 2 == 0 else "assistant" for i in range(400)], "text": [f"said {i}" for i in range(400)]})
    spark.createDataFrame(turns).repartition(3).write.parquet(str(tmp_path / "conversations.parquet"))
    # Small files go to one task each, as the parts of a large table would.
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 << 20))
    asked, plain = {}, SS.stream_history
    monkeypatch.setattr(SS, "stream_history", lambda s, base, schema, **more: asked.update(more, base=base) or plain(s, base, schema, **more))
    try:
        got = catalog.QUERIES["stream_history_late"](spark, str(tmp_path)).drop("prompt_ids_csv")
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert asked["max_files_per_trigger"] == 3 and len(spark.read.parquet(asked["base"]).inputFiles()) == 3 * catalog.ARRIVALS
    want = H.history_prompts(H.live_messages(H.sessions_from_turns(catalog._eventful(spark.createDataFrame(turns)))))
    assert got.count() > 0 and got.exceptAll(want.select(*got.columns)).count() == want.select(*got.columns).exceptAll(got).count() == 0


def test_a_session_of_a_micro_batch_makes_one_block(monkeypatch):
    import numpy as np
    import pandas as pd
    fold, state = SS._history_fn(2, None, None), State()
    part = pd.DataFrame({"turn": np.array([0, 1, 2, 3]), "role": ["user", "assistant", "user", "user"], "text": ["a", np.nan, None, "d"]})
    (out,) = fold((7,), iter([part]), state)
    assert list(out.columns) == ["session", "turn", "revision", "n_messages", "prompt"] and len(out._mgr.blocks) == 1
    assert [(r.turn, r.n_messages) for r in out.itertuples()] == [(0, 1), (3, 3), (2, None)]
    assert state.value[2] == ["a", None, None, "d"]
