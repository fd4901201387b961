"""Each stage of the pipeline against a plain version over a whole small table."""

import base64
import os
import re
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402

import corpus_pipeline as P  # noqa: E402
from samplewright.llm import decontam, pii, toxicity  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data missing")


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_are_the_named_ones():
    assert [name for name, _ in P.STAGES] == ["toxicity", "near_duplicates", "decontamination", "personal_data", "byte_bpe"]


def test_stage_by_stage(spark):
    import public_tokenizers
    import tiktoken
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("rejected", P.F.lit("clash")).withColumn("leaks", P.F.lit(1))
    stages = dict(P.STAGES)
    # toxicity: what stays is what the chain does not reject
    kept = stages["toxicity"](spark, docs, SF).cache()
    scores = {r.doc_id: r.rejected for r in toxicity.classify(docs.select("doc_id", "text"), spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    before = texts(docs)
    assert texts(kept) == {i: t for i, t in before.items() if not scores[i]}
    # near duplicates: one of each group at 0.8
    single = stages["near_duplicates"](spark, kept, SF).cache()
    groups = brute.near_duplicates(list(texts(kept).items()), 80)
    assert texts(single) == {i: t for i, t in texts(kept).items() if groups[i][1] == i}
    # decontamination: plain tiling of every document with every item
    clean = stages["decontamination"](spark, single, SF).cache()
    strip = lambda t: [w for w in (x.lower().strip(decontam.PUNCTUATION) for x in t.split()) if w]
    items = [strip(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaked = set()
    for i, t in texts(single).items():
        words = strip(t)
        grams = {tuple(words[k:k + 5]) for k in range(len(words) - 4)}
        for item in items:
            if sum(tuple(item[k:k + 5]) in grams for k in range(len(item) - 4)) and brute.tiles(words, item) >= decontam.COVERAGE * len(item):
                leaked.add(i)
    assert set(texts(clean)) == set(texts(single)) - leaked
    # personal data: every span is replaced by its kind, and no base span is left
    redacted = stages["personal_data"](spark, clean, SF).cache()
    after = texts(redacted)
    for r in pii.with_pii(clean).collect():
        want, at = "", 0
        for span in r.pii:
            if span.start >= at:
                want += r.text[at:span.start] + f"[{span.kind.upper()}]"
            at = max(at, span.end)
        assert after[r.doc_id] == want + r.text[at:]
        assert {s for s in brute.base_pii(r.text)} <= {(s.start, s.rank, s.kind, s.end) for s in r.pii}
        assert not brute.base_pii(after[r.doc_id])
    assert redacted.columns == list(P.DOCUMENT)
    # byte BPE: as the library
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path(P.RANK_FILE), "rb"))}
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = stages["byte_bpe"](spark, redacted, SF).collect()
    assert len(rows) == len(after)
    for r in rows:
        assert r.token_ids == plain.encode_ordinary(after[r.doc_id] or "") and r.round_trip and r.n_tokens == len(r.token_ids)
    assert sorted(r.doc_id for r in P.run(spark, SF).collect()) == sorted(after)


def test_stages_take_odd_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (None, "a b c", None, "s", 5), (3, "mail x@y.zz " * 3000, "en", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in P.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0, name
        got = stage(spark, docs, SF)
        assert got.count() == len(rows), name
        if name == "personal_data":
            assert re.fullmatch(r"(mail \[EMAIL\] )+", texts(got)[3])
