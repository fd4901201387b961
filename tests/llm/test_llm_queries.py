"""Each registered training-data query against a plain version, over whole small tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402

from samplewright.llm import catalog, decontam, repeats  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data missing")


@pytest.fixture(scope="module")
def documents(spark):
    return [(r[0], r[1]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def rows(spark, name):
    return catalog.QUERIES[name](spark, SF).collect()


def test_op1_groups(spark, documents):
    want = brute.near_duplicates(documents)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in rows(spark, "op1_minhash")}
    assert got == want


def test_op2_as_the_library(spark, documents):
    import base64

    import public_tokenizers as P
    import tiktoken
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path(catalog.RANK_FILE), "rb"))}
    plain = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: tuple(r)[1:] for r in rows(spark, "op2_byte_bpe")}
    for i, text in documents:
        ids = plain.encode_ordinary(text or "")
        assert got[i] == (len(ids), brute.sha(",".join(map(str, ids))), brute.sha(text or ""))
    assert len(got) == len(documents)


def test_op3_base_spans(spark, documents):
    got = {r.doc_id: r for r in rows(spark, "op3_pii")}
    found = 0
    for i, text in documents:
        want, r = brute.base_pii(text), got[i]
        found += len(want)
        assert r.base_sha256 == brute.sha(brute.joined(want))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[1] == k for s in want) for k in range(4)]
        assert set(filter(None, brute.joined(want).split(","))) <= set(r.spans.split(","))
    assert found > 5 and len(got) == len(documents)


def test_op4_as_a_plain_chain(spark, documents):
    """Every document's probabilities, one word and one model after the other in plain Python."""
    import math
    import re

    import pyarrow as pa

    from samplewright.llm import toxicity
    got = {r.doc_id: r for r in rows(spark, "op4_toxicity_chain")}
    docs, labels = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "labels"))
    models = toxicity.fit_chain(*toxicity.labelled_sample(docs, labels, {"low_quality": "1 - quality", "toxic": "toxic"}))
    weights = [dict(zip(m.numbers.tolist(), m.weights.tolist())) for m in models]
    assert len(got) == len(documents) and any(weights[1].values())
    for i, text in documents:
        words = set(re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))
        numbers = set(toxicity.feature_numbers(pa.array(sorted(words), pa.string())).ravel().tolist()) if words else set()
        earlier = []
        for model, known in zip(models, weights):
            z = model.bias + sum(known.get(n, 0.0) for n in numbers) + sum(w * p for w, p in zip(model.chain, earlier))
            earlier.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
        assert abs(got[i].p_low_quality - earlier[0]) < 2e-6 and abs(got[i].p_toxic - earlier[1]) < 2e-6
        assert got[i].rejected == (earlier[1] >= toxicity.THRESHOLD)


def test_op5_pairs(spark, documents):
    got = {(r.doc_id, r.item_id): r for r in rows(spark, "op5_string_tiling")}
    items = spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()
    assert got
    for r in got.values():
        assert r.coverage >= decontam.COVERAGE and r.covered <= r.n_words
    for item in items:
        for i, text in documents:
            if item.text in text:
                assert got[i, item.item_id].covered == got[i, item.item_id].n_words


def test_op6_removed(spark, documents):
    want, passages = brute.repeats(documents), brute.repeats(documents, repeats.PASSAGE)
    got = rows(spark, "op6_repeats")
    assert len(got) == len(documents)
    for r in got:
        n, removed, spans, kept = want[r.doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (n, removed, spans, brute.sha(kept)), r.doc_id
        assert r.n_passage == passages[r.doc_id][1]


def test_op7_article_only(spark):
    import re
    from html import unescape
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in rows(spark, "op7_html_cut"):
        article = re.search(r"<article>(.*)</article>", pages[r.page_id], re.S).group(1)
        parts = re.split(r"</?(?:p|h\d)>", article)
        want = "\n".join(filter(None, (" ".join(unescape(re.sub("<[^>]*>", lambda m: " " if m[0] == "<br>" else "", p)).split()) for p in parts)))
        assert r.text == want and r.n_chars == len(want)


def test_op8_scores(spark):
    table = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert sorted(tuple(r) for r in rows(spark, "op8_top_k")) == brute.top_k(table)


def test_op9_places(spark, documents):
    """Every document's slot by its key's hash, and the shard that owns the slot."""
    import hashlib

    from samplewright.llm import shards
    got = {r.doc_id: (r.slot, r.shard) for r in rows(spark, "op9_lookup_shards")}
    table = shards.lookup_table([f"shard-{i:03d}" for i in range(64)])
    slots = {i: int(hashlib.md5(str(i).encode()).hexdigest()[:15], 16) % 65537 for i, _ in documents}
    assert got == {i: (slot, table[slot]) for i, slot in slots.items()}


def test_shards_are_written_by_many_tasks(spark, tmp_path):
    from samplewright.llm import shards
    names = ["a", "b", "c"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as large data would have it
    try:
        shards.write_shards(docs, str(tmp_path / "out"), names, files=4)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    back = spark.read.parquet(str(tmp_path / "out"))
    want = shards.assign(docs, names).select("doc_id", "text", "slot", "shard")
    assert back.count() == want.count() and back.select(*want.columns).exceptAll(want).count() == 0
    assert all(len([f for f in os.listdir(tmp_path / "out" / f"shard={k}") if f.endswith("parquet")]) > 1 for k in range(3))


def test_op10_base_spans(spark):
    more = SF.replace("0.001", "0.01")
    documents = [(r[0], r[1]) for r in spark.read.parquet(f"{more}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: r for r in catalog.QUERIES["op10_secret_field"](spark, more).collect()}
    found = 0
    for i, text in documents:
        want, r = brute.base_secrets(text), got[i]
        found += len(want)
        assert r.base_sha256 == brute.sha(brute.joined(want))
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s[1] == k for s in want) for k in range(3)]
        assert set(filter(None, brute.joined(want).split(","))) <= set(r.spans.split(","))
    assert found > 5 and len(got) == len(documents)
