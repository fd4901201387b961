"""Operators 11 to 13: plain versions, hot blocks, odd rows, damaged files."""

import os
import random
import sys
import zlib

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402

from samplewright.llm import ball_search, catalog, spelling, token_files  # noqa: E402

SF = "/root/testdata/sf0.001"
given = pytest.mark.skipif(not os.path.isdir(SF), reason="test data missing")


def frame(spark, rows, kind="doc_id long, text string"):
    return spark.createDataFrame(rows, kind)


def texts_of(spark, name, key):
    return [(r[0], r[1]) for r in spark.read.parquet(f"{SF}/{name}.parquet").select(key, "text").collect()]


def spec():
    import public_tokenizers as P
    with open(P.path(catalog.TOKENIZER_FILE), encoding="utf-8") as f:
        return f.read()


# ---------------------------------------------------------------- op11
@given
def test_op11_whole_table(spark):
    want = brute.spelling(texts_of(spark, "documents", "doc_id"))
    got = {r.word: tuple(r)[1:] for r in catalog.QUERIES["op11_spelling_variants"](spark, SF).collect()}
    assert got == want and got


def variants_of(rng, n):
    """Words in families one or more edits apart, some of them very frequent."""
    words = []
    for _ in range(n):
        base = "".join(rng.choice("abcdeéñ×") for _ in range(rng.randint(6, 9)))
        words += [base] * rng.choice([5, 30, 200])
        for _ in range(4):
            w, at = list(base), rng.randrange(len(base))
            kind = rng.random()
            if kind < 0.3:
                del w[at]
            elif kind < 0.6:
                w.insert(at, rng.choice("abcé"))
            else:
                w[at] = rng.choice("abcé")
            words += ["".join(w)] * rng.choice([5, 6, 40])
    rng.shuffle(words)
    return words


def test_variants_on_made_words(spark, monkeypatch):
    rng = random.Random(4)
    words = variants_of(rng, 60)
    docs = [(i, " ".join(words[i::50])) for i in range(50)]
    want = brute.spelling(docs, 7)
    for block in (1024, 8):  # whole blocks, and blocks cut into many parts
        monkeypatch.setattr(spelling, "BLOCK", block)
        monkeypatch.setattr(spelling, "SLICE", block)
        got = {r.word: tuple(r)[1:] for r in spelling.variants(frame(spark, docs), noise=7).collect()}
        assert got == want
    assert any(f and r != f for f, r, *_ in want.values())  # chains of more than one step


def test_variants_odd_rows(spark):
    long = "abcdefghij" * 400
    docs = [(None, "wörter wörter"), (1, None), (2, ""), (3, "wörter " * 9 + "wörtes " * 5 + (long + " ") * 5), (3, "WÖRTER"), (4, (long[:-1] + " ") * 30)]
    rows = [(*d, 1, "x", "b") for d in docs]
    got = {r.word: tuple(r)[1:] for r in spelling.variants(frame(spark, rows, "doc_id long, text string, n int, word string, block string")).collect()}
    assert got == brute.spelling(docs)
    assert got[long][0] == long[:-1]
    assert spelling.variants(frame(spark, [])).count() == 0


def test_near_pairs_are_exact():
    rng = random.Random(9)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 5))) for _ in range(300)})
    by_length = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)

    def block(ws):
        points, ends = spelling.code_points(pa.array(ws))
        return spelling.Words(points, ends[:-1], len(ws[0]))

    found = set()
    for n, ws in by_length.items():
        i, j = spelling.near_pairs(block(ws), block(ws), True)
        found |= {(ws[a], ws[b]) for a, b in zip(i, j)}
        if n + 1 in by_length:
            i, j = spelling.near_pairs(block(ws), block(by_length[n + 1]), False)
            found |= {(ws[a], by_length[n + 1][b]) for a, b in zip(i, j)}
    want = set()
    for a in words:
        for b in words:
            same = len(a) == len(b) and a < b and sum(x != y for x, y in zip(a, b)) == 1
            longer = len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))
            if same or longer:
                want.add((a, b))
    assert found == want


# ---------------------------------------------------------------- op12
@given
def test_op12_whole_table(spark):
    items = texts_of(spark, "benchmark", "item_id")
    want = sorted((items[row][0], r, i, s) for row, r, i, s in brute.ranked(texts_of(spark, "documents", "doc_id"), items))
    assert sorted(tuple(r) for r in catalog.QUERIES["op12_ball_search"](spark, SF).collect()) == want


def test_ranked_by_blocks_and_small_bundles(spark, monkeypatch):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(60)] + ["é", "Ab", "中文"]
    weights = [1 / (i + 1) for i in range(len(words))]
    docs = [(i % 180, " ".join(rng.choices(words, weights, k=rng.choice([1, 5, 40, 300])))) for i in range(400)]
    docs += [(1000 + i, docs[0][1]) for i in range(60)]  # ties
    items = [(i // 2, " ".join(rng.choices(words, k=rng.randint(1, 12)))) for i in range(30)]
    monkeypatch.setattr(ball_search, "BUNDLE", 64)
    monkeypatch.setattr(ball_search, "LEAF", 4)
    want = sorted((items[row][0], r, i, s) for row, r, i, s in brute.ranked(docs, items))
    for block in (1 << 22, 300):
        got = ball_search.ranked(frame(spark, docs).repartition(3), frame(spark, items, "item_id long, text string"), block=block)
        assert sorted(tuple(r) for r in got.collect()) == want


def test_ranked_odd_rows(spark):
    docs = [(None, "one two"), (1, None), (2, ""), (3, " .,; "), (4, "one two"), (4, "one two"), (5, "ONE\u0000two two"), (6, "x" * 50_000 + " one")]
    items = [(1, "one two"), (1, "two"), (None, "ONE one"), (2, None), (3, ""), (4, "absent"), (5, "two one two")]
    rows = [(*d, 9, "r") for d in docs]
    got = ball_search.ranked(frame(spark, rows, "doc_id long, text string, score int, row string"),
                             frame(spark, [(*i, 3) for i in items], "item_id long, text string, rank int")).collect()
    want = [(items[row][0], r, i, s) for row, r, i, s in brute.ranked(docs, items)]
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))
    empty = frame(spark, [])
    assert ball_search.ranked(empty, frame(spark, items, "item_id long, text string")).count() == 0
    assert ball_search.ranked(frame(spark, docs), frame(spark, [], "item_id long, text string")).count() == 0


def test_search_prunes_and_stays_exact():
    """Bounds hold for every leaf, and far leaves are never scored."""
    rng = np.random.default_rng(3)
    lists = []
    for group in range(16):  # documents of one group share their terms
        for _ in range(64):
            codes = np.sort(rng.choice(np.arange(group * 20, group * 20 + 20), 8, replace=False))
            lists.append((codes, rng.integers(1, 900_000, 8)))
    starts = np.concatenate([[0], np.cumsum([len(c) for c, _ in lists])])
    codes, impacts = np.concatenate([c for c, _ in lists]), np.concatenate([v for _, v in lists])
    scale = np.ones(320)
    tree = ball_search.Tree(starts, codes, impacts * scale[codes], 320)
    at, _ = ball_search.gather(starts, tree.order)
    row = {"doc_ids": tree.order.tolist(), "starts": tree.starts.astype("<i8").tobytes(), "codes": tree.codes.astype("<i4").tobytes(),
           "impacts": impacts[at].astype("<i8").tobytes(), "radii": tree.radii.tobytes(), "node_codes": tree.node_codes.astype("<i4").tobytes(),
           "node_starts": tree.node_starts.tobytes(), "nodes": tree.nodes.tobytes(), "values": tree.values.tobytes()}
    bundle = ball_search.Bundle(row)
    room, dense = np.zeros(320, np.int64), np.zeros((len(lists), 320), np.int64)
    for i, (c, v) in enumerate(lists):
        dense[i, c] = v
    for q in range(40):
        mine = np.sort(rng.choice(np.arange(q % 16 * 20, q % 16 * 20 + 20), 5, replace=False))
        weights = rng.integers(1, 9_000, 5)
        queries = ball_search.Queries([(mine, weights)], scale)
        exact = dense[:, mine] @ weights
        bounds = bundle.leaf_bounds(mine, queries.points[0], queries.squares[0])
        n = len(lists)
        for leaf, bound in enumerate(bounds):
            assert exact[tree.order[n * leaf >> bundle.levels:n * (leaf + 1) >> bundle.levels]].max() <= bound
        rows, scores = bundle.search(mine, weights, queries.points[0], queries.squares[0], 20, 1, room)
        want = sorted(zip((-exact).tolist(), range(n)))[:20]
        assert sorted(zip((-scores).tolist(), bundle.doc_ids[rows].tolist())) == want and not room.any()
    assert bundle.visited < 40 * len(bounds) / 2


# ---------------------------------------------------------------- op13
@given
def test_op13_as_the_library(spark):
    import public_tokenizers as P
    from tokenizers import Tokenizer
    library, at, want = Tokenizer.from_file(P.path(catalog.TOKENIZER_FILE)), 0, []
    for i, text in sorted(texts_of(spark, "documents", "doc_id")):
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(tuple(r) for r in catalog.QUERIES["op13_token_files"](spark, SF).collect()) == want


def test_texts_split_as_the_library_splits_them():
    rng = random.Random(1)
    parts = ["'s", "'t", "'re", "'ve", "'m", "'ll", "'d", "'", " ", "  ", "\n", "\t", " ", "　", "a", "Z", "é", "1", "２", "½", "!", "..", "\U0001F600",
             "中", "don", "x'", "''", "<|endoftext|>", "​", "\r\n", "٣", "\x00", "͸", "\U00010D4A"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(4000)] + ["a" * 5000, "", " ", "   "]
    encoder = token_files.TextEncoder(spec(), 2)
    got = encoder.encode(pa.array(texts), 2)
    for text, ids in zip(texts, got):
        assert np.frombuffer(ids.as_py(), encoder.kind_of_ids).tolist() == encoder.library.encode(text, add_special_tokens=False).ids + [2]
    every = np.concatenate([np.frombuffer(x.as_py(), encoder.kind_of_ids) for x in got])
    assert (np.bincount(every, minlength=len(encoder.total)) == encoder.total).all()


@pytest.mark.parametrize("n", [1, 31, 33, 8191, 8193, 16385, 70_000])
def test_coded_ids_come_back(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.geometric(0.01, n), 50_000)
    ids[:: 997] = 49_999  # rare beside frequent
    values, counts = np.unique(ids, return_counts=True)
    table = token_files.Frequencies.of_counts(dict(zip(values.tolist(), counts.tolist())))
    assert int(table.freq.sum()) == 1 << table.bits and table.freq.min() >= 1
    words, per_block, states, places = token_files.encode_ids(ids, table)
    assert per_block.sum() == len(words)
    assert (token_files.decode_ids(words, states, places, table)[:n] == ids).all()
    last = (n - 1) // token_files.SEGMENT  # any checkpoint can be entered by itself
    tail = token_files.decode_ids(words, states.reshape(len(places), -1)[last:], places[last:], table)
    assert (tail[:n - last * token_files.SEGMENT] == ids[last * token_files.SEGMENT:]).all()


def test_files_of_odd_rows_and_damage(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "CHUNK", 64)
    rows = [(None, "null id", 1), (5, None, 2), (5, "", 3), (5, "same", 4), (5, "same", 4), (2, "word " * 3000, 5), (9, "<|endoftext|> é\U0001F600", 6)]
    path = str(tmp_path / "files")
    token_files.write_ids(frame(spark, rows, "doc_id long, text string, start int"), path, spec(), 2)
    library = token_files.Tokenizer.from_str(spec())
    want = sorted([((-1 if i is None else i), library.encode(t or "", add_special_tokens=False).ids + [2]) for i, t, _ in rows], key=str)
    back = token_files.read_ids(spark, path).collect()
    got = [((-1 if r.doc_id is None else r.doc_id), np.frombuffer(r.ids, "<u4").tolist()) for r in back]
    assert sorted(got, key=str) == want
    in_order = sorted(back, key=lambda r: r.start)
    assert [r.start for r in in_order] == np.cumsum([0] + [r.n_tokens for r in in_order])[:-1].tolist()
    assert [r.doc_id for r in in_order] == [None, 2, 5, 5, 5, 5, 9]
    chunks = spark.read.parquet(f"{path}/chunks")
    other = str(tmp_path / "damaged")
    chunks.withColumn("words", __import__("pyspark").sql.functions.expr("overlay(words placing X'FFFFFFFF' from 1)")).write.parquet(f"{other}/chunks")
    for name in ("table", "index"):
        spark.read.parquet(f"{path}/{name}").write.parquet(f"{other}/{name}")
    with pytest.raises(Exception, match="checksums"):
        token_files.read_ids(spark, other).collect()
    token_files.write_ids(frame(spark, []), str(tmp_path / "none"), spec(), 2)
    assert token_files.read_ids(spark, str(tmp_path / "none")).count() == 0
