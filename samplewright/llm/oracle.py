"""DuckDB SQL for the training-data queries that SQL can express: the same results by plain means."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: op1: all pairs that share a shingle, exact similarity, reachability by a recursive query.
NEAR_DUPLICATES = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS words
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) END AS shingles FROM w),
n AS (SELECT doc_id, len(shingles) AS n FROM s),
e AS (SELECT doc_id, md5(unnest(shingles)) AS h FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM e a JOIN e b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * k >= 85 * (x.n + y.n - k)),
g AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, g.b FROM r JOIN g ON r.b = g.a)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, min(r.b) AS component_id, n.doc_id = min(r.b) AS kept
FROM n JOIN r ON r.a = n.doc_id GROUP BY n.doc_id, n.n"""

def _runs(tag: str, length: int) -> str:
    """CTEs r<tag>: the runs (a, b) of bytes covered by strings of ``length`` bytes that occur twice."""
    return f"""
w{tag} AS (SELECT doc_id, p, md5(substr(x, 2 * p + 1, {2 * length})) AS h FROM (SELECT doc_id, x, unnest(range(0, len(x) // 2 - {length - 1})) AS p FROM t)),
d{tag} AS (SELECT doc_id, p FROM w{tag} JOIN (SELECT h FROM w{tag} GROUP BY h HAVING count(*) > 1) USING (h)),
o{tag} AS (SELECT doc_id, p, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= {length} THEN 0 ELSE 1 END AS opens FROM d{tag}),
g{tag} AS (SELECT doc_id, p, sum(opens) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM o{tag}),
r{tag} AS (SELECT doc_id, run, min(p) AS a, max(p) + {length} AS b FROM g{tag} GROUP BY doc_id, run)"""


#: op6: every 400-byte string counted, the starts of those that occur twice merged into runs; the same for passages of 320 bytes.
REPEATS = f"""
WITH t AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),{_runs('', 400)},{_runs('_short', 320)},
q AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS z FROM r),
k AS (SELECT q.doc_id, string_agg(substr(x, 2 * z + 1, 2 * (a - z)), '' ORDER BY a) AS ahead, max(b) AS last, sum(b - a) AS removed, count(*) AS runs
      FROM q JOIN t ON q.doc_id = t.doc_id GROUP BY q.doc_id),
s AS (SELECT doc_id, sum(b - a) AS passage FROM r_short GROUP BY doc_id)
SELECT t.doc_id, CAST(len(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(runs, 0) AS BIGINT) AS n_spans,
       sha256(unhex(CASE WHEN runs IS NULL THEN x ELSE ahead || substr(x, 2 * last + 1) END)) AS kept_sha256, CAST(coalesce(passage, 0) AS BIGINT) AS n_passage
FROM t LEFT JOIN k ON t.doc_id = k.doc_id LEFT JOIN s ON s.doc_id = t.doc_id"""

#: op8: all scores, ranked.
TOP_K = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score FROM r WHERE rank <= 5"""


def _quarter_steps() -> list[int]:
    """What four steps of the reflected crc32 polynomial make of each value of four bits."""
    out = []
    for value in range(16):
        for _ in range(4):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        out.append(value)
    return out


def _crc32(text: str) -> str:
    """SQL for the unsigned crc32 of a string's UTF-8, folded over its half bytes, the low one first."""
    digits = f"list_transform(range(0, len(hex(encode({text})))), lambda i: strpos('0123456789ABCDEF', substr(hex(encode({text})), CAST(xor(i, 1) + 1 AS INTEGER), 1)) - 1)"
    step = f"lambda c, d: xor(({_quarter_steps()}::BIGINT[])[xor(c, d) & 15 + 1], c >> 4)".replace("xor(c, d) & 15 + 1", "(xor(c, d) & 15) + 1")
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, CAST({digits} AS BIGINT[])), {step}), 4294967295::BIGINT)"


#: op11: noise by a folded crc32, near words by their spellings without one code point, chains by a recursive query.
SPELLING = f"""
WITH RECURSIVE t AS (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]{{6,}}')) AS run FROM documents),
u AS (SELECT concat(doc_id, ':', run) AS named, run, k FROM (SELECT doc_id, translate(run, '{_UPPER}', '{_LOWER}') AS run, count(*) AS k FROM t GROUP BY ALL)),
h AS (SELECT run, k, {_crc32('named')} AS h FROM u),
w AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM (
        SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) AS INTEGER) + 2) ELSE run END AS word, k FROM h)
      WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5),
p AS (SELECT word, i, substr(word, CAST(1 AS INTEGER), CAST(i - 1 AS INTEGER)) || substr(word, CAST(i + 1 AS INTEGER)) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM w)),
e AS (SELECT a.word AS x, b.word AS y FROM p a JOIN p b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
      UNION SELECT p.word, w.word FROM p JOIN w ON p.rest = w.word
      UNION SELECT w.word, p.word FROM p JOIN w ON p.rest = w.word),
b AS (SELECT x, y, w.n AS m, count(*) OVER (PARTITION BY x) AS n_near, row_number() OVER (PARTITION BY x ORDER BY w.n DESC, y) AS place FROM e JOIN w ON w.word = e.y),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 5 * w.n THEN y END AS form, CASE WHEN m >= 5 * w.n THEN m END AS form_n
      FROM w LEFT JOIN b ON b.x = w.word AND place = 1),
c AS (SELECT word, word AS at FROM f UNION ALL SELECT c.word, f.form FROM c JOIN f ON f.word = c.at WHERE f.form IS NOT NULL),
r AS (SELECT c.word, c.at AS root FROM c JOIN f ON f.word = c.at WHERE f.form IS NULL)
SELECT f.word, f.form, r.root, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form_n FROM f JOIN r ON r.word = f.word"""

_TERMS = f"unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'))"

#: op12: every score, ranked.
RANKED_SEARCH = f"""
WITH f AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, {_TERMS} AS term FROM documents) GROUP BY ALL),
s AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM f GROUP BY doc_id),
c AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM s),
m AS (SELECT doc_id, 100 - 25 + (25 * n * docs) // total AS m FROM s, c),
q AS (SELECT item_id, term, count(*) AS k FROM (SELECT item_id, {_TERMS} AS term FROM benchmark) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM (SELECT term, count(*) AS df FROM f GROUP BY term), c),
x AS (SELECT item_id, f.doc_id, CAST(sum(k * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
      FROM q JOIN w ON w.term = q.term JOIN f ON f.term = q.term JOIN m ON m.doc_id = f.doc_id GROUP BY item_id, f.doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM x WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 20"""
