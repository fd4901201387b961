"""Plain single-machine versions of the training-data queries, for comparison on small tables."""

import hashlib
import re

import numpy as np


def sha(x):
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


def shingles(text, n=5):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return set()
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} or {tuple(words)}


def near_duplicates(docs, percent=85):
    """id -> (n_shingles, component)"""
    sets = {i: shingles(t) for i, t in docs}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= percent * (len(x) + len(y) - both):
                    p, q = sorted((find(a), find(b)))
                    root[q] = p
    return {i: (len(sets[i]), find(i)) for i in ids}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def base_pii(text):
    text = text or ""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, "email", m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, "ip", m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, "card", m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((m.start(), 3, "phone", m.end()))
    return sorted(out)


def base_secrets(text):
    text = text or ""
    out = []
    key = "[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"
    for m in re.finditer(rf"""({key})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m.group(2)) >= 6:
            out.append((m.start(), 0, "assign", m.end()))
    for m in re.finditer(r"AKIA[A-Z0-9]+", text):
        if m.end() - m.start() >= 20:
            out.append((m.start(), 1, "access", m.end()))
    for m in re.finditer(r"[0-9a-f]+", text):
        if m.end() - m.start() >= 24:
            out.append((m.start(), 2, "hex", m.end()))
    return sorted(out)


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in spans)


def repeats(docs, length=400):
    """id -> (n_bytes, n_removed, n_spans, kept bytes)"""
    seen = {}
    raws = {i: (t or "").encode() for i, t in docs}
    for i, raw in raws.items():
        for p in range(len(raw) - length + 1):
            seen.setdefault(raw[p:p + length], []).append((i, p))
    gone = {i: np.zeros(len(raw), bool) for i, raw in raws.items()}
    for places in seen.values():
        if len(places) > 1:
            for i, p in places:
                gone[i][p:p + length] = True
    out = {}
    for i, raw in raws.items():
        g = gone[i]
        runs = int(np.count_nonzero(np.diff(g.astype(int), prepend=0) == 1))
        out[i] = (len(raw), int(g.sum()), runs, bytes(b for b, x in zip(raw, g) if not x))
    return out


def top_k(rows, k=5):
    vectors = {i: np.floor(256 * np.array(v, float)).astype(int) for i, v in rows
               if i is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v)}
    out = []
    for q, a in vectors.items():
        if q % 50 == 0:
            best = sorted((-int(a @ b), i) for i, b in vectors.items() if i != q and len(a) == len(b))[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return sorted(out)


def tiles(doc, item, least=5):
    """Greedy string tiling over word lists by comparing all places: covered words."""
    in_doc, in_item, covered = [False] * len(doc), [False] * len(item), 0
    while True:
        best = (0, 0, 0)
        for a in range(len(doc)):
            for b in range(len(item)):
                n = 0
                while (a + n < len(doc) and b + n < len(item) and doc[a + n] == item[b + n]
                       and not in_doc[a + n] and not in_item[b + n]):
                    n += 1
                if n > best[0]:
                    best = (n, a, b)
        n, a, b = best
        if n < least:
            return covered
        for k in range(n):
            in_doc[a + k] = in_item[b + k] = True
        covered += n


def spelling(docs, noise=199):
    """word -> (form, root, n, n_near, form_n)"""
    import zlib
    from collections import Counter
    count = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % noise == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            count[run] += 1
    n = {w: c for w, c in count.items() if len(w) >= 6 and c >= 5}

    def one_edit(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        if len(a) > len(b):
            a, b = b, a
        return len(b) - len(a) == 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))

    near = {w: [v for v in n if v != w and one_edit(w, v)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None)
    return out


def ranked(docs, items, k=20):
    """Rows (item row, rank, doc_id, score) of every item with a text."""
    import math
    from collections import Counter

    def terms(text):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)

    rows = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    total, length = len(rows), sum(sum(c.values()) for _, c in rows)
    df = Counter(t for _, c in rows for t in c)
    out = []
    for row, (_, text) in enumerate(items):
        asked, scores = Counter(terms(text)), []
        for i, c in rows:
            m = 100 - 25 + (25 * sum(c.values()) * total) // length
            s = sum(r * math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 12 * m))
                    for t, r in asked.items() if c[t])
            if s > 0:
                scores.append((-s, i is None, i))
        out += [(row, r, i, -s) for r, (s, _, i) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return out
