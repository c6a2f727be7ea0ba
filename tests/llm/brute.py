"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib

import numpy as np
import xxhash

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").encode())


def fingerprint(text, n=3):
    w = [x.translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")) for x in words(text)]
    shingles = [b" ".join(w[i : i + n]) for i in range(len(w) - n + 1)] if len(w) >= n else [b" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def components(nodes, linked):
    """The smallest node reachable from each; ``linked(a, b)`` is symmetric."""
    nodes, root = sorted(set(nodes)), {}
    for start in nodes:
        if start in root:
            continue
        root[start], todo = start, [start]
        while todo:
            a = todo.pop()
            for b in nodes:
                if b not in root and linked(a, b):
                    root[b] = start
                    todo.append(b)
    return root


def repeated(docs, n=20):
    """doc_id: (words, removed, digest of what is kept)."""
    seen, out = {}, {}
    for key in sorted(docs):
        w = words(docs[key])
        gone = [False] * len(w)
        for s in range(len(w) - n + 1):
            if seen.setdefault(tuple(w[s : s + n]), (key, s)) != (key, s):
                gone[s : s + n] = [True] * n
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out[key] = (len(w), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest())
    return out


def good_vector(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(x != 0 for x in v)


def cosine(a, b):
    a, b = np.asarray(a, float), np.asarray(b, float)
    return float(a @ b / math.sqrt(a @ a) / math.sqrt(b @ b))


def targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """source: target, by capping and sharing again until none is above."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    budget, full = share * sum(sizes.values()), set()
    while True:
        rest = budget - sum(most * sizes[s] for s in full)
        free = sum(weight[s] for s in order if s not in full)
        over = {s for s in order if s not in full and rest * weight[s] / free > most * sizes[s]} if free else set()
        if not over:
            return {s: most * sizes[s] if s in full else rest * weight[s] / free for s in order}
        full |= over


def runs(w, least=24, periods=3):
    """(start, length, smallest period) of the runs of some words."""
    found = {}
    for q in range(1, len(w) // periods + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if (length := i + q - start) >= max(least, periods * q):
                found.setdefault((start, length), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def collapsed(w, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return b" ".join(x for i, x in enumerate(w) if i not in gone)


def planted(doc_id, text):
    """The words of a text, repeated from some word on in one document of ten."""
    w, h = words(text), zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def line_dedup(rows):
    """(doc_id, lines, dropped, kept) of each (doc_id, text)."""
    blank, split = " \t\n\v\f\r", [(i, (t or "").split("\n")) for i, t in rows]
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    holders = {}
    for i, found in split:
        for line in found:
            if i is not None:
                holders.setdefault(line.strip(blank).translate(lower), set()).add(i)
    out = []
    for i, found in split:
        keys = [x.strip(blank).translate(lower) for x in found]
        kept = [x for x, k in zip(found, keys, strict=True) if i is None or len(k) < 20 or len(holders[k]) < 3 or max(holders[k]) == i]
        out.append((i, len(found), len(found) - len(kept), "\n".join(kept)))
    return out


def alignment(texts, spell_a, spell_b):
    """For each text the digest row of two tokenizers, given as functions to lists of (id, bytes)."""
    rows, count = [], {}
    for t in texts:
        want = b" " + (t or "").encode()
        a, b = (spell(t) if t else [] for spell in (spell_a, spell_b))
        if not t or b"".join(x for _, x in a) != want or b"".join(x for _, x in b) != want:
            a = b = []
        ends_a, ends_b = ([sum(len(x) for _, x in s[: i + 1]) for i in range(len(s))] for s in (a, b))
        links = [(a[i][0], b[j][0]) for i, e in enumerate(ends_a) for j, f in enumerate(ends_b) if e == f]
        for x in links:
            count[x] = count.get(x, 0) + 1
        groups, i, j = [], 0, 0
        for e in sorted(set(ends_a) & set(ends_b)):
            m, n = ends_a.index(e) + 1, ends_b.index(e) + 1
            groups.append(",".join(str(x) for x, _ in a[i:m]) + "|" + ",".join(str(x) for x, _ in b[j:n]))
            i, j = m, n
        rows.append((len(a), len(b), groups, links))
    top = {}
    for (_, b), n in count.items():
        top[b] = max(top.get(b, 0), n)
    return [(na, nb, len(g), len(x), sum(count[p] == top[p[1]] for p in x), sum(count[p] for p in x), ";".join(g)) for na, nb, g, x in rows]
