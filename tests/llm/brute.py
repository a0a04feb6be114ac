"""Plain versions of the operators, a text at a time."""

from __future__ import annotations

import base64
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def words(text, lower=True):
    text = text or ""
    return WORD.findall(text.translate(UPPER) if lower else text)


def base(text):
    ws = words(text, lower=False)
    seen = Counter(tuple(ws[i : i + 5]) for i in range(len(ws) - 4))
    covered = set()
    for i in range(len(ws) - 4):
        if seen[tuple(ws[i : i + 5])] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return {
        "n_words": len(ws),
        "word_chars": sum(map(len, ws)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }


def katz(docs, cutoff=5, order=3):
    """{id: (n_tokens, n_known, N, base, score)} from (id, text, held), and for some histories
    of each length the sum of all words' probabilities."""
    end, start = object(), object()
    tokens = {k: [*words(t), end] for k, t, _ in docs}
    train = [k for k, _, held in docs if not held]
    one = Counter(w for k in train for w in tokens[k])
    total, distinct = sum(one.values()), len(one)

    def discounts(counter):
        n = Counter(counter.values())
        d = {r: 1.0 for r in range(1, cutoff + 1)}
        if n[1]:
            tail = (cutoff + 1) * n[cutoff + 1] / n[1]
            for r in d:
                if n[r] and tail < 1:
                    x = ((r + 1) * n[r + 1] / n[r] / r - tail) / (1 - tail)
                    d[r] = x if 0 < x < 1 else 1.0
        return d

    d1 = discounts(one)
    lost = sum((1 - d1.get(c, 1)) * c for c in one.values())
    scale = 1.0 if lost > 0 else total / (total + 1)
    reserved = (lost / total if lost > 0 else 1 / (total + 1)) if total else 1.0

    def p1(w):
        c = one[w]
        return d1.get(c, 1) * c / total * scale if c else reserved

    after = {k: defaultdict(dict) for k in range(2, order + 1)}
    d = {}
    for k in after:
        grams = Counter()
        for name in train:
            marked = [start, *tokens[name]]
            grams.update(tuple(marked[i : i + k]) for i in range(len(marked) - k + 1))
        d[k] = discounts(grams)
        for gram, c in grams.items():
            after[k][gram[:-1]][gram[-1]] = c
    weights = {}

    def p(h, w):
        if not h:
            return p1(w)
        k = len(h) + 1
        if h not in after[k]:
            return p(h[1:], w)
        follow = after[k][h]
        if h not in weights:
            n = sum(follow.values())
            gone = sum((1 - d[k].get(c, 1)) * c for c in follow.values())
            size = n if gone > 0 else n + 1
            weights[h] = size, (gone or 1) / size / (1 - sum(p(h[1:], x) for x in follow))
        size, weight = weights[h]
        c = follow.get(w, 0)
        return d[k].get(c, 1) * c / size if c else weight * p(h[1:], w)

    def score(ts):
        marked = [start, *ts]
        return sum(math.log10(p(tuple(marked[max(0, i - order + 1) : i]), marked[i])) for i in range(1, len(marked)))

    found = {}
    for k, ts in tokens.items():
        found[k] = (
            len(ts),
            sum(one[w] > 0 for w in ts),
            total,
            sum(math.log10((one[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in ts),
            score(ts),
        )
    sums = {h: sum(p(h, w) for w in one) + p(h, None) for k in after for h in list(after[k])[:40]}
    return found, sums


def shingles(text, size):
    ws = words(text)
    if not ws:
        return frozenset()
    if len(ws) < size:
        return frozenset([tuple(ws)])
    return frozenset(tuple(ws[i : i + size]) for i in range(len(ws) - size + 1))


def joined(docs, size, percent):
    """{id: (n, component)} of (id, text)."""
    sets = {k: shingles(t, size) for k, t in docs}
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    keys = list(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= percent * (len(x) + len(y) - both):
                    low, high = sorted((find(a), find(b)))
                    root[high] = low
    return {k: (len(s), find(k)) for k, s in sets.items()}


def warc(pages):
    """{id: (bytes, digest, type, refers_to)} of (id, html)."""
    least = {}
    for k, html in pages:
        data = (html or "").encode()
        least[data] = min(k, least.get(data, k))
    found = {}
    for k, html in pages:
        data = (html or "").encode()
        first = least[data]
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        found[k] = len(data), digest, "response" if first == k else "revisit", None if first == k else first
    return found


def dedup(docs, chars=40, least=5):
    """{id: (n_lines, n_dropped, text)} of (id, text)."""

    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(UPPER)

    holders = defaultdict(set)
    for k, t in docs:
        for line in (t or "").split("\n"):
            if len(key(line)) >= chars:
                holders[key(line)].add(k)
    found = {}
    for k, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < least or max(holders[key(x)]) == k]
        found[k] = len(lines), len(lines) - len(kept), "\n".join(kept)
    return found


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5


def one_edit(x, y):
    """Whether exactly one code point is replaced, deleted or inserted."""
    if len(x) < len(y):
        x, y = y, x
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y, strict=True)) == 1
    return len(x) == len(y) + 1 and any(x[:i] + x[i + 1 :] == y for i in range(len(x)))


def spelling(docs, damage=97):
    """{word: (form, root, n, n_near, form_n)} of (id, text)."""
    counts = Counter()
    for k, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if k is None else k}:{run}".encode())
            if h % damage == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 5 and c >= 3}
    by_hole = defaultdict(set)  # words that agree but for one place
    for w in n:
        for i in range(len(w)):
            by_hole[w[:i] + "*" + w[i + 1 :]].add(w)
    near = defaultdict(set)
    for group in by_hole.values():
        for w in group:
            near[w] |= group - {w}
    for w in n:
        for i in range(len(w)):
            short = w[:i] + w[i + 1 :]
            if short in n:
                near[w].add(short)
                near[short].add(w)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {w: (form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n}


def nearest(vectors, k=20):
    """{row: [(id, score), ...]} for (id, vector) rows whose id divides by 20."""
    ids = [i for i, _ in vectors]
    found = {}
    for at, (i, v) in enumerate(vectors):
        if i % 20 == 0:
            scores = [(-sum(a * b for a, b in zip(v, w, strict=False)), ids[j]) for j, (_, w) in enumerate(vectors) if j != at]
            found[at] = [(j, -s) for s, j in sorted(scores)[:k]]
    return found
