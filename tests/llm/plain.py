"""Plain versions of the operators' contracts: one loop over all rows, no Spark."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash

SF001 = "/root/testdata/sf0.001"

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n if doc_id is not None else 0


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def secrets(text):
    x = text or ""
    assign = [(m.start(), 0, m.end()) for m in re.finditer(
        r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", x, re.A | re.I)
        if len(m[1]) >= 6]
    access = [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", x) if len(m[0]) >= 20]
    longhex = [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", x) if len(m[0]) >= 24]
    spans = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(assign + access + longhex))
    return len(assign), len(access), len(longhex), sha(spans)


def fingerprint(text, size=3):
    w = WORD.findall(lower(text))
    shingles = [" ".join(w[i:i + size]) for i in range(len(w) - size + 1)] if len(w) >= size else [" ".join(w)] * bool(w)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, distance=3, groups=False):
    """Of (id, fingerprint) rows: the least id reachable, per row or (``groups``) per component."""
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j][1]).bit_count() <= distance:
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(prints):
        least[find(i)].append(doc_id)
    ids = {k: min((x for x in v if x is not None), default=None) for k, v in least.items()}
    return list(ids.values()) if groups else [ids[find(i)] for i in range(len(prints))]


def quality(text):
    t = text or ""
    w = WORD.findall(t)
    windows = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    hit = {i + k for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    failed = len(w) < 50 or 100 * len(hit) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit), failed


def kept_words(rows, window=20):
    """Of (id, text) rows in their order: (id, words, removed, hash of what is kept)."""
    seen, out = set(), []
    for doc_id, text in rows:
        w, hit = WORD.findall(text or ""), set()
        for p in range(len(w) - window + 1):
            key = tuple(w[p:p + window])
            if key in seen:
                hit.update(range(p, p + window))
            seen.add(key)
        out.append((doc_id, len(w), len(hit), sha(" ".join(x for i, x in enumerate(w) if i not in hit))))
    return out


def language_model(rows, mu=500.0):
    uni, bi, tokens = Counter(), Counter(), []
    for doc_id, text in rows:
        w = WORD.findall(lower(text)) + [None]
        tokens.append(w)
        if fold(doc_id, 7) != 2:
            uni.update(w)
            bi.update(zip([0] + w[:-1], w))
    total, types = sum(uni.values()), len(uni)
    p = lambda t: (uni[t] + 1) / (total + types + 1)
    out = []
    for w in tokens:
        score, before = 0.0, 0
        for t in w:
            context = uni[None] if before == 0 else uni[before]
            score += math.log10((bi[before, t] + mu * p(t)) / (context + mu))
            before = t
        out.append((len(w), sum(uni[t] > 0 for t in w), total, sum(math.log10(p(t)) for t in w), score))
    return out


def contamination(rows, items, size=10):
    windows = defaultdict(set)
    for name, text in items:
        w = ALNUM.findall(lower(text))
        k = min(size, len(w))
        for i in range(len(w) - k + 1 if k else 0):
            windows[tuple(w[i:i + k])].add(str(name))
    out = []
    for text in rows:
        w, hit, found = ALNUM.findall(lower(text)), set(), set()
        for k in {len(x) for x in windows}:
            for i in range(len(w) - k + 1):
                if own := windows.get(tuple(w[i:i + k])):
                    found |= own
                    hit.update(range(i, i + k))
        out.append((len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out
