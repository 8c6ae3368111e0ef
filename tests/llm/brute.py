"""Plain single-machine versions of the operators, for small inputs."""

from __future__ import annotations

import base64
import hashlib
import math
import re
from collections import defaultdict

import xxhash

BLANKS = re.compile(r"[\x20\x09-\x0D]+")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def exact(rows):
    """(id, text) -> sorted (id, keep, size, kept, sha)."""
    groups = defaultdict(list)
    for at, (i, text) in enumerate(rows):
        groups[hashlib.sha256(BLANKS.sub(" ", text or "").encode()).hexdigest()].append((i is None, i, at))
    out = []
    for sha, members in groups.items():
        first = min(members, key=lambda m: (m[0], m[1] if m[1] is not None else 0, m[2]))
        out += [(m[1], first[1], len(members), m is first, sha) for m in members]
    return out


def fingerprint(text, n=4):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORDS.findall(lower)
    if not words:
        return 0
    shingles = [" ".join(words[k:k + n]) for k in range(len(words) - n + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(values, linked):
    """Index of the class of each of ``values`` under the pair test."""
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(values)):
        for b in range(a):
            if linked(values[a], values[b]):
                parent[find(a)] = find(b)
    return [find(a) for a in range(len(values))]


def near(rows, bits=4, n=4):
    """(id, text) -> {(id, fingerprint hex, component id)} as a sorted list."""
    prints = [fingerprint(t, n) for _, t in rows]
    distinct = sorted(set(prints))
    of = dict(zip(distinct, classes(distinct, lambda a, b: (a ^ b).bit_count() <= bits)))
    least = {}
    for (i, _), p in zip(rows, prints):
        if i is not None:
            least[of[p]] = min(i, least.get(of[p], i))
    return [(i, f"{p:016x}", least.get(of[p])) for (i, _), p in zip(rows, prints)]


def mix_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """{source: words} -> {source: target}, sharing the excess again and again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, left, open_ = {}, share * sum(sizes.values()), set(names)
    while True:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if total and left * weight[s] / total >= most * sizes[s]]
        if not over:
            break
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
            open_.discard(s)
    return target | {s: left * weight[s] / total for s in open_}


def verdict(url, rules):
    """(host, path, rule, action) by the rules alone."""
    url = url or ""
    after = url.split("://", 1)[1] if "://" in url else ""
    host, path = (re.match(p, after, re.S)[k] for p, k in ((r"([^/?#]*)", 1), (r"[^/?#]*([^?#]*)", 1)))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fit, key=lambda r: len(r[0] + r[1]), default=None)
    return host, path, best and best[0] + best[1], best and best[2]


def archive(rows):
    """(page id, html) -> (id, bytes, digest, type, refers to)."""
    groups = defaultdict(list)
    for at, (i, html) in enumerate(rows):
        groups[(html or "").encode()].append((i, at))
    out = []
    for data, members in groups.items():
        first = max(members, key=lambda m: (m[0] is not None, m[0] or 0, -m[1]))
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out += [(m[0], len(data), digest, "response" if m is first else "revisit", None if m is first else first[0]) for m in members]
    return out


def top_k(rows, is_query, k, scale):
    """(id, vector) -> (query, rank, id, score)."""
    ok = [(i, [math.floor(float(x) * scale) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for at, (q, w) in enumerate(ok):
        if is_query(q):
            scored = sorted((-max(min(sum(a * b for a, b in zip(w, x)), (1 << 63) - 1), 1 - (1 << 63)), i) for k2, (i, x) in enumerate(ok) if k2 != at)
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return out
