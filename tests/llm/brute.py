"""Plain-Python versions of the operators, for small tables."""

from __future__ import annotations

import base64
import hashlib
import re
from collections import defaultdict

LOW = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ASSIGN = re.compile(
    r"((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def words(text, pattern=ALNUM):
    return pattern.findall((text or "").translate(LOW))


def phrases(text):
    """(n_words, n_base, first, last, labels)"""
    w = words(text)
    found = [(a, label) for p, label in PHRASES.items() for a in range(len(w)) if w[a : a + len(p.split())] == p.split()]
    places = [a for a, _ in found]
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in found}))


def secrets(text):
    """(n_assign, n_access, n_hex, digest)"""
    t = text or ""
    a = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 8]
    k = [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    h = [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
    joined = ",".join(f"{('assign', 'access', 'hex')[n]}:{x}:{y}" for x, n, y in sorted(a + k + h))
    return len(a), len(k), len(h), hashlib.sha256(joined.encode()).hexdigest()


def shingles(text, k=4):
    w = words(text, SPACED)
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def near_components(docs, percent=85, k=4):
    """docs: [(id, text)] -> [(id, n, component)] row by row, all pairs compared."""
    sets = [shingles(t, k) for _, t in docs]
    group = list(range(len(docs)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= percent * (len(a) + len(b) - both):
                    group[find(i)] = find(j)
    least = defaultdict(list)
    for i, (doc, _) in enumerate(docs):
        least[find(i)].append(doc)
    return [(doc, len(sets[i]), min((x for x in least[find(i)] if x is not None), default=None)) for i, (doc, _) in enumerate(docs)]


def decontaminated(docs, items, window=13):
    """[(id, n_words, n_hit, item ids, contaminated)]"""
    grams = defaultdict(set)
    for item, text in items:
        w = words(text)
        k = min(window, len(w))
        for a in range(len(w) - k + 1 if k else 0):
            grams[tuple(w[a : a + k])].add("" if item is None else str(item))
    sizes = sorted({len(g) for g in grams})
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for k in sizes:
            for a in range(len(w) - k + 1):
                if tuple(w[a : a + k]) in grams:
                    found |= grams[tuple(w[a : a + k])]
                    hit.update(range(a, a + k))
        out.append((doc, len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def warc(pages):
    """[(page_id, bytes, digest, type, refers_to)] for distinct page ids"""
    first = {}
    for page, html in pages:
        first[html or ""] = min(first.get(html or "", page), page)
    return [
        (p, len((h or "").encode()), base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode(), "response" if first[h or ""] == p else "revisit", None if first[h or ""] == p else first[h or ""])
        for p, h in pages
    ]
