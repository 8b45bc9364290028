"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import xxhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def components(count, edges):
    parent = list(range(count))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(k) for k in range(count)]


def simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_groups(rows):
    """rows: (doc_id, text) with distinct ids -> {(doc_id, fingerprint, component_id)}"""
    rows = sorted(rows)
    prints = [simhash(t) for _, t in rows]
    near = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3]
    roots = components(len(rows), near)
    return {(rows[i][0], prints[i], rows[roots[i]][0]) for i in range(len(rows))}


def vector_groups(rows, cosine=0.9):
    """rows: (vec_id, vector) -> {(vec_id, n_links, component_id)}"""
    rows = sorted(rows, key=lambda r: r[0])
    usable = [
        v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)
        for _, v in rows
    ]
    links = []
    for i, (_, a) in enumerate(rows):
        for j in range(i):
            b = rows[j][1]
            if usable[i] and usable[j] and len(a) == len(b):
                x, y = np.array(a, float), np.array(b, float)
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= cosine:
                    links.append((i, j))
    roots = components(len(rows), links)
    count = [sum(i in pair for pair in links) for i in range(len(rows))]
    return {(rows[i][0], count[i], rows[roots[i]][0]) for i in range(len(rows))}


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def decontaminated(docs, items):
    """(doc_id, n_words, n_hit, items) of every document."""
    windows = {}
    for item, text in items:
        words = words_of(text)
        length = min(10, len(words))
        for k in range(len(words) - length + 1 if words else 0):
            windows.setdefault(tuple(words[k : k + length]), set()).add(str(item))
    out = []
    for doc, text in docs:
        words = words_of(text)
        hit, found = set(), set()
        for length in {len(w) for w in windows}:
            for k in range(len(words) - length + 1):
                here = windows.get(tuple(words[k : k + length]))
                if here:
                    hit.update(range(k, k + length))
                    found |= here
        out.append((doc, len(words), len(hit), tuple(sorted(found))))
    return out


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
ADDRESS = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
    return sum(v - 9 * (v > 9) for v in doubled) % 10 == 0


def personal(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    spans = [("email", *m.span()) for m in EMAIL.finditer(text)]
    spans += [("ip", *m.span()) for m in ADDRESS.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    spans += [("card", *m.span()) for m in CARD.finditer(text) if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    spans += [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m[0])) <= 15]
    return spans


def sha1(text):
    return hashlib.sha1((text or "").encode()).hexdigest()
