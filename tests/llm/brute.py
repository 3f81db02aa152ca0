"""Plain versions of the operators, for small tables only."""

import hashlib
import re
from collections import Counter, defaultdict


def repeated_bytes(rows, length=50):
    """(doc_id, text) rows -> list of (doc_id, n_bytes, n_removed, n_spans, sha)."""
    first = {}
    for d, t in rows:
        raw = (t or "").encode()
        for i in range(len(raw) - length + 1):
            w = raw[i:i + length]
            first[w] = min(first.get(w, d), d)
    out = []
    for d, t in rows:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if first[raw[i:i + length]] < d:
                gone[i:i + length] = b"\x01" * length
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        spans = sum(1 for i in range(len(raw)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((d, len(raw), len(raw) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


def near_duplicates(rows, width):
    """doc_id -> (n_shingles, component_id), by counting shared shingles."""
    sets = {}
    for d, t in rows:
        words = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        sets[d] = {tuple(words[i:i + width]) for i in range(len(words) - width + 1)} if len(words) >= width else ({tuple(words)} if words else set())
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            holders[x].append(d)
    for d, s in sets.items():
        for e, both in Counter(e for x in s for e in holders[x] if e < d).items():
            if 100 * both >= 80 * (len(s) + len(sets[e]) - both):
                a, b = root(d), root(e)
                parent[max(a, b)] = min(a, b)
    return {d: (len(s), root(d)) for d, s in sets.items()}


_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contamination(docs, items, window=10):
    """list of (doc_id, n_words, n_hit, n_items, sha, contaminated)."""
    windows = defaultdict(set)
    for i, t in items:
        words = _WORD.findall((t or "").encode().lower())
        n = min(window, len(words))
        for j in range(len(words) - n + 1 if words else 0):
            windows[tuple(words[j:j + n])].add(i)
    out = []
    for d, t in docs:
        words = _WORD.findall((t or "").encode().lower())
        hit, found = set(), set()
        for n in {len(w) for w in windows}:
            for j in range(len(words) - n + 1):
                if (own := windows.get(tuple(words[j:j + n]))):
                    found |= own
                    hit.update(range(j, j + n))
        listing = ",".join(sorted(str(i) for i in found))
        out.append((d, len(words), len(hit), len(found), hashlib.sha256(listing.encode()).hexdigest(), bool(hit)))
    return out
