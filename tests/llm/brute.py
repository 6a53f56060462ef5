"""Brute-force versions of the operators in plain Python, written from their contracts."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from fractions import Fraction

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORDS.findall(text or "")


def lower_ascii(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def sha(parts):
    return hashlib.sha256(",".join(parts).encode()).hexdigest()


def targets(sizes: dict) -> dict:
    """Target words per source: shares by weight, those above three times the size stop, the excess goes round again."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    total = sum(sizes.values())
    stopped = set()
    while True:
        left = total - sum(3 * sizes[s] for s in stopped)
        open_weight = sum(weight[s] for s in order if s not in stopped)
        share = {s: Fraction(3 * sizes[s]) if s in stopped else Fraction(left * weight[s], open_weight) for s in order}
        above = {s for s in order if share[s] > 3 * sizes[s]}
        if not above:
            return {s: float(v) for s, v in share.items()}
        stopped |= above


def secrets(text):
    text = text or ""
    spans = []
    for m in re.finditer(r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 8:
            spans.append((m.start(), 0, m.end()))
    for k, pattern, least in ((1, "AKIA[A-Z0-9]+", 16), (2, "[0-9a-f]+", 32)):
        spans += [(m.start(), k, m.end()) for m in re.finditer(pattern, text) if len(m[0]) >= least]
    names = ("assign", "access", "hex")
    spans.sort()
    found = [f"{names[k]}:{a}:{b}" for a, k, b in spans]
    return [sum(k == j for _, k, _ in spans) for j in range(3)], sha(found), found


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def personal(text):
    text = text or ""
    digits = lambda s: re.sub("[^0-9]", "", s)
    kinds = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(digits(s)) <= 19 and luhn(digits(s))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
    )
    found, counts = [], []
    for name, pattern, valid in kinds:
        own = [f"{name}:{m.start()}:{m.end()}" for m in re.finditer(pattern, text) if valid(m[0])]
        counts.append(len(own))
        found += own
    return counts, sha(found), found


def quality(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    seen = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {k for i in range(len(w) - 4) if seen[tuple(w[i : i + 5])] > 1 for k in range(i, i + 5)}
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return (
        len(w),
        sum(map(len, w)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
        failed,
    )


def shingles(text):
    w = words(lower_ascii(text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3)))


def components(docs):
    """doc_id -> (set size, smallest doc_id reachable) by comparing all pairs."""
    sets = {d: shingles(t) for d, t in docs}
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            x, y = sets[a], sets[b]
            if not x or not y or 100 * min(len(x), len(y)) < 85 * max(len(x), len(y)):
                continue
            common = len(x & y)
            if 100 * common >= 85 * (len(x) + len(y) - common):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {d: (len(sets[d]), find(d)) for d in ids}


ITEM_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contamination(docs, items):
    cut = lambda t: ITEM_WORDS.findall(lower_ascii(t or ""))
    windows = {}
    for item, text in items:
        w = cut(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[i : i + 10]), set()).add(str(item))
    widths = {len(x) for x in windows}
    out = {}
    for doc, text in docs:
        w = cut(text)
        hit, found = set(), set()
        for n in widths:
            for i in range(len(w) - n + 1):
                if (own := windows.get(tuple(w[i : i + n]))) is not None:
                    hit.update(range(i, i + n))
                    found |= own
        out[doc] = (len(w), len(hit), len(found), sha(sorted(found)), bool(hit))
    return out


def crc(text):
    return zlib.crc32((text or "").encode())
