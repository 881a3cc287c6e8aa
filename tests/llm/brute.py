"""Plain Python versions of the operators' contracts, for small inputs."""

import hashlib
import re
from collections import Counter

GAP = re.compile(r"[\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LAST = 2**63 - 1


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def rank(i):
    return LAST if i is None else i


def line_dedup(rows):
    keyed = [(i, [(x, lower(x.strip(" \t\n\x0b\x0c\r"))) for x in (t or "").split("\n")]) for i, t in rows]
    first = {}
    for i, lines in keyed:
        for _, k in lines:
            first[k] = min(first.get(k, LAST), rank(i))
    out = []
    for i, lines in keyed:
        kept = [x for x, k in lines if len(k) < 10 or first[k] == rank(i)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def suffix_dedup(rows, length):
    raw = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(b[p: p + length] for _, b in raw for p in range(len(b) - length + 1))
    out = []
    for i, b in raw:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if count[b[p: p + length]] > 1:
                gone[p: p + length] = b"\1" * length
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((i, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return out


def seed_dedup(rows, n=13):
    seqs = [(i, WORD.findall(t or "")) for i, t in rows]
    first = {}
    for i, w in seqs:
        for p in range(len(w) - n + 1):
            k = tuple(w[p: p + n])
            first[k] = min(first.get(k, LAST), rank(i))
    out = []
    for i, w in seqs:
        gone = set()
        for p in range(len(w) - n + 1):
            if first[tuple(w[p: p + n])] < rank(i):
                gone.update(range(p, p + n))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def shingles(t, n=5):
    w = WORD.findall(lower(t or ""))
    return frozenset(tuple(w[k: k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def jaccard(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    up = {}

    def find(x):
        while up.get(x, x) != x:
            x = up[x]
        return x

    for a, s in sets:
        for b, t in sets:
            if a is not None and b is not None and s and t:
                o = len(s & t)
                if 100 * o >= 80 * (len(s) + len(t) - o):
                    x, y = find(a), find(b)
                    up[max(x, y)] = min(x, y)
    return [(i, len(s), find(i) if s and i is not None else i) for i, s in sets]


def exact(rows):
    norm = [(i, GAP.sub(" ", t or "")) for i, t in rows]
    groups = {}
    for i, t in norm:
        groups.setdefault(t, []).append(rank(i))
    return [(i, min(groups[t]), len(groups[t]), sha(t)) for i, t in norm]


def base_rules(t):
    t = t or ""
    w = WORD.findall(t)
    seen, dup = set(), 0
    for x in t.split("\n"):
        dup += bool(x in seen and WORD.search(x))
        seen.add(x)
    tri = Counter(tuple(w[k: k + 3]) for k in range(len(w) - 2))
    rep = {p for k in range(len(w) - 2) if tri[tuple(w[k: k + 3])] > 1 for p in (k, k + 1, k + 2)}
    failed = len(w) < 50 or 100 * len(rep) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(rep), failed


def targets(sizes, weights=(5, 2, 1), cap=3):
    """By repeated sharing: what is over a cap goes to the others by weight."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, out, free = sum(sizes.values()), {}, list(names)
    while free:
        rest = total - sum(out.values())
        share = {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] > cap * sizes[s]]
        if not over:
            out.update(share)
            break
        for s in over:
            out[s] = cap * sizes[s]
        free = [s for s in free if s not in over]
    return out
