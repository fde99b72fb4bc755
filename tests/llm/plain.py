"""Plain versions of the operators, in the most obvious way, for small inputs."""

import hashlib
import re

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def ordered(rows):
    """Documents in the order the operators give to odd ids: null first, then by id, then by text."""
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] if r[0] is not None else 0, r[1] is not None, (r[1] or "").encode()))


def passages(rows, window):
    seen, words = {}, [SPLIT.findall(t or "") for _, t in rows]
    for w in words:
        for k in range(len(w) - window + 1):
            seen[tuple(w[k:k + window])] = seen.get(tuple(w[k:k + window]), 0) + 1
    out = []
    for (i, _), w in zip(rows, words):
        gone = set()
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k:k + window])] > 1:
                gone |= set(range(k, k + window))
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def bytespans(rows, window):
    seen, out = set(), []
    for i, t in ordered(rows):
        data, gone = (t or "").encode(), set()
        for k in range(len(data) - window + 1):
            run = data[k:k + window]
            if run in seen:
                gone |= set(range(k, k + window))
            seen.add(run)
        spans = sum(p - 1 not in gone for p in gone)
        kept = bytes(b for p, b in enumerate(data) if p not in gone)
        out.append((i, len(data), len(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def shingles(text, size=5):
    w = SPLIT.findall(ascii_lower(text or ""))
    return {tuple(w[k:k + size]) for k in range(max(len(w) - size + 1, 1))} if w else set()


def components(rows):
    """(id, set size, first id of the component) with documents in the operators' order."""
    rows = ordered(rows)
    sets = [shingles(t) for _, t in rows]
    head = list(range(len(rows)))

    def find(x):
        while head[x] != x:
            x = head[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                head[max(x, y)] = min(x, y)
    return [(rows[k][0], len(sets[k]), rows[find(k)][0]) for k in range(len(rows))]


ITEM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contamination(rows, items, window):
    runs = []
    for name, text in items:
        w = ITEM.findall(ascii_lower(text or ""))
        n = min(len(w), window)
        runs += [(str(name), tuple(w[k:k + n])) for k in range(len(w) - n + 1)] if w else []
    out = []
    for i, text in rows:
        w, hit, named = ITEM.findall(ascii_lower(text or "")), set(), set()
        for name, run in runs:
            for k in range(len(w) - len(run) + 1):
                if tuple(w[k:k + len(run)]) == run:
                    hit |= set(range(k, k + len(run)))
                    named.add(name)
        out.append((i, len(w), len(hit), len(named), hashlib.sha256(",".join(sorted(named)).encode()).hexdigest(), bool(hit)))
    return out
