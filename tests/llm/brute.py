"""Plain Python versions of the operators, for small tables."""

import hashlib
import re
import zlib
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def covered(docs, units_of, k):
    """(doc_id, units, flags) of each document; flags mark units under a window of k that a smaller
    id has, too."""
    first = {}
    docs = [(d, units_of(t)) for d, t in docs]
    for d, u in docs:
        for i in range(len(u) - k + 1):
            if d is not None:
                x = tuple(u[i:i + k])
                first[x] = min(first.get(x, d), d)
    out = []
    for d, u in docs:
        flags = [False] * len(u)
        for i in range(len(u) - k + 1):
            if d is not None and first[tuple(u[i:i + k])] < d:
                flags[i:i + k] = [True] * k
        out.append((d, u, flags))
    return out


def substring_words(docs, k=13):
    out = []
    for d, u, f in covered(docs, lambda t: WORD.findall(t or ""), k):
        kept = " ".join(x for x, y in zip(u, f) if not y)
        out.append((d, len(u), sum(f), sha(kept)))
    return out


def substring_bytes(docs, k=50):
    out = []
    for d, u, f in covered(docs, lambda t: (t or "").encode(), k):
        runs = sum(y and not (i and f[i - 1]) for i, y in enumerate(f))
        out.append((d, len(u), sum(f), runs, sha(bytes(x for x, y in zip(u, f) if not y))))
    return out


def lines(docs, w=3, long=50):
    seen, out = set(), {}
    for d, t in sorted(docs, key=lambda r: (r[0] is None, r[0] or 0)):
        every = (t or "").split("\n")
        full = [i for i, x in enumerate(every) if WORD.search(x)]
        gone = set()
        if d is not None:
            spans = [(i, w, "window") for i in range(len(full) - w + 1)]
            spans += [(i, 1, "line") for i, j in enumerate(full) if len(WORD.findall(every[j])) >= long]
            spans += [(0, len(full), "text")] if 0 < len(full) < w else []
            for i, n, kind in spans:
                x = kind, tuple(every[j] for j in full[i:i + n])
                if x in seen:
                    gone |= set(range(i, i + n))
                seen.add(x)
        runs = sum(i - 1 not in gone for i in gone)
        out[d] = (d, len(full), len(gone), runs, sha("\n".join(x for i, x in enumerate(every) if i not in {full[j] for j in gone})))
    return list(out.values())


def shingles(t, size=3):
    w = [x.translate({i: i + 32 for i in range(65, 91)}) for x in WORD.findall(t or "")]
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()


def components(nodes, linked):
    up = {n: n for n in nodes}

    def root(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in linked:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def near(docs, size=3, percent=85):
    sets = {d: shingles(t, size) for d, t in docs}
    holders = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            holders[x].append(d)
    links = set()
    for d, s in sets.items():
        for o in {o for x in s for o in holders[x] if o < d}:
            both = len(s & sets[o])
            if 100 * both >= percent * (len(s) + len(sets[o]) - both):
                links.add((o, d))
    where = components(sets, links)
    return [(d, len(sets[d]), where[d], where[d] == d) for d, _ in docs]


def targets(sizes):
    """Source -> target, by resharing what exceeds a limit again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, done = 1.5 * sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in done]
        left, share = total - sum(done.values()), sum(weight[s] for s in rest)
        over = [s for s in rest if left * weight[s] / share > 2 * sizes[s]]
        if not over:
            return done | {s: left * weight[s] / share for s in rest}
        done |= {s: 2.0 * sizes[s] for s in over}
        if len(done) == len(names):
            return done


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def paragraphs(t):
    return set(re.findall(r"[^\n]{1,%d}" % PARAGRAPH, t))


PARAGRAPH = 160
