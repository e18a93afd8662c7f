"""Plain-Python statements of what the operators return, for small inputs."""

import hashlib
import re
from collections import Counter, defaultdict
from itertools import combinations

WS = re.compile(r"[\x20\x09-\x0D]+")


def words(t):
    return [w for w in WS.split(t or "") if w]


def measure(t):
    w = words(t)
    lines = [x for x in (t or "").split("\n") if words(x)]
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    often = {g for g, n in Counter(grams).items() if n > 1}
    hit = {i + k for i, g in enumerate(grams) if g in often for k in range(3)}
    failed = len(w) < 50 or 100 * len(hit) > 50 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(hit), failed)


def host_rejected(docs):
    """docs: (host, text). Hosts whose shrunk failure rate of some rule is over one half."""
    n, fails = Counter(), defaultdict(Counter)
    for host, t in docs:
        if host is None:
            continue
        w, _, s, d, r, _ = measure(t)
        lines = sum(bool(words(x)) for x in (t or "").split("\n"))
        n[host] += 1
        for k, bad in enumerate((w < 50, 100 * r > 50 * w, 100 * s > 50 * w, 100 * d > 50 * lines)):
            fails[k][host] += bad
    out = set()
    total = sum(n.values())
    for k in range(4):
        m = sum(fails[k].values()) / total if total else 0
        v = sum(n[h] * (fails[k][h] / n[h]) ** 2 for h in n) / total - m * m if total else 0
        weight = max(2.0, min(1000.0, m * (1 - m) / v - 1)) if v > 0 else 1000.0
        out |= {h for h in n if (fails[k][h] + m * weight) / (n[h] + weight) > 0.5}
    return out


def dedup_lines(docs, key, min_lines=2, long_words=50):
    """docs: (id, text); ``key(id, text)`` gives the order. {(id, text): (new text, n_lines, n_deleted)}."""
    seqs = {}
    for d, t in docs:
        raw = t.split("\n") if t is not None else []
        seqs[d, t] = [(i, x) for i, x in enumerate(raw) if words(x)]
    seen, gone = set(), defaultdict(set)
    for size in (1, min_lines):
        seen = set()
        for d in sorted(seqs, key=lambda x: key(*x)):
            s = seqs[d]
            for p in range(len(s) - size + 1):
                run = tuple(x for _, x in s[p:p + size])
                if size == 1 and len(words(run[0])) < long_words and min_lines > 1:
                    continue
                if run in seen:
                    gone[d].update(range(p, p + size))
                seen.add(run)
    out = {}
    for (d, t), s in seqs.items():
        dead = gone[d, t]
        if not dead:
            out[d, t] = (t, len(s), 0)
            continue
        raw = t.split("\n")
        drop = {s[p][0] for p in dead}
        for p in dead:
            if p + 1 in dead:
                drop.update(range(s[p][0], s[p + 1][0]))
        out[d, t] = ("\n".join(x for i, x in enumerate(raw) if i not in drop), len(s), len(dead))
    return out


def shingles(t, k=4):
    w = words((t or "").translate(str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def components(docs, percent=85):
    """docs: (id, text). [(id, size, component)] in order."""
    sets = [shingles(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(range(len(docs)), 2):
        if sets[a] and sets[b] and find(a) != find(b):
            i = len(sets[a] & sets[b])
            if 100 * i >= percent * (len(sets[a]) + len(sets[b]) - i):
                root[find(a)] = find(b)
    least = {}
    for k, (d, _) in enumerate(docs):
        if d is not None:
            least[find(k)] = min(d, least.get(find(k), d))
    return [(d, len(sets[k]), least.get(find(k)) if sets[k] else d) for k, (d, _) in enumerate(docs)]


def plain_words(t):
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", (t or "").translate(
        str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})))


def coverage(doc, item, least=5):
    """Greedy string tiling by its definition: search the longest unmarked common run again and again."""
    d, t = plain_words(doc), plain_words(item)
    md, mt = [False] * len(d), [False] * len(t)
    while True:
        best = (least - 1, 0, 0)
        for j in range(len(t)):
            for i in range(len(d)):
                n = 0
                while i + n < len(d) and j + n < len(t) and d[i + n] == t[j + n] and not md[i + n] and not mt[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return sum(mt) / len(t) if t else 0.0
        md[i:i + n] = mt[j:j + n] = [True] * n


def sha(x):
    return hashlib.sha256(x).hexdigest()
