"""Plain versions of the operators, for small fixtures."""

import hashlib
from collections import Counter, defaultdict

DOCS = "doc_id long, text string, source string, kept string, n int, at int"


def docs_frame(spark, rows):
    """doc_id and text beside extra columns whose names clash with results."""
    return spark.createDataFrame([(i, t, "s", "x", 1, 2) for i, t in rows], DOCS)


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text, n):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def near_duplicates(rows, n, percent):
    sets = {i: shingles(t, n) for i, t in rows if i is not None}
    lists = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            lists[g].append(i)
    links = []
    for i, s in sets.items():
        hits = Counter(j for g in s for j in lists[g] if j < i)
        links += [(i, j) for j, c in hits.items() if 100 * c >= percent * (len(s) + len(sets[j]) - c)]
    root = components(sets, links)
    return {i: (len(sets[i]), root[i], root[i] == i) for i in sets}


def removed_words(rows, window=20):
    """Per document its words and which of them go."""
    seen, out = set(), {}
    for i, t in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0)):
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            key = tuple(w[k:k + window])
            if key in seen:
                gone[k:k + window] = [True] * window
            seen.add(key)
        out[i] = (w, gone)
    return out


def substring_digest(rows):
    return {i: (len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest())
            for i, (w, gone) in removed_words(rows).items()}
