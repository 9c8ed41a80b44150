"""Plain Python forms of the operators that the tests compare with."""

import re

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text, n=5):
    w = words((text or "").translate(LOW))
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def near_groups(docs, percent=75):
    """{doc_id: (set size, component)} of {doc_id: text}."""
    sets = {i: shingles(t) for i, t in docs.items()}
    parent = {i: i for i in docs}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(docs)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = root(a), root(b)
                parent[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), root(i)) for i in ids}


def targets(sizes, weights=(5, 2, 1), share=1.5, repeat=2):
    """{source: target} of {source: size}; None is the last source."""
    order = sorted(s for s in sizes if s is not None) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full = set()
    while True:
        left = share * sum(sizes.values()) - sum(repeat * sizes[s] for s in full)
        open_ = [s for s in order if s not in full]
        goal = {s: repeat * sizes[s] for s in full} | {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        over = {s for s in open_ if goal[s] > repeat * sizes[s]}
        if not over:
            return goal
        full |= over
