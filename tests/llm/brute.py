"""Plain versions of the operators, for small inputs."""

import re
from collections import defaultdict

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def fold(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def shingle_set(text, size):
    w = SPACE.findall(fold(text))
    return {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def jaccard(rows, size, percent):
    """rows: (id, text). Per row: (id, n, component, links), as the operator's docstring says."""
    sets = [shingle_set(t, size) for _, t in rows]
    top, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                top[find(i)] = find(j)
    ids = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            ids[find(i)].append(d)
    return [(d, len(sets[i]), min(ids[find(i)], default=None), links[i]) for i, (d, _) in enumerate(rows)]
