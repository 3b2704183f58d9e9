"""Plain versions of the operators, for comparison."""

import re
from collections import defaultdict

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text, words):
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(found) < words:
        return frozenset([tuple(found)] if found else [])
    return frozenset(tuple(found[i : i + words]) for i in range(len(found) - words + 1))


def near_brute(rows, words, percent):
    """doc_id -> (number of shingles, smallest id reachable); ids must not repeat."""
    sets = [shingles(r[1], words) for r in rows]
    owners = defaultdict(list)
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, own in enumerate(sets):
        common = defaultdict(int)
        for s in own:
            for j in owners[s]:
                common[j] += 1
            owners[s].append(i)
        for j, n in common.items():
            if 100 * n >= percent * (len(own) + len(sets[j]) - n):
                parent[root(i)] = root(j)
    smallest = {}
    for i, r in enumerate(rows):
        smallest[root(i)] = min(smallest.get(root(i), r[0]), r[0])
    return {r[0]: (len(sets[i]), smallest[root(i)]) for i, r in enumerate(rows)}
