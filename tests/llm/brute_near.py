"""Near-duplicate groups by comparing all pairs."""

import re


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def components(docs, percent=85):
    """{doc_id: text} -> {doc_id: smallest id of its group}."""
    sets = {d: shingles(t) for d, t in docs.items()}
    group = {d: d for d in docs}

    def find(d):
        while group[d] != d:
            d = group[d]
        return d

    ids = sorted(docs)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and min(len(x), len(y)) * 100 >= percent * max(len(x), len(y)):
                shared = len(x & y)
                if 100 * shared >= percent * (len(x) + len(y) - shared):
                    one, other = find(a), find(b)
                    group[max(one, other)] = min(one, other)
    return {d: find(d) for d in ids}
