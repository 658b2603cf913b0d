"""Plain versions of the filtering stages, over a dictionary of texts by id."""
import re

import xxhash


def exact_keep(texts):
    groups = {}
    for i, t in texts.items():
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i))
    return {min(g)[1] for g in groups.values()}


def simhash(t):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
    if not words:
        return 0
    k = min(4, len(words))
    h = [xxhash.xxh64(b" ".join(words[i:i + k]), seed=42).intdigest() for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def near_keep(texts):
    ids = sorted(texts)
    fps = [simhash(texts[i]) for i in ids]
    group = list(range(len(ids)))
    changed = True
    while changed:
        changed = False
        for i in range(len(ids)):
            for j in range(i):
                if group[i] != group[j] and (fps[i] ^ fps[j]).bit_count() <= 4:
                    low = min(group[i], group[j])
                    old = max(group[i], group[j])
                    group = [low if g == old else g for g in group]
                    changed = True
    return {ids[g] for g in set(group)}
