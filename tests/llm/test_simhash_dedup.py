"""SimHash near-dedup against brute force over all pairs."""
import random

import pytest
import xxhash

from wattgrid.llm import simhash_dedup as S
from wattgrid.llm.common import components

SCHEMA = "doc_id long, text string, _fp string, a string"


def fingerprint(text):
    import re
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    k = min(4, len(words))
    h = [xxhash.xxh64(" ".join(words[i:i + k]).encode(), seed=42).intdigest() for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def label(ids, fps, bits):
    """Smallest id reachable from each row."""
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                parent[find(i)] = find(j)
    low = {}
    for i, d in enumerate(ids):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return [low.get(find(i)) for i in range(len(fps))]


def corpus():
    rng = random.Random(3)
    words = ["alpha", "Beta", "GAMMA", "delta", "É", "ñu", "x"]
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two three"), (None, "one"), (None, "lonely text without a name"), (6, "one two three")]
    base = [" ".join(rng.choice(words) + str(rng.randrange(99)) for _ in range(200)) for _ in range(6)]
    for i in range(60):
        w = rng.choice(base).split()
        for _ in range(rng.randrange(0, 6)):
            w[rng.randrange(len(w))] = "changed" + str(rng.randrange(1000))
        rows.append((100 + i, rng.choice([" ", "\n", "  "]).join(w)))
    return [(*r, "clash", "clash") for r in rows]


def test_equals_brute_force(spark):
    rows = corpus()
    r = S.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    fps = [fingerprint(t) for _, t, *_ in rows]
    want = sorted(zip([r[0] for r in rows], fps, label([r[0] for r in rows], fps, 4)), key=str)
    got = sorted(((x["_id"], x["_fp"] % (1 << 64), x["_component"]) for x in r), key=str)
    assert got == want and len({c for *_, c in want}) < len(rows) - 5


@pytest.mark.parametrize("bits,depth", [(4, 2), (4, 3), (3, 2), (7, 3), (1, 2)])
def test_links_are_all_pairs(spark, bits, depth):
    rng = random.Random(bits * 10 + depth)
    fps = {0, (1 << 64) - 1}
    while len(fps) < 120:
        x = rng.getrandbits(64)
        fps.add(x)
        for _ in range(3):
            y = x
            for b in rng.sample(range(64), rng.randrange(1, bits + 3)):
                y ^= 1 << b
            fps.add(y)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    got = [tuple(sorted((r["a"], r["b"]))) for r in S.links(spark.createDataFrame([(x,) for x in signed], "_fp long"), bits, depth).collect()]
    want = {tuple(sorted((x, y))) for x in signed for y in signed if x < y and bin((x ^ y) & (1 << 64) - 1).count("1") <= bits}
    assert len(got) == len(set(got)) and set(got) == want and want


def test_depth_follows_size():
    assert S.chain_depth(1000) == 2 and S.chain_depth(10**9) == 3


def test_components_of_chain_star_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(500, 500), (7, 3), (3, 7)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_empty_and_stage(spark):
    assert S.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = corpus()
    out = S.stage(spark, spark.createDataFrame(rows, SCHEMA), "")
    assert out.columns == ["doc_id", "text", "_fp", "a"]
    fps = [fingerprint(r[1]) for r in rows]
    comp = label(list(range(len(rows))), fps, 4)
    assert out.count() == len(set(comp))
