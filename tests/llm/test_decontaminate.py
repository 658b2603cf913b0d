"""Suffix arrays: order and search against plain versions, planted passages, cuts, hard cases."""
import hashlib
import random
import re

import numpy as np

from wattgrid.llm import decontaminate as D

DOCS = "doc_id long, text string, n_hit long, _id string, item string"
ITEMS = "item_id long, text string, _x string"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(docs, items, window=10):
    wins = {}
    for i, t in items:
        w = words(t)
        if i is not None and w:
            k = min(window, len(w))
            for at in range(len(w) - k + 1):
                wins.setdefault(tuple(w[at:at + k]), set()).add(str(i))
    sizes = {len(w) for w in wins}
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for k in sizes:
            for at in range(len(w) - k + 1):
                if tuple(w[at:at + k]) in wins:
                    hit.update(range(at, at + k))
                    found |= wins[tuple(w[at:at + k])]
        out.append((i, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


def brute_longest(docs, items, window=10):
    best = {}
    for i, t in items:
        q = words(t)
        for at in range(len(q) - min(window, len(q)) + 1 if q and i is not None else 0):
            for d, text in docs:
                w = words(text)
                for p in range(len(w)):
                    n = 0
                    while at + n < len(q) and p + n < len(w) and q[at + n] == w[p + n]:
                        n += 1
                    if n >= min(window, len(q)):
                        key = (-n, d is None, d or 0, p)
                        best[str(i), at] = min(best.get((str(i), at), key), key)
    return sorted((i, at, -k[0], None if k[1] else k[2], k[3]) for (i, at), k in best.items())


def got(found):
    return sorted(((r["_id"], r["n_words"], r["n_hit"], r["items"]) for r in D.documents(found).collect()), key=str)


def got_longest(found):
    return sorted(((r["item"], r["position"], r["length"], r["doc_id"], r["place"]) for r in D.matches(found).collect()), key=str)


def test_suffix_array_is_sorted():
    rng = np.random.default_rng(0)
    for size, top, bits, width in ((2000, 3, 2, 31), (500, 2, 21, 3), (3000, 50, 7, 9), (0, 2, 2, 31), (40, 1, 21, 1)):
        numbers = rng.integers(0, top + 1, size).astype(np.int32)
        numbers[size // 4:size // 2] = numbers[size // 2:size // 2 + size // 2 - size // 4]  # a long repeat
        for shortest in (1, 4):
            a = D.suffix_array(numbers, shortest, bits, width)
            runs = [m.span() for m in re.finditer(r"[^\x00]+", "".join(map(chr, numbers.tolist()))) if m.end() - m.start() >= shortest]
            want = sorted(tuple(numbers[p:e].tolist()) for s, e in runs for p in range(s, e))
            have = []
            for p in a.order.tolist():
                e = p
                while a.text[e]:
                    e += 1
                have.append(tuple(a.text[p:e].tolist()))
                assert a.text[p] == numbers[a.source[p]]
            assert have == want


def sample(seed=1):
    rng = random.Random(seed)
    vocab = [f"v{i}" for i in range(12)] + ["É", "ß9"]
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice((3, 8, 15, 30))))) for i in range(25)]
    items += [(3, items[3][1]), (3, items[9][1]), (100, items[7][1]), (101, None), (102, "?!"), (None, items[4][1]), (103, "A lone")]
    docs = []
    for i in range(120):
        w = rng.choices(vocab + ["other"], k=rng.randint(0, 60))
        if i % 3 == 0:
            p = words(items[rng.randrange(25)][1])
            a = rng.randrange(len(p))
            w[len(w) // 2:len(w) // 2] = p[a:a + rng.randint(1, 30)]
        docs.append((i, rng.choice((" ", ", ", "\n")).join(w).upper().replace("É", "É") if i % 2 else " ".join(w)))
    hot = "intro " + items[2][1] + " middle " + items[9][1]
    docs += [(200 + i, hot) for i in range(60)] + [(200, hot), (None, hot), (300, None), (301, ""), (302, " .. "), (303, "x y " * 3000 + items[8][1])]
    return docs, items


def test_equals_brute_force(spark):
    docs, items = sample()
    d = spark.createDataFrame([(*r, 0, "x", "y") for r in docs], DOCS).repartition(3)
    q = spark.createDataFrame([(*r, "x") for r in items], ITEMS)
    want, longest = brute(docs, items), sorted(brute_longest(docs, items), key=str)
    assert sum(r[2] > 0 for r in want) > 60 and any(r[2] == 0 for r in want)
    for shard in (D.SHARD, 50):  # small shards cut documents into overlapping pieces
        found = D.scan(d, q, shard_words=shard)
        assert got(found) == want
        assert got_longest(found) == longest
    spans = {r["_id"]: [(s["start"], s["end"]) for s in r["spans"]] for r in D.documents(found).collect()}
    assert all(sum(e - s for s, e in spans[i]) == n for i, _, n, _ in want if i is not None)


def test_blocks_of_items(spark, tmp_path):
    """Items read in several blocks give what one block gives."""
    docs, items = sample(2)
    q = spark.createDataFrame([(str(i), t) for i, t in items if i is not None and t is not None], "_item string, _text string").distinct()
    q.selectExpr("_item", "CAST(_text AS BINARY) AS _text").coalesce(1).write.parquet(str(tmp_path / "items"))
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    schema = to_arrow_schema(StructType.fromDDL("_id long, " + D.SCANNED))
    texts = [t.encode() if t else b"" for _, t in docs]
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in docs], pa.int64()), pa.array(range(len(docs)), pa.int64()),
                                        pa.array([len(t) for t in texts], pa.int64()), pa.array(texts, pa.binary())], names=["_id", "_x", "_n", "_text"])
    results = []
    for size in (1 << 20, 20):
        old, D.BLOCK = D.BLOCK, size
        D.held(("none",), object)
        try:
            rows = [r for b in D._scan(str(tmp_path / "items"), 10, 100, schema)(iter([batch])) for r in b.to_pylist()]
        finally:
            D.BLOCK = old
        results.append((sorted(((r["_id"], r["n_words"], r["n_hit"], r["items"], str(r["spans"])) for r in rows if not r["_match"]), key=str),
                        {(r["item"], r["position"], r["length"]) for r in rows if r["_match"]}))
    assert results[0] == results[1]
    assert [(a, b, c, d) for a, b, c, d, _ in results[0][0]] == brute(docs, items)


def test_removal_and_empty_tables(spark):
    docs, items = sample()
    d = spark.createDataFrame([(*r, 0, "x", "y") for r in docs], DOCS)
    q = spark.createDataFrame([(*r, "x") for r in items], ITEMS)
    kept = D.decontaminate(d, q)
    assert kept.columns == d.columns
    want = sorted((str(i) for i, _, n, _ in brute(docs, items) if n == 0))
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == want
    assert D.decontaminate(d.limit(0), q).count() == 0
    assert D.decontaminate(d, q.limit(0)).count() == len(docs)


def test_registered_query_equals_brute_force(spark):
    path = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{path}/benchmark.parquet").collect()]
    want = sorted((i, n, h, len(f), hashlib.sha256(",".join(f).encode()).hexdigest(), h > 0) for i, n, h, f in brute(docs, items))
    have = sorted(tuple(r[c] for c in ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")) for r in D.op12_suffix_arrays(spark, path).collect())
    assert have == want and any(r[5] for r in have)
