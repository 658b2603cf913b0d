"""Multi-query ranking: shared sets, scores against a plain version, hard cases, the registered query."""
import math
import re
from collections import Counter

import pytest

from wattgrid.llm import ranked_search as R
from wattgrid.llm.words import slices

DOCS = "doc_id long, text string, score long, _terms string"
ITEMS = "item_id long, text string, rank string"


def terms(text):
    t = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", t)


def brute(docs, items, k=50):
    words = [(i, Counter(terms(t))) for i, t in docs]
    words = [(i, c) for i, c in words if c]
    n, total = len(words), sum(sum(c.values()) for _, c in words)
    df = Counter(t for _, c in words for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, ts in asked.items():
        found = []
        for i, c in words:
            m = 100 - 50 + (50 * sum(c.values()) * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m)) for t in ts if t in c)
            if s > 0:
                found.append((-s, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


def got(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=str)


def test_slices_are_whole_words(monkeypatch):
    import wattgrid.llm.words as words
    text = "Ab9 É-x\x00ſK_　 end" * 50
    whole = terms(text)
    monkeypatch.setattr(words, "SLICE", 7)
    assert [w.decode() for s in slices(text.encode()) for w in s] == whole


def test_shared_sets_cover_items_once():
    items = [[0, 1, 2, 3], [0, 1, 2, 4], [0, 1, 2, 3, 5], [6], [2, 3, 7], [0, 1, 2, 3], []]
    nodes, operands = R.shared_sets(items, 8)

    def leaves(o):
        return [o] if o < 8 else leaves(nodes[o - 8][0]) + leaves(nodes[o - 8][1])
    assert [sorted(x for o in ops for x in leaves(o)) for ops in operands] == [sorted(i) for i in items]
    assert all(max(a, b) < 8 + j for j, (a, b) in enumerate(nodes))
    used = Counter(o for ops in operands for o in ops) + Counter(o for n in nodes for o in n)
    assert all(used[8 + j] >= 2 for j, _ in enumerate(nodes) if any(8 + j in ops for ops in operands))
    # fewer additions than term by term
    assert len(nodes) + sum(len(o) for o in operands) < sum(len(i) for i in items)


def test_equals_brute_force_in_blocks_and_batches(spark, monkeypatch):
    import random
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(60)] + ["É", "ſ", "straße", "9", "K"]
    docs = [(i, " ".join(rng.choices(vocab, weights=range(65, 0, -1), k=rng.randint(0, 40)))) for i in range(300)]
    docs += [(i, "w1 W1 w2.w3") for i in range(400, 480)]  # copies: ties by id
    docs += [(401, "w1 W1 w2.w3"), (None, "w1 W1 w2.w3"), (500, None), (501, ""), (502, "?! --"), (503, "w5 " * 5000 + "é")]
    items = [(i, " ".join(rng.sample(vocab, rng.randint(1, 12)))) for i in range(40)]
    items += [(5, "w1 w2 extra"), (50, None), (51, "!?"), (52, "absent"), (None, "w1 W2"), (53, " ".join(vocab)), (53, " ".join(vocab))]
    want = brute(docs, items, 7)
    d = spark.createDataFrame([(*r, 0, "x") for r in docs], DOCS).repartition(5)
    q = spark.createDataFrame([(*r, "x") for r in items], ITEMS)
    assert got(R.search(d, q, 7)) == want
    monkeypatch.setattr(R, "BLOCK_ITEMS", 9)  # blocks are made on the driver
    assert got(R.search(d, q, 7)) == want


def test_lengths_beyond_64_bits():
    import numpy as np
    n, total = 10 ** 12, 10 ** 15
    lengths = np.array([10 ** 9, 3], np.int64)
    assert R.saturation(lengths, n, total).tolist() == [50 + 50 * v * n // total for v in lengths.tolist()]


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a", 0, "")], DOCS)
    q = spark.createDataFrame([(1, "a", "")], ITEMS)
    assert R.search(d.limit(0), q).count() == 0 and R.search(d, q.limit(0)).count() == 0
    assert R.search(d.withColumn("text", R.F.lit(None).cast("string")), q).count() == 0


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_registered_query_equals_its_sql(spark, sf):
    import duckdb
    path = f"/root/testdata/{sf}"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}/{t}.parquet')")
    want = con.execute(f"SELECT item_id, rank, doc_id, score FROM ({R.ORACLE_SQL})").fetchall()
    assert got(R.op11_ranked_search(spark, path)) == sorted(want, key=str)
