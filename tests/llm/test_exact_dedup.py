"""Exact dedup against brute force, with every hard case of its contract."""
import hashlib
import random
import re

import pytest

from wattgrid.llm import exact_dedup as X
from wattgrid.llm.common import IDENTITY

SCHEMA = "doc_id long, text string, TEXT string, _row string"


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]", "", t or "")


def brute(rows):
    """Per (doc_id, text): keep_id, group_size, how many rows are kept."""
    groups = {}
    for r in rows:
        groups.setdefault(norm(r[1]), []).append(r)
    out = []
    for t, g in groups.items():
        best = min(g, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))
        out += [(r[0], best[0], len(g), hashlib.sha256(t.encode()).hexdigest()) for r in g]
    return sorted(out, key=str), len(groups)


def run(spark, rows, **kw):
    r = X.exact_dedup(spark.createDataFrame(rows, SCHEMA), **kw).collect()
    return sorted(((x["_id"], x["_keep_id"], x["_size"], x["_sha"]) for x in r), key=str), sum(x["_kept"] for x in r), r


ROWS = [(1, "a b c"), (2, "abc"), (3, "a\tb\nc "), (4, "abd"), (5, None), (6, ""), (7, " \n"), (None, "abc"), (None, None),
        (8, "é" * 50), (9, "é " * 50), (9, "é " * 50), (10, "x" * 5000), (11, "x " * 5000), (12, "x" * 4999), (13, "abc "), (2, "abc")]
ROWS = [(*r, "clash", "clash") for r in ROWS]


@pytest.mark.parametrize("kw", [{}, {"chunk_bytes": 64}, {"chunk_bytes": 16, "spread_bytes": 40}, {"primes": (7, 11)}, {"chunk_bytes": 8, "primes": (2, 3)}])
def test_equals_brute_force(spark, kw):
    """Chunked, spread over tasks, and with primes so small that fingerprints collide."""
    rows, kept, full = run(spark, ROWS, **kw)
    want, groups = brute(ROWS)
    assert rows == want and kept == groups
    assert all(x["_id"] == x["_keep_id"] for x in full if x["_kept"])


def test_collisions_in_quantity(spark):
    rng = random.Random(5)
    rows = [(i, "".join(rng.choice("ab ") for _ in range(rng.randint(0, 6))), "", "") for i in range(300)]
    rows_out, kept, _ = run(spark, rows, primes=(5, 3))
    want, groups = brute(rows)
    assert rows_out == want and kept == groups


def test_empty_table(spark):
    assert X.exact_dedup(spark.createDataFrame([], SCHEMA)).count() == 0


def test_hashes_combine():
    rng = random.Random(1)
    data = bytes(rng.randrange(256) for _ in range(1000))
    whole = X.fingerprint(data, X._powers(1000))
    for cut in (0, 1, 333, 1000):
        a, b = data[:cut], data[cut:]
        parts = [X.fingerprint(x, X._powers(7)) for x in (a, b)]
        assert X.combine(*parts, len(b)) == whole
    by_hand = tuple(sum((x + 1) * pow(b, len(data) - 1 - i, p) for i, x in enumerate(data)) % p for b, p in zip(X.BASES, X.PRIMES))
    assert whole == by_hand


def test_stage_keeps_columns_and_one_of_repeats(spark):
    df = spark.createDataFrame([(r[0], r[1], "en", "s") for r in ROWS], "doc_id long, text string, _x string, Doc_ID string")
    out = X.stage(spark, df, "")
    assert out.columns == df.columns
    out = out.toDF("doc_id", "text", "a", "b")
    got = [norm(r["text"]) for r in out.collect()]
    assert len(got) == len(set(got)) == brute(ROWS)[1]
    assert IDENTITY == ["_id", "_x", "_n"]
