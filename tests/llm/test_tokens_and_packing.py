"""Token ids, records and packing against the tokenizers library and by invariants."""
import hashlib
import random
import sys
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wattgrid.llm import packing as P
from wattgrid.llm import token_records as T
from wattgrid.llm.bpe_prefix import Bpe, SuffixAutomaton, decode, encode, op5_bpe_prefix
from wattgrid.llm.common import scratch
from wattgrid.llm.tokens import Encoder, tokenizer_path

PARTS = ["a", "b", "'s", " ", "\n", "  ", "\t", "1", "É", "ç", "!", ".", ",", "\x1c", "\x85", "'ll", "日本", "🙂", "<|endoftext|>", "\r\n", "x", "word", "İ", "ΑΣ", "é", "<|startoftext|>"]
SCHEMA = "doc_id long, text string, start string, _rank string"
ROWS = [(3, "a b"), (1, None), (2, ""), (5, "word " * 3000 + "end"), (4, " \n\n x  "), (None, "no id"), (7, "<|endoftext|> x"), (8, "b a"), (8, "b a"), (9, "z" * 9000)]
ROWS = [(*r, "clash", "clash") for r in ROWS]


def texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 12))) for _ in range(n)]


def test_encoder_equals_library():
    e, lib = Encoder(most=50), Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    for t in texts(3000, 1) + [r[1] or "" for r in ROWS]:
        assert e.ids(t) == np.array(lib.encode(t, add_special_tokens=False).ids, "<u4").tobytes(), t


def test_encoder_slices_long_texts(monkeypatch):
    from wattgrid.llm import tokens
    monkeypatch.setattr(tokens, "SLICE", 40)
    e = Encoder()
    for t in (" ".join(texts(60, 3)), "plain words and more " * 30 + "end", "x" * 200):
        assert e.ids(t) == e.whole(t)


def test_prefix_bpe_equals_library():
    b, lib = Bpe(), Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    rng = random.Random(4)
    some = texts(3000, 2) + ["".join(rng.choice("aeinorst") for _ in range(rng.randint(1, 30))) for _ in range(2000)] + ["a" * 500, "the" * 200]
    for t in some:
        ids = lib.encode(t, add_special_tokens=False).ids
        got = b.encode(t)
        assert got == np.array(ids, "<u4").tobytes(), t
        assert b.decode(got) == lib.decode(ids, skip_special_tokens=False)
        assert " ".join(s for i, s in b.pieces(t) if i) == b.decode(got)


def test_prefix_bpe_on_every_code_point():
    b, lib = Bpe(), Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    points = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    rng = random.Random(7)
    some = ["a" + c for c in points] + ["".join(rng.choices(points[:0x3000], k=rng.randint(2, 6))) for _ in range(20_000)]
    some += ["a" + x + y for x in "\u0898\u06df\u05c2\u08d0\u0301\u0327" for y in "\u0898\u06df\u05c2\u08d0\u0301\u0327"]
    for t, want in zip(some, lib.encode_batch(some, add_special_tokens=False)):
        assert b.encode(t) == np.array(want.ids, "<u4").tobytes(), ascii(t)


def calls(fn):
    """How many Python functions ``fn`` enters; a generator's every step is one."""
    seen = []
    sys.setprofile(lambda frame, event, arg: seen.append(event == "call"))
    try:
        fn()
    finally:
        sys.setprofile(None)
    return sum(seen)


def test_known_parts_and_symbols_take_no_python_call_each():
    from wattgrid.llm import bpe_prefix
    b = bpe_prefix.bpe()
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["so many words again " * 1000])], names=["_id", "_text"])
    run = lambda: list(bpe_prefix._digests(bpe_prefix.WORD_BPE)(iter([batch])))
    run()
    assert calls(run) < 200
    word = "antidisestablishmentarianism" * 4
    b.word(word)
    assert calls(lambda: b.word(word)) < 10


@pytest.mark.parametrize("seed", range(20))
def test_suffix_automaton_finds_every_match(seed):
    rng = random.Random(seed)
    words = {"".join(rng.choices("abc", k=rng.randint(1, 6))): i for i in range(25)}
    text = "".join(rng.choices("abcd", k=200))
    want = [sorted(((len(w), i) for w, i in words.items() if text[:at].endswith(w)), reverse=True) for at in range(1, len(text) + 1)]
    assert list(SuffixAutomaton(words).matches(text)) == want


def test_registered_bpe_query_equals_library(spark, tmp_path, monkeypatch):
    from wattgrid.llm import bpe_prefix
    monkeypatch.setattr(bpe_prefix, "SLICE", 64)
    lib = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    rows = [(i, t) for i, t in enumerate([*texts(60, 9), None, "", "\u1c89x \ua7cb", "word " * 400])]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in op5_bpe_prefix(spark, str(tmp_path)).collect()}
    for i, t in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()
        assert got[i] == (len(ids), *want), t


def test_prefix_bpe_on_tables(spark):
    lib = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    df = spark.createDataFrame(ROWS, SCHEMA)
    enc = encode(df)
    got = sorted(((r["_id"], bytes(r["ids"])) for r in enc.collect()), key=str)
    want = [(r[0], lib.encode(r[1] or "", add_special_tokens=False).ids) for r in ROWS]
    assert got == sorted(((i, np.array(x, "<u4").tobytes()) for i, x in want), key=str)
    assert sorted(r["text"] for r in decode(enc).collect()) == sorted(lib.decode(x, skip_special_tokens=False) for _, x in want)
    assert encode(spark.createDataFrame([], SCHEMA)).count() == 0


def test_records_round_trip(spark):
    e = Encoder()
    folder = scratch(spark, "test-records")
    m = T.write_records(spark.createDataFrame(ROWS, SCHEMA), folder)
    want = sorted(((r[0], e.whole(r[1] or "") + b"\0\0\0\0") for r in ROWS), key=str)
    in_order = T.read_records(m, folder).orderBy("shard", "record").collect()
    assert sorted(((r["doc_id"], bytes(r["ids"])) for r in in_order), key=str) == want
    ids = [r["doc_id"] for r in in_order]
    assert ids[0] is None and ids[1:] == sorted(ids[1:])
    assert sorted(((r["doc_id"], bytes(r["ids"])) for r in T.read_shuffled(m, folder, 5).collect()), key=str) == want
    assert T.read_index(m, folder).count() == len(ROWS)
    empty = scratch(spark, "test-records")
    assert T.read_records(T.write_records(spark.createDataFrame([], SCHEMA), empty), empty).count() == 0


def test_records_show_damage():
    import io
    ids = np.array([1, 70000, 3], "<u4").tobytes()
    data = T.MARK + T.pack(5, ids) + T.pack(None, b"")
    assert [T.unpack(b)[0] for _, b in T.records(io.BytesIO(data), "f")] == [5, None]
    assert T.unpack(next(T.records(io.BytesIO(data), "f"))[1])[1].tobytes() == ids
    for at in range(len(T.MARK), len(data)):
        broken = bytearray(data)
        broken[at] ^= 4
        with pytest.raises(ValueError):
            list(T.records(io.BytesIO(bytes(broken)), "f"))
    with pytest.raises(ValueError):
        list(T.records(io.BytesIO(data[:-3]), "f"))


@pytest.mark.parametrize("kind", ["uniform", "log", "small", "big", "same", "none", "third"])
def test_plan_uses_every_item_once(kind):
    rng = np.random.default_rng(len(kind))
    lengths = {"uniform": rng.integers(1, 2049, 3000), "log": np.clip(rng.lognormal(6, 1, 5000).astype(int), 1, 2048), "small": rng.integers(1, 40, 2000),
               "big": rng.integers(1000, 2049, 500), "same": np.full(1000, 700), "none": np.zeros(0, int),
               "third": np.concatenate((np.full(3000, 1365), rng.integers(1, 2049, 3000)))}[kind]
    counts = np.bincount(lengths, minlength=2049)
    plan = P.plan(counts)
    used = np.zeros(2049, int)
    for pattern, n in plan:
        assert n > 0 and sum(pattern) <= 2048
        for x in pattern:
            used[x] += n
    assert (used == counts).all()
    assert sum(n for _, n in plan) <= sum(n for _, n in P.best_fit_plan(counts.copy(), 2048))
    if kind in ("log", "small"):
        assert sum(n for _, n in plan) <= -(-lengths.sum() // 2048) + 2
    rows = P.places(plan)
    assert len(rows) < 20_000
    for length in set(lengths.tolist()):
        spans = sorted((lo, hi) for x, lo, hi, *_ in rows if x == length)
        assert spans[0][0] == 0 and spans[-1][1] == counts[length] and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


def test_exact_complements_are_exact():
    counts = np.zeros(2049, int)
    for x in (1500, 548, 1000, 700, 348, 900, 500, 400, 248):
        counts[x] += 1
    left = counts.copy()
    plan = P.exact_plan(left, 2048)
    assert all(sum(p) == 2048 for p, _ in plan) and len(plan) == 3 and not left.any()


def test_pack_table(spark):
    e = Encoder()
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = P.pack(df).collect()
    ids = {(r[0], r[1]): e.whole(r[1] or "") + b"\0\0\0\0" for r in ROWS}
    by_id = {}
    for (i, _), x in ids.items():
        by_id.setdefault(i, []).append(x)
    pieces = {}
    for r in got:
        x = by_id[r["_id"]][0]
        assert zlib.crc32(x[4 * r["start"]:4 * (r["start"] + r["length"])]) == r["ids_crc32"] and 0 < r["length"] <= 2048
        pieces.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for p in pieces.values():
        p.sort()
        assert [o for o, _ in p] == [sum(n for _, n in p[:k]) for k in range(len(p))] and sum(n for _, n in p) <= 2048
    total = sum(len(e.whole(r[1] or "")) // 4 + 1 for r in ROWS)
    assert sum(r["length"] for r in got) == total and len(pieces) <= -(-total // 2048) + 1
    for i in (5, 9):
        sizes = [r["length"] for r in sorted((r for r in got if r["_id"] == i), key=lambda r: r["piece"])]
        assert all(s == 2048 for s in sizes[1:])
    assert P.pack(spark.createDataFrame([], SCHEMA)).count() == 0


def test_one_task_a_shard(spark):
    """Shards are dealt evenly, whatever their numbers hash to."""
    manifest = spark.range(40).select(F.col("id").cast("int").alias("shard"), F.lit(7).alias("tokens"))
    per = T._shards(manifest).groupBy(F.spark_partition_id()).count().select("count").collect()
    assert [r["count"] for r in per] == [1] * 40
    assert T._shards(manifest.limit(0)).count() == 0
