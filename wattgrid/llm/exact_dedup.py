"""Exact duplicates by composable polynomial fingerprints.

A text's fingerprint is a polynomial of its normalised bytes modulo two primes. Hashes of
parts combine, ``H(a + b) = H(a) * B**len(b) + H(b)``, so a text is hashed in chunks of
bounded size and a huge one by many tasks at once. Texts with equal length and
fingerprint are then compared with their group's first text, chunk by chunk;
texts that differ after all (a collision) form further groups.

Groups are formed by aggregates and joins only, never by gathering a group: a text
that is a third of all rows costs each task its share. Defined results: NULL text
counts as empty; NULL ids sort last; of repeats of one row exactly one is kept;
an empty table gives no rows; other columns are not read.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import IDENTITY, keep_rows, same, table, text_rows, written

# Two primes below 2**31 (products of a byte and a power stay in
# 64 bits) and the bases of the polynomials.
PRIMES = (2147483647, 2147483629)
BASES = (911382323, 972663749)
WHITE = b" \t\n\x0b\x0c\r"
CHUNK_BYTES = 1 << 16
SPREAD_BYTES = 32 << 20


def _powers(n: int, primes: tuple[int, int] = PRIMES) -> list[np.ndarray]:
    """Powers ``B**(n-1) ... B**0`` of each base, by doubling."""
    out = []
    for p, b in zip(primes, BASES):
        pw = np.ones(1, np.int64)
        while len(pw) < n:
            step = pow(b, len(pw), p)
            pw = np.concatenate((pw, pw * step % p))
        out.append(pw[:n][::-1].copy())
    return out


def chunk_hashes(data: bytes, powers: list[np.ndarray], primes: tuple[int, int] = PRIMES) -> tuple[int, int]:
    """Both hashes of one chunk (at most as long as the powers); bytes count from 1."""
    a = np.frombuffer(data, np.uint8).astype(np.int64) + 1
    return tuple(int(a @ pw[len(pw) - len(a):]) % p for pw, p in zip(powers, primes))


def combine(left: tuple[int, int], right: tuple[int, int], right_len: int, primes: tuple[int, int] = PRIMES) -> tuple[int, int]:
    """Hashes of a concatenation from the hashes of its parts."""
    return tuple((x * pow(b, right_len, p) + y) % p for x, y, b, p in zip(left, right, BASES, primes))


def fingerprint(data: bytes, powers: list[np.ndarray], primes: tuple[int, int] = PRIMES) -> tuple[int, int]:
    size, h = len(powers[0]), (0, 0)
    for i in range(0, len(data), size):
        part = data[i:i + size]
        h = combine(h, chunk_hashes(part, powers, primes), len(part), primes)
    return h


def _whole(size: int, primes: tuple[int, int]):
    """Arrow function: fingerprint and SHA-256 of each whole normalised text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = _powers(size, primes)
        for b in batches:
            norm = [t.as_py().translate(None, WHITE) for t in b.column("_text")]
            fp = [fingerprint(t, powers, primes) for t in norm]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in (*IDENTITY, "_cp")), pa.array([len(t) for t in norm], pa.int64()),
                 pa.array([x[0] for x in fp], pa.int64()), pa.array([x[1] for x in fp], pa.int64()),
                 pa.array([hashlib.sha256(t).hexdigest() for t in norm], pa.string())],
                names=[*IDENTITY, "_cp", "_len", "_h1", "_h2", "_sha"])
    return run


def _parts(size: int, primes: tuple[int, int]):
    """Arrow function: hashes of chunk rows of huge texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = _powers(size, primes)
        for b in batches:
            norm = [t.as_py().translate(None, WHITE) for t in b.column("_part")]
            fp = [fingerprint(t, powers, primes) for t in norm]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in (*IDENTITY, "_no")), pa.array([len(t) for t in norm], pa.int64()),
                 pa.array([x[0] for x in fp], pa.int64()), pa.array([x[1] for x in fp], pa.int64())],
                names=[*IDENTITY, "_no", "_len", "_h1", "_h2"])
    return run


def _combined(primes: tuple[int, int]):
    """Arrow function: combine the ordered chunk hashes of each huge text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for parts in b.column("_parts").to_pylist():
                h, n = (0, 0), 0
                for p in sorted(parts, key=lambda p: p["_no"]):
                    h, n = combine(h, (p["_h1"], p["_h2"]), p["_len"], primes), n + p["_len"]
                rows.append((n, *h))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in IDENTITY), *(pa.array([r[i] for r in rows], pa.int64()) for i in range(3))],
                                             names=[*IDENTITY, "_len", "_h1", "_h2"])
    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 chunk_bytes: int = CHUNK_BYTES, spread_bytes: int = SPREAD_BYTES,
                 primes: tuple[int, int] = PRIMES) -> DataFrame:
    """One row per document: identity, code points, normalised length, both hashes, SHA-256.

    Texts over ``spread_bytes`` are cut into pieces of that many chunks' bytes which
    tasks hash side by side; only the hashes of the pieces meet again.
    """
    rows = text_rows(docs, id_col, text_col).withColumn("_cp", F.length("_text").cast("long"))
    id_type = docs.schema[id_col].dataType.simpleString()
    key = f"_id {id_type}, _x long, _n int"
    small = (rows.filter(F.col("_n") <= spread_bytes).withColumn("_text", F.col("_text").cast("binary"))
             .mapInArrow(_whole(chunk_bytes, primes), f"{key}, _cp long, _len long, _h1 long, _h2 long, _sha string"))
    huge = rows.filter(F.col("_n") > spread_bytes)
    if huge.isEmpty():
        return small
    once = huge.dropDuplicates(IDENTITY).withColumn("_text", F.col("_text").cast("binary"))
    step = max(chunk_bytes, spread_bytes // 8)
    pieces = once.select(*IDENTITY, "_text", F.explode(F.sequence(F.lit(0), ((F.col("_n") - 1) / step).cast("int"))).alias("_no"))
    pieces = pieces.select(*IDENTITY, "_no", F.expr(f"substring(_text, _no * {step} + 1, {step})").alias("_part"))
    hashed = (pieces.repartition(F.col("_x"), F.col("_no"))
              .mapInArrow(_parts(chunk_bytes, primes), f"{key}, _no int, _len long, _h1 long, _h2 long"))
    whole = (hashed.groupBy(*IDENTITY).agg(F.collect_list(F.struct("_no", "_len", "_h1", "_h2")).alias("_parts"))
             .mapInArrow(_combined(primes), f"{key}, _len long, _h1 long, _h2 long"))
    sha = huge.select(*IDENTITY, "_cp", F.sha2(F.regexp_replace("_text", r"[\x20\x09-\x0D]+", "").cast("binary"), 256).alias("_sha"))
    joined = sha.join(whole, same(sha, whole, IDENTITY)).select(*[sha[c] for c in (*IDENTITY, "_cp")], "_len", "_h1", "_h2", "_sha")
    return small.unionByName(joined)


FP = ["_len", "_h1", "_h2"]


def _cut(size: int):
    """Arrow function: normalised texts as rows of one chunk each (an empty text: one empty chunk)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = [c for c in b.schema.names if c != "_text"]
            for r in range(b.num_rows):
                t = b.column("_text")[r].as_py().translate(None, WHITE)
                parts = [t[i:i + size] for i in range(0, len(t), size)] or [b""]
                for lo in range(0, len(parts), 256):
                    some = parts[lo:lo + 256]
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array([b.column(c)[r].as_py()] * len(some), b.column(c).type) for c in keep),
                         pa.array(range(lo, lo + len(some)), pa.int32()), pa.array(some, pa.binary())],
                        names=[*keep, "_no", "_part"])
    return run


def _compare(rows: DataFrame, todo: DataFrame, chunk_bytes: int) -> DataFrame:
    """Compare each text of ``todo(identity, fingerprint, _first)`` with its group's first text,
    chunk against chunk; gives the identities whose chunks are not all equal."""
    pick = todo.select(*[F.col(c).alias(f"_t{c}") for c in IDENTITY], *FP, "_first")
    on = (rows["_id"].eqNullSafe(pick["_t_id"])) & (rows["_x"] == pick["_t_x"]) & (rows["_n"] == pick["_t_n"])
    members = rows.join(pick, on).select(*IDENTITY, *FP, "_first", F.col("_text").cast("binary").alias("_text"))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in members.schema.fields if f.name != "_text")
    # written once for both sides of the join below, which so has two shuffles of its own: Spark can split a hot group
    chunks = written(members.mapInArrow(_cut(chunk_bytes), f"{fields}, _no int, _part binary"), "chunks")
    first = written(chunks.filter("_first").groupBy(*FP, "_no").agg(F.first("_part").alias("_ref"))
                    .select(*[F.col(c).alias(f"_r{c}") for c in (*FP, "_no")], "_ref"), "references")
    rest = chunks.filter("NOT _first")
    on = (rest["_len"] == first["_r_len"]) & (rest["_h1"] == first["_r_h1"]) & (rest["_h2"] == first["_r_h2"]) & (rest["_no"] == first["_r_no"])
    return (rest.join(first, on, "left").filter(~F.col("_part").eqNullSafe(F.col("_ref")))
            .select(*IDENTITY).distinct())


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            chunk_bytes: int = CHUNK_BYTES, spread_bytes: int = SPREAD_BYTES,
            primes: tuple[int, int] = PRIMES) -> DataFrame:
    """Written table, one row per document: identity, ``_row``, ``_cp``, ``_sha``, the class
    (fingerprint and ``_round``), proven equal text by text."""
    fp = written(fingerprints(docs, id_col, text_col, chunk_bytes, spread_bytes, primes)
                 .withColumn("_row", F.monotonically_increasing_id()), "fingerprints")
    rows = text_rows(docs, id_col, text_col)
    found = None
    left, turn = fp.select(*IDENTITY, *FP), 0
    while True:
        order = F.struct(F.col("_id").isNull(), F.col("_id"), F.col("_x"), F.col("_n"))
        groups = (left.groupBy(*FP).agg(F.count(F.lit(1)).alias("_m"), F.min(order).alias("_low"), F.max(order).alias("_high"))
                  .filter("_m > 1 AND _low <> _high" if turn == 0 else "true").select(*FP, "_low"))
        todo = (left.distinct().join(groups, FP).withColumn("_first", order.eqNullSafe(F.col("_low"))).drop("_low"))
        wrong = written(_compare(rows, todo, chunk_bytes), "unequal")
        if wrong.isEmpty():
            break
        again = written(left.join(wrong, same(left, wrong, IDENTITY), "left_semi"), "unequal")
        turn += 1
        marked = again.select(*IDENTITY, F.lit(turn).alias("_turn"))
        found = marked if found is None else found.unionByName(marked)
        left = again
    if found is None:
        return fp.withColumn("_round", F.lit(0))
    last = found.groupBy(*IDENTITY).agg(F.max("_turn").alias("_round"))
    joined = fp.join(last, same(fp, last, IDENTITY), "left")
    return joined.select(*[fp[c] for c in fp.columns], F.coalesce("_round", F.lit(0)).alias("_round"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                chunk_bytes: int = CHUNK_BYTES, spread_bytes: int = SPREAD_BYTES,
                primes: tuple[int, int] = PRIMES) -> DataFrame:
    """One row per document: identity, ``_keep_id``, ``_size``, ``_kept``, ``_sha``, ``_cp``, hashes.

    Of equal texts the one with the most code points in the original stays, then the
    one with the smallest id, then any one of the repeats.
    """
    c = classes(docs, id_col, text_col, chunk_bytes, spread_bytes, primes)
    cls = [*FP, "_round"]
    best = F.min(F.struct((-F.col("_cp")).alias("cp"), F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_row").alias("row")))
    # groups of one need no join; the others are written, so that Spark can split a hot one
    per = written(c.groupBy(*cls).agg(F.count(F.lit(1)).alias("_m"), best.alias("_best")).filter("_m > 1")
                  .select(*[F.col(x).alias(f"_g{x}") for x in cls], "_m", "_best"), "groups")
    on = (c["_len"] == per["_g_len"]) & (c["_h1"] == per["_g_h1"]) & (c["_h2"] == per["_g_h2"]) & (c["_round"] == per["_g_round"])
    return (c.join(per, on, "left").withColumn("_size", F.coalesce("_m", F.lit(1).cast("long")))
            .withColumn("_keep_id", F.when(F.col("_m").isNull(), F.col("_id")).otherwise(F.col("_best.id")))
            .withColumn("_kept", F.coalesce(F.col("_row") == F.col("_best.row"), F.lit(True))).drop("_best", "_m"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicates over whole ``documents``: one row per document, dropped ones too."""
    r = exact_dedup(table(spark, sf_dir, "documents"))
    return r.select(F.col("_id").alias("doc_id"), F.col("_keep_id").alias("keep_id"), F.col("_size").alias("group_size"),
                    F.col("_kept").alias("kept"), F.col("_sha").alias("text_sha256"))


# Every row of the result is a function of the normalised texts, so plain SQL can give it.
ORACLE_SQL = r"""
WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS cp,
                  sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY text_sha256 ORDER BY cp DESC, doc_id NULLS LAST) AS rn,
             count(*) OVER (PARTITION BY text_sha256) AS group_size,
             first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY cp DESC, doc_id NULLS LAST) AS keep_id FROM n)
SELECT doc_id, keep_id, group_size, rn = 1 AS kept, text_sha256 FROM r
"""


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the rows that exact deduplication keeps, all columns."""
    r = written(exact_dedup(docs).select(*IDENTITY, "_kept"), "exact-kept")
    return keep_rows(docs, r, "doc_id", "text")
