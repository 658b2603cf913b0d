"""SimHash near-duplicates with pigeonring filtering.

A 64-bit fingerprint is split into ``m = bits + 1`` segments on a ring. If two
fingerprints differ in at most ``bits`` places, then at some start segment every chain of
``l`` consecutive segments holds at most ``floor(l * bits / m)`` differences: none in the
first, at most one in the first two, and so on. Candidates are found by the start of such
a chain: the first segment equal, and of the second (one difference at most) one half
equal; with very many fingerprints also one third of the third segment. A pair is then
tested chain by chain, and only one that holds at some start meets the full distance
check. Each pair comes out once, at its first viable start.

Equal fingerprints are one representative, so copies cost nothing; components are
found over representatives by star contraction in written rounds. Defined results:
NULL or blank text has fingerprint zero, linked like any other; NULL ids are never a
component's name unless it has no other; an empty table gives no rows.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import IDENTITY, components, join_summary, keep_rows, table, text_rows, written

SHINGLE = 4
MAX_BITS = 4
SEED = 42
BLOCK = 1 << 14  # shingles whose bits are counted at a time


def simhash(data: bytes, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit fingerprint of a text's shingles, repeats included."""
    words = data.lower().split()  # on bytes: A-Z only, and the six white-space bytes
    if not words:
        return 0
    n, k = len(words), min(shingle, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate((np.zeros(1, np.int64), ends[:-1] + 1))[:n - k + 1].tolist()
    ends = ends[k - 1:].tolist()
    h = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for i in range(0, len(starts), BLOCK):
        part = np.array([h(joined[s:e], SEED) for s, e in zip(starts[i:i + BLOCK], ends[i:i + BLOCK])], "<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(starts), bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([simhash(t.as_py(), shingle) for t in b.column("_text")], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in IDENTITY), pa.array(fp, pa.int64())], names=[*IDENTITY, "_fp"])
    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Identity and ``_fp`` (the fingerprint as a signed long) of every row."""
    rows = text_rows(docs, id_col, text_col).withColumn("_text", F.col("_text").cast("binary"))
    id_type = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(_fingerprints(shingle), f"_id {id_type}, _x long, _n int, _fp long")


def segments(bits: int) -> list[tuple[int, int]]:
    """Offset and width of the ``bits + 1`` segments of 64 bits."""
    m = bits + 1
    cuts = [round(i * 64 / m) for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _part(c: Column, offset: int, width: int) -> Column:
    return F.shiftrightunsigned(c, offset).bitwiseAND(F.lit((1 << width) - 1))


def _pieces(offset: int, width: int, n: int) -> list[tuple[int, int]]:
    cuts = [offset + round(i * width / n) for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _keys(bits: int, depth: int) -> list[list[tuple[int, int]]]:
    """Bit ranges of each block key: a whole segment, one half of the next (its chain has
    at most one difference), one third of the one after (at most two), ..."""
    segs = segments(bits)
    m = len(segs)
    out = []
    for i in range(m):
        chains = [[segs[i]]]
        for step in range(1, min(depth, m)):
            budget = (step + 1) * bits // m
            nxt = segs[(i + step) % m]
            chains = [c + [p] for c in chains for p in _pieces(*nxt, budget + 1)]
        out.extend(chains)
    return out


def _viable(x: Column, bits: int, start: int) -> Column:
    """Whether every chain from this start stays within its share of the budget."""
    segs, total, ok = segments(bits), F.lit(0), F.lit(True)
    m = len(segs)
    for length in range(1, m + 1):
        total = total + F.bit_count(_part(x, *segs[(start + length - 1) % m]))
        ok = ok & (total <= F.lit(length * bits // m))
    return ok


def links(fps: DataFrame, bits: int = MAX_BITS, depth: int = 2) -> DataFrame:
    """Pairs ``(a, b)`` of distinct fingerprints at ``bits`` or fewer differing bits, each once."""
    if bits == 0:
        return fps.select(F.col("_fp").alias("a"), F.col("_fp").alias("b")).limit(0)
    keys, m = _keys(bits, depth), bits + 1
    per = len(keys) // m

    def key(ranges: list[tuple[int, int]]) -> Column:
        k = F.lit(0).cast("long")
        for o, w in ranges:
            k = F.shiftleft(k, w).bitwiseOR(_part(F.col("_fp"), o, w))
        return k

    blocks = fps.select("_fp", F.posexplode(F.array(*[key(r) for r in keys])).alias("_tag", "_key"))
    a = blocks.select(F.col("_fp").alias("a"), "_tag", "_key")
    b = blocks.select(F.col("_fp").alias("b"), F.col("_tag").alias("_tag2"), F.col("_key").alias("_key2"))
    x = F.col("a").bitwiseXOR(F.col("b"))
    # the key at which a pair comes out: its first viable start, there the first equal parts
    tag = F.lit(None).cast("int")
    for i in reversed(range(m)):
        at = F.lit(None).cast("int")
        for j in reversed(range(per)):
            equal = F.lit(True)
            for o, w in keys[i * per + j][1:]:
                equal = equal & (_part(x, o, w) == 0)
            at = F.when(equal, F.lit(i * per + j)).otherwise(at)
        tag = F.when(_viable(x, bits, i), at).otherwise(tag)
    return (a.join(b, (a["_tag"] == b["_tag2"]) & (a["_key"] == b["_key2"]) & (F.col("a") < F.col("b"))
                   & (F.col("_tag") == tag) & (F.bit_count(x) <= bits)).select("a", "b"))


def chain_depth(n: int, bits: int = MAX_BITS) -> int:
    """Segments in a block key, so that keys and expected candidates of ``n`` fingerprints
    together are fewest. Any depth gives the same links."""
    cost = {}
    for depth in range(2, min(3, bits + 1) + 1):
        keys = _keys(bits, depth)
        cost[depth] = 2 * n * len(keys) + n * n / 2 * sum(2.0 ** -sum(w for _, w in k) for k in keys)
    return min(cost, key=cost.get) if cost else 1


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, bits: int = MAX_BITS) -> DataFrame:
    """One row per document: identity, ``_row``, ``_fp``, ``_component`` (smallest id), ``_root``."""
    fp = written(fingerprints(docs, id_col, text_col, shingle).withColumn("_row", F.monotonically_increasing_id()), "simhash")
    reps = written(fp.groupBy("_fp").agg(F.min("_id").alias("_low"), F.count(F.lit(1)).alias("_m")), "simhash-classes")
    n = reps.agg(F.count(F.lit(1)).alias("classes"), F.coalesce(F.sum("_m"), F.lit(0)).alias("rows")).first()
    found = written(links(reps.select("_fp"), bits, chain_depth(n["classes"], bits)), "simhash-links")
    cc = components(found, "simhash-components")
    rooted = written(reps.join(cc, reps["_fp"] == cc["node"], "left")
                     .select("_fp", "_low", F.col("_m").alias("_rows"), F.coalesce("root", "_fp").alias("_root")), "simhash-rooted")
    per = rooted.groupBy("_root").agg(F.min("_low").alias("_component"), F.count(F.lit(1)).alias("_m"))
    named = join_summary(rooted, "_root", per, n["classes"]).select("_fp", "_root", "_component", F.col("_rows").alias("_m"))
    return join_summary(fp, "_fp", written(named, "simhash-named"), n["rows"])


def op7_simhash_pigeonring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash near-duplicates over whole ``documents``: fingerprint and component of each."""
    r = near_duplicates(table(spark, sf_dir, "documents"))
    return r.select(F.col("_id").alias("doc_id"), F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"),
                    F.col("_component").alias("component_id"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each near-duplicate group, that with the smallest id."""
    r = written(near_duplicates(docs), "simhash-members")
    first = r.groupBy("_root").agg(F.min(F.struct(F.col("_id").isNull(), F.col("_id"), F.col("_row"))).alias("_best"), F.count(F.lit(1)).alias("_m"))
    r = join_summary(r, "_root", first, r.count()).select(*IDENTITY, (F.col("_row") == F.col("_best._row")).alias("_kept"))
    return keep_rows(docs, written(r, "simhash-kept"), "doc_id", "text")
