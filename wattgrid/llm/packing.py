"""Best-fit packing of token sequences with exact-complement hashing.

Documents become items of 1 to ``capacity`` tokens; full ones need no partner. How many
sequences are needed depends only on how many items there are of each length, a
table of at most ``capacity`` rows however large the corpus, so the plan is made on those
counts: for the longest item left, the gap it leaves is looked up among the sums of one, two and
three shorter lengths, and a combination that fills it exactly is used as often as the
counts allow. What has no exact partner is placed best-fit. The plan is a table of patterns
("these lengths, so many times"), not of documents.

Items then take their places by rank among items of their length. Ranks come from running
counts within partitions plus a prefix sum over (length, partition) counts, so a length
shared by a third of all documents is no one task's work.
"""
from __future__ import annotations

import bisect
import itertools
import struct
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, text_rows, written
from .tokens import BYTE_BPE, encoder

CAPACITY = 2048
Plan = list[tuple[tuple[int, ...], int]]  # lengths of a sequence, and how many such sequences


class Sums:
    """Sums of one, two and three lengths that are still available, looked up by the gap to fill."""

    def __init__(self, counts: np.ndarray, balanced: bool):
        self.counts, self.at = counts, -1 if balanced else 0  # of several pairs: the evenest, or the one with the longest member

    def one(self, gap: int) -> tuple[int, ...] | None:
        return (gap,) if self.counts[gap] else None

    def two(self, gap: int, longest: int = 0, taken: int = 0) -> tuple[int, ...] | None:
        """Two lengths with sum ``gap``, none over ``longest`` (if given); one item of length ``taken`` is spoken for."""
        low = np.arange(max(1, gap - longest if longest else 1), gap // 2 + 1)
        high, c = gap - low, self.counts
        hit = np.flatnonzero((c[low] >= 1 + (low == taken) + (low == high)) & (c[high] >= 1 + (high == taken) + (low == high)))
        if not len(hit):
            return None
        x = int(low[hit[self.at]])
        return gap - x, x

    def three(self, gap: int) -> tuple[int, ...] | None:
        lens = np.flatnonzero(self.counts[:max(gap - 1, 0)])
        lens = lens[lens * 3 >= gap]
        for longest in (lens if self.at else lens[::-1]).tolist():
            rest = self.two(gap - longest, longest, longest)
            if rest:
                return longest, *rest
        return None


def _times(counts: np.ndarray, pattern: tuple[int, ...]) -> int:
    """How often the counts allow the pattern."""
    return min(int(counts[x]) // pattern.count(x) for x in set(pattern))


def exact_plan(counts: np.ndarray, capacity: int, most: int = 3, balanced: bool = True) -> Plan:
    """Sequences filled exactly by an item and up to ``most`` others, fewest others first;
    ``counts`` keeps what is left."""
    sums, out = Sums(counts, balanced), []
    if counts[capacity]:
        out.append(((capacity,), int(counts[capacity])))
        counts[capacity] = 0
    for look in (sums.one, sums.two, sums.three)[:most]:
        for length in range(capacity - 1, 0, -1):
            while counts[length]:
                counts[length] -= 1
                rest = look(capacity - length)
                counts[length] += 1
                if rest is None:
                    break
                pattern = (length, *rest)
                n = _times(counts, pattern)
                for x in pattern:
                    counts[x] -= n
                out.append((pattern, n))
    return out


def best_fit_plan(counts: np.ndarray, capacity: int) -> Plan:
    """Best-fit decreasing on counts: each length goes to the smallest gaps that hold it."""
    groups: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)  # by gap
    gaps: list[int] = []  # sorted gaps that have groups

    def put(pattern: tuple[int, ...], n: int) -> None:
        gap = capacity - sum(pattern)
        if gap not in groups or not groups[gap]:
            bisect.insort(gaps, gap)
        groups[gap].append((pattern, n))

    for length in range(capacity, 0, -1):
        left = int(counts[length])
        while left:
            i = bisect.bisect_left(gaps, length)
            if i == len(gaps):
                fits = capacity // length
                if left >= fits:
                    put((length,) * fits, left // fits)
                if left % fits:
                    put((length,) * (left % fits), 1)
                break
            gap = gaps[i]
            pattern, n = groups[gap].pop()
            if not groups[gap]:
                del groups[gap], gaps[i]
            fits = min(gap // length, left)
            use = min(n, left // fits)
            if use < n:
                put(pattern, n - use)
            put(pattern + (length,) * fits, use)
            left -= use * fits
    counts[:] = 0
    return [g for gap in gaps for g in groups[gap]]


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> Plan:
    """All sequences for ``counts[length]`` items: exact complements, then best fit.

    Using up short items on exact fills can leave too few of them for the rest, so
    complements of up to one, two and three items are tried and the fewest sequences win.
    """
    best, total = None, 0
    least = -(-int(counts @ np.arange(capacity + 1)) // capacity)
    for most, balanced in ((3, True), (2, True), (3, False), (1, True)):
        left = counts.astype(np.int64).copy()
        got = exact_plan(left, capacity, most, balanced) + best_fit_plan(left, capacity)
        n = sum(k for _, k in got)
        if best is None or n < total:
            best, total = got, n
        if total == least:
            break
    return best


def _items(tokenizer: str, end_id: int, capacity: int):
    """Arrow function: the pieces of every text, with a running rank among its partition's pieces of that length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end, part = encoder(tokenizer), struct.pack("<I", end_id), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for b in batches:
            rows = []
            for doc_id, text in zip(b.column("_id").to_pylist(), b.column("_text")):
                ids = enc.ids(text.as_py()) + end
                n = len(ids) // 4
                first = n % capacity or capacity
                at = 0
                for k, size in enumerate([first] + [capacity] * ((n - first) // capacity)):
                    rows.append((doc_id, k, at, size, zlib.crc32(ids[4 * at:4 * (at + size)]), seen[size]))
                    seen[size] += 1
                    at += size
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], b.schema.field("_id").type), pa.array([r[1] for r in rows], pa.int32()),
                 *(pa.array([r[i] for r in rows], pa.int64()) for i in (2, 3, 4, 5)), pa.array([part] * len(rows), pa.int32())],
                names=["_id", "piece", "start", "length", "ids_crc32", "_rank", "_part"])
    return run


def items(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = BYTE_BPE,
          end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of at most ``capacity`` tokens; of a longer document the first may be shorter."""
    rows = text_rows(docs, id_col, text_col).select("_id", "_text")
    id_type = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(_items(tokenizer, end_id, capacity),
                           f"_id {id_type}, piece int, start long, length long, ids_crc32 long, _rank long, _part int")


def places(sequences: Plan) -> list[tuple[int, int, int, int, int, int]]:
    """For each length, which ranks go where: ranks ``lo .. hi - 1`` to sequences from ``first``
    on, ``each`` to a sequence, side by side from place ``offset``."""
    used: dict[int, int] = defaultdict(int)
    rows, first = [], 0
    for pattern, n in sequences:
        offset = 0
        for length, run in itertools.groupby(sorted(pattern, reverse=True)):
            each = len(list(run))
            rows.append((length, used[length], used[length] + n * each, first, each, offset))
            used[length] += n * each
            offset += length * each
        first += n
    return rows


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = BYTE_BPE,
         end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """Every piece with its sequence and place: ``_id``, ``piece``, ``start``, ``length``,
    ``ids_crc32``, ``sequence_id``, ``offset``.

    NULL text is an empty document (its end id alone); NULL and repeated ids are packed
    like others; an empty table gives no rows.
    """
    spark = docs.sparkSession
    it = written(items(docs, id_col, text_col, tokenizer, end_id, capacity), "items")
    per = it.groupBy("length", "_part").agg(F.count(F.lit(1)).alias("_m"))
    counts = np.zeros(capacity + 1, np.int64)
    for r in per.groupBy("length").agg(F.sum("_m").alias("n")).collect():  # at most `capacity` rows
        counts[r["length"]] = r["n"]
    before = F.sum("_m").over(Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    base = per.select(F.col("length").alias("_bl"), F.col("_part").alias("_bp"), F.coalesce(before, F.lit(0)).alias("_base"))
    ranked = it.join(base, (it["length"] == base["_bl"]) & (it["_part"] == base["_bp"])).withColumn("_at", F.col("_rank") + F.col("_base"))
    sequences = plan(counts, capacity)
    # full pieces need no plan: their rank is their sequence
    full, rest = int(counts[capacity]), places([s for s in sequences if s[0] != (capacity,)])
    whole = ranked.filter(F.col("length") == capacity).select("_id", "piece", "start", "length", "ids_crc32", F.col("_at").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    # bounded by the capacity: each row of the plan uses up a length or a gap
    where = F.broadcast(spark.createDataFrame(rest, "_l long, _lo long, _hi long, _first long, _each long, _offset long"))
    part = ranked.filter(F.col("length") < capacity)
    part = part.join(where, (part["length"] == where["_l"]) & (part["_at"] >= where["_lo"]) & (part["_at"] < where["_hi"]))
    nth = F.col("_at") - F.col("_lo")
    part = part.select("_id", "piece", "start", "length", "ids_crc32", (F.lit(full) + F.col("_first") + F.expr("(_at - _lo) div _each")).alias("sequence_id"),
                       (F.col("_offset") + nth % F.col("_each") * F.col("length")).alias("offset"))
    return whole.unionByName(part)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents`` packed into sequences of at most 2048 tokens, a row per piece."""
    return pack(table(spark, sf_dir, "documents")).withColumnRenamed("_id", "doc_id")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage, the last: the pieces of all documents and their places."""
    return pack(docs).withColumnRenamed("_id", "doc_id")
