"""Nearest neighbours by randomly rotated one-bit codes with error bounds.

Every vector is scaled to unit length, taken from a centre, padded with zeros to ``BITS``
dimensions or more, rotated by a random orthogonal matrix and kept as the signs of its
coordinates, packed into 64-bit words, with three scalars: its distance from the centre, its
product with the centre, and the product of the coded and the true direction. A query's rotated
coordinates are rounded to ``QUERY_BITS`` bits and kept as bit planes, so a code's product with it is
a sum of bit counts of words. From these the cosine is estimated without bias, and the error
stays within a bound that shrinks with the number of code bits.

Vectors are compared exactly (in double precision on the original components) in the order of
their upper bounds, until none left reaches the k-th exact score found. That score is carried
from one block of codes to the next for the first ``CARRIED`` queries; it only saves comparisons.
Queries are a stated set, read in blocks of bounded size against every block of
candidates; each pair of blocks passes on k rows a query at most.

Vectors that are NULL, zero, of another length than most, or hold NULL or non-finite
components, and rows without an id, take no part; finite components may be of any size (vectors are
scaled by a power of two before squares are taken). Rows with the same id and vector count
once; ties go to the smaller id. The index covers every row; only its centre is
fitted, on a documented, bounded sample.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import masked, place_of, scratch, ship, table, written
from .token_records import place

SEED = 20240521
FIT_ROWS = 10_000  # rows the centre is the mean of: those with the smallest hashes of their ids
EPSILON = 3.0  # width of the error bound, in standard deviations of a random rotation's error
QUERY_BLOCK = 256
INDEX_BLOCK = 32_768
BITS = 512  # code bits, at least; the bound's width falls with their square root
QUERY_BITS = 4
CARRIED = 1 << 20  # queries whose marks a task carries from block to block, 8 bytes each
STEP = 128  # vectors compared exactly between two looks at the mark


def rotation(dim: int, seed: int = SEED, bits: int = BITS) -> np.ndarray:
    """The first ``dim`` columns of a random orthogonal matrix, whole words of rows; the same everywhere for a seed."""
    rows = -(-max(bits, dim) // 64) * 64
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((rows, dim)))
    return q * np.sign(np.diag(r))


def scaled(v: np.ndarray) -> np.ndarray:
    """Rows times powers of two, their largest components between 0.5 and 1: no square overflows or vanishes."""
    return np.ldexp(v, -np.frexp(np.abs(v).max(1, keepdims=True))[1])


def unit(v: np.ndarray) -> np.ndarray:
    v = scaled(v)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def encode(v: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, ...]:
    """Packed signs, distance from the centre, product with it, product of code and direction."""
    d = unit(v) - centre
    far = np.sqrt((d * d).sum(1))
    safe = np.where(far > 0, far, 1.0)
    r = (d / safe[:, None]) @ turn.T
    agree = np.abs(r).sum(1) / np.sqrt(len(turn))
    return np.packbits(r > 0, axis=1), far, (d + centre) @ centre, np.where(far > 0, agree, 1.0)


class Query:
    """A query's direction from the centre as bit planes of its rounded coordinates."""

    def __init__(self, q: np.ndarray, centre: np.ndarray, turn: np.ndarray):
        d = unit(q[None, :])[0] - centre
        r = turn @ d
        self.shift = float(d @ centre)
        self.low, top = float(r.min()), (1 << QUERY_BITS) - 1
        self.step = (float(r.max()) - self.low) / top or 1.0
        level = np.rint((r - self.low) / self.step).astype(np.uint8)
        self.total = float(level.sum()) * self.step + self.low * len(r)
        self.planes = [np.packbits(level >> j & 1).view(np.uint64)[:, None] for j in range(QUERY_BITS)]
        self.far = float(np.sqrt(d @ d))
        rounding = r - (self.low + self.step * level)
        self.rounding = float(np.sqrt(rounding @ rounding))


class Codes:
    """A block of codes by words, with what the estimates need of each."""

    def __init__(self, code: np.ndarray, far: np.ndarray, own: np.ndarray, agree: np.ndarray, epsilon: float = EPSILON):
        self.words = np.ascontiguousarray(np.ascontiguousarray(code).view(np.uint64).T)
        self.bits = 64 * len(self.words)
        self.ones = np.bitwise_count(self.words).sum(0, dtype=np.int32)
        self.own = own
        self.scale = far / agree / np.sqrt(self.bits)
        self.code_width = epsilon * np.sqrt(np.maximum(1 - agree ** 2, 0)) / agree / np.sqrt(self.bits - 1) * far
        self.query_width = epsilon * self.scale

    def bounds(self, q: Query) -> tuple[np.ndarray, np.ndarray]:
        """Estimated cosine of each vector with the query, and its error bound."""
        held = np.zeros(self.words.shape[1], np.int32)
        for j, plane in enumerate(q.planes):
            held += np.bitwise_count(self.words & plane).sum(0, dtype=np.int32) << j
        # the code's coordinates are 2 b - 1: twice the sum over set bits less the sum over all
        product = 2 * (q.low * self.ones + q.step * held) - q.total
        return product * self.scale + (q.shift + self.own), q.far * self.code_width + q.rounding * self.query_width + 1e-9


def cosine(a: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Cosines of rows with one vector; each row is summed in the same order, so equal rows tie."""
    a, q = scaled(a), scaled(q[None, :])[0]
    return (a * q).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((q * q).sum()))


def nearest(v: np.ndarray, ids: np.ndarray, q: np.ndarray, high: np.ndarray, k: int, mark: float) -> tuple[np.ndarray, np.ndarray, int]:
    """Places and exact scores of the ``k`` best of the vectors whose upper bound reaches ``mark``,
    compared from the highest bound down until none left reaches the k-th score; and how many were compared."""
    pick = np.flatnonzero(high >= mark)
    pick = pick[np.argsort(-high[pick], kind="stable")]
    best, score, done = pick[:0], np.empty(0), 0
    while done < len(pick) and not (len(best) == k and high[pick[done]] < max(mark, score[-1])):
        part = pick[done:done + STEP]
        done += len(part)
        best, score = np.concatenate((best, part)), np.concatenate((score, cosine(v[part], q)))
        order = np.lexsort((ids[best], -score))[:k]
        best, score = best[order], score[order]
    return best, score, done


def vectors(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Usable rows ``_id``, ``_v`` (doubles), each (id, vector) once."""
    ship(rows.sparkSession)
    v = F.transform(F.col(place_of(rows, vec_col)), lambda x: x.cast("double"))
    ok = masked(rows).select(F.col(place_of(rows, id_col)).cast("long").alias("_id"), v.alias("_v")).filter("_id IS NOT NULL AND _v IS NOT NULL")
    fine = F.forall("_v", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))) & ~F.isnan(x)) & F.exists("_v", lambda x: x != 0)
    return ok.filter(fine).dropDuplicates(["_id", "_v"])


def _index(dim: int, centre: np.ndarray):
    turn = rotation(dim)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            code, far, own, agree = encode(_matrix(b.column("_v"), dim), centre, turn)
            yield pa.RecordBatch.from_arrays([b.column("_id"), b.column("_v"), pa.array([c.tobytes() for c in code], pa.binary()),
                                              pa.array(far), pa.array(own), pa.array(agree)], names=["_id", "_v", "_code", "_far", "_own", "_agree"])
    return run


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(-1, dim)


def build_index(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", fit_rows: int = FIT_ROWS) -> tuple[DataFrame, np.ndarray] | None:
    """Written index (a row for each vector: id, vector, code and scalars) and its centre; None if no vector can be used."""
    v = written(vectors(rows, id_col, vec_col), "vectors")
    common = v.groupBy(F.size("_v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if common is None:
        return None
    dim = common["d"]
    v = v.filter(F.size("_v") == dim)
    sample = v.orderBy(F.xxhash64("_id"), "_id").limit(fit_rows).select("_v").toArrow()
    centre = unit(_matrix(sample.column("_v").combine_chunks(), dim)).mean(0)
    return written(v.mapInArrow(_index(dim, centre), "_id long, _v array<double>, _code binary, _far double, _own double, _agree double"), "codes"), centre


def _search(folder: str, centre: np.ndarray, k: int, epsilon: float):
    dim = len(centre)
    turn = rotation(dim)

    def queries() -> Iterator[tuple[np.ndarray, np.ndarray, list]]:
        fs, top = place(folder)
        files = sorted(f.path for f in fs.get_file_info(pa.fs.FileSelector(top)) if f.path.endswith(".parquet"))
        for path in files:
            with fs.open_input_file(path) as f:
                for b in pq.ParquetFile(f).iter_batches(QUERY_BLOCK):
                    if b.num_rows:
                        yield b.column("_id").to_numpy(), _matrix(b.column("_v"), dim), b.column("_q").to_pylist()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held, n = [], 0
        for b in batches:
            held.append(b)
            n += b.num_rows
            if n >= INDEX_BLOCK:
                yield pa.Table.from_batches(held)
                held, n = [], 0
        if n:
            yield pa.Table.from_batches(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = np.full(0, -np.inf)
        for t in blocks(batches):
            t = t.combine_chunks()
            ids = t.column("_id").to_numpy()
            v = _matrix(t.column("_v").chunk(0), dim)
            code = np.frombuffer(b"".join(t.column("_code").to_pylist()), np.uint8).reshape(len(ids), -1)
            codes = Codes(code, *(t.column(c).to_numpy() for c in ("_far", "_own", "_agree")), epsilon)
            place_in = 0
            for q_ids, q, q_keys in queries():
                if len(marks) < min(place_in + len(q), CARRIED):
                    marks = np.concatenate((marks, np.full(len(q), -np.inf)))
                out = []
                for i, (qid, key) in enumerate(zip(q_ids.tolist(), q_keys)):
                    est, width = codes.bounds(Query(q[i], centre, turn))
                    high = est + width
                    high[ids == qid] = -np.inf
                    at = place_in + i
                    mark = marks[at] if at < len(marks) else -np.inf
                    best, score, compared = nearest(v, ids, q[i], high, k, max(mark, -2.0))  # no bound of another vector is below
                    if len(best) == k and at < len(marks):
                        marks[at] = max(marks[at], score[-1])
                    out.extend((qid, key, int(ids[j]), float(x), compared if n == 0 else 0) for n, (j, x) in enumerate(zip(best, score)))
                place_in += len(q)
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, ty) for c, ty in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64()))],
                                                     names=["query_id", "_q", "vec_id", "score", "reranked"])
    return run


def candidates(index: tuple[DataFrame, np.ndarray], queries: DataFrame, k: int, epsilon: float = EPSILON) -> DataFrame:
    """Each block's best rows for every query; ``reranked``, summed over a query's rows, is how many vectors
    were compared exactly with it in blocks that gave a row."""
    codes, centre = index
    folder = scratch(codes.sparkSession, "queries")
    queries.select("_id", "_v", F.xxhash64("_id", "_v").alias("_q")).write.parquet(folder)
    return codes.mapInArrow(_search(folder, centre, k, epsilon), "query_id long, _q long, vec_id long, score double, reranked long")


def search(index: tuple[DataFrame, np.ndarray], queries: DataFrame, k: int, epsilon: float = EPSILON) -> DataFrame:
    """The ``k`` nearest of each query row (``_id``, ``_v`` of the index): ``query_id``, ``rank``,
    ``vec_id``, ``score``."""
    found = candidates(index, queries, k, epsilon)
    w = Window.partitionBy("query_id", "_q").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op4_rabitq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest by cosine of every row of ``embeddings`` whose id is divisible by 50."""
    index = build_index(table(spark, sf_dir, "embeddings"))
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return search(index, index[0].filter("_id % 50 = 0"), 5)
