"""Cross-entropy difference scores from matched n-gram models.

Two n-gram models over the bytes of UTF-8, one of the target documents and one of all documents, have
the same order, the same smoothing (interpolated Witten-Bell) and one vocabulary: the 256 bytes
and an end mark. A document's score is the mean over its tokens (bytes and the end mark) of the
target model's loss minus the background model's, in nats: below zero, it is more like the target.
The order is the parameter's at any size and in any script; up to ``63 // BITS`` tokens fit a key.

Counts cover all documents, and the table of n-grams grows with them; it is never held whole
anywhere. Documents are cut into slices of about ``SLICE`` bytes. A slice asks for each
n-gram it holds once, the questions are joined with the model, and the answers are
written by slices, so a task that scores reads its own slices' answers only. Which documents are target is
known from a join of ids alone. Texts are written once and never shuffled.

Defined results: NULL and empty texts are an end mark alone; NULL labels name no target;
repeats count as often as they occur; without target documents the target model
is uniform; an empty table gives no rows.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch, table, written
from .token_records import place
from .words import byte_rows

ORDER = 5
BITS = 9  # of a token in a key
START, END, BYTE = 0, 1, 2  # tokens; a byte is its value plus BYTE
CHOICES = 257  # tokens that can come next: every byte and the end
SLICE = 1 << 24  # bytes of text, and ROW for every row
ROW = 64
PER_FOLDER = 3  # bits: slices of a task share a folder of answers eight at a time
PIECE = 1 << 21  # tokens handled at a time
HELD_KEYS = 1_000_000  # n-grams a task holds before it passes sums on


def grams(text: bytes, order: int) -> Iterator[np.ndarray]:
    """The n-gram that ends at each token of the text, as one integer; a piece of the text at a time."""
    flat = np.frombuffer(text, np.uint8)
    for lo in range(0, len(flat) + 1, PIECE):
        n = min(PIECE, len(flat) + 1 - lo)
        left = max(0, lo - order + 1)
        s = np.concatenate((np.full(order - 1 - (lo - left), START), flat[left:lo + n].astype(np.int64) + BYTE,
                            np.full(lo + n - len(flat) if lo + n > len(flat) else 0, END)))
        key = np.zeros(n, np.int64)
        for i in range(order):
            key = key << BITS | s[i:i + n]
        yield key


def _numbered(size: int):
    """Arrow function: rows with their slice, a task's rows in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, held, row = TaskContext.get().partitionId(), 0, 0, 0
        for b in batches:
            slices = []
            for n in pc.binary_length(b.column("_text")).to_pylist():
                if held >= size:
                    seq, held = seq + 1, 0
                held += n + ROW
                slices.append(part << 32 | seq)
            rows = pa.array(np.arange(row, row + b.num_rows) + (part << 40), pa.int64())
            row += b.num_rows
            yield pa.RecordBatch.from_arrays([b.column("_id"), rows, pa.array(slices, pa.int64()), b.column("_text")], names=["_id", "_row", "_slice", "_text"])
    return run


def by_slices(df: DataFrame, key: str, label: str) -> str:
    """Folder with the rows of ``df`` (with ``_slice`` and ``key``) in a folder for every few slices."""
    folder = scratch(df.sparkSession, label)
    df = df.withColumn("_high", F.shiftright("_slice", 42)).withColumn("_few", F.shiftright("_slice", PER_FOLDER))
    df.repartition("_few").sortWithinPartitions("_high", "_few", "_slice", key).write.partitionBy("_high", "_few").parquet(folder)
    return folder


def of_slice(folder: str, number: int, columns: list[str]) -> list[np.ndarray]:
    """What ``by_slices`` wrote for one slice, in order of the first column."""
    fs, top = place(f"{folder}/_high={number >> 42}/_few={number >> PER_FOLDER}")
    parts = []
    for f in fs.get_file_info(pafs.FileSelector(top, allow_not_found=True)):
        if f.path.endswith(".parquet"):
            with fs.open_input_file(f.path) as h:
                parts.append(pq.read_table(h, columns=columns, filters=[("_slice", "=", number)]))
    if not parts:
        return [np.empty(0, np.int64) for _ in columns]
    t = pa.concat_tables(parts)
    found = [t.column(c).to_numpy() for c in columns]
    order = np.argsort(found[0], kind="stable")
    return [c[order] for c in found]


def _runs(b: pa.RecordBatch) -> Iterator[tuple[int, int, int]]:
    """Slice, first and last place of the batch's rows that share a slice."""
    s = b.column("_slice").to_numpy()
    cut = [0, *(np.flatnonzero(np.diff(s)) + 1).tolist(), len(s)]
    for lo, hi in zip(cut, cut[1:]):
        if hi > lo:
            yield int(s[lo]), lo, hi


def _distinct(texts: pa.Array, order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted n-grams of the texts and their counts, for about ``PIECE`` tokens at a time."""
    held, size = [], 0
    for x in texts:
        for g in grams(x.as_py(), order):
            held.append(g)
            size += len(g)
            if size >= PIECE:
                yield np.unique(np.concatenate(held), return_counts=True)
                held, size = [], 0
    if held:
        yield np.unique(np.concatenate(held), return_counts=True)


def _gram_counts(order: int, flags: str):
    """Arrow function: n-grams of a task's texts, how often they occur in all and in target texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size, number, target_rows = 0, -1, np.empty(0, np.int64)

        def merged() -> tuple[np.ndarray, ...]:
            keys, at = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
            return keys, *(np.bincount(at, np.concatenate([h[i] for h in held]), len(keys)).astype(np.int64) for i in (1, 2))

        def batch(h: tuple[np.ndarray, ...]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x) for x in h], names=["gram", "n", "n_target"])

        for b in batches:
            for this, lo, hi in _runs(b):
                if this != number:
                    number, (target_rows,) = this, of_slice(flags, this, ["_row"])
                is_target = np.isin(b.column("_row").to_numpy()[lo:hi], target_rows)
                for target in (True, False):
                    for k, n in _distinct(b.column("_text").slice(lo, hi - lo).filter(pa.array(is_target == target)), order):
                        held.append((k, n, n if target else np.zeros(len(n), np.int64)))
                        size += len(k)
                        if size > 4 * HELD_KEYS:
                            held = [merged()]
                            size = len(held[0][0])
                            if size > HELD_KEYS:
                                yield batch(held[0])
                                held, size = [], 0
        if held:
            yield batch(merged())
    return run


def _questions(order: int):
    """Arrow function: the n-grams of each slice, once (again where a slice is read in two parts)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = -1, [], 0

        def asked() -> Iterator[pa.RecordBatch]:
            if held:
                keys = np.unique(np.concatenate(held))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), number, np.int64)), pa.array(keys)], names=["_slice", "gram"])

        for b in batches:
            for this, lo, hi in _runs(b):
                if this != number:
                    yield from asked()
                    number, held, size = this, [], 0
                for k, _ in _distinct(b.column("_text").slice(lo, hi - lo), order):
                    held.append(k)
                    size += len(k)
                    if size > 4 * HELD_KEYS:
                        held = [np.unique(np.concatenate(held))]
                        size = len(held[0])
                        if size > 2 * HELD_KEYS:
                            yield from asked()
                            held, size = [], 0
        yield from asked()
    return run


def models(counts: DataFrame, order: int) -> DataFrame:
    """Written table ``gram``, ``loss`` and ``loss_target`` of every n-gram counted."""
    grams = written(counts, "gram-counts")
    uniform = 1.0 / CHOICES
    lower: DataFrame | None = None
    for k in range(1, order + 1):
        mask = F.lit((1 << (BITS * k)) - 1)
        level = grams.groupBy(F.col("gram").bitwiseAND(mask).alias("g")).agg(F.sum("n").alias("n"), F.sum("n_target").alias("n_target")) if k < order \
            else grams.withColumnRenamed("gram", "g")
        level = level.withColumn("h", F.shiftright("g", BITS))
        ctx = level.groupBy("h").agg(F.sum("n").alias("c"), F.count(F.lit(1)).alias("t"), F.sum("n_target").alias("c_target"),
                                     F.sum((F.col("n_target") > 0).cast("long")).alias("t_target")).withColumnRenamed("h", "_h")
        level = level.join(ctx, level["h"] == ctx["_h"])
        if lower is None:
            level = level.withColumn("q", F.lit(uniform)).withColumn("q_target", F.lit(uniform))
        else:
            short = F.lit((1 << (BITS * (k - 1))) - 1)
            level = level.withColumn("s", F.col("g").bitwiseAND(short)).join(lower, F.col("s") == F.col("_g"))

        def mixed(n: str, c: str, t: str, q: str) -> Column:
            return F.when(F.col(c) > 0, (F.col(n) + F.col(t) * F.col(q)) / (F.col(c) + F.col(t))).otherwise(F.col(q))

        level = level.select("g", mixed("n", "c", "t", "q").alias("p"), mixed("n_target", "c_target", "t_target", "q_target").alias("p_target"))
        level = written(level, f"model-{k}")
        lower = level.select(F.col("g").alias("_g"), F.col("p").alias("q"), F.col("p_target").alias("q_target"))
    return level.select(F.col("g").alias("gram"), (-F.log("p")).cast("float").alias("loss"), (-F.log("p_target")).cast("float").alias("loss_target"))


def _score(order: int, answers: str):
    """Arrow function: tokens and summed losses of each text, from its slice's answers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, keys, loss, target = -1, *(np.empty(0) for _ in range(3))
        for b in batches:
            rows = []
            for this, lo, hi in _runs(b):
                if this != number:
                    number, (keys, loss, target) = this, of_slice(answers, this, ["gram", "loss", "loss_target"])
                for x in b.column("_text").slice(lo, hi - lo):
                    sums = [0, 0.0, 0.0]
                    for g in grams(x.as_py(), order):
                        at = np.searchsorted(keys, g)
                        sums = [sums[0] + len(at), sums[1] + float(loss[at].sum(dtype=np.float64)), sums[2] + float(target[at].sum(dtype=np.float64))]
                    rows.append(sums)
            yield pa.RecordBatch.from_arrays([b.column("_id"), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.float64()),
                                              pa.array([r[2] for r in rows], pa.float64())], names=["_id", "n_tokens", "loss", "loss_target"])
    return run


def cross_entropy_difference(docs: DataFrame, targets: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER,
                             slice_bytes: int = SLICE) -> DataFrame:
    """``_id``, ``n_tokens``, ``loss_target`` and ``loss_background`` (nats a token) and ``score``,
    their difference, of every row. ``targets`` has the target documents' ids in its first column."""
    if not 1 <= order <= 63 // BITS:
        raise ValueError(f"order must be 1 to {63 // BITS}")
    ids = targets.select(targets[targets.columns[0]].alias("_tid")).filter("_tid IS NOT NULL").distinct()
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = written(byte_rows(docs, id_col, text_col).mapInArrow(_numbered(slice_bytes), f"_id {id_type}, _row long, _slice long, _text binary"), "sliced")
    known = rows.select("_id", "_row", "_slice")
    flags = by_slices(known.join(ids, known["_id"] == ids["_tid"], "left_semi").select("_slice", "_row"), "_row", "targets")
    counts = rows.select("_row", "_slice", "_text").mapInArrow(_gram_counts(order, flags), "gram long, n long, n_target long")
    model = models(counts.groupBy("gram").agg(F.sum("n").alias("n"), F.sum("n_target").alias("n_target")), order)
    questions = rows.select("_slice", "_text").mapInArrow(_questions(order), "_slice long, gram long")
    answers = by_slices(questions.join(model, "gram").select("_slice", "gram", "loss", "loss_target"), "gram", "answers")
    scored = rows.select("_id", "_slice", "_text").mapInArrow(_score(order, answers), f"_id {id_type}, n_tokens long, loss double, loss_target double")
    return scored.select("_id", "n_tokens", (F.col("loss_target") / F.col("n_tokens")).alias("loss_target"), (F.col("loss") / F.col("n_tokens")).alias("loss_background"),
                         ((F.col("loss_target") - F.col("loss")) / F.col("n_tokens")).alias("score"))


def op9_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-entropy difference of every document between the documents labelled as good (one fold
    of the labels held out) and all documents."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    good = labels.filter((F.col("quality") == 1) & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)).select("doc_id")
    return cross_entropy_difference(docs, good).withColumnRenamed("_id", "doc_id")
