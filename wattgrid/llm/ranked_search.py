"""Ranked lexical search of many queries at once, with common subexpressions computed once.

Queries are a stated set of items, read in blocks of bounded size. Each item is the set of its
terms. Sets of terms that several items share are mined pair by pair: the pair of operands
held by most items becomes a node, takes their place in these items, and may itself be part
of further pairs. The result is a graph without cycles whose leaves are terms, whose inner
nodes are shared sets, and whose outputs are the items.

Documents are read once a block: each becomes its length and the counts of the block's
terms. For a batch of documents every node's partial accumulator (one partial score a
document) is added up once from its two operands, and every item adds the accumulators of its
own operands. All scores are integers, so sums over shared nodes are exact. A task
keeps the best k documents of each item and hands on no more than these.

Defined results: NULL or term-free texts belong to no count and match nothing; repeated rows
are documents of their own, with ranks next to each other; equal scores go by id, NULL ids
last. Item rows with the same id (NULL too) are one item with all their terms. Empty
tables give no rows. Ids are integers.
"""
from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import masked, place_of, table, written
from .words import PATTERN, byte_rows, folded, slices

BLOCK_ITEMS, BLOCK_TERMS = 1024, 65_536  # a block of items ends at either; an item with more terms is a block
NEAR = 16  # operands of an item are paired with so many that follow, most shared first
CELLS = 1 << 22  # of a batch's accumulators
MERGED = 64  # tasks whose lists meet before the last ranking
FOUND = "item_id long, score long, doc_id long, part int"


# ---------------------------------------------------------------- the queries

def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``_item`` and its distinct ``terms``, sorted."""
    rows = masked(items).select(F.col(place_of(items, id_col)).cast("long").alias("_item"), F.col(place_of(items, text_col)).alias("_text"))
    terms = F.expr(f"regexp_extract_all(_t, '{PATTERN.replace(chr(92), chr(92) * 2)}', 0)")
    each = rows.withColumn("_t", folded(F.col("_text"))).select("_item", F.explode(terms).alias("t")).distinct()
    return each.groupBy("_item").agg(F.sort_array(F.collect_list("t")).alias("terms"))


def blocks(terms: DataFrame) -> Iterator[list[tuple[int | None, list[str]]]]:
    """Items in order of their ids, a block at a time."""
    held, seen = [], set()
    for r in terms.orderBy("_item").toLocalIterator():
        if held and (len(held) >= BLOCK_ITEMS or len(seen.union(r["terms"])) > BLOCK_TERMS):
            yield held
            held, seen = [], set()
        held.append((r["_item"], r["terms"]))
        seen.update(r["terms"])
    if held:
        yield held


def shared_sets(items: list[list[int]], leaves: int) -> tuple[list[tuple[int, int]], list[list[int]]]:
    """Nodes (pairs of operands; node ``i`` is operand ``leaves + i``) and each item's operands.

    Every node stands in at least two items or nodes when it is made. Work follows the items'
    sizes: an operand is paired with ``NEAR`` that follow it, in the order of how many items hold them.
    """
    nodes: list[tuple[int, int]] = []
    held = [set(i) for i in items]
    while True:
        often = Counter(o for s in held for o in s)
        pairs = defaultdict(list)
        for i, s in enumerate(held):
            order = sorted((o for o in s if often[o] > 1), key=lambda o: (-often[o], o))
            for at, a in enumerate(order):
                for b in order[at + 1:at + 1 + NEAR]:
                    pairs[(a, b) if a < b else (b, a)].append(i)
        made = False
        for (a, b), where in sorted((p for p in pairs.items() if len(p[1]) > 1), key=lambda p: (-len(p[1]), p[0])):
            still = [i for i in where if a in held[i] and b in held[i]]
            if len(still) > 1:
                made = True
                for i in still:
                    held[i] -= {a, b}
                    held[i].add(leaves + len(nodes))
                nodes.append((a, b))
        if not made:
            return nodes, [sorted(s) for s in held]


# ---------------------------------------------------------------- the documents

def _postings(vocabulary: dict[bytes, int]):
    """Length and the vocabulary's terms with their counts, of every document with any term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.keys()
        for b in batches:
            ids, n, starts, terms, counts = [], [], [0], [], []
            for doc, text in zip(b.column("_id").to_pylist(), b.column("_text")):
                size, own = 0, Counter()
                for words in slices(text.as_py()):
                    size += len(words)
                    every = Counter(words)
                    for w in every.keys() & known:
                        own[vocabulary[w]] += every[w]
                if size:
                    ids.append(doc)
                    n.append(size)
                    terms.extend(own.keys())
                    counts.extend(own.values())
                    starts.append(len(terms))
            at = pa.array(starts, pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.ListArray.from_arrays(at, pa.array(terms, pa.int32())),
                                              pa.ListArray.from_arrays(at, pa.array(counts, pa.int64()))], names=["_id", "_len", "_terms", "_counts"])
    return run


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def saturation(length: np.ndarray, n: int, total: int) -> np.ndarray:
    """A document's ``m`` by its length; products beyond 64 bits are counted in full."""
    if int(length.max()) * 50 * n < 2 ** 63:
        return 50 + length * (50 * n) // total
    return np.array([50 + 50 * v * n // total for v in length.tolist()], np.int64)


class Best:
    """The best ``k`` documents of one item so far."""

    def __init__(self, k: int):
        self.k, self.mark = k, 1
        self.score, self.doc, self.null = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    def add(self, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        pick = np.flatnonzero(score >= self.mark)
        if len(pick):
            score, doc, null = (np.concatenate([a, b[pick]]) for a, b in ((self.score, score), (self.doc, doc), (self.null, null)))
            order = np.lexsort((doc, null, -score))[:self.k]
            self.score, self.doc, self.null = score[order], doc[order], null[order]
            if len(order) == self.k:
                self.mark = int(self.score[-1])


def _rank(item_ids: list, operands: list[list[int]], nodes: list[tuple[int, int]], weights: np.ndarray, n: int, total: int, k: int):
    """The best ``k`` documents of each item among a task's postings."""
    leaves = len(weights)

    def scores(terms: np.ndarray, counts: np.ndarray, doc: np.ndarray, m: np.ndarray, acc: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        acc[:leaves] = 0
        acc[terms, doc] = weights[terms] * (1_000_000_000 * counts // (1000 * counts + 20 * m[doc]))
        for j, (a, b) in enumerate(nodes):
            np.add(acc[a], acc[b], out=acc[leaves + j])
        for i, own in enumerate(operands):
            yield i, acc[own].sum(0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in item_ids]
        step = max(1, min(2048, CELLS // (leaves + len(nodes))))
        acc = np.zeros((leaves + len(nodes), step), np.int64)
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                b = whole.slice(at, step)
                m = saturation(b.column("_len").to_numpy(), n, total)
                doc = np.repeat(np.arange(b.num_rows), pc.list_value_length(b.column("_terms")).to_numpy())
                terms, counts = b.column("_terms").flatten().to_numpy(), b.column("_counts").flatten().to_numpy()
                ids, null = pc.fill_null(b.column("_id"), 0).to_numpy(), b.column("_id").is_null().to_numpy(zero_copy_only=False)
                for i, score in scores(terms, counts, doc, m, acc):
                    best[i].add(score[:b.num_rows], ids, null)
        part = TaskContext.get().partitionId() // MERGED
        for item, kept in zip(item_ids, best):
            if len(kept.score):
                c = len(kept.score)
                yield pa.RecordBatch.from_arrays([pa.array([item] * c, pa.int64()), pa.array(kept.score), pa.array(kept.doc, mask=kept.null),
                                                  pa.array([part] * c, pa.int32())], names=["item_id", "score", "doc_id", "part"])
    return run


def _best(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score``: the ``k`` best documents of every item with scores above 0."""
    spark = docs.sparkSession
    rows = byte_rows(docs, id_col, text_col).withColumn("_id", F.col("_id").cast("long"))
    out = None
    for block in blocks(written(item_terms(items, item_col, item_text_col), "items")):
        vocabulary = {t: i for i, t in enumerate(sorted({t.encode() for _, terms in block for t in terms}))}
        posted = written(rows.mapInArrow(_postings(vocabulary), "_id long, _len long, _terms array<int>, _counts array<long>"), "postings")
        size = posted.agg(F.count(F.lit(1)).alias("n"), F.sum("_len").cast("long").alias("l")).first()
        if not size["n"]:
            break
        df = np.zeros(len(vocabulary), np.int64)
        for r in posted.select(F.explode("_terms").alias("t")).groupBy("t").count().collect():  # a block's terms at most
            df[r["t"]] = r["count"]
        weights = np.array([weight(size["n"], int(d)) for d in df], np.int64)
        nodes, operands = shared_sets([[vocabulary[t.encode()] for t in terms] for _, terms in block], len(vocabulary))
        found = posted.mapInArrow(_rank([i for i, _ in block], operands, nodes, weights, size["n"], size["l"], k), FOUND)
        # lists of neighbouring tasks meet first, so the last ranking of an item sees a small share of them
        found = _best(_best(found, ["item_id", "part"], k).drop("rank"), ["item_id"], k)
        found = written(found.select("item_id", "rank", "doc_id", "score"), "ranked")
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long") if out is None else out


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    return search(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text"))


_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLE_SQL = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents WHERE text IS NOT NULL),
size AS (SELECT doc_id, len(ws) AS n FROM d WHERE len(ws) > 0),
corpus AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM size),
item AS (SELECT DISTINCT item_id, unnest({_WORDS}) AS t FROM benchmark),
tf AS (SELECT doc_id, t, count(*)::BIGINT AS tf FROM (SELECT doc_id, unnest(ws) AS t FROM d) WHERE t IN (SELECT t FROM item) GROUP BY doc_id, t),
w AS (SELECT t, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM (SELECT t, count(*) AS df FROM tf GROUP BY t), corpus),
part AS (SELECT doc_id, t, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))) AS s FROM tf JOIN w USING (t) JOIN size USING (doc_id), corpus),
score AS (SELECT item_id, doc_id, sum(s)::BIGINT AS score FROM item JOIN part USING (t) GROUP BY item_id, doc_id HAVING sum(s) > 0)
SELECT item_id, rank, doc_id, score FROM (
  SELECT *, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank FROM score) WHERE rank <= 50
"""
