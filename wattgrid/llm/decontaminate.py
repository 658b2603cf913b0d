"""Benchmark decontamination with suffix arrays over the training texts.

Every task cuts its documents into shards of a bounded number of words and builds a suffix array
of each: positions sorted by the words that follow them (sorting by packed first words, then
by doubling where these tie). Each suffix of every test item is searched in it by bisection:
first by its window (10 words, or the whole item if shorter), which gives all places where the window occurs, then
in full, which gives its longest verbatim match and where that is. Words that no
item holds cannot be part of a match; they end runs, and runs shorter than the shortest window
are left out of the array.

Test items are read in blocks of bounded size from the shared folder, whatever their number.
Shards end where documents end; a document of more words than a shard is cut into pieces that
overlap by the longest item, so no match is lost at a cut. Documents are neither shuffled nor
cut short; results are spans of words per document, the items found in it, and per test suffix
the longest match over all shards.

Defined results: NULL and empty texts have no words and are never contaminated; items without words
or without an id take no part; repeated item rows count once, several texts under one id are one item;
repeated documents each have a row; of equal longest matches the one with the smallest id
(NULL last), then the smallest place is named.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held, keep_rows, masked, place_of, scratch, table, text_rows, written
from .token_records import place
from .words import slices

WINDOW = 10
SHARD = 1 << 20  # words of a suffix array
MOST = 1 << 16  # documents of a shard, however short
BLOCK = 1 << 20  # words of a block of test items; a longer item is a block of its own


# ---------------------------------------------------------------- test items

class Block:
    """Test items as word numbers, and their suffixes that can hold a window."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.ids = [i for i, _ in items]
        self.numbers: dict[bytes, int] = {}
        for _, words in items:
            for w in words:
                self.numbers.setdefault(w, len(self.numbers) + 1)
        self.bits = (len(self.numbers) + 1).bit_length()
        self.width = 63 // self.bits  # words that fit a first sort key
        sizes = np.array([len(words) for _, words in items], np.int64)
        self.longest, self.shortest = int(sizes.max()), int(min(window, sizes.min()))
        # items one after another, a zero after each
        self.words = np.zeros(int(sizes.sum()) + len(items), np.int32)
        start = 0
        for (_, words), size in zip(items, sizes.tolist()):
            self.words[start:start + size] = [self.numbers[w] for w in words]
            start += size + 1
        span = np.minimum(sizes, window)
        count = sizes - span + 1  # windows of each item
        self.item = np.repeat(np.arange(len(items)), count)
        self.offset = _ranges(np.zeros(len(items), np.int64), count)
        begin = np.cumsum(sizes + 1) - sizes - 1
        self.at = begin[self.item] + self.offset
        self.span = span[self.item]
        self.rest = sizes[self.item] - self.offset

    def number(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.numbers.get, words, repeat(0)), np.int32, len(words))


def _ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``start, start + 1, ...`` (``count`` of them) for each pair, one after another."""
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - count, count) + np.repeat(start, count)


class Blocks:
    """The blocks of a folder of test items; a single block is kept."""

    def __init__(self, folder: str, window: int):
        self.folder, self.window, self.only = folder, window, None

    def _items(self) -> Iterator[tuple[str, list[bytes]]]:
        fs, top = place(self.folder)
        for path in sorted(f.path for f in fs.get_file_info(pafs.FileSelector(top)) if f.path.endswith(".parquet")):
            with fs.open_input_file(path) as f:
                for b in pq.ParquetFile(f).iter_batches(256):
                    for i, text in zip(b.column("_item").to_pylist(), b.column("_text").to_pylist()):
                        words = [w for s in slices(text) for w in s]
                        if words:
                            yield i, words

    def __iter__(self) -> Iterator[Block]:
        if self.only is not None:
            yield from self.only
            return
        part, size, made = [], 0, []
        for i, words in self._items():
            if part and size + len(words) > BLOCK:
                made.append(None)
                yield Block(part, self.window)
                part, size = [], 0
            part.append((i, words))
            size += len(words)
        last = [Block(part, self.window)] if part else []
        if not made:
            self.only = last
        yield from last


# ---------------------------------------------------------------- suffix arrays

@dataclass
class SuffixArray:
    """Sorted suffixes of runs of numbered words. ``text`` holds the runs with zeros after them, ``source``
    the places of its words before others were left out."""
    text: np.ndarray
    source: np.ndarray
    order: np.ndarray
    keys: np.ndarray
    bits: int
    width: int


def _packed(text: np.ndarray, at: np.ndarray, words: np.ndarray | int, bits: int, width: int) -> np.ndarray:
    """The first ``words`` (at most ``width``) words at ``at`` in one integer; nothing after a zero counts."""
    key = np.zeros(len(at), np.int64)
    alive = np.ones(len(at), bool)
    last = len(text) - 1
    for j in range(width):
        w = text[np.minimum(at + j, last)]
        alive &= (w != 0) & (j < words)
        key = (key << bits) | np.where(alive, w, 0)
    return key


def suffix_array(numbers: np.ndarray, shortest: int, bits: int, width: int) -> SuffixArray:
    """Sort all suffixes that start in runs of at least ``shortest`` words other than zero."""
    zeros = np.concatenate([[-1], np.flatnonzero(numbers == 0), [len(numbers)]])
    start, size = zeros[:-1] + 1, np.diff(zeros) - 1
    good = size >= max(1, shortest)
    start, size = start[good], size[good]
    source = _ranges(start, size + 1)  # each run and the place after it
    text = np.append(numbers, np.int32(0))[source]
    text = np.append(text, np.int32(0))
    ends = np.cumsum(size + 1) - 1
    rest = np.repeat(ends, size + 1) - np.arange(len(source))  # words to the run's end
    at = np.flatnonzero(rest > 0)
    keys = _packed(text, at, width, bits, width)
    order = np.argsort(keys, kind="stable")
    sa, keys = at[order], keys[order]
    rank = np.zeros(len(text), np.int64)
    rest = np.append(rest, 0)
    n = len(sa)
    first = np.ones(n, bool)  # a suffix that differs from the one before it in what is compared so far
    first[1:] = keys[1:] != keys[:-1]
    group = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    rank[sa] = group + 1
    tied = np.flatnonzero(~first | ~np.append(first[1:], True))
    far = width
    while True:
        tied = tied[rest[sa[tied]] >= far]  # shorter ones are equal to their end
        if not len(tied):
            return SuffixArray(text, source, sa, keys, bits, width)
        here = sa[tied]
        key = rank[here] * (n + 1) + rank[here + far]
        o = np.argsort(key, kind="stable")
        here, key = here[o], key[o]
        sa[tied] = here  # ties are sorted within their own group's places
        new = np.ones(len(tied), bool)
        new[1:] = key[1:] != key[:-1]
        # places in the array, so ranks of groups never tied stay comparable
        rank[here] = np.maximum.accumulate(np.where(new, tied, 0)) + 1
        tied = tied[~new | ~np.append(new[1:], True)]
        far *= 2


def _common(a: SuffixArray, at: np.ndarray, words: np.ndarray, suffix: np.ndarray, upto: np.ndarray, known: int) -> np.ndarray:
    """Length of the common prefix of array suffixes ``at`` and test suffixes, at most ``upto``; ``known`` words are equal."""
    length = np.full(len(at), known, np.int64)
    live = np.flatnonzero(length < upto)
    while len(live):
        same = a.text[at[live] + length[live]] == words[suffix[live] + length[live]]
        live = live[same]
        length[live] += 1
        live = live[length[live] < upto[live]]
    return length


def _bound(a: SuffixArray, words: np.ndarray, suffix: np.ndarray, upto: np.ndarray, low: np.ndarray, high: np.ndarray, known: int, after: bool) -> np.ndarray:
    """Bisection for each test suffix between ``low`` and ``high``, whose suffixes share its first ``known`` words:
    the first array suffix that is not smaller than its first ``upto`` words (``after``: that is greater)."""
    low, high = low.copy(), high.copy()
    live = np.flatnonzero(low < high)
    while len(live):
        mid = (low[live] + high[live]) // 2
        at, s, u = a.order[mid], suffix[live], upto[live]
        length = _common(a, at, words, s, u, known)
        same = length >= u
        step = np.where(same, 0, length)
        less = np.where(same, after, a.text[at + step] < words[s + step])
        low[live] = np.where(less, mid + 1, low[live])
        high[live] = np.where(less, high[live], mid)
        live = live[low[live] < high[live]]
    return low


def occurrences(a: SuffixArray, words: np.ndarray, suffix: np.ndarray, upto: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Interval of the array whose suffixes begin with the first ``upto`` words of each test suffix."""
    first = np.minimum(upto, a.width)
    key = _packed(words, suffix, first, a.bits, a.width)
    low = np.searchsorted(a.keys, key, "left")
    high = np.searchsorted(a.keys, key + (np.int64(1) << (a.bits * (a.width - first))), "left")
    more = np.flatnonzero((upto > a.width) & (low < high))
    if len(more):
        args = (a, words, suffix[more], upto[more], low[more], high[more], a.width)
        low[more], high[more] = _bound(*args, False), _bound(*args, True)
    return low, high


def longest(a: SuffixArray, words: np.ndarray, suffix: np.ndarray, rest: np.ndarray, low: np.ndarray, high: np.ndarray, known: int) -> np.ndarray:
    """Length of each test suffix's longest match within its (not empty) interval of suffixes that share ``known`` words."""
    place_ = _bound(a, words, suffix, rest, low, high, known, False)
    best = np.full(len(suffix), known, np.int64)
    for near, ok in ((place_ - 1, place_ > low), (place_, place_ < high)):
        i = np.flatnonzero(ok)
        best[i] = np.maximum(best[i], _common(a, a.order[near[i]], words, suffix[i], rest[i], known))
    return best


# ---------------------------------------------------------------- a task's documents

@dataclass
class Document:
    """What is known of a document: its row's identity, words, hit spans, and items."""
    key: tuple
    words: int = 0
    spans: list = field(default_factory=list)
    items: set = field(default_factory=set)

    def merged(self) -> list[tuple[int, int]]:
        out: list[tuple[int, int]] = []
        for s, e in sorted(self.spans):
            if out and s <= out[-1][1]:
                out[-1] = (out[-1][0], max(e, out[-1][1]))
            else:
                out.append((s, e))
        return out


class Shard:
    """Pieces of documents, one after another with a mark between them, up to a number of words."""

    def __init__(self):
        self.words: list[bytes] = []
        self.docs: list[Document] = []
        self.start: list[int] = []  # place of a piece's first word
        self.skip: list[int] = []   # words of its document before it
        self.own: list[int] = []    # its words that are not read again in the next piece

    def add(self, doc: Document, words: list[bytes], skip: int, own: int) -> None:
        self.start.append(len(self.words))
        self.docs.append(doc)
        self.skip.append(skip)
        self.own.append(own)
        self.words += words
        self.words.append(b"")

    def search(self, block: Block) -> Iterator[tuple]:
        """Mark hits in the documents; yield ``item, offset, length, doc key, place`` of the longest matches."""
        a = suffix_array(block.number(self.words), block.shortest, block.bits, block.width)
        if not len(a.order):
            return
        low, high = occurrences(a, block.words, block.at, block.span)
        found = np.flatnonzero(low < high)
        if not len(found):
            return
        start = np.array(self.start)
        # equal windows of several suffixes have one interval
        windows, which = np.unique(np.stack([low[found], high[found], block.span[found]], 1), axis=0, return_inverse=True)
        size = windows[:, 1] - windows[:, 0]
        at = a.source[a.order[_ranges(windows[:, 0], size)]]
        window = np.repeat(np.arange(len(windows)), size)
        self._spans(at, windows[window, 2], start)
        # documents and windows, each pair once, then the items of each window
        pairs = np.unique((np.searchsorted(start, at, "right") - 1) * len(windows) + window)
        holds = np.unique(which.ravel() * len(block.ids) + block.item[found])
        of, item = holds // len(block.ids), holds % len(block.ids)
        begin, count = np.searchsorted(of, np.arange(len(windows))), np.bincount(of, minlength=len(windows))
        doc, w = pairs // len(windows), pairs % len(windows)
        both = np.unique(np.repeat(doc, count[w]) * len(block.ids) + item[_ranges(begin[w], count[w])])
        for d, i in zip((both // len(block.ids)).tolist(), (both % len(block.ids)).tolist()):
            self.docs[d].items.add(block.ids[i])
        yield from self._longest(a, block, found, low, high, start)

    def _spans(self, at: np.ndarray, size: np.ndarray, start: np.ndarray) -> None:
        edge = np.zeros(len(self.words) + 1, np.int64)
        np.add.at(edge, at, 1)
        np.add.at(edge, at + size, -1)
        hit = np.diff(np.concatenate([[0], (np.cumsum(edge) > 0).astype(np.int8)]))
        for s, e in zip(np.flatnonzero(hit > 0).tolist(), np.flatnonzero(hit < 0).tolist()):
            d = int(np.searchsorted(start, s, "right")) - 1
            self.docs[d].spans.append((s - self.start[d] + self.skip[d], e - self.start[d] + self.skip[d]))

    def _longest(self, a: SuffixArray, block: Block, found: np.ndarray, low: np.ndarray, high: np.ndarray, start: np.ndarray) -> Iterator[tuple]:
        suffix, rest = block.at[found], block.rest[found]
        best = longest(a, block.words, suffix, rest, low[found], high[found], block.shortest)
        low, high = occurrences(a, block.words, suffix, best)
        # places in the order of ids, then of words; those that the next piece reads whole come last
        by_id = sorted(range(len(self.docs)), key=lambda d: (self.docs[d].key[0] is None, self.docs[d].key[0] or 0, self.skip[d]))
        order = np.empty(len(by_id), np.int64)
        order[by_id] = np.arange(len(by_id))
        of = np.searchsorted(start, a.source[a.order], "right") - 1
        far = a.source[a.order] - start[of]
        first = np.where(far < np.array(self.own)[of], order[of] * (len(self.words) + 1) + far, np.iinfo(np.int64).max)
        known: dict[tuple[int, int], int] = {}
        for f, lo, hi, length in zip(found.tolist(), low.tolist(), high.tolist(), best.tolist()):
            code = known.get((lo, hi))
            if code is None:
                code = known[lo, hi] = int(first[lo:hi].min())
            if code < np.iinfo(np.int64).max:
                d = by_id[code // (len(self.words) + 1)]
                yield (block.ids[block.item[f]], int(block.offset[f]), length, self.docs[d].key[0], code % (len(self.words) + 1) + self.skip[d])


def _scan(folder: str, window: int, shard_words: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = held(("decontaminate", folder, window), lambda: Blocks(folder, window))
        overlap = max((b.longest for b in blocks), default=1) - 1
        shard = Shard()
        done: list[Document] = []

        def batch(docs: list[Document], matches: list[tuple]) -> pa.RecordBatch:
            spans = [d.merged() for d in docs]
            none, rows, more = [None] * len(matches), len(docs), [None] * len(docs)
            cols = [[i for i in [d.key[0] for d in docs] + [m[3] for m in matches]],
                    [d.key[1] for d in docs] + none, [d.key[2] for d in docs] + none, [d.words for d in docs] + none,
                    [sum(e - s for s, e in sp) for sp in spans] + none, [sorted(d.items) for d in docs] + none,
                    [[{"start": s, "end": e} for s, e in sp] for sp in spans] + none,
                    *([*more, *(m[c] for m in matches)] for c in (0, 1, 2, 4)), [False] * rows + [True] * len(matches)]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

        def searched() -> Iterator[pa.RecordBatch]:
            nonlocal shard
            matches = [m for block in blocks for m in shard.search(block)] if shard.words else []
            shard = Shard()
            if matches or done:
                yield batch(done, matches)
                done.clear()

        for b in batches:
            for key, text in zip(zip(*(b.column(c).to_pylist() for c in ("_id", "_x", "_n"))), b.column("_text")):
                doc = Document(key)
                piece: list[bytes] = []
                skip = 0
                for words in slices(text.as_py()):
                    piece += words
                    doc.words += len(words)
                    while len(piece) > shard_words + overlap:  # more follows: what overlaps is read again
                        shard.add(doc, piece[:shard_words + overlap], skip, shard_words)
                        yield from searched()
                        piece = piece[shard_words:]
                        skip += shard_words
                if piece:
                    shard.add(doc, piece, skip, len(piece))
                done.append(doc)
                if len(shard.words) >= shard_words or len(done) >= MOST:
                    yield from searched()
        yield from searched()
    return run


SCANNED = ("_x long, _n long, n_words long, n_hit long, items array<string>, spans array<struct<start:long,end:long>>, "
           "item string, position long, length long, place long, _match boolean")


def scan(docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text", shard_words: int = SHARD) -> DataFrame:
    """Written result of the search, for ``documents`` and ``matches``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    folder = scratch(docs.sparkSession, "items")
    (masked(items).select(F.col(place_of(items, item_col)).cast("string").alias("_item"), F.col(place_of(items, item_text_col)).cast("binary").alias("_text"))
     .filter("_item IS NOT NULL AND _text IS NOT NULL").distinct().write.parquet(folder))
    rows = text_rows(docs, id_col, text_col).withColumn("_text", F.col("_text").cast("binary"))
    schema = StructType([rows.schema["_id"], *StructType.fromDDL(SCANNED).fields])
    return written(rows.mapInArrow(_scan(folder, window, shard_words, to_arrow_schema(schema)), schema), "decontaminated")


def documents(found: DataFrame) -> DataFrame:
    """A row for every document: ``_id``, ``n_words``, ``n_hit``, ``items`` (sorted), ``spans`` of hit words (end excluded)."""
    return found.filter("NOT _match").select("_id", "_x", "_n", "n_words", "n_hit", "items", "spans")


def matches(found: DataFrame) -> DataFrame:
    """For every test suffix that begins with a window found anywhere: ``item``, ``position`` of its first word,
    ``length`` of its longest verbatim match in words, and where that begins: ``doc_id``, ``place``."""
    first = F.struct((-F.col("length")).alias("l"), F.col("_id").isNull().alias("u"), F.col("_id").alias("d"), F.col("place").alias("p"))
    best = found.filter("_match").groupBy("item", "position").agg(F.min(first).alias("b"))
    return best.select("item", "position", (-F.col("b.l")).alias("length"), F.col("b.d").alias("doc_id"), F.col("b.p").alias("place"))


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without any window of ``items``."""
    found = documents(scan(docs, items, id_col=id_col, text_col=text_col, **options))
    return keep_rows(docs, found.select("_id", "_x", "_n", (F.col("n_hit") == 0).alias("_kept")), id_col, text_col)


def _digest(items: str) -> Column:
    return F.sha2(F.array_join(items, ",").cast("binary"), 256)


def op12_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document, those that repeat 10 consecutive words of ``benchmark`` items, and these items."""
    found = documents(scan(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text")))
    return found.select(F.col("_id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        _digest("items").alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLE_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce({_WORDS}, []) AS ws FROM documents),
b AS (SELECT item_id, {_WORDS} AS ws FROM benchmark WHERE item_id IS NOT NULL),
w AS (SELECT item_id, least(10, len(ws)) AS k, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS i, ws FROM b WHERE len(ws) > 0),
win AS (SELECT DISTINCT item_id, k, array_to_string(ws[i:i + k - 1], ' ') AS g FROM w),
spot AS (SELECT doc_id, k, unnest(range(1, len(ws) - k + 2)) AS i, ws FROM d, (SELECT DISTINCT k FROM win) WHERE len(ws) >= k),
hit AS (SELECT doc_id, item_id, s.k, i FROM (SELECT doc_id, k, i, array_to_string(ws[i:i + k - 1], ' ') AS g FROM spot) AS s JOIN win ON s.k = win.k AND s.g = win.g),
place AS (SELECT doc_id, count(DISTINCT p)::BIGINT AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY doc_id),
item AS (SELECT doc_id, count(*)::BIGINT AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS s FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN place USING (doc_id) LEFT JOIN item USING (doc_id)
"""
