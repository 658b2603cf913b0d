"""Toxicity by a subsequence string kernel, Nyström landmarks and a linear SVM.

Two words are alike by the sequences of ``LENGTH`` letters they share in order, gaps
allowed: each occurrence counts ``DECAY`` to the power of the letters it skips, over at most
``SPAN`` letters. So an insult with a letter put in, left apart or changed stays close to
itself. Words are scaled by their length alone. The kernel's feature map is approximated
on landmark words (``K(x, Z) K(Z, Z)^-1/2``) and a squared-hinge SVM is trained there. Its decision
is a combination of the landmarks' own features, so scoring needs one weight for each
letter sequence and costs the same for any number of landmarks.

Labels belong to documents; the SVM's rows are words of the sampled documents, not sentences,
and a document scores by its two strongest words. Positives
are the words found in toxic documents beyond chance, weighed by that excess; negatives are
words that mark nothing and, round by round, the strongest words of clean documents.
Words are compared by their letters: marks, digits in the place of letters and accents are
folded, and letters set apart by blanks are also read as one word.

Learning is on a bounded sample (``SAMPLE`` documents of each label, those with the
smallest hashes of their ids); the driver sees only bounded lists of words and two numbers
per sampled document. Defined results: NULL and empty texts have no word and score like a
word without letters; NULL labels and ids teach nothing; a document labelled both ways is
left out; without documents of both labels every score is 0.
"""
from __future__ import annotations

import itertools
import math
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import IDENTITY, held, masked, place_of, ship, table, text_rows, written

LENGTH = 4  # letters of a subsequence
SPAN = 7  # letters it may reach over
DECAY = 0.5
SAMPLE = 3000  # documents of each label to learn from, at most
MARKS = 4000  # words that mark toxic documents, at most
LANDMARKS = 96  # of words that mark toxic documents; half as many of common words
POOL = 6000  # clean words among the negatives from the start; a third as many common ones
ROUNDS = 4
LONG = 200  # longer words are not remembered
REACH = 1.5  # decisions count up to here; the margin is 1
WORDS = 150_000  # words in a generation of a worker's memory

# Digits and signs that stand for letters inside a word.
LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})
EDGE = re.compile(r"^[\W_]+|[\W_]+$")
SENTENCE = re.compile(r"[.!?\n]+(?=\s|$)|\n")
BOUND, OTHER = 27, 28
PATTERNS = [(0, *p) for p in itertools.combinations(range(1, SPAN), LENGTH - 1)]
WEIGHTS = [DECAY ** (p[-1] + 1 - LENGTH) for p in PATTERNS]
KEYS = 1 << (5 * LENGTH)


def letters(word: str) -> str:
    """The word's letters: lower case, without accents, signs inside it read as letters."""
    if not (word.isascii() and word.isalpha()):
        word = EDGE.sub("", word)
        if not word:
            return ""
        if not word.isalpha() and any(c.isalpha() for c in word):
            word = word.translate(LEET)
        if not word.isascii():
            word = unicodedata.normalize("NFKD", word)
        word = "".join(filter(str.isalpha, word))
    return word.lower()


def words(text: str) -> list[str]:
    """The blank-separated parts of a text; runs of three and more single letters, not all the
    same, also as one word."""
    parts = text.split()
    if len({p for p in set(parts) if len(p) == 1 and p.isalpha()}) < 2:
        return parts
    run, extra = [], []
    for p in [*parts, ""]:
        if len(p) == 1 and p.isalpha():
            run.append(p)
        else:
            if len(run) > 2 and len(set(run)) > 1:
                extra.append("".join(run))
            run = []
    return parts + extra


def _codes(forms: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letter codes of all words on one line, a boundary on either side and zeros between; starts."""
    gap = "\x00" * (SPAN - 1)
    line = gap.join(f"\x1b{w}\x1b" for w in forms) + gap
    a = np.frombuffer(line.encode("utf-32-le"), "<u4").astype(np.int64)
    code = np.where((a >= 97) & (a <= 122), a - 96, np.where(a == 0x1b, BOUND, np.where(a == 0, 0, OTHER + a % 4)))
    sizes = np.fromiter((len(w) + 2 + len(gap) for w in forms), np.int64, len(forms))
    return code, np.concatenate((np.zeros(1, np.int64), np.cumsum(sizes)[:-1]))


def _scales(forms: list[str]) -> np.ndarray:
    """One over the root of the summed squared weights a word of that length has."""
    def size(n: int) -> float:
        return sum(w * w * max(0, n - p[-1]) for p, w in zip(PATTERNS, WEIGHTS))
    known = {n: 1 / math.sqrt(size(n)) if size(n) else 0.0 for n in {len(f) + 2 for f in forms}}
    return np.array([known[len(f) + 2] for f in forms])


def sequences(forms: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, float, np.ndarray]]:
    """For each gap pattern: keys of letter sequences at every place, whether one is there, its weight; starts."""
    code, starts = _codes(forms)
    n = len(code)
    padded = np.concatenate((code, np.zeros(SPAN, np.int64)))
    for p, w in zip(PATTERNS, WEIGHTS):
        cols = [padded[o:o + n] for o in p]
        there = cols[0] > 0
        key = cols[0]
        for c in cols[1:]:
            there = there & (c > 0)
            key = key << 5 | c
        yield key, there, w, starts


def decide(forms: list[str], weights: np.ndarray, bias: float) -> np.ndarray:
    """SVM decision of each word, from one weight per letter sequence."""
    if not forms:
        return np.zeros(0)
    total, starts = None, None
    for key, there, w, starts in sequences(forms):
        part = np.where(there, weights[np.where(there, key, 0)], 0) * w
        total = part if total is None else total + part
    return np.add.reduceat(total, starts) * _scales(forms) + bias


def features(forms: list[str]) -> list[dict[int, float]]:
    """Explicit feature maps of a few words."""
    out: list[dict[int, float]] = [{} for _ in forms]
    for key, there, w, starts in sequences(forms):
        at = np.flatnonzero(there)
        for i, k in zip((np.searchsorted(starts, at, "right") - 1).tolist(), key[at].tolist()):
            out[i][k] = out[i].get(k, 0.0) + w
    return [{k: v * s for k, v in f.items()} for f, s in zip(out, _scales(forms))]


class Landmarks:
    """Kernel values of any words with the landmarks, and the Nyström map."""

    def __init__(self, forms: list[str]):
        self.forms, self.maps = forms, features(forms)
        keys = sorted({k for m in self.maps for k in m})
        self.row = np.full(KEYS, -1, np.int64)
        self.row[keys] = np.arange(len(keys))
        self.keys = np.array(keys, np.int64)
        self.matrix = np.zeros((len(keys) + 1, len(forms)))
        for j, m in enumerate(self.maps):
            for k, v in m.items():
                self.matrix[self.row[k], j] = v
        kzz = self.matrix.T @ self.matrix
        val, vec = np.linalg.eigh(kzz)
        inv = np.where(val > 1e-6 * max(val.max(), 1e-12), 1 / np.sqrt(np.maximum(val, 1e-12)), 0)
        self.whiten = vec * inv @ vec.T

    def kernel(self, forms: list[str]) -> np.ndarray:
        out = np.zeros((len(forms), len(self.forms)))
        for lo in range(0, len(forms), 4000):
            some = forms[lo:lo + 4000]
            for key, there, w, starts in sequences(some):
                at = np.flatnonzero(there)
                row = self.row[key[at]]
                ok = row >= 0
                np.add.at(out, lo + np.searchsorted(starts, at[ok], "right") - 1, self.matrix[row[ok]] * w)
        return out * _scales(forms)[:, None] if forms else out

    def map(self, forms: list[str]) -> np.ndarray:
        return self.kernel(forms) @ self.whiten

    def weights(self, w: np.ndarray) -> np.ndarray:
        """One weight per letter sequence: the decision ``w`` in the landmarks' own features."""
        out = np.zeros(KEYS, np.float32)
        out[self.keys] = self.matrix[:-1] @ (self.whiten @ w)
        return out


def svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float) -> tuple[np.ndarray, float]:
    """Squared-hinge linear SVM by Newton steps on the rows inside the margin."""
    a = np.hstack((x, np.ones((len(x), 1))))
    ridge = np.ones(a.shape[1])
    ridge[-1] = 1e-6
    w = np.zeros(a.shape[1])

    def cost(w: np.ndarray) -> float:
        m = np.maximum(0, 1 - y * (a @ w))
        return 0.5 * float(ridge @ (w * w)) + c * float(weight @ (m * m))

    now = cost(w)
    for _ in range(40):
        inside = y * (a @ w) < 1
        s, cw = a[inside], c * weight[inside]
        h = np.diag(ridge) + 2 * (s * cw[:, None]).T @ s
        step = np.linalg.solve(h, 2 * s.T @ (cw * y[inside]) - 2 * (s * cw[:, None]).T @ (s @ w) - ridge * w)
        t = 1.0
        while t > 1e-4 and cost(w + t * step) > now:
            t /= 2
        after = cost(w + t * step)
        if now - after <= 1e-7 * max(now, 1):
            break
        w, now = w + t * step, after
    return w[:-1], float(w[-1])


def platt(f: np.ndarray, y: np.ndarray, share: float) -> tuple[float, float]:
    """``a, b`` of ``1 / (1 + exp(-(a f + b)))``; ``share`` of all labelled documents are toxic."""
    w = np.where(y > 0, share / max(1, (y > 0).sum()), (1 - share) / max(1, (y <= 0).sum()))
    x, t, r, p = np.stack((f, np.ones(len(f)))).T, (y > 0).astype(float), np.array([1e-4, 1e-8]), np.zeros(2)
    for _ in range(100):
        q = 1 / (1 + np.exp(-np.clip(x @ p, -30, 30)))
        step = np.linalg.solve((x * (w * q * (1 - q))[:, None]).T @ x + np.diag(r), x.T @ (w * (t - q)) - r * p)
        p = p + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return max(float(p[0]), 1e-6), float(p[1])


class Scorer:
    """Strongest words of texts under one model; words met before are remembered."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, bias: float):
        self.weights = np.zeros(KEYS, np.float32)
        self.weights[keys] = values
        self.bias, self.memo, self.old = bias, {}, {}

    def learn(self, words: set[str]) -> None:
        """Decisions of words not met lately: taken over from the generation before, or made."""
        known = self.old.keys() & words
        self.memo.update({w: self.old[w] for w in known})
        new = list(words - known)
        for lo in range(0, len(new), 20_000):
            some = new[lo:lo + 20_000]
            self.memo.update(zip(some, decide([letters(w) for w in some], self.weights, self.bias).tolist()))

    def strongest(self, text: str) -> tuple[float, float, str]:
        """The two highest word decisions in the text, and the first one's letters."""
        if len(self.memo) > WORDS:
            self.old, self.memo = self.memo, {}
        parts = words(text)
        if not parts:
            return self.bias, self.bias, ""
        new = set(parts).difference(self.memo)
        if new:
            self.learn(new)
        scores = list(map(self.memo.__getitem__, parts))
        top = max(scores)
        at = scores.index(top)
        scores[at] = -math.inf
        for w in new:
            if len(w) > LONG:
                del self.memo[w]
        return top, max(max(scores), self.bias), letters(parts[at])

    def sentences(self, text: str) -> list[tuple[float, str]]:
        """Every sentence with its score."""
        return [(self.strongest(s)[0], s) for s in SENTENCE.split(text) if s and s.strip()]


def _scorer(keys: bytes, values: bytes, bias: float) -> Scorer:
    return held(("toxicity", keys, values, bias), lambda: Scorer(np.frombuffer(keys, np.int64), np.frombuffer(values, np.float32), bias))


def _strongest(model: "Model"):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = _scorer(model.keys, model.values, model.bias)
        for b in batches:
            got = [s.strongest(t.as_py()) for t in b.column("_text")]
            keep = [c for c in b.schema.names if c != "_text"]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array([g[0] for g in got], pa.float64()), pa.array([g[1] for g in got], pa.float64()), pa.array([g[2] for g in got])],
                                             names=[*keep, "_f", "_f2", "_word"])
    return run


class Model:
    """Weights of letter sequences (those that are not zero), bias and calibration."""

    def __init__(self, weights: np.ndarray, bias: float, odds: tuple[float, float] = (1.0, 0.0)):
        at = np.flatnonzero(weights).astype(np.int64)
        self.keys, self.values = at.tobytes(), weights[at].astype(np.float32).tobytes()
        self.bias, self.odds = bias, odds

    def apply(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``_f``, ``_f2`` and ``_word`` in the place of ``_text``."""
        fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "_text")
        return rows.mapInArrow(_strongest(self), f"{fields}, _f double, _f2 double, _word string")

    def probability(self) -> Column:
        """From the sum of ``_f`` and ``_f2``; beyond ``REACH`` neither counts more."""
        a, b = self.odds
        f, f2 = (F.greatest(F.least(F.col(x), F.lit(REACH)), F.lit(-REACH)) for x in ("_f", "_f2"))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-((f + f2) * F.lit(a) + F.lit(b))))


def _forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow function: each sampled document's different word forms."""
    for b in batches:
        for text, toxic in zip(b.column("_text"), b.column("_toxic").to_pylist()):
            found = sorted({f for w in set(words(text.as_py())) if (f := letters(w))})
            for lo in range(0, len(found), 10_000):
                some = found[lo:lo + 10_000]
                yield pa.RecordBatch.from_arrays([pa.array(some), pa.array([toxic] * len(some), pa.int32())], names=["form", "toxic"])


def learning_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
                  sample: int = SAMPLE, held_out: Column | None = None) -> tuple[DataFrame, dict[int, int]]:
    """Written sample of labelled documents: ``_text``, ``_toxic``; and how many there are of each label."""
    one = masked(labels).select(F.col(place_of(labels, id_col)).alias("_lid"), F.col(place_of(labels, label_col)).cast("int").alias("_toxic")).filter("_lid IS NOT NULL AND _toxic IS NOT NULL")
    one = one.groupBy("_lid").agg(F.min("_toxic").alias("_toxic"), F.max("_toxic").alias("_max")).filter("_toxic = _max").drop("_max")
    one = one.filter(F.crc32(F.col("_lid").cast("string").cast("binary")) % 5 != 0 if held_out is None else ~held_out)
    rows = text_rows(docs, id_col, text_col)
    ids = rows.select("_id").filter("_id IS NOT NULL").distinct()
    one = written(one.join(ids, one["_lid"] == ids["_id"], "left_semi"), "toxicity-labels")  # of rows that are there
    total = {r["_toxic"]: r["count"] for r in one.filter("_toxic IN (0, 1)").groupBy("_toxic").count().collect()}
    picked = one.filter("_toxic = 1").orderBy(F.xxhash64("_lid"), "_lid").limit(sample).unionAll(
        one.filter("_toxic = 0").orderBy(F.xxhash64("_lid"), "_lid").limit(sample))
    picked = F.broadcast(written(picked, "toxicity-sample"))  # 2 * sample rows of an id and a label
    return written(rows.join(picked, rows["_id"] == picked["_lid"]).select("_text", "_toxic"), "toxicity-texts"), total


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          sample: int = SAMPLE, c: float = 20.0) -> Model | None:
    """Model learned from the sample; None without documents of both labels."""
    rows, total = learning_rows(docs, labels, id_col, text_col, label_col, sample)
    if not total.get(0) or not total.get(1):
        return None
    size = {r["_toxic"]: r["count"] for r in rows.groupBy("_toxic").count().collect()}
    forms = rows.repartition(16).mapInArrow(_forms, "form string, toxic int").groupBy("form").agg(
        F.sum("toxic").alias("pos"), F.sum(F.lit(1) - F.col("toxic")).alias("neg"))
    # documents a form is in beyond what its share of clean ones lets expect, and how sure that is
    chance = F.col("neg") * F.lit(size[1] / size[0])
    forms = written(forms.withColumn("excess", F.col("pos") - chance).withColumn("sure", F.col("excess") / F.sqrt(chance + 1)), "toxicity-forms")
    sure = forms.withColumn("chance", chance).filter("sure > 0 AND pos > 1 AND excess > 3 * chance").orderBy(F.desc("sure"), "form").limit(MARKS).select("form", "excess", "sure").collect()
    if not sure:
        return None
    level = min(4.0, sure[0]["sure"] / 2)
    marks = {r["form"]: r["excess"] for r in sure if r["sure"] >= level}
    plain = forms.filter("sure < 1 AND neg > 0")  # words that mark nothing
    common = [r["form"] for r in plain.orderBy(F.desc("neg"), "form").limit(POOL // 3).collect()]
    negatives = dict.fromkeys(common + [r["form"] for r in plain.orderBy(F.xxhash64("form"), "form").limit(POOL).collect()], 1.0)
    # landmarks: the surest marks that no surer one stands for, and the commonest words
    names = list(marks)
    maps, chosen = features(names), []
    for i, m in enumerate(maps):
        if len(chosen) < LANDMARKS and all(sum(v * maps[j].get(k, 0) for k, v in m.items()) < 0.9 for j in chosen):
            chosen.append(i)
    space = Landmarks([names[i] for i in chosen] + common[:LANDMARKS // 2])
    model = None
    for turn in range(ROUNDS):
        if turn:  # the strongest words of clean documents
            top = model.apply(rows.filter("_toxic = 0")).filter(F.col("_f") > -1).groupBy("_word").count().collect()
            new = {r["_word"]: r["count"] for r in top if r["_word"] not in marks}
            negatives |= {w: max(n, negatives.get(w, 0)) + 1.0 for w, n in new.items()}
        y = np.concatenate((np.ones(len(marks)), -np.ones(len(negatives))))
        weight = np.array([*marks.values(), *negatives.values()], float)
        for side in (y > 0, y < 0):
            weight[side] /= weight[side].sum()
        w, b = svm(space.map([*marks, *negatives]), y, weight, c * len(y))
        model = Model(space.weights(w), b)
    got = model.apply(rows).select("_toxic", "_f", "_f2").toPandas()
    model.odds = platt(got[["_f", "_f2"]].to_numpy(float).clip(-REACH, REACH).sum(1), got["_toxic"].to_numpy(int), total[1] / (total[0] + total[1]))
    return model


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Identity, ``_word`` (the strongest word's letters) and ``_score`` of every row."""
    rows = text_rows(docs, id_col, text_col)
    if model is None:
        return rows.select(*IDENTITY, F.lit("").alias("_word"), F.lit(0.0).alias("_score"))
    return model.apply(rows).select(*IDENTITY, "_word", model.probability().alias("_score"))


def op3_toxicity_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text of ``documents``; learned from the folds that are not held out."""
    docs = table(spark, sf_dir, "documents")
    r = score(docs, train(docs, table(spark, sf_dir, "labels")))
    held = F.crc32(F.col("_id").cast("string").cast("binary")) % 5 == 0
    return r.select(F.col("_id").alias("doc_id"), F.coalesce(held, F.lit(False)).alias("held_out"), F.col("_score").alias("score"),
                    (F.col("_score") >= 0.5).cast("int").alias("predicted"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents that are not predicted toxic, all columns, without a shuffle."""
    model = train(docs, table(spark, sf_dir, "labels"))
    if model is None:
        return docs
    ship(spark)
    rows = masked(docs)
    scored = model.apply(rows.withColumn("_text", F.coalesce(F.col(place_of(docs, "text")), F.lit(""))))
    return scored.filter(model.probability() < 0.5).select(*rows.columns).toDF(*docs.columns)
