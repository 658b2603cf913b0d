"""Toxicity kernel and cross-entropy difference against brute force and held-out labels."""
import collections
import itertools
import math
import random
import zlib

import numpy as np
import pytest

from wattgrid.llm import cross_entropy as C
from wattgrid.llm import toxicity as T

SF = "/root/testdata/sf0.01"


def kernel(s, t):
    """The string kernel by its definition, on words with boundaries."""
    def maps(w):
        w = f"^{w}$"
        out = collections.Counter()
        for at in itertools.combinations(range(len(w)), T.LENGTH):
            if at[-1] - at[0] < T.SPAN:
                out["".join(w[i] for i in at)] += T.DECAY ** (at[-1] - at[0] + 1 - T.LENGTH)
        return out, math.sqrt(sum(T.DECAY ** (2 * (at[-1] - at[0] + 1 - T.LENGTH)) for at in itertools.combinations(range(len(w)), T.LENGTH) if at[-1] - at[0] < T.SPAN))
    (a, na), (b, nb) = maps(s), maps(t)
    return sum(v * b[k] for k, v in a.items()) / (na * nb) if na and nb else 0.0


def test_kernel_by_definition():
    forms = ["idiot", "idxiot", "scum", "abababab", "a", "", "ab", "worthless", "idiotworthless"]
    space = T.Landmarks(["idiot", "scum", "worthless", "ababab"])
    got = space.kernel(forms)
    assert np.allclose(got, [[kernel(f, z) for z in space.forms] for f in forms])
    assert kernel("idxiot", "idiot") > 3 * kernel("edition", "idiot")
    maps = T.features(forms)
    assert np.allclose(got, [[sum(v * m.get(k, 0) for k, v in f.items()) for m in space.maps] for f in maps])


def test_decisions_equal_landmark_form():
    """One weight per letter sequence gives what the SVM gives in the Nyström space."""
    rng = random.Random(0)
    space = T.Landmarks(["idiot", "scum", "worthless", "house", "garden"])
    w, b = np.array([rng.uniform(-1, 1) for _ in range(5)]), 0.3
    forms = ["".join(rng.choice("idotscumwrhle") for _ in range(rng.randrange(0, 15))) for _ in range(200)]
    assert np.allclose(T.decide(forms, space.weights(w), b), space.map(forms) @ w + b, atol=1e-4)


def test_letters_and_words():
    assert [T.letters(x) for x in ("Idiot!!!", "1d1ot", "id-iot", "ÍDÏÓT", "123", "...", "", "i*d.i0t", "größe")] == \
        ["idiot", "idiot", "idiot", "idiot", "", "", "", "idiot", "große".replace("ß", "ß")]
    assert "idiot" in T.words("you i d i o t now") and T.words(" a b ") == ["a", "b"]


def corpus(n=400, seed=0):
    rng = random.Random(seed)
    plain = ["garden", "house", "window", "letter", "summer", "paper", "river", "mountain", "table", "yellow"]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(plain) + rng.choice(["", "s", "ly"]) for _ in range(30)]
        toxic = int(i % 3 == 0)
        if toxic:
            for _ in range(2):
                words[rng.randrange(30)] = rng.choice(["idiot", "Idiots", "worthless", "scumbag"])
        docs.append((i, " ".join(words) + ". The end.", "clash", "clash"))
        labels.append((i, 1 - toxic, toxic))
    return docs, labels


def test_learns_and_tolerates_gaps(spark):
    docs, labels = corpus()
    labels += [(None, 1, 1), (5, None, None), (7, 1, 1)]  # no id, no label, and 7 both ways
    hard = ["an idxiot in the house and w-o-r-t-h-l-e-s-s paper, i d i o t", "garden house window", None, "", "1d1ot wörthless", "paper " * 3000]
    docs += [(1000 + i, t, "", "") for i, t in enumerate(hard)] + [(None, "idiot scumbag", "", "")]
    d = spark.createDataFrame(docs, "doc_id long, text string, _f string, _toxic string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = T.train(d, lab)
    got = {r["_id"]: r["_score"] for r in T.score(d, model).collect()}
    assert len(got) == len(docs) and all(0 <= s <= 1 for s in got.values())
    assert all((got[i] >= 0.5) == bool(t) for i, _, t in labels if i is not None and t is not None and i != 7)
    assert got[1000] >= 0.5 and got[1004] >= 0.5 and got[None] >= 0.5
    assert max(got[i] for i in (1001, 1002, 1003, 1005)) < 0.5 and got[1002] == got[1003]
    again = T.train(d, lab)
    assert again.keys == model.keys and again.odds == pytest.approx(model.odds)


def test_stage_drops_toxic_rows_and_keeps_columns(spark, tmp_path):
    docs, labels = corpus()
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    lab.write.parquet(str(tmp_path / "labels.parquet"))
    d = spark.createDataFrame(docs + [(None, None, "", "")], "doc_id long, text string, _text string, TEXT string")
    out = T.stage(spark, d, str(tmp_path))
    assert out.columns == d.columns
    kept = {r["doc_id"] for r in out.toDF("doc_id", "t", "a", "b").collect()}
    assert kept == {i for i, _, t in labels if not t} | {None}


def test_without_both_labels(spark):
    d = spark.createDataFrame([(1, "a b", "")], "doc_id long, text string, _f string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert T.train(d, none) is None and [r["_score"] for r in T.score(d, None).collect()] == [0.0]
    assert T.train(d.limit(0), none) is None


def test_held_out_labels(spark):
    """AUC of at least 0.8 on the fold never learned from, though some labels are noise."""
    r = T.op3_toxicity_kernel(spark, "/root/testdata/sf0.1").toPandas().merge(spark.read.parquet("/root/testdata/sf0.1/labels.parquet").toPandas(), on="doc_id")
    x = r[r.held_out]
    p, n = x.score[x.toxic == 1].to_numpy(), np.sort(x.score[x.toxic == 0].to_numpy())
    auc = (np.searchsorted(n, p, "left") + np.searchsorted(n, p, "right")).mean() / 2 / len(n)
    assert auc >= 0.9 and (x.predicted[x.toxic == 0] == 0).mean() > 0.97


def test_held_out_recall_by_language(spark):
    """Of all held-out toxic documents of each language, nine in ten are predicted toxic."""
    sf = "/root/testdata/sf0.1"
    r = T.op3_toxicity_kernel(spark, sf).toPandas()
    for name in ("labels", "documents"):
        r = r.merge(spark.read.parquet(f"{sf}/{name}.parquet").drop("text").toPandas(), on="doc_id")
    recall = r[r.held_out & (r.toxic == 1)].groupby("lang").predicted.mean()
    assert set(recall.index) == {"en", "de", "fr", "es"} and recall.min() >= 0.9


TEXTS = ["abab", "abba c", None, "", "cafe É", "É", "zzz", "a" * 300, "abab"]


@pytest.mark.parametrize("order,size", [(5, 1 << 24), (2, 100), (7, 1)])
def test_cross_entropy_equals_brute_force(spark, monkeypatch, order, size):
    """Also where every text is a slice of its own, and texts are handled in pieces."""
    docs = list(enumerate(TEXTS)) + [(None, "abx")]
    good = {0, 1, 4}
    d = spark.createDataFrame([(*r, "clash", "clash") for r in docs], "doc_id long, text string, gram string, _row string")
    ids = spark.createDataFrame([(i,) for i in [*good, 0, 99]] + [(None,)], "doc_id long")
    got = C.cross_entropy_difference(d, ids, order=order, slice_bytes=size).collect()

    def symbols(t):
        return ["<"] * (order - 1) + list((t or "").encode()) + [">"]

    def model(texts):
        counts = [collections.Counter(tuple(s[i - k + 1:i + 1]) for t in texts for s in [symbols(t)] for i in range(order - 1, len(s))) for k in range(1, order + 1)]

        def p(g):
            q = 1 / 257
            for k in range(1, order + 1):
                h = g[order - k:-1]
                after = [n for x, n in counts[k - 1].items() if x[:-1] == h]
                if after:
                    q = (counts[k - 1][g[order - k:]] + len(after) * q) / (sum(after) + len(after))
            return q
        return p
    back, target = model([t for _, t in docs]), model([t for i, t in docs if i in good])

    def score(t):
        s = symbols(t)
        g = [tuple(s[i - order + 1:i + 1]) for i in range(order - 1, len(s))]
        return len(g), sum(-math.log(target(x)) for x in g) / len(g), sum(-math.log(back(x)) for x in g) / len(g)
    want = sorted(((i, *score(t)) for i, t in docs), key=str)
    have = sorted(((r["_id"], r["n_tokens"], r["loss_target"], r["loss_background"]) for r in got), key=str)
    assert [h[:2] for h in have] == [w[:2] for w in want]
    assert np.allclose([h[2:] for h in have], [w[2:] for w in want], rtol=1e-6)


def test_grams_in_pieces(monkeypatch):
    text = "größe und Ähre 𝄞".encode() * 5
    whole = np.concatenate(list(C.grams(text, 5)))
    monkeypatch.setattr(C, "PIECE", 7)
    pieces = list(C.grams(text, 5))
    assert len(pieces) > 10 and (np.concatenate(pieces) == whole).all() and len(whole) == len(text) + 1
    assert [len(x) for x in C.grams(b"", 5)] == [1] and [len(x) for x in C.grams(b"a" * 7, 5)] == [7, 1]


def test_quality_of_held_out_labels(spark):
    """The registered query tells good documents from others in the fold of labels held out."""
    sf = "/root/testdata/sf0.01"
    r = C.op9_cross_entropy(spark, sf).toPandas()
    assert len(r) == spark.read.parquet(f"{sf}/documents.parquet").count() and set(r.columns) == {"doc_id", "n_tokens", "loss_target", "loss_background", "score"}
    x = r.merge(spark.read.parquet(f"{sf}/labels.parquet").toPandas(), on="doc_id")
    x = x[[zlib.crc32(str(i).encode()) % 5 == 0 for i in x.doc_id]]
    p, n = -x.score[x.quality == 1].to_numpy(), np.sort(-x.score[x.quality == 0].to_numpy())
    assert (np.searchsorted(n, p, "left") + np.searchsorted(n, p, "right")).mean() / 2 / len(n) >= 0.95


def test_cross_entropy_without_target_or_rows(spark):
    d = spark.createDataFrame([(1, "ab"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long")
    assert C.cross_entropy_difference(d, none).count() == 2
    assert C.cross_entropy_difference(d.limit(0), none).count() == 0


def test_order_is_the_callers_in_any_script(spark):
    """A corpus of more characters than any alphabet has keeps its order; one that no key holds is refused."""
    d = spark.createDataFrame([(i, "".join(chr(0x3400 + (i * 700 + j) % 90_000) for j in range(700))) for i in range(100)], "doc_id long, text string")
    got = C.cross_entropy_difference(d, d.select("doc_id").limit(50))
    assert got.count() == 100 and got.filter("n_tokens > 2000").count() == 100
    with pytest.raises(ValueError):
        C.cross_entropy_difference(d, d.select("doc_id"), order=8)
