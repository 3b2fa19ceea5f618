import random

import numpy as np
from pyspark.sql import functions as F

from variantloom.llm.language import Profiles, fit_profiles, held_out, keep_languages, ngrams, predict_language, ranked
from variantloom.llm.toxicity import NonNegativePU, fit_toxicity, score_toxicity

DATA = "/root/testdata/sf0.01"


def test_ranks_by_plain_counting():
    from collections import Counter

    text = "Ab ab, ba! 12 éa"
    keys = ngrams(text, 2).tolist()
    words = [" ab ", " ab ", " ba ", " éa "]
    letters = Counter(c for w in words for c in w.strip())
    assert Counter(k for k in keys if k < 1 << 21) == Counter({ord(c): n for c, n in letters.items()})
    top = ranked(np.array([5, 5, 3, 3, 9]), 2)
    assert top.tolist() == [3, 5]


def test_out_of_place_distance():
    p = Profiles([("x", [1, 2, 3]), ("y", [3, 2, 1])], 3)
    assert [lang for lang, _, _ in p.langs] == ["x", "y"]
    a, b = ord("a"), ord("b")
    q = Profiles([("l", [a, b])], 4)
    assert q.predict("a")[0] == "l" and q.predict("12 !")[0] == "und" and q.predict(None) == ("und", 0.0)


def test_held_out_accuracy_and_odd_texts(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    profiles = fit_profiles(docs.where(~held_out()))
    assert sorted(x for x, _ in profiles) == ["de", "en", "es", "fr"]
    pred = predict_language(docs, profiles).join(docs.select("doc_id", "lang"), "doc_id").where(held_out())
    right, n = pred.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right / n > 0.98
    odd = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (3, "12 !?", "c"), (None, "the of and", None), (4, "the " * 50000, "d"), (4, "語" * 10, "e")], "doc_id long, text string, lang_pred string")
    got = [(r.doc_id, r.lang_pred) for r in predict_language(odd, profiles).collect()]
    assert [x for _, x in got[:3]] == ["und"] * 3 and got[3] == (None, "en") and got[4] == (4, "en")
    kept = keep_languages(odd, profiles)
    assert kept.columns == odd.columns and [r.lang_pred for r in kept.collect()] == [None, "d"]
    assert fit_profiles(docs.limit(0)) == [] and predict_language(odd, []).where("lang_pred != 'und'").count() == 0


def test_risk_stays_non_negative():
    rng = np.random.default_rng(0)
    n = 400
    y = rng.random(n) < 0.2
    rows, cols = [], []
    for i in range(n):
        for c in ({0, 1} if y[i] and rng.random() < 0.9 else set()) | set(rng.integers(2, 40, 5).tolist()):
            rows.append(i)
            cols.append(c)
    r, c = np.array(rows), np.array(cols)
    pos = np.flatnonzero(y)
    keep = np.isin(r, pos)
    back = {p: n + k for k, p in enumerate(pos)}
    rr = np.r_[r, [back[x] for x in r[keep]]]
    model = NonNegativePU(0.2).fit(rr, np.r_[c, c[keep]], np.r_[np.zeros(n, bool), np.ones(len(pos), bool)], 40)
    z = np.bincount(r, model.weights[c], n) + model.bias
    assert ((z > 0) == y).mean() > 0.95


def test_toxicity_held_out_and_odd_texts(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(600):
        toxic = i % 8 == 0
        t = [rng.choice(words) for _ in range(rng.randint(5, 60))] + ([rng.choice(["vile", "nasty"])] if toxic else [])
        rng.shuffle(t)
        rows.append((i, " ".join(t)))
        labels.append((i, int(toxic)))
    docs, lab = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels + [(5, 0), (None, 1), (9, None)], "doc_id long, toxic int")
    out = held_out(folds=5, fold=0)
    weights, bias = fit_toxicity(docs, lab.where(~out), max_rows=500)
    got = score_toxicity(docs, weights, bias).where(out).collect()
    right = sum(r.predicted == int(r.doc_id % 8 == 0) for r in got)
    assert right / len(got) > 0.97, right / len(got)
    odd = score_toxicity(spark.createDataFrame([(None, None, "x"), (1, "", "y"), (1, "vile " * 20000, "z")], "doc_id long, text string, score string"), weights, bias).collect()
    assert [r.predicted for r in odd] == [0, 0, 1] and all(0 <= r.score <= 1 for r in odd)
    assert fit_toxicity(docs, lab.where("toxic = 0"))[0] == {}


def test_fit_follows_the_risk_estimator():
    """The gradient of each branch of the non-negative risk, by finite differences of its plain definition."""
    rng = np.random.default_rng(3)
    x = (rng.random((60, 5)) < 0.4).astype(float)
    positive = rng.random(60) < 0.3
    r, c = np.nonzero(x)
    prior, decay, eps = 0.3, 1e-3, 1e-6

    def parts(w):
        z = x @ w[:-1] + w[-1]
        as_negative, as_positive = np.log1p(np.exp(z)), np.log1p(np.exp(-z))
        return prior * as_positive[positive].mean(), as_negative[~positive].mean() - prior * as_negative[positive].mean()

    model = NonNegativePU(prior, steps=40, rate=0.05, decay=decay).fit(r, c, positive, 5)
    w = np.r_[np.zeros(5), np.log(prior / (1 - prior))]
    m = v = np.zeros(6)
    for t in range(1, 41):
        climbing = parts(w)[1] < 0
        target = (lambda u: -parts(u)[1]) if climbing else (lambda u: sum(parts(u)))
        g = np.array([(target(w + eps * e) - target(w - eps * e)) / (2 * eps) for e in np.eye(6)]) + decay * np.r_[w[:-1], 0]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g**2
        w = w - 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    assert np.allclose(np.r_[model.weights, model.bias], w, atol=1e-3)


def test_unlabelled_texts_take_part(spark):
    """Words of texts without any label count; labels of 0 change nothing but the prior; empty tables have no weights."""
    rows = [(i, f"plain talk number {i % 7} " + ("foul" if i % 5 == 0 else "calm")) for i in range(200)]
    docs = spark.createDataFrame([*rows, (None, "foul foul"), (5, "foul once more")], "doc_id long, text string")
    lab = spark.createDataFrame([(i, 1) for i in range(0, 100, 5)], "doc_id long, toxic int")
    zeros = lab.unionByName(spark.createDataFrame([(i, 0) for i in range(1, 80) if i % 5], "doc_id long, toxic int"))
    one, two = fit_toxicity(docs, lab, prior=0.2), fit_toxicity(docs, zeros, prior=0.2)
    assert one == two and one[0]["foul"] > 0 > one[0]["calm"]
    assert fit_toxicity(docs.limit(0), lab) == ({}, -10.0) and fit_toxicity(docs, lab.limit(0)) == ({}, -10.0)


def test_profiles_and_predictions_by_brute_force(spark):
    """Counts of n-grams, ranks and out-of-place distances by plain loops over dictionaries."""
    from collections import Counter

    rng = random.Random(5)
    rows = [(i, " ".join("".join(rng.choice("abcé" if lang == "x" else "dfgé") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 12))), lang) for i, lang in enumerate("xy" * 30)]
    rows += [(100, None, "x"), (101, "aa", None), (102, "", "y"), (103, "12 ?", "x"), (104, "ab " * 400_000, None)]

    def grams(text):
        words = "".join(ch if ch.isalpha() else " " for ch in (text or "").lower()).split()
        out = Counter()
        for k, w in enumerate(words):
            out.update(w)
            padded = " " + w + " "
            out.update(padded[i : i + n] for n in (2, 3) for i in range(len(padded) - n + 1))
        return out

    code = lambda g: sum(ord(ch) << (21 * (len(g) - 1 - i)) for i, ch in enumerate(g))
    rank = lambda counts, size: [code(g) for g in sorted(counts, key=lambda g: (-counts[g], code(g)))[:size]]
    want = {lang: rank(sum((grams(t) for _, t, x in rows if x == lang and t), Counter()), 20) for lang in "xy"}
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    profiles = fit_profiles(docs, size=20)
    assert {lang: list(keys) for lang, keys in profiles} == want
    for r in predict_language(docs, profiles, size=20).collect():
        doc = rank(grams(dict((i, t) for i, t, _ in rows)[r.doc_id]), 20)
        far = {lang: sum(abs(want[lang].index(g) - i) if g in want[lang] else 20 for i, g in enumerate(doc)) for lang in "xy"}
        best = min("xy", key=lambda lang: far[lang]) if doc else "und"
        assert r.lang_pred == best and abs(r.score - (1 - far[best] / (20 * len(doc)) if doc else 0.0)) < 1e-9
