"""Language model, classifiers: brute force, gradients, held-out accuracy, edge cases."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.llm import langid, lm, quality, queries, toxicity
from riskframe.llm.common import fold

from llm_rows import NASTY, SF_SMALL, docs_of  # noqa: F401

SF = "/root/testdata/sf0.01"


def tokens(text):
    return (text or "").encode().lower().split() + [lm.END]


def brute_lm(rows, train, deleted, weights_of):
    """Plain dictionaries: base scores, and scores by the weights that the given learner finds."""
    kept, uni, bi, start = Counter(), Counter(), Counter(), 0
    parts = []
    for (i, t), learn in zip(rows, train):
        w = tokens(t)
        parts.append((w, learn))
        if learn:
            uni.update(w)
            bi.update(zip([None] + w[:-1], w))
            start += 1
    n, v = sum(uni.values()), len(uni)
    out = []
    for (w, _), (i, _) in zip(parts, rows):
        base = sum(math.log10((uni[x] + 1) / (n + v + 1)) for x in w)
        out.append((i, len(w), sum(uni[x] > 0 for x in w), n, base))
    return out


def test_base_scores_match_brute_force(spark, docs_of):
    rows = NASTY + [(30 + i, f"the cat {i % 7} sat on The Mat\tand it {'purred ' * (i % 5)}") for i in range(60)]
    train = [zlib.crc32(str(i if i is not None else "null").encode()) % 7 != 2 for i, _ in rows]
    got = lm.score_texts(docs_of(rows), fold(F.col("doc_id"), 7) != 2).collect()
    key = lambda r: (str(r[0]), r[1], r[2], round(r[4], 6))
    want = sorted(brute_lm(rows, train, None, None), key=key)
    mine = sorted(((r["id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got), key=key)
    assert len(mine) == len(want)
    for a, b in zip(mine, want):
        assert a[:4] == b[:4] and a[4] == pytest.approx(b[4], abs=1e-6)
    assert all(r["score"] <= 0 and math.isfinite(r["score"]) for r in got)
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got)


def test_mixture_is_a_distribution():
    """For a context, the mixed probabilities of all known words and one unknown word sum to 1 (bigrams of a seen context)."""
    uni, bi, n, docs, words = Counter(a=6, b=3, z=1), Counter({("a", "a"): 2, ("a", "b"): 3, ("a", "z"): 1}), 10, 2, 3
    counts = [np.array([uni[w] for w in "abz?"]), np.array([bi["a", w] for w in "abz?"])]
    bucket, p = lm.estimates(counts, [None, np.full(4, 6)], n, docs, words)
    weights = np.full((lm.BUCKETS, 3), 1 / 3)
    assert (p * weights[bucket]).sum() == pytest.approx(1)


def test_weights_follow_the_held_out_counts():
    import pandas as pd
    bins = pd.DataFrame({"bucket": [2, 2, 5], "n": [90, 10, 50], "p0": [90 * 1e-4, 10 * 1e-4, 50 * 1e-4],
                         "p1": [90 * 1e-3, 10 * 1e-3, 50 * 1e-2], "p2": [90 * 0.5, 0, 0]})
    w = lm.learn_weights(bins, 2)
    assert w[2][2] > 0.8 and w[5][1] > 0.9 and w[0] == pytest.approx(w[2]) and w.sum(1) == pytest.approx(1)


def test_lm_without_training_or_rows(docs_of):
    docs = docs_of(NASTY)
    got = lm.score_texts(docs, F.lit(False)).collect()
    assert {(r["train_tokens"], r["score"], r["base_score"]) for r in got} == {(0, 0.0, 0.0)} and len(got) == len(NASTY)
    assert lm.score_texts(docs.limit(0), F.lit(True)).count() == 0


def test_network_gradients():
    rng = np.random.default_rng(1)
    listed, ids, _ = toxicity.windows_of(["a bb ccc dddd eee", "the cat sat on the mat and it was the end of all " * 6])
    words, net = toxicity.Words.of(listed), toxicity.Network.fresh(rng)
    y, w = rng.integers(0, 2, len(ids)).astype(np.float32), np.ones(len(ids), np.float32)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    grads = net.gradients(words, ids, y, w)

    def loss():
        q = net.windows(words, ids)
        return float(-(y * np.log(q) + (1 - y) * np.log(1 - q)).mean())

    for k, v in net.p.items():
        at = np.unravel_index(np.abs(grads[k]).argmax(), v.shape)
        v[at] += 1e-3
        up = loss()
        v[at] -= 2e-3
        down = loss()
        v[at] += 1e-3
        assert grads[k][at] == pytest.approx((up - down) / 2e-3, rel=2e-2, abs=1e-6), k


def test_windows_cover_every_word():
    text = " ".join(f"w{i}" for i in range(500))
    listed, ids, owner = toxicity.windows_of([text, "", "one"])
    assert {listed[i] for i in ids[owner == 0].ravel()} == {f"w{i}".encode() for i in range(500)}
    assert (ids[owner == 2][0] >= 0).sum() == 1 and 1 not in owner


def held_out(spark, name, label):
    got = queries.QUERIES[name](spark, SF).toPandas()
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").toPandas()
    assert len(got) == len(docs) and got["score"].between(0, 1).all()
    return got.merge(labels if label != "lang" else docs, on="doc_id").query("held_out")


def test_toxicity_held_out(spark):
    m = held_out(spark, "op1_toxicity", "toxic")
    assert ((m.predicted == m.toxic).mean() >= 0.85) and m.predicted[m.toxic == 0].mean() < 0.08
    assert ((m.score >= 0.5) == (m.predicted == 1)).all()


def test_quality_held_out(spark):
    m = held_out(spark, "op5_quality", "quality")
    assert (m.predicted == m.quality).mean() >= 0.93


def test_language_held_out(spark):
    m = held_out(spark, "op10_language_id", "lang")
    assert (m.lang_pred == m.lang).mean() >= 0.97


def test_edge_texts(spark, docs_of):
    docs = docs_of(NASTY)
    labels = spark.createDataFrame([(4, 1, 1), (5, 0, 0), (7, None, 1), (4, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for fit, score in ((toxicity.fit_toxicity, toxicity.score_toxicity), (quality.fit_quality, quality.score_quality)):
        for train in (F.lit(True), F.lit(False)):
            model = fit(docs, labels, train)
            got = score(docs, model).collect()
            assert len(got) == len(NASTY) and all(0 <= r["score"] <= 1 for r in got)
            assert len({r["score"] for r in got if r["doc_id"] == 4}) == 1
            assert score(docs.limit(0), model).count() == 0
    scored = toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, labels, F.lit(True)))
    tox = {r["doc_id"]: r["score"] for r in scored.collect()}
    assert tox[1] == tox[2] == tox[3] == 0


def test_language_edge_texts(spark):
    rows = [(i, t, "de" if i % 2 else "xx") for i, t in enumerate(["der die das und nicht", "zzq yyw zzq"] * 20)]
    rows += [(100, None, "de"), (101, "", "de"), (102, "123 !!", "xx"), (103, "das und die", None), (None, "zzq", "xx")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "'s' as score", "1 as lang_pred")
    model = langid.fit_languages(docs, F.lit(True))
    got = {r["doc_id"]: r for r in langid.identify(docs, model).collect()}
    assert [got[i]["lang_pred"] for i in (100, 101, 102)] == ["und"] * 3 and len(got) == len(rows)
    assert got[0]["lang_pred"] == "xx" and got[1]["lang_pred"] == "de" and 0.5 <= got[0]["score"] <= 1
    none = langid.identify(docs, langid.fit_languages(docs, F.lit(False))).collect()
    assert {(r["lang_pred"], r["score"]) for r in none} == {("und", 0.0)}
    assert sorted(langid.FAMILY_OF.get(x, x) for x in ("en", "fr", "xx")) == ["germanic", "romance", "xx"]
