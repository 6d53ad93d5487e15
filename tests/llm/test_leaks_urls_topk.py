"""Decontamination, URL filter and top-k search against brute force."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.llm import decontam, trees, urls
from riskframe.llm.topk import top_k

from llm_rows import NASTY, docs_of  # noqa: F401


def edit_distance_inside(pattern, text):
    """Fewest edits of the pattern against any part of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def leak_corpus():
    rng = random.Random(2)
    syllables = "the and ing ion re ha ti or an es to is".split()
    prose = lambda n: "".join(rng.choice(syllables) + rng.choice(["", " "]) for _ in range(n))
    items = [(k, prose(rng.choice([12, 40, 120]))) for k in range(8)] + [(8, None), (9, " \n "), (10, "zq!"), (11, items_text := "A b" * 30), (11, items_text)]
    rows = list(NASTY) + [(20 + k, prose(150)) for k in range(20)]
    for k, (item, text) in enumerate(items[:8] + items[10:12]):
        for edits in (0, 2, 40):
            t = list(text)
            for _ in range(edits):
                at = rng.randrange(len(t))
                t[at:at + 1] = rng.choice([[], ["x"], [t[at], "y"]])
            rows.append((100 + 10 * k + edits % 7, prose(rng.choice([0, 60])) + "".join(t).replace(" ", "\n") + prose(rng.choice([0, 60]))))
    return rows, items


def test_leaks_match_brute_force(spark, docs_of, monkeypatch):
    monkeypatch.setattr(decontam, "CHUNK", 97)          # q-grams across chunk edges count too
    rows, items = leak_corpus()
    index = decontam.build_index(items, 0.1, 160)
    got = decontam.matches([t for _, t in rows], index)
    for (_, text), found in zip(rows, got):
        data, want = decontam.normal(text or ""), set()
        for item, whole in items:
            whole = decontam.normal(whole or "").strip()
            if not whole or len(data) > 3000:
                continue
            one = decontam.build_index([(item, whole.decode())], 0.1, 160)
            parts = [bytes(one.matrix[i, :n]) for i, n in enumerate(one.sizes)]
            if any(edit_distance_inside(p, data) <= k for p, k in zip(parts, one.budget)) or not parts and whole in data:
                want.add(item)
        if len(data) <= 3000:
            assert {m["item_id"] for m in found} == want
    exact = next(m for (i, _), f in zip(rows, got) for m in f if i == 100)
    assert exact["edits"] == 0


def test_find_leaks_over_parts_and_clashing_columns(spark, docs_of):
    rows, items = leak_corpus()
    bench = spark.createDataFrame(items, "item_id long, text string")
    run = lambda **p: {(str(r["row"]["doc_id"]), r["row"]["text"]): sorted({m["item_id"] for m in r["leaks"]})
                       for r in decontam.find_leaks(docs_of(rows), bench, **p).collect()}
    whole = run()
    assert len(whole) == len({(str(i), t) for i, t in rows}) and whole == run(part_bytes=100)
    assert decontam.find_leaks(docs_of([]), bench).count() == 0
    assert all(not r["leaks"] for r in decontam.find_leaks(docs_of(rows), bench.limit(0)).collect())


def test_excerpts_are_found_at_every_offset():
    rng = random.Random(8)
    item = "".join(rng.choice("abcdefghij klmnop") for _ in range(394)).strip()
    item += "z" * (394 - len(item))
    index = decontam.build_index([(1, "some other text of the benchmark"), (7, item)], 0.1, 160)
    for length, edits in ((160, 0), (160, 12)):
        excerpts = []
        for at in range(len(item) - length + 1):
            t = list(item[at:at + length])
            for place in rng.sample(range(10, length - 10), edits):
                t[place] = "#"
            excerpts.append("w" * rng.randrange(50) + "".join(t) + "v" * rng.randrange(50))
        assert all([m["item_id"] for m in found] == [7] for found in decontam.matches(excerpts, index))
    assert decontam.matches([item[100:220]], index) == [[]]


def test_items_without_an_id_are_found(spark, docs_of):
    bench = spark.createDataFrame([(None, "a passage whose row has no id at all"), (None, None), (3, "a passage with an id")], "item_id long, text string")
    rows = [(1, "here is a passage whose row has no id at all"), (2, "a passage with an id here"), (3, "neither of the two")]
    for parts in ({}, {"part_bytes": 10}):
        got = {r["row"]["doc_id"]: [m["item_id"] for m in r["leaks"]] for r in decontam.find_leaks(docs_of(rows), bench, **parts).collect()}
        assert len(got[1]) == 1 and got[1] != [3] and got[2] == [3] and got[3] == []


def test_spans_point_at_the_passage():
    text = "überall " * 10 + "a benchmark passage that is long enough to be found in here" + " und so weiter" * 5
    index = decontam.build_index([(1, "a benchmark passage that is long enough to be found in here")], 0.1, 160)
    (m,), = decontam.matches([text], index)
    assert text[m["start"]:m["end"]] == "a benchmark passage that is long enough to be found in here" and m["edits"] == 0


def brute_url(url):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for what, rule in urls.RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[1])):
            best = what, rule
    return host, path, best and best[1], best and best[0]


def test_url_rules_match_brute_force(spark):
    hosts = ["a.example.net", "EXAMPLE.net", "net", "xnet", "example.com", "sub.example.com", "x.org", "org", "ÄÖ.org", "a.example.net:80", ""]
    made = [f"http{s}://{h}{p}{q}" for s in ("", "s") for h in hosts for p in ("", "/", "/en/", "/en", "/de/1", "/fr/x/y", "//fr/")
            for q in ("", "?a=1&b=2", "#top", "?x=/en/#y")]
    made += [None, "", "no scheme", "a://b://c/en/", "://net/", "http://net/en/\nnext", "x" * 20_000 + "://y.net/"]
    pages = spark.createDataFrame(list(enumerate(made)), "page_id long, url string").selectExpr("*", "1 as host", "2 as row", "3 as score")
    got = {r["row"]["page_id"]: r for r in urls.judge_urls(pages, rounds=5).collect()}
    assert len(got) == len(made)
    for i, u in enumerate(made):
        host, path, rule, said = brute_url(u)
        r = got[i]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule), u
        assert r["verdict"] == (said or ("block" if r["score"] >= 0.5 else "allow")) and 0 <= r["score"] <= 1


def test_urls_without_labels_are_allowed(spark):
    pages = spark.createDataFrame([(1, "http://example.com/x"), (2, None)], "page_id long, url string")
    assert {r["verdict"] for r in urls.judge_urls(pages).collect()} == {"allow"}
    assert urls.judge_urls(pages.limit(0)).count() == 0


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.uniform(-1, 1, (4000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 2] > 0.3)).astype(int)
    model = trees.fit_trees(x[:3000], y[:3000], 40, 3, 0.2)
    assert ((model.predict(x[3000:]) >= 0.5) == y[3000:]).mean() > 0.95


def brute_top(rows, asked, k):
    vecs = {}
    keep = [(i, [int(np.floor(1024 * np.float64(np.float32(c)))) for c in v]) for i, v in rows
            if i is not None and v and all(c is not None and np.isfinite(c) for c in v)]
    size = max(len(v) for _, v in keep)
    keep = [(i, np.array(v + [0] * (size - len(v)))) for i, v in keep]
    out = set()
    for q, v in keep:
        if asked(q):
            best = sorted((-int(v @ w), i) for i, w in keep if i != q)[:k]
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(best)}
    return out


@pytest.mark.parametrize("params", [{}, {"pivots": 3, "chunk_rows": 7}, {"pivots": 40}])
def test_top_k_matches_brute_force(spark, params):
    rng = np.random.default_rng(8)
    rows = [(i, [float(c) for c in rng.normal(0, 0.2, 6).round(2)]) for i in range(150)]
    rows += [(1000 + i, [0.5, 0.25, 0.0, 0.0, 0.0, 0.1]) for i in range(60)]                    # one very common vector
    rows += [(2000, None), (2010, []), (2020, [1.0, None, 0.0]), (2030, [float("nan")] * 6), (2040, [float("inf")] * 6),
             (None, [1.0] * 6), (2050, [0.3, 0.1]), (2060, [0.0] * 6), (2050, [0.3, 0.1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as id", "2 as vec")
    got = {tuple(r) for r in top_k(df, F.col("vec_id") % 10 == 0, **params).collect()}
    assert got == brute_top(rows, lambda i: i % 10 == 0, 10)


def test_top_k_of_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in top_k(df, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 1024 * 512)]
    assert top_k(df.limit(0), F.col("vec_id") == 0).count() == 0


def test_top_k_with_many_rows_of_the_querys_own_id(spark):
    """A query finds k rows of other ids, however often its own id stands beside them or on other vectors."""
    rows = [(100, [8.0, 0.0])] * 25 + [(100, [9.0 + i, 0.0]) for i in range(15)] + [(100 + i, [8.0, 0.0]) for i in range(1, 11)]
    rows += [(200, [8.0, 0.0])] * 12 + [(300 + i, [1.0, 1.0]) for i in range(10)] + [(5, [0.5, 0.5])] * 30
    got = top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id").isin(100, 5), pivots=3).collect()
    for query, vectors in ((100, {(8.0, 0.0)} | {(9.0 + i, 0.0) for i in range(15)}), (5, {(0.5, 0.5)})):
        lists = []
        for q in vectors:
            scored = sorted((-sum(int(1024 * a) * int(1024 * b) for a, b in zip(q, v)), i) for i, v in rows if i != query)[:10]
            lists += [(query, rank, i, -s) for rank, (s, i) in enumerate(scored, 1)]
        assert sorted(tuple(r) for r in got if r["query_id"] == query) == sorted(lists)
