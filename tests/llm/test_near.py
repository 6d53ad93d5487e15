"""Near-duplicate classes and components against brute force."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from riskframe.llm import neardup
from riskframe.llm.components import components

from llm_rows import NASTY, docs_of  # noqa: F401


def brute_classes(rows, threshold=0.8, gain=0.25):
    words = [(t or "").encode().lower().split() for _, t in rows]
    bags = [Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter() for w in words]
    df = Counter(s for b in bags for s in b)
    n = len(rows)
    scale = gain / max(1.0, math.log(max(2, n)))
    weights = [{s: c * (1 + scale * math.log(n / df[s])) for s, c in b.items()} for b in bags]
    root = list(range(n))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            low = sum(min(w, weights[j].get(s, 0)) for s, w in weights[i].items())
            high = sum(weights[i].values()) + sum(weights[j].values()) - low
            if words[i] == words[j] or rows[i][0] == rows[j][0] is not None or high and low / high >= threshold:
                root[max(top(i), top(j))] = min(top(i), top(j))
    return [top(i) for i in range(n)]


def corpus():
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(3000)]
    passage = [rng.choice(vocab) for _ in range(60)]
    rows = list(NASTY)
    for g in range(25):
        base = [rng.choice(vocab) for _ in range(rng.choice([8, 60, 200]))] + (passage if g % 2 else [])
        for c in range(rng.choice([1, 2, 5])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, len(base) // 20])):
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            rows.append((100 + len(rows), " ".join(copy) if c % 2 else "  ".join(copy).upper()))
    return rows


def partition(ids, labels):
    groups = defaultdict(list)
    for i, g in zip(ids, labels):
        groups[g].append(i)
    return sorted(sorted(g) for g in groups.values())


@pytest.mark.parametrize("bucket_part", [256, 3])
def test_classes_match_brute_force(docs_of, bucket_part):
    rows = corpus()
    got = neardup.near_duplicates(docs_of(rows), bucket_part=bucket_part).collect()
    assert len(got) == len(rows)
    told = [(r["id"], r["class_id"]) for r in got if r["id"] in dict(rows)]
    want = [(i, c) for (i, _), c in zip(rows, brute_classes(rows)) if i is not None]
    assert partition(*zip(*told)) == partition(*zip(*want))
    smallest = {g[0] for g in partition(*zip(*told))}
    assert {c for _, c in told} == smallest


def test_large_group_of_near_copies_is_one_class(docs_of):
    """More copies than a bucket part holds, each with its own edit: nothing is lost, nothing is paired in full."""
    rng = random.Random(1)
    base = [f"b{i}" for i in range(300)]
    rows = []
    for k in range(400):
        copy = list(base)
        copy[rng.randrange(300)] = f"edit{k}"
        rows.append((k, " ".join(copy)))
    rows += [(1000 + k, " ".join(f"c{k}x{i}" for i in range(80))) for k in range(20)]
    got = {r["id"]: r["class_id"] for r in neardup.near_duplicates(docs_of(rows), bucket_part=64).collect()}
    assert {got[k] for k in range(400)} == {0} and all(got[k] == k for k in range(1000, 1020))


def test_original_with_many_variants_that_are_not_near_each_other(docs_of):
    """Every variant hangs on the original alone, and the buckets are much larger than a part."""
    rng = random.Random(6)
    base = [f"b{i}" for i in range(200)]
    rows = [(0, " ".join(base))]
    for k in range(1, 601):
        copy = list(base)
        for at in rng.sample(range(200), 3):
            copy[at] = f"edit{k}x{at}"
        rows.append((k, " ".join(copy)))
    got = {r["id"]: r["class_id"] for r in neardup.near_duplicates(docs_of(rows), bucket_part=16).collect()}
    assert set(got.values()) == {0}


def test_empty_table(docs_of):
    assert neardup.near_duplicates(docs_of([])).collect() == []


def test_samples_estimate_weighted_jaccard():
    rng = np.random.default_rng(5)
    for share in (0.5, 0.8, 0.95):
        keys = np.sort(rng.integers(0, 1 << 63, 2000, dtype=np.uint64))
        w = rng.uniform(1, 3, 2000).astype(np.float32)
        mine = rng.random(2000) < share
        a, b = np.flatnonzero(mine | (rng.random(2000) < 0.5)), np.flatnonzero(mine | (rng.random(2000) < 0.5))
        true = neardup.weighted_jaccard(keys[a].tobytes(), w[a].tobytes(), keys[b].tobytes(), w[b].tobytes())
        told = (neardup.draw(keys[a], w[a]) == neardup.draw(keys[b], w[b])).mean()
        assert abs(told - true) < 4 * math.sqrt(true * (1 - true) / neardup.SAMPLES) + 0.02


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, k) for k in range(101, 140)] + [(200, 201), (201, 202), (202, 200), (201, 200), (300, 300)]
    got = {r["v"]: r["c"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[k] for k in range(31)} == {0} and {got[k] for k in range(100, 140)} == {100}
    assert {got[k] for k in (200, 201, 202)} == {200} and got[300] == 300
