"""Line dedup and source mixing against brute force."""

import hashlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from riskframe.llm import mixing, mph, queries
from riskframe.llm.common import SPACE
from riskframe.llm.linededup import dedup_lines

from llm_rows import NASTY, SF_SMALL, docs_of  # noqa: F401


def brute_lines(rows, min_chars=20, min_docs=3):
    key = lambda line: line.strip(SPACE).lower()
    split = [(i, (t or "").encode().split(b"\n")) for i, t in rows]
    docs, keeper = defaultdict(int), {}
    for i, lines in split:
        for k in {key(x) for x in lines if len(key(x).decode()) >= min_chars}:
            docs[k] += 1
            keeper[k] = max(keeper.get(k, -1), -1 if i is None else i)
    out = []
    for i, lines in split:
        kept = [x for x in lines if not (docs.get(key(x), 0) >= min_docs and (-1 if i is None else i) != keeper[key(x)])]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256(b"\n".join(kept)).hexdigest()))
    return sorted(out, key=str)


def line_rows(docs, **params):
    got = dedup_lines(docs, **params).select("row.doc_id", "n_lines", "n_dropped", "kept_sha256").collect()
    return sorted((tuple(r) for r in got), key=str)


LONG = "this line is long enough to count"


@pytest.mark.parametrize("params", [{}, {"shard_keys": 2, "per_salt": 2}])
def test_line_dedup_matches_brute_force(docs_of, params):
    rows = NASTY + [(10 + i, f"own line number {i} of this text\n  {LONG.upper() if i % 2 else LONG}\t\nshort\n\n{LONG}") for i in range(9)]
    rows += [(40 + i, "é" * 20 + "\n" + "é" * 19) for i in range(3)]
    assert line_rows(docs_of(rows), **params) == brute_lines(rows)


def test_line_dedup_of_an_empty_table(docs_of):
    assert line_rows(docs_of([])) == []


def test_minimal_perfect_hash_is_a_bijection():
    rng = np.random.default_rng(0)
    h = rng.integers(0, 1 << 63, (2, 5000), dtype=np.uint64)
    h[0, :50] = h[0, 0]                      # equal first halves are told apart by the second
    sizes, bits = mph.build(h[0], h[1])
    at = mph.index(h[0], h[1], sizes, *mph.ranks(bits))
    assert sorted(at) == list(range(5000)) and len(bits) * 8 < 5 * 5000


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_oracles(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    want = con.execute(queries.ORACLE[name])
    cols = [c[0] for c in want.description]
    got = queries.QUERIES[name](spark, SF_SMALL).select(*cols).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall())


def brute_sainte_lague(votes, seats):
    got = [0] * len(votes)
    for _ in range(seats if sum(votes) else 0):
        best = max(range(len(votes)), key=lambda i: (votes[i] / (2 * got[i] + 1), -i))
        got[best] += 1
    return got


def test_sainte_lague_matches_highest_quotients():
    rng = np.random.default_rng(3)
    for _ in range(50):
        votes = rng.integers(0, 60, rng.integers(1, 8)).tolist()
        seats = int(rng.integers(0, 90))
        assert mixing.sainte_lague(votes, seats).tolist() == brute_sainte_lague(votes, seats)
    assert mixing.sainte_lague([1e12, 3e12, 5.0], 10 ** 9).sum() == 10 ** 9


def test_targets_reshare_the_excess():
    assert mixing.fill_targets([100, 100, 100], [1, 2, 3], 3).tolist() == [50, 100, 150]
    assert mixing.fill_targets([1, 1, 998], [1, 2, 3], 3).tolist() == [3, 3, 994]
    assert mixing.fill_targets([0, 10], [3, 1], 3).tolist() == [0, 10]


def test_mixing_meets_its_contract(spark):
    rows = [(i, "w " * (i % 50) + f"\tx{i}\n", [None, "b", "a", "hot", "hot", "hot"][i % 6]) for i in range(600)]
    rows += [(600, None, "tiny"), (601, "one", "tiny"), (None, "no id", "b"), (5, "w w", "hot"), (5, "w w", "hot")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 as size", "2 as target", "3 as row")
    run = lambda **p: sorted((tuple(r) for r in mixing.mix_sources(docs, **p).select(
        "row.doc_id", "source", "size", "source_size", "target", "taken").collect()), key=str)
    for params in ({}, {"shard_tokens": 500, "block_tokens": 16}):
        got = run(**params)
        assert len(got) == len(rows) and got == run(**params)
        sizes, taken, target = defaultdict(int), defaultdict(int), {}
        for _, s, size, whole, t, k in got:
            sizes[s] += size
            taken[s] += k
            target[s] = (whole, t)
            assert 0 <= k <= 3 * size
        order = sorted(sizes, key=lambda s: (s is None, s))
        want = mixing.fill_targets([sizes[s] for s in order], [1 + i % 3 for i in range(len(order))], 3)
        for s, t in zip(order, want):
            assert target[s] == (sizes[s], pytest.approx(t)) and abs(taken[s] - t) <= max(64, 0.02 * t)
    assert mixing.mix_sources(docs.limit(0)).count() == 0
    nothing = mixing.mix_sources(docs.filter("text is null")).collect()
    assert [(r["target"], r["taken"]) for r in nothing] == [(0.0, 0)]
