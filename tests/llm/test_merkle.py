"""The Merkle manifest against a plain recursive tree."""

import hashlib
import zlib

import pytest
from llm_rows import NASTY
from pyspark.sql import functions as F

from riskframe.llm.merkle import manifest, numbered

COLUMNS = "doc_id long, source string, lang string, n_chars long, text string"


def h(s):
    return hashlib.sha256(s if isinstance(s, bytes) else s.encode()).hexdigest()


def leaf(row, text):
    out = b""
    for v in (*row[:4], text):
        raw = None if v is None else str(v).encode()
        out += b"-" if raw is None else str(len(raw)).encode() + b":" + raw
    return h(out)


def climb(nodes, fan):
    """Root of the nodes, and the siblings of each original node level by level as (before, after)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i:i + fan] for i in range(0, len(nodes), fan)]
        for i, place in enumerate(at):
            run = runs[place // fan]
            paths[i].append(("".join(run[:place % fan]), "".join(run[place % fan + 1:])))
        at, nodes = [p // fan for p in at], [h("".join(r)) for r in runs]
    return nodes[0], paths


def expected(rows, fan=3):
    key = lambda v: (v is not None, v)
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        members = sorted(groups[s], key=lambda r: (key(r[0]), leaf(r, r[4])))
        trees[s] = (members, *climb([leaf(r, r[4]) for r in members], fan))
    root, tops = climb([trees[s][1] for s in order], fan) if order else (None, [])
    out = []
    for s, top in zip(order, tops):
        members, sub, paths = trees[s]
        for r, path in zip(members, paths):
            path = path + top
            cut = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None
            fold = leaf(r, r[4].replace("\n", "") if cut else r[4])
            for before, after in path:
                fold = h(before + fold + after)
            out.append((r[0], leaf(r, r[4]), sub, root, h("".join(b + a for b, a in path)), fold, fold == root))
    return out


def run(spark, rows, **kw):
    docs = spark.createDataFrame(rows, COLUMNS).selectExpr("*", "'x' as grp", "'y' as rank", "'z' as hash", "1 as block")
    cut = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit("")))
    found = manifest(docs, changed={"text": cut}, **kw).drop("path")
    return [tuple(r) for r in found.collect()]


def key(r):
    return (r[0] is None, r[0] or 0, r[1:6])


@pytest.mark.parametrize("digits", [1, 2, 4])
def test_equals_the_plain_tree(spark, digits):
    sizes = {"b": 31, "a": 1, None: 9, "é": 2, "": 4, "hot": 100}
    rows = [(i * 7 + len(s or ""), s, "en" if i % 3 else None, i, f"line {i}\nrest" if i % 2 else "no break") for s, n in sizes.items() for i in range(n)]
    assert sorted(run(spark, rows, digits=digits), key=key) == sorted(expected(rows), key=key)


def test_another_fan(spark):
    rows = [(i, "s" if i % 4 else "t", None, None, None if i % 5 == 0 else "a\nb" * i) for i in range(40)]
    docs = spark.createDataFrame(rows, COLUMNS)
    got = {r["id"]: (r["subroot"], r["root"], r["verified"]) for r in manifest(docs, fan=4, digits=2).collect()}
    assert got == {r[0]: (r[2], r[3], True) for r in expected(rows, 4)}


def test_nasty_rows(spark):
    rows = [(i, None if n % 2 else "s", None, None, t) for n, (i, t) in enumerate(NASTY)] + [(4, "s", None, None, "other")] + [(9, "t", "l", 1, "same\n")] * 5
    assert sorted(run(spark, rows, digits=2), key=key) == sorted(expected(rows), key=key)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_numbers_are_places_whatever_the_parts(spark):
    rows = spark.createDataFrame([("hot" if i % 3 else f"g{i % 7}", i % 50) for i in range(600)], "grp string, ord long").repartition(5)
    got = numbered(rows, "grp", ["ord"]).collect()
    for g in {r["grp"] for r in got}:
        inside = sorted((r["rank"], r["ord"]) for r in got if r["grp"] == g)
        assert [r for r, _ in inside] == list(range(len(inside)))
        assert [o for _, o in inside] == sorted(o for _, o in inside)
