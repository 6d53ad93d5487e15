"""Spelling variants against all pairs compared by brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_rows import NASTY, SF_SMALL, docs_of  # noqa: F401

from riskframe.llm.spelling import group_variants, near_pairs, pieces


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows, ratio=10, drop=31, min_n=2):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    n = Counter()
    for i, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = run.translate(low)
            x = zlib.crc32(f"{'null' if i is None else i}:{w}".encode())
            if drop and x % drop == 0:
                w = w[:x % len(w)] + w[x % len(w) + 1:]
            n[w] += 1
    words = {w: c for w, c in n.items() if len(w) >= 7 and c >= min_n}
    by_cut = {}
    for w in words:
        for v in {w} | {w[:i] + w[i + 1:] for i in range(len(w))}:
            by_cut.setdefault(v, set()).add(w)
    near = {w: {v for c in {w} | {w[:i] + w[i + 1:] for i in range(len(w))} for v in by_cut[c] if one_edit(w, v)} for w in words}
    form = {}
    for w, vs in near.items():
        top = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = top if top is not None and words[top] >= ratio * words[w] else None
    out = set()
    for w in words:
        r = w
        while form[r] is not None:
            r = form[r]
        out.add((w, form[w], r, words[w], len(near[w]), words.get(form[w])))
    return out


def run(docs, **kw):
    return [tuple(r) for r in group_variants(docs, **kw).collect()]


def variants(seed, words, texts, alphabet="abcé"):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(7, 11))) for _ in range(words)]
    rows = []
    for i in range(texts):
        line = []
        for _ in range(rnd.randint(0, 60)):
            w = rnd.choice(base[:3] if rnd.random() < 0.7 else base)
            if rnd.random() < 0.2:
                k = rnd.randrange(len(w))
                w = w[:k] + rnd.choice(["", rnd.choice(alphabet), w[k] + rnd.choice(alphabet)]) + w[k + 1:]
            line.append(w.upper() if rnd.random() < 0.1 else w)
        rows.append((i, rnd.choice([" ", ", ", "1"]).join(line)))
    return rows


@pytest.mark.parametrize("place_rows", [50_000, 3])
def test_equals_brute_force(docs_of, place_rows):
    """Also where crowded places are dealt again down to single letters."""
    rows = variants(1, 40, 120)
    got = run(docs_of(rows), place_rows=place_rows)
    assert len(got) == len(set(got)) and set(got) == brute(rows)
    assert any(r[1] for r in got) and any(r[4] > 1 for r in got)


def test_forms_are_followed_to_the_last(docs_of):
    chain = ["qbcdefgh", "qbcdefgxh", "qbcdefgxx", "qbcdefgxxy", "qbcdxfgxxy"]
    rows = [(0, " ".join(w for w, n in zip(chain, (30_000, 3_000, 300, 30, 3)) for _ in range(n)))]
    got = run(docs_of(rows), drop_one_in=0)
    assert set(got) == brute(rows, drop=0) and {r[2] for r in got} == {chain[0]}


def test_without_lost_letters(docs_of):
    rows = variants(2, 25, 80, "ab")
    assert set(run(docs_of(rows), drop_one_in=0, ratio=2)) == brute(rows, 2, 0)


def test_given_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert set(run(docs)) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_nasty_rows(docs_of):
    long = "x" * 70_000 + " " + "x" * 69_999 + " " + "×" * 8 + " İstanbul STRASSEN strassen "
    rows = [*NASTY, (20, long), (20, long), (21, "Ünïcode ünïcode UNICODE unicode " * 3), (22, "ÀBCDEFG àbcdefg Àbcdefg")]
    assert set(run(docs_of(rows))) == brute(rows)


def test_empty_table(docs_of):
    assert run(docs_of([])) == []
    assert run(docs_of([(1, None), (2, "short")])) == []


def test_long_texts_are_cut_between_words(monkeypatch):
    monkeypatch.setattr("riskframe.llm.spelling.PIECE", 10)
    text = "abcdefghijklmnop qrs tuvwxyzabc defgh " * 5
    parts = list(pieces(text, re.compile("[a-z]")))
    assert "".join(parts) == text and len(parts) > 5
    assert sum((p.split() for p in parts), []) == text.split()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sets(st.text("abc", min_size=0, max_size=6), min_size=1, max_size=25), min_size=1, max_size=4))
def test_scan_of_several_lists(lists):
    """Every pair of one list at one edit, both ways, never across lists."""
    entries = [(p, w) for p, ws in enumerate(lists) for w in sorted(ws)]
    place = np.array([p for p, _ in entries])
    i, j = near_pairs(place, [w for _, w in entries], np.zeros(len(place), int), np.full(len(place), 99))
    want = {(x, y) for x, a in enumerate(entries) for y, b in enumerate(entries) if a[0] == b[0] and one_edit(a[1], b[1])}
    assert len(i) == len(want) and set(zip(i.tolist(), j.tolist())) == want
