"""Repeated passages against a dictionary of all strings of the length."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_rows import NASTY, SF_SMALL, docs_of  # noqa: F401

from riskframe.llm import repeats
from riskframe.llm.repeats import drop_repeats, fragments, maximal_repeats, suffix_array


def brute(rows, length):
    """(id, bytes, removed, kept) of documents in order of id; ids must differ where texts do."""
    seen, out = set(), []
    for i, text, *_ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        t = (text or "").encode()
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - length + 1):
            s = t[p:p + length]
            if s in seen:
                gone[p:p + length] = True
            seen.add(s)
        kept = bytes(b for b, g in zip(t, gone) if not g)
        runs = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((i, len(t), int(gone.sum()), runs, kept))
    return sorted(out, key=str)


def run(docs, length, **kw):
    return sorted(((r["id"], r["n_bytes"], r["n_removed"], len(r["spans"]), bytes(r["kept"])) for r in drop_repeats(docs, length=length, **kw).collect()), key=str)


def prose(seed, docs, words=60, parts=12):
    """Texts made of shared passages, cut and edited here and there."""
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randint(2, 8))) for _ in range(words)]
    say = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    shared = [say(rnd.randint(5, 60)) for _ in range(8)]
    rows = []
    for i in range(docs):
        text = ""
        for _ in range(rnd.randint(0, parts)):
            p = rnd.choice(shared)
            text += rnd.choice([say(rnd.randint(1, 30)), p, p[rnd.randrange(len(p)):], p[:rnd.randrange(len(p))] + "#" + p, p + p])
        rows.append((i * 3, text))
    return rows + [(1000 + i, rows[i][1]) for i in range(0, docs, 4)]


@pytest.mark.parametrize("length, group_rows", [(100, 4096), (64, 4096), (80, 3), (50, 2)])
def test_equals_brute_force(docs_of, length, group_rows):
    """Also where crowded keys are cut finer, down to single starts."""
    rows = prose(length, 60)
    want = brute(rows, length)
    assert run(docs_of(rows).repartition(5), length, group_rows=group_rows) == want
    assert sum(w[2] for w in want) > 5000


def test_given_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert run(docs, 100) == brute([(r["doc_id"], r["text"]) for r in docs.collect()], 100)


def test_periodic_texts(docs_of):
    rows = [(1, "a" * 500), (2, "ab" * 300), (3, "b" + "a" * 120), (4, "ba" * 60 + "x" + "a" * 99), (5, "abc" * 50)]
    assert run(docs_of(rows), 100) == brute(rows, 100)


def test_long_texts_in_pieces(docs_of, monkeypatch):
    monkeypatch.setattr(repeats, "AT_ONCE", 256)
    rows = prose(5, 30)
    assert run(docs_of(rows), 60) == brute(rows, 60)


def test_nasty_rows(docs_of):
    long = "the same sentence stands in all of these texts and it is long enough to go where it comes again, ends"
    rows = [*NASTY, (20, long), (20, long), (21, "x" + long), (None, long + "y")]
    want = brute([r for r in rows if r != (20, long)] + [(20, long)], 100)
    want = sorted([*want, (20, len(long), len(long), 1, b"")], key=str)
    assert run(docs_of(rows), 100) == want


def test_rows_that_share_an_id(docs_of):
    """One text stays whole, the others lose what it holds, whatever their order."""
    a, b = "the first " * 12 + "end", "the first " * 15
    got = run(docs_of([(7, a), (7, b), (7, a)]), 60)
    assert got == run(docs_of([(7, a), (7, a), (7, b)]).repartition(3), 60)
    assert sum(n - gone for _, n, gone, _, _ in got) < len(a) and [g[3] for g in got].count(1) == 3


def test_empty_table(docs_of):
    assert run(docs_of([]), 100) == []
    assert run(docs_of([(1, None)]), 100) == [(1, 0, 0, 0, b"")]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=60, max_size=300), min_size=1, max_size=5), st.integers(50, 60))
def test_fragments_cover_every_start_once(texts, length):
    data = np.frombuffer(b"".join(texts), np.uint8)
    text, start, n, key, mark, off = fragments(data, np.cumsum([len(t) for t in texts]), length)
    got = sorted((int(t), int(s) + i) for t, s, m in zip(text, start, n) for i in range(m))
    assert got == [(t, s) for t, x in enumerate(texts) for s in range(len(x) - length + 1)]
    assert (off < length - repeats.WIDTH + 1).all() and (off >= n - 1).all()


@settings(max_examples=150, deadline=None)
@given(st.text("ab", min_size=2, max_size=40).map(str.encode), st.integers(1, 5))
def test_interval_tree_lists_all_maximal_repeats(text, length):
    """Each string of at least the length that occurs twice and can't be extended, with all its occurrences."""
    data = np.frombuffer(text, np.uint8)
    at = np.arange(len(text))
    order, lcp = suffix_array(data, at, len(text) - at, np.zeros(len(text), int))
    assert [text[i:] for i in order] == sorted(text[i:] for i in at)
    left = np.r_[-1, data[:-1].astype(int)]
    got = list(maximal_repeats(order, lcp, left, at, length))
    strings = {text[i:j] for i in at for j in range(i + length, len(text) + 1)}
    want = {}
    for s in strings:
        places = [i for i in at if text.startswith(s, i)]
        befores = {text[i - 1:i] if i else None for i in places}
        afters = {text[i + len(s):i + len(s) + 1] or i for i in places}
        if len(places) > 1 and (len(befores) > 1 or None in befores) and len(afters) > 1:
            want[s] = places
    listed = {}
    for size, first, later in got:
        s = text[first:first + size]
        assert s in want and first == want[s][0] and set(later) <= set(want[s])
        listed[s] = later
    for s, places in want.items():     # every later occurrence is listed here or at a longer repeat
        for p in places[1:]:
            assert any(p in later and t.startswith(s) for t, later in listed.items()) or any(
                q <= p and p + len(s) <= q + len(t) for t, later in listed.items() for q in later)
