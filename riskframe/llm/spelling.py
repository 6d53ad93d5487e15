"""Spelling variants: words one edit apart, found by dynamic programming down sorted lists.

1. Tasks count the words of whole texts; the counts of equal words are added up.
2. Two words at one edit, the shorter of c letters, agree in their first c // 2 letters
   or in the other c - c // 2 at the end. Each word is dealt to both places, for c = its
   length and one less (as the longer one); what the place leaves open is its hole.
   A place with more words than ``place_rows`` is dealt once more by the halves
   of its hole, and so on; at a hole of one letter a place holds one word a letter.
3. A place's holes are sorted; adjacent common prefixes (LCPs) make its lists of
   children. All its words walk down at once: a row of the banded edit matrix (three
   cells) per word and shared prefix is computed once for all list entries that share
   it, and entries whose shared prefix already takes more than one edit are skipped.
4. A word's form is its near word of largest count; forms are followed to their
   roots by doubling. A form has ``ratio`` times its word's count, so chains are short.

Null texts have no words; empty texts neither. Texts of any length are read in pieces cut
between words. A null doc_id counts as the text ``null``. Rows that repeat an id or a text count
each time; ties of the largest count go to the smaller word. Empty tables
give no rows, other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import stored

LETTERS = "A-Za-zÀ-ÿ"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PIECE = 1 << 20     # characters of a text that are split at once
FAR = 2             # more than one edit


def pieces(text: str, letters: re.Pattern) -> Iterator[str]:
    """The text in pieces that end between words."""
    start = 0
    while len(text) - start > PIECE:
        end = start + PIECE
        while end < len(text) and letters.match(text[end]):
            end += 1
        yield text[start:end]
        start = end
    yield text[start:] if start else text


def word_counts(docs: DataFrame, id_col: str, text_col: str, min_chars: int, drop_one_in: int) -> DataFrame:
    """word, n: occurrences of each word, one letter lost wherever ``drop_one_in`` divides the hash of id and word."""

    def run(batches):
        letter, words = re.compile(f"[{LETTERS}]"), re.compile(f"[{LETTERS}]{{{min_chars},}}")
        for b in batches:
            found: Counter[str] = Counter()
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                salt = zlib.crc32(f"{'null' if i is None else i}:".encode())
                for piece in pieces(text or "", letter):
                    for w, n in Counter(words.findall(piece)).items():
                        w = w.lower() if w.isascii() else w.translate(LOWER)
                        hit = zlib.crc32(w.encode(), salt) if drop_one_in else 1
                        if drop_one_in and hit % drop_one_in == 0:
                            at = hit % len(w)
                            w = w[:at] + w[at + 1:]
                            if len(w) < min_chars:
                                continue
                        found[w] += n
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["word", "n"])

    return (docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")))


def first_places(words: DataFrame, min_chars: int) -> DataFrame:
    """place, hole, first, word: what each word leaves open (``hole``) at the places it is dealt to.

    ``first``: letters at the hole's start in which a pair that is near at this
    place may not agree, because another place has it (0: none).
    """
    chars = F.char_length("word")
    c = F.explode(F.array(chars, chars - 1))
    return words.select("word", c.alias("c")).filter(F.col("c") >= min_chars).selectExpr(
        "word", "c", "explode(array(struct(c div 2 as a, 0 as b), struct(0 as a, c - c div 2 as b))) as cut").selectExpr(
        "concat_ws(',', c, cut.a, cut.b, substring(word, 1, cut.a), right(word, cut.b)) as place",
        "substring(word, cut.a + 1, char_length(word) - cut.a - cut.b) as hole", "if(cut.a = 0, c div 2, 0) as first", "c - cut.a - cut.b as open", "word")


def next_places(held: DataFrame) -> DataFrame:
    """The same for words of crowded places: the hole is halved."""
    cuts = "array(struct(open div 2 as a, 0 as b), struct(0 as a, open - open div 2 as b))"
    return held.selectExpr("*", f"explode({cuts}) as cut").filter("cut.a = 0 or first = 0 or first > cut.a").selectExpr(
        "concat_ws(',', place, cut.a, cut.b, substring(hole, 1, cut.a), right(hole, cut.b)) as place",
        "substring(hole, cut.a + 1, char_length(hole) - cut.a - cut.b) as hole",
        "case when cut.a > 0 then if(first = 0, 0, first - cut.a) when first = 0 then open div 2 else least(first, open div 2) end as first",
        "open - cut.a - cut.b as open", "word")


def child_lists(flat: np.ndarray, at: np.ndarray, size: np.ndarray, place: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each depth d, where in the sorted list the children at depth d + 1 start and end.

    The list holds the places one after the other; a child is a run of entries of
    one place that share d + 1 letters: it starts where the LCP with the entry
    before is at most d.
    """
    n = len(at)
    new = np.r_[True, place[1:] != place[:-1]]
    lcp = np.where(new, -1, 0)
    alive, d = np.flatnonzero(~new), 0
    while len(alive):  # entries that share d letters with the one before
        alive = alive[(size[alive] > d) & (size[alive - 1] > d)]
        alive = alive[flat[at[alive] + d] == flat[at[alive - 1] + d]]
        d += 1
        lcp[alive] = d
    starts, ends = [], []
    for d in range(int(size.max(initial=0))):
        edge = np.flatnonzero(lcp <= d)
        own = size[edge] > d
        starts.append(edge[own])
        ends.append(np.r_[edge[1:], n][own])
    return starts, ends


def near_pairs(place: np.ndarray, holes: list[str], first: np.ndarray, open_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes (word, near word) of the entries one edit apart, both ways. Entries are sorted by place and hole."""
    size = np.array([len(h) for h in holes])
    at = np.cumsum(size + 2) - size     # one 0 before and after each hole
    flat = np.zeros(int(size.sum()) + 2 * len(holes) + 2, np.uint32)
    text = np.frombuffer("".join(holes).encode("utf-32-le"), np.uint32)
    flat[np.repeat(at - (np.cumsum(size) - size), size) + np.arange(len(text))] = text
    starts, ends = child_lists(flat, at, size, place)

    top = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    stop = np.r_[top[1:], len(place)]
    q = np.arange(len(place))                       # walkers: the word, its list range, three cells of its row
    s, e = np.repeat(top, stop - top), np.repeat(stop, stop - top)
    lo, mid, hi = np.full(len(q), FAR, np.int8), np.zeros(len(q), np.int8), np.ones(len(q), np.int8)
    left, right = [], []
    for d in range(len(starts) + 1):
        gap = size[q] - d
        done = size[s] == d                         # the entry that ends here is the first of its range
        cost = np.where(gap == 0, mid, np.where(gap == -1, lo, np.where(gap == 1, hi, FAR)))
        hit = done & (cost == 1)
        left.append(q[hit])
        right.append(s[hit])
        if d == len(starts):
            break
        a, b = np.searchsorted(starts[d], s), np.searchsorted(starts[d], e)
        many = b - a
        child = np.repeat(a - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
        q, lo, mid, hi = (np.repeat(v, many) for v in (q, lo, mid, hi))
        s, e = starts[d][child], ends[d][child]
        letter, base, length = flat[at[s] + d], at[q] + d, size[q]
        lo = np.minimum(lo + (flat[base - 1] != letter), mid + 1).astype(np.int8)
        lo[length < d] = FAR
        mid_ = np.minimum(np.minimum(mid + (flat[np.minimum(base, len(flat) - 1)] != letter), hi + 1), lo + 1)
        mid_[length < d + 1] = FAR
        hi = np.minimum(hi + (flat[np.minimum(base + 1, len(flat) - 1)] != letter), mid_ + 1)
        hi[length < d + 2] = FAR
        mid = mid_
        live = (lo <= 1) | (mid <= 1) | (hi <= 1)
        q, s, e, lo, mid, hi = (v[live] for v in (q, s, e, lo, mid, hi))
    i, j = np.concatenate(left), np.concatenate(right)
    both_long = (size[i] > open_[i]) & (size[j] > open_[j])  # such a pair belongs to the next length
    shared = np.array([f > 0 and holes[x][:f] == holes[y][:f] for x, y, f in zip(i, j, first[i])], bool)
    keep = ~both_long & ~shared
    return i[keep], j[keep]


def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by place and hole: whole places are gathered up to some rows, then searched together."""
    held: list[pa.RecordBatch] = []

    def solve(t: pa.Table) -> pa.RecordBatch:
        place = t.column("place").combine_chunks().dictionary_encode().indices.to_numpy()
        n = np.bincount(place)[place] if len(place) else place
        t, place = t.filter(pa.array(n > 1)), place[n > 1]
        holes = t.column("hole").to_pylist()
        at = np.array(sorted(range(t.num_rows), key=lambda x: (place[x], holes[x])), np.int64)
        words = t.column("word").to_numpy()[at]
        i, j = (near_pairs(place[at], [holes[x] for x in at], t.column("first").to_numpy()[at], t.column("open").to_numpy()[at])
                if len(at) else (at, at))
        return pa.RecordBatch.from_arrays([pa.array(words[i], pa.string()), pa.array(words[j], pa.string())], names=["word", "near"])

    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        if sum(x.num_rows for x in held) < 20_000:
            continue
        t = pa.Table.from_batches(held)
        place = t.column("place")
        last, cut = place[-1].as_py(), t.num_rows
        while cut and place[cut - 1].as_py() == last:
            cut -= 1
        if cut:
            yield solve(t.slice(0, cut))
            held = t.slice(cut).to_batches()
    if held:
        yield solve(pa.Table.from_batches(held))


def near_words(words: DataFrame, min_chars: int, place_rows: int) -> DataFrame:
    """word, near: each pair of ``words`` one edit apart, both ways, once."""
    spark = words.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt, found = first_places(words, min_chars), None
    while True:
        size = dealt.filter("open > 1").groupBy("place").agg(F.count(F.lit(1)).alias("n"))
        full = stored(size.filter(F.col("n") > place_rows).select("place"), "spelling-full")
        crowded = not full.isEmpty()
        rows = dealt.join(full, "place", "left_anti") if crowded else dealt
        pairs = (rows.repartition(parts, "place").sortWithinPartitions("place")
                 .mapInArrow(scan, "word string, near string"))
        pairs = stored(pairs, "spelling-pairs")
        found = pairs if found is None else found.unionByName(pairs)
        if not crowded:
            return found
        dealt = stored(next_places(dealt.join(full, "place", "left_semi")), "spelling-places")


def roots(forms: DataFrame) -> DataFrame:
    """word, root: ``form`` followed to the last word; each round doubles the steps taken."""
    at = stored(forms.filter("form is not null").select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        step = at.select(F.col("word").alias("_w"), F.col("root").alias("_r"))
        new = stored(at.join(step, at["root"] == step["_w"], "left")
                     .select("word", F.coalesce("_r", "root").alias("root"), F.col("_r").isNotNull().alias("moved")), "spelling-roots")
        at = new.select("word", "root")
        if new.filter("moved").isEmpty():
            return at


def group_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 7, min_n: int = 2,
                   ratio: int = 10, drop_one_in: int = 31, place_rows: int = 50_000) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of at least ``min_chars`` letters and ``min_n`` occurrences.

    ``drop_one_in``: words lose a letter where this divides their hash (0: never).
    """
    words = stored(word_counts(docs, id_col, text_col, min_chars, drop_one_in).filter(F.col("n") >= min_n), "spelling-words")
    pairs = near_words(words.select("word"), min_chars, place_rows)
    near = pairs.join(words.select(F.col("word").alias("near"), "n"), "near")
    best = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n")).alias("n"), "near")).alias("top"))
    largest = -F.col("top.n")
    formed = stored(words.join(best, "word", "left")
                    .select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                            F.when(largest >= ratio * F.col("n"), F.col("top.near")).alias("form"),
                            F.when(largest >= ratio * F.col("n"), largest).alias("form_n")), "spelling-forms")
    return (formed.join(roots(formed), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
