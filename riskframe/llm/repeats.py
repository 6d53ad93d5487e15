"""Repeated passages: maximal repeats from enhanced suffix arrays, removed wherever they occur again.

Two equal strings of ``length`` bytes hold the same anchor: the smallest hash among their
strings of WIDTH bytes. So a text is cut into fragments, one an anchor: the starts
whose string has that anchor, with the bytes of their strings. Equal strings lie at the
same place of fragments with one key (the anchor's hash).

1. Tasks cut texts and emit (key, hash of the fragment, place). Of equal fragments of
   a batch only the first goes on, the others are spans to remove. The rest meet in key
   order: the first of equal ones stays as a leaf for all copies, the others are spans.
2. Keys with different fragments are the candidates; their bytes are fetched from the texts.
3. Fragments of one key (several keys at once) make an enhanced suffix array: sorted
   suffixes of the starts and longest common prefixes (LCP). A stack scan builds the
   common-prefix interval tree; an interval of at least ``length`` bytes whose bytes to
   the left differ is a maximal repeat. Its first occurrence (in document order, then
   by start) stays, all others are spans as long as the repeat. An occurrence is listed at
   the deepest interval that has an earlier one, so the lists stay linear.
4. A key with more than ``group_rows`` fragments is cut finer: starts by halves of their
   distance to the anchor, keyed by the longer string that all of them hold. With one
   start left, all fragments of a key are equal and thus one leaf.
5. A document's spans are gathered and the bytes they cover removed.

Documents stand in order of id, a null id last (the largest long stands for it). Rows
that share an id are documents of their own in order of a hash of their text; equal
rows are copies of each other, one of them first. Null texts are empty; texts shorter than ``length``
bytes keep all. Empty tables give no rows, other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import stored

WIDTH = 48            # bytes of an anchor
AT_ONCE = 1 << 20     # bytes of text hashed at once (below 2 ** 24)
LAST = np.iinfo(np.int64).max
BASE = 0x9E3779B97F4A7C15
BYTES = np.random.default_rng(12).integers(0, 2 ** 64, 256, np.uint64)   # a random word for each byte
SALTS = 32
FRAGMENT, SPAN = 0, 1                                # kinds of rows; a span's n is its size
PLACE = "kind int, id long, tie long, start int, n int"
HASHED = f"{PLACE}, key long, mark long, off int"
WITH_BYTES = f"{HASHED}, bytes binary"


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Hashes:
    """Hashes of any substrings of some bytes, from sums of byte words times powers of an odd base."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTES[data] * powers(BASE, len(data)), out=self.sums[1:], dtype=np.uint64)
        self.back = powers(pow(BASE, -1, 2 ** 64), len(data) + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.sums[end] - self.sums[start]) * self.back[start]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0x94D049BB133111EB)
        return h ^ h >> np.uint64(29)


def fragments(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """text, start, n, key, mark, off of every fragment of the texts (each at least ``length`` bytes) that end at ``ends``.

    ``off``: the anchor's distance from the start; ``mark``: the hash of the fragment's bytes."""
    places = np.arange(len(data) - WIDTH + 1)
    h = Hashes(data)
    anchors = h.of(places, places + WIDTH)
    # the smallest hash of each run, the leftmost of equal ones: packed with its position
    low = (anchors >> np.uint64(24) << np.uint64(24)) | places.astype(np.uint64)
    run, step = length - WIDTH + 1, 1
    while step * 2 <= run:
        low, step = np.minimum(low[:-step], low[step:]), step * 2
    low = np.minimum(low[:len(low) - (run - step)], low[run - step:])
    begins = np.r_[0, ends[:-1]]
    many = ends - begins - length + 1
    starts = np.repeat(begins - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
    text = np.repeat(np.arange(len(ends)), many)
    owner = (low[starts] & np.uint64((1 << 24) - 1)).astype(np.int64)
    at = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    n, first, text, owner = np.diff(np.r_[at, len(starts)]), starts[at], text[at], owner[at]
    return text, first - begins[text], n, anchors[owner], h.of(first, first + n + length - 1), owner - first


def lots(texts: list[bytes], length: int) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Texts long enough, some bytes of them at once; a longer text in overlapping pieces (text, offset, bytes)."""
    who, where, held, size = [], [], [], 0
    for i, t in enumerate(texts):
        for start in range(0, len(t) - length + 1, AT_ONCE):
            piece = t[start:start + AT_ONCE + length - 1]
            if size + len(piece) > 2 * AT_ONCE:
                yield who, where, held
                who, where, held, size = [], [], [], 0
            who.append(i)
            where.append(start)
            held.append(piece)
            size += len(piece)
    if held:
        yield who, where, held


def merged(spans: pd.DataFrame) -> pd.DataFrame:
    """Spans in order of place, those of a document that touch as one."""
    if not len(spans):
        return spans
    end = (spans["start"] + spans["n"]).to_numpy()
    top = spans.assign(end=end).groupby(["id", "tie"], sort=False)["end"].cummax().to_numpy()
    same = np.r_[False, (spans["id"].to_numpy()[1:] == spans["id"].to_numpy()[:-1]) & (spans["tie"].to_numpy()[1:] == spans["tie"].to_numpy()[:-1])]
    new = ~same
    new[1:] |= spans["start"].to_numpy()[1:] > top[:-1]
    at = np.flatnonzero(new)
    out = spans.iloc[at].copy()
    out["n"] = top[np.r_[at[1:] - 1, len(spans) - 1]] - out["start"].to_numpy()
    return out


def settle(pdf: pd.DataFrame, length: int) -> pd.DataFrame:
    """Fragments of a batch: the first of equal ones stays, the others turn into spans."""
    pdf = pdf.sort_values(["id", "tie", "start"], kind="stable")
    again = pdf.duplicated(["key", "mark", "n"])
    return pd.concat([pdf[~again], merged(as_spans(pdf[again], length))])


def as_spans(pdf: pd.DataFrame, length: int) -> pd.DataFrame:
    """Whole fragments as spans."""
    return pdf.assign(kind=SPAN, n=pdf["n"].to_numpy() + length - 1)


def as_batch(pdf: pd.DataFrame) -> pa.RecordBatch:
    return pa.RecordBatch.from_pandas(pdf.astype({"kind": "int32", "start": "int32", "n": "int32", "off": "int32"}), preserve_index=False)


def cut_texts(texts: DataFrame, length: int) -> DataFrame:
    """Fragments of all texts (id, tie, text)."""

    def run(batches):
        for b in batches:
            ids, ties = (b.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            own = np.flatnonzero(~pd.DataFrame({"id": ids, "tie": ties}).duplicated())   # equal rows are cut once
            held = b.column(2).take(pa.array(own)).to_pylist()
            for who, where, parts in lots(held, length):
                ends = np.cumsum([len(t) for t in parts])
                text, start, n, key, mark, off = fragments(np.frombuffer(b"".join(parts), np.uint8), ends, length)
                at = own[np.array(who)[text]]
                pdf = pd.DataFrame({"kind": FRAGMENT, "id": ids[at], "tie": ties[at], "start": start + np.array(where)[text], "n": n,
                                    "key": key.view(np.int64), "mark": mark.view(np.int64), "off": off})
                yield as_batch(settle(pdf, length))

    return texts.mapInArrow(run, HASHED)


def meet(rows: DataFrame, length: int) -> DataFrame:
    """Fragments with others of their key: the first of equal ones as they are, the rest as spans; a key's
    only fragment goes. Spans pass. Copies of a place (equal rows) count once."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        last = alone = None      # the last fragment, and the first of its key while no other one is known
        for b in batches:
            pdf = b.to_pandas()
            spans = pdf[pdf["kind"] == SPAN]
            if len(spans):
                yield as_batch(spans)
            pdf = pdf[pdf["kind"] == FRAGMENT]
            if not len(pdf):
                continue
            keys = ["key", "mark", "n", "id", "tie", "start"]
            now = pdf[keys].to_numpy()
            same = np.equal(now, np.vstack([now[:1] if last is None else last, now[:-1]]))
            if last is None:
                same[0] = False
            last = now[-1:]
            same_key, equal, copy = same[:, 0], same[:, :3].all(1), same.all(1)
            other = same_key & ~equal
            key_no = np.cumsum(~same_key)
            more = np.bincount(key_no, other, key_no[-1] + 1) > 0
            if alone is not None and more[0]:
                yield as_batch(alone)
            if more[0] or key_no[-1]:
                alone = None
            first = ~same_key
            if key_no[-1] and not more[-1]:
                alone = pdf[first & (key_no == key_no[-1])]
            out = pd.concat([pdf[other | first & more[key_no]], as_spans(pdf[equal & ~copy], length)])
            if len(out):
                yield as_batch(out)

    place = F.when(F.col("kind") == SPAN, F.xxhash64("id", "tie")).otherwise(F.col("key"))  # spans need not go to their key
    return (rows.repartition(parts, place).sortWithinPartitions("kind", "key", "mark", "n", "id", "tie", "start")
            .mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)))


def packed(texts: DataFrame) -> DataFrame:
    """id, tie, packed, copies: the distinct texts, compressed for the shuffle."""

    def run(batches):
        for b in batches:
            pack = zstandard.ZstdCompressor(level=3).compress
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([pack(t) for t in b.column(2).to_pylist()], pa.binary())],
                                             names=["id", "tie", "packed"])

    return (texts.mapInArrow(run, "id long, tie long, packed binary")
            .groupBy("id", "tie").agg(F.first("packed").alias("packed"), F.count(F.lit(1)).alias("copies")))


def with_bytes(places: DataFrame, texts: DataFrame, length: int) -> DataFrame:
    """The fragments with their bytes."""
    of_text = places.groupBy("id", "tie").agg(F.collect_list(F.struct("start", "n", "key", "mark", "off")).alias("places"))

    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for b in batches:
            many = b.column(3).value_lengths().to_numpy()
            flat = b.column(3).flatten()
            start, n = flat.field("start").to_numpy(), flat.field("n").to_numpy()
            of, end, lo = np.repeat(np.arange(b.num_rows), many), np.cumsum(many), 0
            found: list[bytes] = []
            size = 0
            for i in range(b.num_rows):
                text = unpack(b.column(2)[i].as_py())
                here = slice(end[i] - many[i], end[i])
                found += [text[x:x + m + length - 1] for x, m in zip(start[here].tolist(), n[here].tolist())]
                size += len(text)
                if size < 4 * AT_ONCE and i + 1 < b.num_rows:
                    continue
                own = slice(lo, end[i])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(found), FRAGMENT, np.int32)), b.column(0).take(pa.array(of[own])), b.column(1).take(pa.array(of[own])),
                     *(flat.field(c)[lo:end[i]] for c in ("start", "n", "key", "mark", "off")), pa.array(found, pa.binary())],
                    names=["kind", "id", "tie", "start", "n", "key", "mark", "off", "bytes"])
                found, size, lo = [], 0, end[i]

    return packed(texts).join(of_text, ["id", "tie"]).select("id", "tie", "packed", "places").mapInArrow(run, WITH_BYTES)


def cut_finer(held: DataFrame, length: int, width: int) -> DataFrame:
    """Fragments cut where their starts' distance to the anchor passes a multiple of ``width``; a piece's key is
    of the string that all starts of its distances hold."""

    def run(batches):
        for b in batches:
            out = []
            for r in b.to_pylist():
                at = 0
                while at < r["n"]:
                    low = (r["off"] - at) // width * width       # distances low .. low + width - 1
                    n = min(r["n"] - at, r["off"] - at - low + 1)
                    core = r["bytes"][r["off"] - low:r["off"] - low - width + 1 + length]
                    text = r["bytes"][at:at + n + length - 1]
                    key = xxhash.xxh3_64_intdigest(core + low.to_bytes(4, "little"), r["key"] & (2 ** 64 - 1))
                    out.append((FRAGMENT, r["id"], r["tie"], r["start"] + at, n, key - 2 ** 63, xxhash.xxh3_64_intdigest(text) - 2 ** 63, r["off"] - at, text))
                    at += n
            names = ["kind", "id", "tie", "start", "n", "key", "mark", "off", "bytes"]
            if out:
                yield as_batch(settle(pd.DataFrame(out, columns=names), length))

    return held.mapInArrow(run, WITH_BYTES)


def suffix_array(data: np.ndarray, at: np.ndarray, size: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the suffixes (``size`` bytes at ``at``, keys apart) and each one's LCP with the one before."""
    words = -(-int(size.max()) // 8)
    wide = np.concatenate([data, np.zeros(8 * words, np.uint8)])
    cells = np.lib.stride_tricks.sliding_window_view(wide, 8 * words)[at]
    cells = np.where(np.arange(8 * words) < size[:, None], cells, 0).astype(np.uint8)
    big = cells.view(">u8")
    order = np.lexsort([size, *[big[:, w] for w in reversed(range(words))], key])
    now, before = cells[order[1:]], cells[order[:-1]]
    differ = now != before
    lcp = np.where(differ.any(1), differ.argmax(1), 8 * words)
    lcp = np.minimum(lcp, np.minimum(size[order[1:]], size[order[:-1]]))
    return order, np.r_[0, np.where(key[order[1:]] == key[order[:-1]], lcp, 0)]


def maximal_repeats(order: np.ndarray, lcp: np.ndarray, left: np.ndarray, place: np.ndarray, length: int) -> Iterator[tuple[int, int, list[int]]]:
    """The common-prefix interval tree by a stack scan: (bytes, first occurrence, later occurrences that
    no deeper interval lists) of each interval of at least ``length`` bytes whose bytes to the left differ.

    ``left``: the byte before each suffix, -1 where none is seen (it differs from all); ``place``: the suffixes'
    order of occurrence. An interval with one byte to its left lies inside the repeat that starts there,
    which lists its occurrences.
    """

    def join(top: list, child: list) -> None:
        early, late = (top[1], child[1]) if place[top[1]] < place[child[1]] else (child[1], top[1])
        top[1] = early
        top[2].append(late)
        if child[3] != top[3]:
            top[3] = -1

    for lo in np.flatnonzero((lcp < length) & (np.r_[lcp[1:], 0] >= length)):
        stack: list[list] = []          # bytes, first occurrence, later ones, byte to the left or -1 where they differ
        i = int(lo)
        while True:
            s = int(order[i])
            i += 1
            depth = int(lcp[i]) if i < len(order) else 0
            child = [0, s, [], int(left[s])]
            while stack and stack[-1][0] > depth:
                join(stack[-1], child)
                child = stack.pop()
                if child[3] < 0:
                    yield child[0], child[1], child[2]
            if depth < length:
                break
            if stack and stack[-1][0] == depth:
                join(stack[-1], child)
            else:
                stack.append([depth, child[1], [], child[3]])


def repeats_of(t: pa.Table, length: int) -> pd.DataFrame:
    """Spans of the fragments of whole keys."""
    pdf = t.to_pandas().sort_values(["id", "tie", "start"], kind="stable", ignore_index=True)
    n, size = pdf["n"].to_numpy(np.int64), np.array([len(x) for x in pdf["bytes"]], np.int64)
    base = np.cumsum(size) - size
    of = np.repeat(np.arange(len(pdf)), n)
    step = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    data = np.frombuffer(b"".join(pdf["bytes"]), np.uint8)
    at = base[of] + step
    key = pd.factorize(pdf["key"])[0][of]
    # a start whose string no other has is in no interval of this length
    _, group, many = np.unique(Hashes(data).of(at, at + length), return_inverse=True, return_counts=True)
    at, of, step, key = (v[many[group] > 1] for v in (at, of, step, key))
    if not len(at):
        return pdf.iloc[:0][["kind", "id", "tie", "start", "n"]]
    order, lcp = suffix_array(data, at, size[of] - step, key)
    left = np.where(step > 0, data[at - 1].astype(np.int64), -1)
    start = pdf["start"].to_numpy(np.int64)[of] + step
    place = np.empty(len(of), np.int64)
    place[np.lexsort([start, pdf.groupby(["id", "tie"], sort=True).ngroup().to_numpy()[of]])] = np.arange(len(of))
    found = [(s, size_) for size_, _, later in maximal_repeats(order, lcp, left, place, length) for s in later]
    who, sizes = (np.array(c, np.int64) for c in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
    rows = pdf.iloc[of[who]][["kind", "id", "tie", "start", "n"]].assign(kind=SPAN, start=start[who], n=sizes)
    return merged(rows.sort_values(["id", "tie", "start"], kind="stable"))


def search(held: DataFrame, length: int, rows: int = 4096) -> DataFrame:
    """The spans of all fragments, whole keys of at least ``rows`` rows together."""
    parts = int(held.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        kept: list[pa.RecordBatch] = []

        def solve(t: pa.Table) -> pa.RecordBatch:
            out = repeats_of(t, length)
            return pa.RecordBatch.from_pandas(out.astype({"kind": "int32", "start": "int32", "n": "int32"}), preserve_index=False)

        for b in batches:
            for lo in range(0, b.num_rows, rows):
                kept.append(b.slice(lo, rows))
                if sum(x.num_rows for x in kept) < rows:
                    continue
                t = pa.Table.from_batches(kept)
                key = t.column("key").to_numpy()
                cut = int(np.flatnonzero(key != key[-1])[-1]) + 1 if (key != key[-1]).any() else 0
                if cut:
                    yield solve(t.slice(0, cut))
                    kept = t.slice(cut).to_batches()
        if kept and sum(x.num_rows for x in kept):
            yield solve(pa.Table.from_batches(kept))

    return held.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(run, PLACE)


def parted(held: DataFrame, group_rows: int) -> tuple[DataFrame, DataFrame | None]:
    """The fragments of keys with at most ``group_rows``, and the others; crowded keys are looked up under salts."""
    full = stored(held.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > group_rows).select("key"), "repeats-full")
    if full.isEmpty():
        return held, None
    salt = F.pmod(F.xxhash64("id", "tie", "start"), F.lit(SALTS)).cast("int")
    spread = full.select("key", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), F.lit(True).alias("crowded"))
    told = stored(held.withColumn("salt", salt).join(spread, ["key", "salt"], "left").select(*held.columns, "crowded"), "repeats-told")
    return told.filter("crowded is null").select(*held.columns), told.filter("crowded").select(*held.columns)


def repeat_spans(texts: DataFrame, length: int, group_rows: int) -> DataFrame:
    """id, tie, start, n: spans (some overlapping) of bytes that a string of ``length`` bytes covers which starts earlier, too."""
    met = stored(meet(cut_texts(texts, length), length), "repeats-met")
    spans = [met.filter(F.col("kind") == SPAN)]
    held = stored(with_bytes(met.filter(F.col("kind") == FRAGMENT), texts, length), "repeats-bytes")
    width = length - WIDTH + 1
    while True:
        few, many = parted(held, group_rows)
        spans.append(stored(search(few, length), "repeats-spans"))
        if many is None:
            break
        width = -(-width // 2)
        met = stored(meet(cut_finer(many, length, width), length), "repeats-met")
        spans.append(met.filter(F.col("kind") == SPAN))
        held = met.filter(F.col("kind") == FRAGMENT)
    out = spans[0].select("id", "tie", "start", "n")
    for s in spans[1:]:
        out = out.unionByName(s.select("id", "tie", "start", "n"))
    return out


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100, group_rows: int = 4096) -> DataFrame:
    """id, n_bytes, n_removed, spans, kept: each text without the bytes that a string of ``length`` bytes covers which starts earlier, too.

    ``spans``: the maximal runs removed (start and n in bytes of the UTF-8 text); ``kept``: the bytes left (binary).
    """
    if length < WIDTH + 2:
        raise ValueError(f"length must be at least {WIDTH + 2}")
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("id"), F.xxhash64(text).alias("tie"), text.cast("binary").alias("text"))
    spans = (repeat_spans(texts, length, group_rows).groupBy("id", "tie")
             .agg(F.collect_list(F.struct("start", "n")).alias("spans")))

    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for b in batches:
            out, size = [], 0
            for i in range(b.num_rows):
                text = unpack(b.column(1)[i].as_py())
                runs: list[list[int]] = []
                for s in sorted((s["start"], s["n"]) for s in b.column(3)[i].as_py() or []):
                    if runs and s[0] <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], sum(s))
                    else:
                        runs.append([s[0], sum(s)])
                cuts = [0, *(x for r in runs for x in r), len(text)]
                kept = b"".join(text[x:y] for x, y in zip(cuts[::2], cuts[1::2]))
                out.append({"id": b.column(0)[i].as_py(), "copies": b.column(2)[i].as_py(), "n_bytes": len(text), "n_removed": len(text) - len(kept),
                            "spans": [{"start": x, "n": y - x} for x, y in runs], "kept": kept})
                size += len(text)
                if size >= 4 * AT_ONCE or i + 1 == b.num_rows:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out, size = [], 0

    schema = pa.schema([("id", pa.int64()), ("copies", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("n", pa.int64())]))), ("kept", pa.binary())])
    done = (packed(texts).join(spans, ["id", "tie"], "left").select("id", "packed", "copies", "spans")
            .mapInArrow(run, "id long, copies long, n_bytes long, n_removed long, spans array<struct<start:long,n:long>>, kept binary"))
    whole = (F.col("copy") > 1) & (F.col("n_bytes") >= length)      # an equal row stands before

    def unless(c: Column, otherwise: Column) -> Column:
        return F.when(whole, otherwise).otherwise(c)

    return (done.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(
        F.nullif("id", F.lit(LAST)).alias("id"), "n_bytes", unless(F.col("n_removed"), F.col("n_bytes")).alias("n_removed"),
        unless(F.col("spans"), F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("n")))).alias("spans"),
        unless(F.col("kept"), F.lit(b"")).alias("kept")))
