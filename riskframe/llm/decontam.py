"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Benchmark texts are cut into overlapping passages, one every ``STEP`` bytes (a
short text is one passage). A document holds a passage of m bytes with at most
k edits only if both share at least m - q + 1 - k*q q-grams on neighbouring
diagonals. So the q-grams that a document shares with an item are gathered in
overlapping diagonal bands, the passages that reach the bound in a band are
kept, and each is verified by an alignment confined to its diagonals. A stretch
of a passage's length is at most STEP / 2 bytes off a passage, so it is found at
every offset in the item if it has STEP / 2 edits fewer than a passage may have.

Texts are compared as UTF-8 bytes with A-Z lower-cased and white space as
spaces. Null or empty documents match nothing; null or blank benchmark texts
match nothing; benchmark texts of fewer than q bytes must occur exactly.
A null item_id counts as a hash of its text. Repeated documents are judged alike,
repeated benchmark rows give their own matches. Other columns pass through untouched.

The benchmark is indexed in parts of at most ``part_bytes``; each part is
broadcast for one pass over the documents, so a larger benchmark costs more
passes, not more memory.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import whole_text
from riskframe.llm.samples import in_groups

Q = 8  # a q-gram is one 64-bit word
SPACES = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")
FILTER_BITS, ODD = 20, np.uint64(0x9E3779B97F4A7C15)
CHUNK = 1 << 20  # bytes of documents whose q-grams are looked up at once
STEP = 8  # bytes between the passages of an item


def normal(text: str) -> bytes:
    return text.encode().translate(SPACES).lower()


def grams(data: bytes) -> np.ndarray:
    """Every window of Q bytes as an integer."""
    n = max(0, len(data) - Q + 1)
    return np.ndarray((n,), "<u8", data, strides=(1,)) if n else np.zeros(0, np.uint64)


def filter_slot(g: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((g * ODD) >> np.uint64(64 - FILTER_BITS)).astype(np.int32)


@dataclass
class Index:
    items: np.ndarray      # item of each passage
    budget: np.ndarray     # edits allowed in each passage
    bound: np.ndarray      # shared q-grams needed
    begin: np.ndarray      # place of each passage in its text
    sizes: np.ndarray
    own: np.ndarray        # passages of text i: own[i] .. own[i+1]
    keys: np.ndarray       # distinct q-grams, sorted
    first: np.ndarray      # postings of key i: first[i] .. first[i+1]
    text: np.ndarray       # postings
    offset: np.ndarray
    maybe: np.ndarray      # which filter slots hold a q-gram
    data: np.ndarray       # bytes of all texts, and zeros for as long as a passage
    starts: np.ndarray     # begin of each passage in them
    short: list[tuple[int, bytes]]

    @property
    def places(self) -> int:
        """More than a text has places."""
        return int((self.begin + self.sizes).max(initial=0)) + 1

    def patterns(self, passages: np.ndarray) -> np.ndarray:
        """Bytes of the passages, one a row, zero-padded."""
        sizes = self.sizes[passages, None]
        ramp = np.arange(sizes.max(initial=0))
        return np.where(ramp < sizes, self.data[self.starts[passages, None] + ramp], 0).astype(np.uint8)

    @property
    def matrix(self) -> np.ndarray:
        return self.patterns(np.arange(len(self.sizes)))

    @property
    def reach(self) -> int:
        """Step of the diagonal bands: no less than any budget."""
        return max(16, int(self.budget.max(initial=0)) + 1)


def build_index(rows: list[tuple[int, str | None]], error: float, size: int) -> Index:
    texts, begins, items, short = [], [], [], []
    for item, text in rows:
        data = normal(text or "").strip()
        if len(data) < Q:
            short += [(item, data)] if data else []
            continue
        begin = np.arange(0, max(1, len(data) - size + 1), STEP)
        if len(data) > size and begin[-1] + size < len(data):
            begin = np.append(begin, len(data) - size)
        texts.append(data)
        begins.append(begin)
        items.append(item)
    count, lengths = np.array([len(b) for b in begins], np.int64), np.array([len(t) for t in texts], np.int64)
    begin = np.concatenate(begins) if begins else np.zeros(0, np.int64)
    m = np.repeat(np.minimum(lengths, size), count)
    budget = np.minimum((error * m).astype(np.int64), (m - Q) // Q)  # keeps the bound at 1 at least
    g = [grams(t) for t in texts]
    g_all = np.concatenate(g) if g else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(g)), [len(x) for x in g])
    offset = np.concatenate([np.arange(len(x)) for x in g]) if g else np.zeros(0, np.int64)
    order = np.argsort(g_all, kind="stable")
    keys, first = np.unique(g_all[order], return_index=True)
    maybe = np.zeros(1 << FILTER_BITS, bool)
    maybe[filter_slot(keys)] = True
    return Index(np.repeat(np.array(items, np.int64), count), budget, m - Q + 1 - budget * Q, begin, m, np.append(0, np.cumsum(count)),
                 keys, np.append(first, len(order)), owner[order], offset[order], maybe,
                 np.frombuffer(b"".join(texts) + bytes(size), np.uint8), np.repeat(np.cumsum(lengths) - lengths, count) + begin, short)


def align(patterns: np.ndarray, sizes: np.ndarray, texts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(fewest edits, diagonal of the end) of each pattern inside its text, the path kept on ``width`` diagonals.

    Row c of ``texts`` begins with the byte on the lowest diagonal for the pattern's first byte; the pattern may begin
    on any of the diagonals. All pairs advance together, byte by byte of their patterns.
    """
    ramp = np.arange(width, dtype=np.int16)
    row = np.zeros((len(patterns), width), np.int16)
    edits, end = np.zeros(len(patterns), np.int64), np.zeros(len(patterns), np.int64)
    for i in range(patterns.shape[1]):
        new = row + (texts[:, i:i + width] != patterns[:, i:i + 1])
        np.minimum(new[:, :-1], row[:, 1:] + 1, out=new[:, :-1])
        row = np.minimum.accumulate(new - ramp, 1) + ramp
        for c in np.flatnonzero(sizes == i + 1):
            end[c] = row[c].argmin()
            edits[c] = row[c, end[c]]
    return edits, end


def shared_bands(buffer: bytes, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """(passage, band): the diagonal bands of the buffer that share as many q-grams with a passage as the bound asks."""
    owner, place, diag = [], [], []
    for start in range(0, len(buffer), CHUNK):
        g = grams(buffer[start:start + CHUNK + Q - 1])
        near = np.flatnonzero(index.maybe.take(filter_slot(g)))
        g = g[near]
        k = np.searchsorted(index.keys, g)
        k[k == len(index.keys)] = 0
        hit = index.keys[k] == g
        k, pos = k[hit], near[hit] + start
        n = index.first[k + 1] - index.first[k]
        post = np.repeat(index.first[k] - np.cumsum(n) + n, n) + np.arange(n.sum())
        owner.append(index.text[post])
        place.append(index.offset[post])
        diag.append(np.repeat(pos, n) - place[-1])
    owner, place, diag = (np.concatenate(x) for x in (owner, place, diag))
    band, spare = np.divmod(diag, index.reach)
    budget, bound, places = index.budget[index.own[:-1]], index.bound[index.own[:-1]], index.places  # a text's passages are alike
    both = np.flatnonzero(spare < budget[owner])  # also in the band before, which reaches that far
    owner, place, band = (np.r_[x, x[both]] for x in (owner, place, band))
    band[len(diag):] -= 1
    if not len(band):
        return owner, band
    low, span = band.min(), int(band.max() - band.min()) + 1
    key = owner * span + (band - low)
    # all hits of a slot of bands first, then each q-gram of a text once in its band
    slot = ((key.astype(np.uint64) * ODD) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
    many = np.flatnonzero(np.bincount(slot, minlength=1 << FILTER_BITS)[slot] >= bound[owner])
    hits = np.unique(key[many] * places + place[many])
    found, count = np.unique(hits // places, return_counts=True)
    found = found[count >= bound[found // span]]
    # the passages of the text that hold enough of them
    n = index.own[found // span + 1] - index.own[found // span]
    passage = np.repeat(index.own[found // span] - np.cumsum(n) + n, n) + np.arange(n.sum())
    found = np.repeat(found, n)
    first = found * places + index.begin[passage]
    inside = np.searchsorted(hits, first + index.sizes[passage] - Q, side="right") - np.searchsorted(hits, first)
    full = np.flatnonzero(inside >= index.bound[passage])
    return passage[full], found[full] % span + low


def aligned(buffer: np.ndarray, owner: np.ndarray, band: np.ndarray, index: Index) -> tuple[np.ndarray, ...]:
    """(passage, edits, begin, end in the buffer) of the bands whose passage is there within its budget."""
    out = [np.zeros((4, 0), np.int64)]
    most = int(index.budget.max(initial=0))
    width = index.reach + 2 * most + 1
    order = np.argsort(index.sizes[owner], kind="stable")
    for lo in range(0, len(order), 512):
        o, b = owner[order[lo:lo + 512]], band[order[lo:lo + 512]]
        sizes = index.sizes[o]
        patterns = index.patterns(o)
        at = b * index.reach - most + index.begin[o]
        edits, end = align(patterns, sizes, buffer.take(at[:, None] + np.arange(patterns.shape[1] + width), mode="clip"), width)
        good = np.flatnonzero(edits <= index.budget[o])
        o, edits, end, sizes = o[good], edits[good], (at + end)[good] + sizes[good], sizes[good]
        if not len(o):
            continue
        # backwards from the end, for the begin
        places = sizes[:, None] - 1 - np.arange(sizes.max())
        back = np.where(places >= 0, np.take_along_axis(index.patterns(o), np.maximum(places, 0), 1), 0)
        width_ = 2 * most + 1
        _, first = align(back, sizes, buffer.take((end + most - 1)[:, None] - np.arange(back.shape[1] + width_), mode="clip"), width_)
        out.append(np.stack([o, edits, end + most - first - sizes, end]))
    return tuple(np.concatenate(out, 1))


def matches(texts: list[str | None], index: Index) -> list[list[dict]]:
    """Per text and item that it holds: fewest edits, passages found, first start and last end (characters)."""
    data = [normal(t or "") for t in texts]
    gap = b"\0" * (index.reach + 1)  # more than any budget, so no match runs over it
    sizes = np.array([len(d) + len(gap) for d in data])
    starts = np.cumsum(sizes) - sizes + len(gap)
    buffer = gap + b"".join(d + gap for d in data)
    spans: list[dict[int, list]] = [{} for _ in data]
    for item, whole in index.short:
        for k, d in enumerate(data):
            if (at := d.find(whole)) >= 0:
                spans[k].setdefault(item, []).append((0, at, at + len(whole), -1))
    if len(index.keys):
        for p, edits, begin, end in zip(*aligned(np.frombuffer(buffer, np.uint8), *shared_bands(buffer, index), index)):
            k = int(np.searchsorted(starts, end - 1, side="right")) - 1
            begin, end = max(0, int(begin - starts[k])), min(len(data[k]), int(end - starts[k]))
            spans[k].setdefault(int(index.items[p]), []).append((int(edits), begin, end, int(p)))
    out = []
    for d, own in zip(data, spans):
        chars = lambda n, d=d: len(d[:n].decode(errors="ignore"))
        out.append([{"item_id": item, "edits": min(s[0] for s in found), "passages": len({s[3] for s in found}),
                     "start": chars(min(s[1] for s in found)), "end": chars(max(s[2] for s in found))}
                    for item, found in sorted(own.items())])
    return out


LEAK = pa.struct([("item_id", pa.int64()), ("edits", pa.int64()), ("passages", pa.int64()),
                  ("start", pa.int64()), ("end", pa.int64())])


def find_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
               item_text_col: str = "text", error: float = 0.1, passage_bytes: int = 160,
               part_bytes: int = 4 << 20) -> DataFrame:
    """``row`` (all columns of ``docs``) and ``leaks``, the benchmark items that its text holds.

    Every text is whole in one task, which walks over it in chunks.
    """
    spark = docs.sparkSession
    item = F.coalesce(F.col(item_col).cast("long"), F.xxhash64(whole_text(F.col(item_text_col))))
    items = benchmark.select(item.alias("item"), F.col(item_text_col).alias("text"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(1, -(-total // part_bytes))
    out = docs.select(F.struct("*").alias("row"), F.array().cast("array<struct<item_id:long,edits:long,passages:long,start:long,end:long>>").alias("leaks"))
    schema = out.schema
    for part in range(parts):
        rows = items.filter(F.expr(f"pmod(xxhash64(item), {parts}) = {part}")).collect()
        index = spark.sparkContext.broadcast(build_index([(r["item"], r["text"]) for r in rows], error, passage_bytes))

        def run(batches, index=index):
            for b in batches:
                row = b.column(0)
                new = [m for group in in_groups(row.field(text_col).to_pylist(), CHUNK) for m in matches(group, index.value)]
                found = [old + m for old, m in zip(b.column(1).to_pylist(), new)]
                yield pa.RecordBatch.from_arrays([row, pa.array(found, pa.list_(LEAK))], names=["row", "leaks"])

        out = out.mapInArrow(run, schema)
    return out
