"""Documents as blocks of token codes, and corpus-wide counts of 64-bit keys.

A block holds about ``BLOCK_TOKENS`` tokens of whole documents: the hashes of
its distinct words and a code per token. Blocks are written once; every later
step reads them instead of the texts.

``count_keys`` counts keys (hashes of n-grams or shingles) over all blocks and
answers each block: a block sends its distinct keys, sorted and packed, to
shards dealt by the key's high bits; a shard merges them and sends back, in the
same order, the totals. Rows are packed arrays, so Spark moves a few bytes per
distinct key of a block; a key that is frequent everywhere is one entry per
block, so no shard is hot.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_TOKENS = 1 << 20
SHARD_KEYS = 1 << 21
BLOCKS = "block long, part int, docs long, tokens long, ids array<long>, sizes binary, words binary, codes binary"
ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * ODD
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


def packed(x: np.ndarray) -> bytes:
    """Compressed by byte planes."""
    planes = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(data: bytes, dtype: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return raw.reshape(np.dtype(dtype).itemsize, -1).T.copy().view(dtype).ravel()


def packed_sorted(x: np.ndarray) -> bytes:
    return packed(np.diff(x, prepend=np.uint64(0)))


def unpacked_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data, np.uint64), dtype=np.uint64)


@dataclass
class Block:
    """Token hashes of whole documents, one after the other."""

    ids: list[int | None]
    sizes: np.ndarray
    tokens: np.ndarray

    @staticmethod
    def of(ids, sizes: bytes, words: bytes, codes: bytes) -> Block:
        return Block(ids, unpacked(sizes, np.int32), unpacked(words, np.uint64)[unpacked(codes, np.int32)])

    @property
    def starts(self) -> np.ndarray:
        return np.cumsum(self.sizes) - self.sizes

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.sizes)), self.sizes)


def write_row(block: int, part: int, ids: list, split: list[list[bytes]]) -> tuple:
    codes = {w: k for k, w in enumerate(dict.fromkeys(chain.from_iterable(split)))}
    words = np.array([xxhash.xxh3_64_intdigest(w) for w in codes], np.uint64)
    code = np.fromiter(map(codes.__getitem__, chain.from_iterable(split)), np.int32)
    sizes = np.array([len(s) for s in split], np.int32)
    return block, part, len(ids), len(code), ids, packed(sizes), packed(words), packed(code)


def to_blocks(docs: DataFrame, end: bytes | None = None, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Blocks of ``docs`` (id long, text string, part int), each of one part. Store the result: block ids hold for one run.

    Tokens are the words of the text with A-Z lower-cased, and ``end`` if given. Null texts are empty.
    """
    types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary())
    names = ["block", "part", "docs", "tokens", "ids", "sizes", "words", "codes"]
    last = [end] if end else []

    def run(batches):
        first, made = TaskContext.get().partitionId() << 32, 0
        open_: dict[int, tuple[list, list, int]] = {}

        def close(part: int) -> pa.RecordBatch:
            nonlocal made
            ids, split, _ = open_.pop(part)
            made += 1
            row = write_row(first + made, part, ids, split)
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=names)

        for b in batches:
            for i, text, part in zip(*(c.to_pylist() for c in b.columns)):
                ids, split, size = open_.get(part, ([], [], 0))
                ids.append(i)
                split.append((text or "").encode().lower().split() + last)
                open_[part] = ids, split, size + len(split[-1])
                if open_[part][2] >= block_tokens or len(ids) >= block_tokens:
                    yield close(part)
        for part in list(open_):
            yield close(part)

    return docs.select("id", "text", "part").mapInArrow(run, BLOCKS)


KeysOf = Callable[[Block, int], tuple[np.ndarray, np.ndarray]]
REPLIES = "kind int, shard long, block long, kept binary, extra binary, distinct long"


def block_rows(batch: pa.RecordBatch) -> Iterator[tuple[int, int, Block]]:
    columns = {n: batch.column(n) for n in ("block", "part", "ids", "sizes", "words", "codes")}
    for k in range(batch.num_rows):
        row = {n: c[k].as_py() for n, c in columns.items()}
        yield row["block"], row["part"], Block.of(row["ids"], row["sizes"], row["words"], row["codes"])


def shard_of(keys: np.ndarray, shards: int, bits: int) -> np.ndarray:
    return ((keys >> np.uint64(bits - 32)) * np.uint64(shards)) >> np.uint64(32)


def tally(pdf: pd.DataFrame) -> pd.DataFrame:
    """One shard: totals of its keys over the blocks of part 0 (kept) and part 1 (extra), for every block."""
    keys = [unpacked_sorted(k) for k in pdf["keys"]]
    size = np.array([len(k) for k in keys])
    _, at = np.unique(np.concatenate(keys), return_inverse=True)
    count = np.concatenate([unpacked(c, np.uint32) for c in pdf["counts"]]).astype(float)
    part = np.repeat(pdf["part"].to_numpy(), size)
    kept, extra = (np.bincount(at, count * (part == p)).astype(np.uint64) for p in (0, 1))
    ends = np.cumsum(size)
    out = []
    for k, (lo, hi) in enumerate(zip(ends - size, ends)):
        own = at[lo:hi]
        out.append((pdf["kind"].iloc[k], pdf["shard"].iloc[k], pdf["block"].iloc[k], packed(kept[own]), packed(extra[own]),
                    int(((kept > 0) | (extra > 0)).sum()) if k == 0 else 0))
    return pd.DataFrame(out, columns=["kind", "shard", "block", "kept", "extra", "distinct"])


def count_keys(blocks: DataFrame, kinds: list[int], keys_of: KeysOf, shards: int, bits: int = 64) -> DataFrame:
    """Replies to all blocks: for each kind of key and shard, totals in the order of the block's sorted keys.

    ``keys_of(block, kind)`` gives the block's distinct keys (below 2 ** ``bits``), sorted, and their counts in the
    block. Parts other than 0 and 1 ask but don't count. ``distinct`` is the number of counted keys of a shard, on one of its rows.
    """
    types = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
    names = ["kind", "shard", "block", "part", "keys", "counts"]

    def ask(batches):
        for b in batches:
            for block, part, own in block_rows(b):
                rows = []
                for kind in kinds:
                    keys, counts = keys_of(own, kind)
                    shard = shard_of(keys, shards, bits).astype(np.int64)
                    edges = np.flatnonzero(np.diff(shard, prepend=-1))
                    for lo, hi in zip(edges, np.append(edges[1:], len(keys))):
                        rows.append((kind, int(shard[lo]), block, part, packed_sorted(keys[lo:hi]), packed(counts[lo:hi].astype(np.uint32))))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    asked = blocks.mapInArrow(ask, "kind int, shard long, block long, part int, keys binary, counts binary")
    return asked.groupBy("kind", "shard").applyInPandas(tally, REPLIES)


def with_replies(blocks: DataFrame, replies: DataFrame, answer: Callable[[int, Block, dict[int, tuple]], pd.DataFrame], schema: str) -> DataFrame:
    """``answer(part, block, {kind: (kept, extra)})`` for every block that has tokens or documents."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = {}
        for kind, rows in right.sort_values(["kind", "shard"]).groupby("kind"):
            found[int(kind)] = tuple(np.concatenate([unpacked(x, np.uint64) for x in rows[c]]).view(np.int64) for c in ("kept", "extra"))
        parts = [answer(int(r.part), Block.of(list(r.ids), r.sizes, r.words, r.codes), found) for r in left.itertuples()]
        return pd.concat(parts) if parts else pd.DataFrame(columns=[c.split()[0] for c in schema.split(", ")])

    return blocks.groupBy("block").cogroup(replies.select("kind", "shard", "block", "kept", "extra").groupBy("block")).applyInPandas(run, schema)


def block_totals(blocks: DataFrame) -> tuple[int, int]:
    """(documents, tokens)."""
    return tuple(blocks.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("tokens"), F.lit(0))).first())
