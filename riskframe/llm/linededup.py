"""Line deduplication: sharded minimal perfect hash, fingerprint and count arrays, probed by the documents.

1. Every document emits the 128-bit hashes of its distinct line keys.
2. A pre-aggregated count per hash gives the number of documents and the
   largest doc_id that holds the line.
3. The hashes are dealt to shards of bounded size; each shard becomes one row:
   a minimal perfect hash and, in its order, arrays of fingerprints, counts
   and keepers.
4. The documents' hashes go to their shard (a shard with many probes is
   replicated and its probes salted) and probe the arrays; only hits that drop
   a line come back, as one short list per document.
5. The documents drop those lines.

All distinct hashes are indexed, so a probe is always a member; the
fingerprint is a guard only.

Each row counts as one document. A null text is one empty line. Rows with a
null doc_id count as documents, and a null is smaller than any id; where all
holders have the same largest id (repeated rows, or nulls only) all keep the
line. Empty tables give empty results; other columns pass through untouched.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm import mph
from riskframe.llm.common import SPACE, stored

NO_ID = np.iinfo(np.int64).min


def line_keys(text: str | None, min_chars: int) -> Iterator[tuple[bytes, bytes | None]]:
    """Each line with the digest of its key; None where the key is too short to count."""
    for line in (text or "").encode().split(b"\n"):
        key = line.strip(SPACE).lower()
        long = len(key) >= 4 * min_chars or len(key) >= min_chars and len(key.decode()) >= min_chars
        yield line, xxhash.xxh3_128_digest(key) if long else None


def line_hashes(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """doc_id, h1, h2: one row per document and distinct line key."""

    def run(batches):
        for b in batches:
            ids, found = [], []
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                own = {d for _, d in line_keys(text, min_chars) if d}
                ids += [i] * len(own)
                found += own
            h = np.frombuffer(b"".join(found), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(h[:, 0]), pa.array(h[:, 1])], names=["doc_id", "h1", "h2"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, "doc_id long, h1 long, h2 long")


def pack_shard(pdf: pd.DataFrame) -> pd.DataFrame:
    """One index row of a shard from its distinct hashes."""
    h1, h2 = (pdf[c].to_numpy(np.int64).view(np.uint64) for c in ("h1", "h2"))
    sizes, bits = mph.build(h1, h2)
    at = mph.index(h1, h2, sizes, *mph.ranks(bits))
    fingerprint, count, keeper = np.zeros(len(at), np.uint16), np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    fingerprint[at] = h2 >> np.uint64(48)
    count[at] = pdf["n"]
    keeper[at] = pdf["keeper"]
    return pd.DataFrame({"shard": [pdf["shard"].iloc[0]], "probes": [int(count.sum())], "levels": [sizes.tobytes()],
                         "bits": [bits.tobytes()], "fingerprint": [fingerprint.tobytes()],
                         "count": [count.tobytes()], "keeper": [keeper.tobytes()]})


INDEX = "shard long, probes long, levels binary, bits binary, fingerprint binary, count binary, keeper binary"


def line_index(lines: DataFrame, shards: int) -> DataFrame:
    """The sharded index of all distinct line hashes, one row per shard."""
    counts = lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"),
                                           F.coalesce(F.max("doc_id"), F.lit(NO_ID)).alias("keeper"))
    return (counts.withColumn("shard", F.expr(f"pmod(h1, {shards}L)"))
            .groupBy("shard").applyInPandas(pack_shard, INDEX))


def dropped_lines(lines: DataFrame, index: DataFrame, shards: int, min_docs: int, per_salt: int) -> DataFrame:
    """doc_id, drop: the digests of the lines that each document loses, concatenated."""
    copies = index.withColumn("salts", F.greatest(F.lit(1), F.ceil(F.col("probes") / per_salt)).cast("int"))
    # at most (all probes / per_salt) rows of two numbers
    hot = copies.filter("salts > 1").select("shard", "salts")
    probes = (lines.withColumn("shard", F.expr(f"pmod(h1, {shards}L)"))
              .join(F.broadcast(hot), "shard", "left")
              .withColumn("salt", F.expr("pmod(xxhash64(doc_id, h2), coalesce(salts, 1))"))
              .select("shard", "salt", F.lit(1).alias("kind"), "doc_id", "h1", "h2",
                      *(F.lit(None).cast("binary").alias(c) for c in ("levels", "bits", "fingerprint", "count", "keeper"))))
    arrays = (copies.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts").cast("long") - 1)))
              .select("shard", "salt", F.lit(0).alias("kind"),
                      *(F.lit(None).cast("long").alias(c) for c in ("doc_id", "h1", "h2")),
                      "levels", "bits", "fingerprint", "count", "keeper"))
    dealt = arrays.unionByName(probes).repartition("shard", "salt").sortWithinPartitions("shard", "salt", "kind")

    def probe(batches):
        at = levels = bits = before = fingerprint = count = keeper = None
        for b in batches:
            shard, kind = (b.column(c).to_numpy(zero_copy_only=False) for c in ("shard", "kind"))
            group = np.cumsum(np.r_[0, (kind[1:] == 0) | (kind[:-1] == 0)]) if len(kind) else kind
            for g in np.split(np.arange(len(kind)), np.flatnonzero(np.diff(group)) + 1):
                if not len(g):
                    continue
                if kind[g[0]] == 0:  # the arrays of the shard that the next rows probe
                    raw = {c: b.column(c)[int(g[0])].as_buffer() for c in ("levels", "bits", "fingerprint", "count", "keeper")}
                    at, levels = shard[g[0]], np.frombuffer(raw["levels"], np.int64)
                    bits, before = mph.ranks(np.frombuffer(raw["bits"], np.uint8))
                    fingerprint, count, keeper = (np.frombuffer(raw[c], t).copy() for c, t in
                                                  (("fingerprint", np.uint16), ("count", np.int64), ("keeper", np.int64)))
                    continue
                assert (shard[g] == at).all(), "probes without their shard's arrays"
                part = b.slice(int(g[0]), len(g))
                ids = part.column("doc_id").fill_null(NO_ID).to_numpy(zero_copy_only=False)
                h1, h2 = (part.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in ("h1", "h2"))
                k = mph.index(h1, h2, levels, bits, before)
                member = (k >= 0) & (fingerprint[k] == h2 >> np.uint64(48))
                lose = member & (count[k] >= min_docs) & (ids != keeper[k])
                yield pa.RecordBatch.from_arrays([part.column("doc_id").filter(pa.array(lose)),
                                                  pa.array(h1[lose].view(np.int64)), pa.array(h2[lose].view(np.int64))],
                                                 names=["doc_id", "h1", "h2"])

    def join_digests(batches):
        for b in batches:
            blob = [np.array([[x["h1"], x["h2"]] for x in row], "<i8").tobytes() for row in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(blob, pa.binary())], names=["doc_id", "drop"])

    return (dealt.mapInArrow(probe, "doc_id long, h1 long, h2 long")
            .groupBy("doc_id").agg(F.collect_list(F.struct("h1", "h2")))  # at most the lines of one document
            .mapInArrow(join_digests, "doc_id long, drop binary"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20,
                min_docs: int = 3, shard_keys: int = 1 << 18, per_salt: int = 1 << 19) -> DataFrame:
    """``row`` (all columns of ``docs``), ``kept_text``, ``n_lines``, ``n_dropped``, ``kept_sha256``."""
    lines = stored(line_hashes(docs, id_col, text_col, min_chars), "line-hashes")
    shards = max(1, -(-lines.count() // shard_keys))
    index = stored(line_index(lines, shards), "line-index")
    drops = dropped_lines(lines, index, shards, min_docs, per_salt).withColumnRenamed("doc_id", "drop_id")
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("id"))
    joined = rows.join(drops, F.col("id").eqNullSafe(F.col("drop_id")), "left").select("row", "drop")

    def rewrite(batches):
        for b in batches:
            out = {"kept_text": [], "n_lines": [], "n_dropped": [], "kept_sha256": []}
            for text, drop in zip(b.column(0).field(text_col).to_pylist(), b.column(1).to_pylist()):
                lose = {drop[i:i + 16] for i in range(0, len(drop), 16)} if drop else ()
                lines = list(line_keys(text, min_chars))
                kept = [line for line, key in lines if key not in lose]
                whole = b"\n".join(kept)
                for k, v in zip(out, (whole.decode(), len(lines), len(lines) - len(kept), hashlib.sha256(whole).hexdigest())):
                    out[k].append(v)
            types = (pa.string(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(v, t) for v, t in zip(out.values(), types))],
                                             names=["row", *out])

    schema = (rows.select("row").schema.add("kept_text", "string").add("n_lines", "long")
              .add("n_dropped", "long").add("kept_sha256", "string"))
    return joined.mapInArrow(rewrite, schema)
