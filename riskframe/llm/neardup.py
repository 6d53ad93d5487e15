"""Near-duplicate classes: improved consistent weighted sampling over TF-IDF shingles.

1. Documents become blocks of word codes; the number of documents holding each
   five-word shingle is counted over the whole corpus.
2. A shingle weighs tf * (1 + idf_gain * ln(N / df) / ln N): the idf is kept
   within a narrow range, so that a large group of near copies, which lowers
   the idf of what its members share, doesn't push them apart.
3. A partner at weighted Jaccard similarity s shares at least s of a
   document's weight, and all of that in shingles of two documents or more; a
   document without that much takes no part (nothing is lost by this).
4. Equal token sequences become one text. Improved consistent weighted
   sampling draws ``SAMPLES`` samples per text; the first ``BANDS * ROWS`` form
   bands. Texts that share a band are in one bucket.
5. In a bucket (a large one is dealt to parts of at most ``bucket_part``
   texts, differently in each band) pairs whose samples agree often enough to
   be similar are found locally; only a spanning forest of them is verified by
   exact weighted Jaccard similarity. A second round verifies all such pairs
   that still lie in different components; in a large bucket every text outside
   its largest component meets all others of the bucket, block by block.
6. Connected components of the verified links and equal texts are the classes.

Words are split at white space, A-Z lower-cased. A text of fewer than five
words is one shingle; texts without words (null, empty, blank) are equal texts.
Rows that repeat an id and text are in its class; a null id counts as a hash of
its text. Empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.blocks import ODD, SHARD_KEYS, Block, block_totals, count_keys, mixed, to_blocks, with_replies
from riskframe.llm.common import stored, whole_text, width
from riskframe.llm.components import components

SHINGLE = 5
SAMPLES, BANDS, ROWS = 256, 16, 4
SIDE_BYTES = 32 << 20  # of shingle keys on a side of a block
AGREE = 0.72  # of the samples, for a pair to be verified: 3.2 standard errors below 0.8

# Fixed tables of random variates; a shingle picks its own for each sample by a hash.
RNG = np.random.default_rng(20240229)
SLOTS = 1 << 16
R = RNG.gamma(2, 1, SLOTS).astype(np.float32)
LOG_C = np.log(RNG.gamma(2, 1, SLOTS)).astype(np.float32)
BETA = RNG.uniform(0, 1, SLOTS).astype(np.float32)
PICK = RNG.integers(1, 1 << 63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """(key, document) of every shingle occurrence."""
    h, n = mixed(block.tokens), len(block.tokens)
    key, starts, sizes = np.zeros(n, np.uint64), block.starts, block.sizes
    left = np.repeat(starts + sizes, sizes) - np.arange(n)  # tokens to the document's end
    with np.errstate(over="ignore"):
        for j in range(SHINGLE):
            part = np.zeros(n, np.uint64)
            part[:n - j] = h[j:]
            key = key * ODD + np.where(left > j, part, np.uint64(j))
    first = np.zeros(n, bool)
    first[starts[sizes > 0]] = True
    use = (left >= SHINGLE) | first
    return mixed(key[use]), block.owner[use]


def per_document(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(the block's distinct shingles, and per document and shingle: document, place among them, occurrences)."""
    key, owner = shingles(block)
    distinct, at = np.unique(key, return_inverse=True)
    pair, tf = np.unique(owner * max(1, len(distinct)) + at, return_counts=True)
    return distinct, pair // max(1, len(distinct)), pair % max(1, len(distinct)), tf


def counted_keys(distinct: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(the high bits of sorted keys, distinct; place of each key among them).

    Counting takes 24 bits more than it needs to number all tokens, at any size of the corpus: a shingle shares them
    with another one in less than one of 10 million cases, and then counts as a little more frequent.
    """
    return np.unique(distinct >> np.uint64(64 - bits), return_inverse=True)


def shingle_counts(bits: int):
    def keys_of(block: Block, kind: int) -> tuple[np.ndarray, np.ndarray]:
        distinct, _, place, _ = per_document(block)
        keys, at = counted_keys(distinct, bits)
        return keys, np.bincount(at[place], minlength=len(keys))

    return keys_of


def draw(keys: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """``SAMPLES`` consistent samples (32-bit identities) of a weighted set given in order of its keys."""
    log_w = np.log(weights).astype(np.float32)[:, None]
    best, sample = np.full(SAMPLES, np.inf, np.float32), np.zeros(SAMPLES, np.uint32)
    for lo in range(0, len(keys), 1024):
        k = keys[lo:lo + 1024]
        with np.errstate(over="ignore"):
            slot = ((k[:, None] * PICK) >> np.uint64(48)).astype(np.int64)
        r = R.take(slot)
        t = np.floor(log_w[lo:lo + 1024] / r + BETA.take(slot))
        log_a = LOG_C.take(slot) - r * (t - BETA.take(slot) + 1)
        row = log_a.argmin(0)
        value = log_a[row, np.arange(SAMPLES)]
        won = value < best
        with np.errstate(over="ignore"):
            identity = mixed(k[row] + t[row, np.arange(SAMPLES)].astype(np.int64).view(np.uint64) * ODD) >> np.uint64(32)
        best, sample = np.where(won, value, best), np.where(won, identity.astype(np.uint32), sample)
    return sample


def band_keys(sample: np.ndarray) -> np.ndarray:
    s, key = sample[:BANDS * ROWS].astype(np.uint64).reshape(BANDS, ROWS), np.zeros(BANDS, np.uint64)
    with np.errstate(over="ignore"):
        for r in range(ROWS):
            key = mixed(key * ODD + s[:, r])
    return key


def weighted_jaccard(a_keys: bytes, a_weights: bytes, b_keys: bytes, b_weights: bytes) -> float:
    ak, bk = np.frombuffer(a_keys, np.uint64), np.frombuffer(b_keys, np.uint64)
    aw, bw = np.frombuffer(a_weights, np.float32).astype(float), np.frombuffer(b_weights, np.float32).astype(float)
    _, i, j = np.intersect1d(ak, bk, assume_unique=True, return_indices=True)
    low = np.minimum(aw[i], bw[j]).sum()
    return float(low / (aw.sum() + bw.sum() - low))


MEMBERS = "id long, t1 long, t2 long, takes boolean, bands binary, sample binary, keys binary, weights binary"


def members(blocks: DataFrame, replies: DataFrame, n_docs: int, bits: int, threshold: float, idf_gain: float) -> DataFrame:
    """Every document with the key of its token sequence; those that may have a partner also with bands, samples and weights.

    A byte of each sample is kept to compare samples by: two different ones agree in one of 256 cases.
    """
    scale = idf_gain / max(1.0, np.log(max(2, n_docs)))

    def answer(part: int, block: Block, found: dict) -> pd.DataFrame:
        n, starts, sizes = len(block.sizes), block.starts, block.sizes
        text = np.array([np.frombuffer(xxhash.xxh3_128_digest(block.tokens[s:s + z].tobytes()), np.int64) for s, z in zip(starts, sizes)]).reshape(n, 2)
        out = {"id": block.ids, "t1": text[:, 0], "t2": text[:, 1], "takes": np.zeros(n, bool),
               "bands": [None] * n, "sample": [None] * n, "keys": [None] * n, "weights": [None] * n}
        if len(block.tokens):
            distinct, doc, place, tf = per_document(block)
            df = found[0][0][counted_keys(distinct, bits)[1]][place]
            w = (tf * (1 + scale * np.log(n_docs / df))).astype(np.float32)
            shared, total = np.bincount(doc, w * (df > 1), n), np.bincount(doc, w, n)
            out["takes"] = (sizes == 0) | (shared >= (threshold - 1e-6) * total)
            edge, seen = np.searchsorted(doc, np.arange(n + 1)), set()
            for i in np.flatnonzero(out["takes"] & (sizes > 0)):
                if (same := text[i].tobytes()) not in seen:  # once for each text of the block
                    seen.add(same)
                    k, own = distinct[place[edge[i]:edge[i + 1]]], w[edge[i]:edge[i + 1]]
                    sample = draw(k, own)
                    out["bands"][i], out["sample"][i] = band_keys(sample).tobytes(), sample.astype(np.uint8).tobytes()
                    out["keys"][i], out["weights"][i] = k.tobytes(), own.tobytes()
        else:
            out["takes"] = np.ones(n, bool)
        return pd.DataFrame(out)

    return with_replies(blocks, replies, answer, MEMBERS)


def bucketed(texts: DataFrame, bucket_part: int) -> DataFrame:
    """band, key, n, deal, id, bytes, sample: texts that share a bucket of n, large buckets dealt to parts."""

    def split(batches):
        for b in batches:
            key = np.frombuffer(b"".join(b.column(1).to_pylist()), np.int64).reshape(-1, BANDS)
            for band in range(BANDS):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), band, np.int32)), pa.array(np.ascontiguousarray(key[:, band])), b.column(0), b.column(2), b.column(3)],
                                                 names=["band", "key", "id", "sample", "bytes"])

    entries = texts.select("id", "bands", "sample", "bytes").mapInArrow(split, "band int, key long, id long, sample binary, bytes int")
    size = entries.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return (entries.join(size, ["band", "key"])
            .withColumn("deal", F.expr(f"pmod(xxhash64(id, band), ceil(n / {bucket_part}))"))
            .select("band", "key", "n", "deal", "id", "bytes", "sample"))


def close_pairs(buckets: DataFrame, forest: bool) -> DataFrame:
    """a < b, distinct: pairs of a bucket part whose samples agree enough, or a spanning forest of them.

    Without ``forest``, only pairs of different components (column ``c``). A task sends one row for each text and
    bucket part, with its partners as an array; the arrays of a text (16 bands, at most a part each) are united.
    """

    def pairs_of(ids: np.ndarray, samples: list[bytes], c: np.ndarray):
        s = np.frombuffer(b"".join(samples), np.uint8).reshape(len(ids), SAMPLES)
        a, b = np.triu_indices(len(ids), 1)
        if not forest:
            apart = c[a] != c[b]
            a, b = a[apart], b[apart]
        agree = np.concatenate([(s[a[lo:lo + 4096]] == s[b[lo:lo + 4096]]).mean(1) for lo in range(0, len(a), 4096)]) if len(a) else np.zeros(0)
        near = np.flatnonzero((agree >= AGREE) & (ids[a] != ids[b]))
        if not forest:
            return [(min(ids[a[k]], ids[b[k]]), max(ids[a[k]], ids[b[k]])) for k in near]
        root, out = list(range(len(ids))), []

        def top(i: int) -> int:
            while root[i] != i:
                root[i] = i = root[root[i]]
            return i

        low, high = np.minimum(ids[a], ids[b])[near], np.maximum(ids[a], ids[b])[near]
        for k in np.lexsort((high, low, -agree[near])):  # the same choice in every band
            i, j = top(a[near[k]]), top(b[near[k]])
            if i != j:
                root[i] = j
                out.append((low[k], high[k]))
        return out

    def run(batches):
        held = None
        for b in batches:
            whole = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
            found, held = cut(whole, last=False)
            yield found
        if held is not None:
            yield cut(held, last=True)[0]

    def cut(rows: pa.Table, last: bool):
        rows = rows.combine_chunks()
        band, key, deal, ids, c = (rows.column(n).to_numpy() for n in ("band", "key", "deal", "id", "c"))
        edges = np.flatnonzero((np.diff(band) != 0) | (np.diff(key) != 0) | (np.diff(deal) != 0)) + 1
        begin, end = np.r_[0, edges][:rows.num_rows], np.r_[edges, rows.num_rows][:rows.num_rows]
        if not last and len(begin):
            rest, begin, end = rows.slice(int(begin[-1])), begin[:-1], end[:-1]
        else:
            rest = None
        out, samples = [], rows.column("sample").to_pylist()
        for lo, hi in zip(begin, end):
            if hi - lo > 1:
                out += pairs_of(ids[lo:hi], samples[lo:hi], c[lo:hi])
        return lists(np.array(out, np.int64).reshape(-1, 2)), rest

    def lists(pairs: np.ndarray) -> pa.RecordBatch:
        pairs = np.unique(pairs, axis=0)
        a, first = np.unique(pairs[:, 0], return_index=True)
        partners = pa.ListArray.from_arrays(pa.array(np.append(first, len(pairs)), pa.int32()), pa.array(pairs[:, 1]))
        return pa.RecordBatch.from_arrays([pa.array(a), partners], names=["a", "partners"])

    if forest:
        buckets = buckets.withColumn("c", F.lit(0).cast("long"))
    place = ["band", "key", "deal"]
    return (buckets.select(*place, "id", "c", "sample").repartition(*place).sortWithinPartitions(*place, "id")
            .mapInArrow(run, "a long, partners array<long>")
            .groupBy("a").agg(F.array_distinct(F.flatten(F.collect_list("partners"))).alias("partners"))
            .select("a", F.explode("partners").alias("b")))


def verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """a, b, similar: whether the pair's exact weighted Jaccard similarity reaches the threshold."""
    side = lambda n: texts.select(F.col("id").alias(n), F.col("keys").alias(f"{n}k"), F.col("weights").alias(f"{n}w"))

    @F.pandas_udf("double")
    def similarity(ak: pd.Series, aw: pd.Series, bk: pd.Series, bw: pd.Series) -> pd.Series:
        return pd.Series([weighted_jaccard(*x) for x in zip(ak, aw, bk, bw)], dtype=float)

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return (both.select("a", "b", (similarity("ak", "aw", "bk", "bw") >= threshold).alias("similar"))
            .groupBy("a", "b").agg(F.max("similar").alias("similar")))  # an id that repeats may carry several texts


def links_in_block(block: pa.Table, threshold: float) -> pa.Table:
    """a, b: verified links between rows (``side`` 0) and columns (1) of a block, enough to join all components they join."""
    side, ids, minor = (block.column(n).to_numpy(zero_copy_only=False) for n in ("side", "id", "minor"))
    sample = np.frombuffer(b"".join(block.column("sample").to_pylist()), np.uint8).reshape(-1, SAMPLES)
    keys = [np.frombuffer(k, np.uint64) for k in block.column("keys").to_pylist()]
    weights = [np.frombuffer(w, np.float32).astype(float) for w in block.column("weights").to_pylist()]
    root = np.unique(block.column("c").to_numpy(), return_inverse=True)[1]
    cols = np.flatnonzero(side == 1)
    if not len(cols):
        return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    col_sample, col_ids, col_minor = sample[cols], ids[cols], minor[cols]
    vocab, place = np.unique(np.concatenate([keys[j] for j in cols]), return_inverse=True)
    place = np.split(place, np.cumsum([len(keys[j]) for j in cols])[:-1])
    totals = np.array([w.sum() for w in weights])
    out = []
    for i in np.flatnonzero(side == 0):
        # two texts outside the largest component meet twice: the smaller id is the row
        near = np.flatnonzero((root[cols] != root[i]) & (col_ids != ids[i]) & ~(col_minor & (col_ids < ids[i])))
        near = near[np.count_nonzero(col_sample[near] == sample[i], axis=1) >= AGREE * SAMPLES]
        if not len(near):
            continue
        own, at = np.zeros(len(vocab)), np.searchsorted(vocab, keys[i])
        at[at == len(vocab)] = 0
        held = vocab[at] == keys[i]
        own[at[held]] = weights[i][held]
        for j in near:
            low = np.minimum(own[place[j]], weights[cols[j]]).sum()
            if root[cols[j]] != root[i] and low >= threshold * (totals[i] + totals[cols[j]] - low):
                root[root == root[cols[j]]] = root[i]
                out.append((min(ids[i], col_ids[j]), max(ids[i], col_ids[j])))
    a, b = np.array(out, np.int64).reshape(-1, 2).T
    return pa.table({"a": a, "b": b})


def large_bucket_links(large: DataFrame, some: DataFrame, threshold: float, side: int) -> DataFrame:
    """a, b: links between components inside large buckets (band, key, id, c, bytes), every pair of them looked at.

    The texts outside a bucket's largest component are the rows of a table whose columns are all its texts; it is cut
    into blocks of at most about ``side`` texts or ``SIDE_BYTES`` a side, and a task verifies the pairs of a block where they meet.
    """
    place = ["band", "key"]
    sizes = large.groupBy(*place, "c").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"))
    most = F.max(F.struct("n", "c", "bytes"))
    blocks = lambda n, size: f"cast(ceil(greatest(({n}) / {side}, ({size}) / {SIDE_BYTES})) as int)"
    mixed_buckets = (sizes.groupBy(*place).agg(most.alias("main"), F.sum("n").alias("n"), F.sum("bytes").alias("bytes"))
                     .filter("n > main.n")
                     .select(*place, F.col("main.c").alias("main"), F.expr(blocks("n - main.n", "bytes - main.bytes")).alias("high"),
                             F.expr(blocks("n", "bytes")).alias("wide")))
    texts = large.join(mixed_buckets, place).withColumn("minor", F.col("c") != F.col("main"))
    dealt = lambda n: F.expr(f"cast(pmod(xxhash64(id, band), {n}) as int)")
    every = lambda n: F.explode(F.expr(f"sequence(0, {n} - 1)"))
    rows = texts.filter("minor").select(*place, dealt("high").alias("i"), every("wide").alias("j"), F.lit(0).alias("side"), "id", "c", "minor")
    cols = texts.select(*place, every("high").alias("i"), dealt("wide").alias("j"), F.lit(1).alias("side"), "id", "c", "minor")
    return (rows.union(cols).join(some.select("id", "sample", "keys", "weights"), "id")
            .groupBy(*place, "i", "j").applyInArrow(lambda block: links_in_block(block, threshold), "a long, b long").distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8,
                    idf_gain: float = 0.25, bucket_part: int = 256) -> DataFrame:
    """id, class_id: every row of ``docs`` with the smallest id of its class."""
    ident = row_ident(F.col(id_col), F.col(text_col))
    blocks = stored(to_blocks(docs.select(ident.alias("id"), F.col(text_col).alias("text"), F.lit(0).alias("part"))), "near-blocks")
    n_docs, n_tokens = block_totals(blocks)
    bits = min(64, 24 + max(16, n_tokens.bit_length()))
    replies = count_keys(blocks, [0], shingle_counts(bits), width(docs.sparkSession, n_tokens, SHARD_KEYS), bits)
    every = stored(members(blocks, replies, n_docs, bits, threshold, idf_gain), "near-members")
    # a text is known by the smallest id among its rows that carry samples and weights (one row a block)
    carrier = F.min(F.when(F.col("sample").isNotNull(), F.col("id"))).alias("carrier")
    texts = stored(every.filter("takes").groupBy("t1", "t2").agg(F.min("id").alias("first"), carrier), "near-texts")
    some = every.filter(F.col("sample").isNotNull())
    carriers = some.select("id", "bands", "sample", F.octet_length("keys").alias("bytes")).join(texts.select(F.col("carrier").alias("id")), "id", "left_semi")
    buckets = stored(bucketed(carriers, bucket_part), "near-buckets")
    tested = stored(verified(close_pairs(buckets, forest=True), some, threshold), "near-links")
    links = tested.filter("similar")
    labels = components(links)
    apart = (buckets.join(labels, buckets["id"] == labels["v"], "left")
             .select("band", "key", "n", "deal", "id", "bytes", F.coalesce("c", "id").alias("c"), "sample"))
    left = close_pairs(apart.filter(F.col("n") <= bucket_part), forest=False).join(tested.select("a", "b"), ["a", "b"], "left_anti")
    large = stored(apart.filter(F.col("n") > bucket_part).drop("sample"), "near-large")
    more = stored(verified(left, some, threshold).filter("similar").select("a", "b")
                  .union(large_bucket_links(large, some, threshold, 8 * bucket_part)), "near-links")
    if not more.isEmpty():
        labels = components(links.select("a", "b").union(more))
    labelled = (texts.join(labels, F.col("carrier") == F.col("v"), "left")
                .select("t1", "t2", F.coalesce("c", "carrier", "first").alias("label"), "first"))
    smallest = labelled.groupBy("label").agg(F.min("first").alias("class_id"))
    classes = labelled.join(smallest, "label").select("t1", "t2", "class_id")
    # a text may be held by a third of all rows: deal them, and give each deal the text's class
    deals = 16
    spread = classes.withColumn("deal", F.explode(F.sequence(F.lit(0), F.lit(deals - 1))))
    takes = every.filter("takes").select("id", "t1", "t2", F.expr(f"cast(pmod(xxhash64(id), {deals}) as int)").alias("deal"))
    return (takes.join(spread, ["t1", "t2", "deal"]).select("id", "class_id")
            .union(every.filter("not takes").select("id", F.col("id").alias("class_id"))))


def row_ident(doc_id: Column, text: Column) -> Column:
    """The id; for a null one a hash of the text."""
    return F.coalesce(doc_id.cast("long"), F.xxhash64(whole_text(text)))
