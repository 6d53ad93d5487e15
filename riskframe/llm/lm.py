"""Language-model scoring by deleted interpolation.

The probability of a token is a mixture of the maximum-likelihood estimates of
order 0 (1 / (V + 1)) to ``order``; the weights depend on how frequent the
context is (buckets of its count, by powers of two). Training documents are
split in a kept part and a deleted part: expectation-maximisation learns the
weights on the deleted part's tokens under the kept part's counts, then the
counts of both parts are used with those weights.

Tokens are words with A-Z lower-cased and one end per document; contexts start
anew in each document. All n-grams of all training documents are counted, by
64-bit hashes (see ``blocks``); none is pruned.

Null and empty texts are one end. Without training tokens both scores are 0.
Repeated rows each count; a null id stays null. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.blocks import ODD, SHARD_KEYS, Block, block_totals, count_keys, mixed, to_blocks, with_replies
from riskframe.llm.common import stored, width

END = b"\n"  # no word holds it
KEPT, DELETED, OTHER = 0, 1, 2
BUCKETS = 24
LOWEST = -40  # of the binned log2 probabilities


def ngram_keys(block: Block, order: int) -> np.ndarray:
    """Key of the n-gram that ends at each token; a document's start is a context of its own."""
    key = mixed(block.tokens)
    starts = block.starts
    for n in range(2, order + 1):
        before = np.roll(key, 1)
        before[starts] = np.uint64(n)
        with np.errstate(over="ignore"):
            key = mixed(before * ODD + block.tokens + np.uint64(n))
    return key


def distinct_ngrams(block: Block, order: int) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(ngram_keys(block, order), return_counts=True)


def token_counts(block: Block, order: int, found: dict, pick) -> tuple[list[np.ndarray], list[np.ndarray | None]]:
    """Per order: counts of the n-grams ending at each token, and of their contexts (None where a document starts: -1)."""
    counts, contexts = [], [None]
    for n in range(1, order + 1):
        _, at = np.unique(ngram_keys(block, n), return_inverse=True)
        counts.append(pick(found[n])[at])
        if n > 1:
            before = np.roll(counts[n - 2], 1)
            before[block.starts] = -1
            contexts.append(before)
    return counts, contexts


def estimates(counts: list, contexts: list, tokens: int, docs: int, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each token's longest context, estimates of order 0 .. n as columns)."""
    p = [np.full(len(counts[0]), 1 / (words + 1))]
    seen = np.full(len(counts[0]), tokens)
    for c, before in zip(counts, contexts):
        seen = seen if before is None else np.where(before < 0, docs, before)
        p.append(c / np.maximum(1, seen))
    return np.minimum(BUCKETS - 1, np.log2(seen + 1).astype(np.int64)), np.column_stack(p)


def learn_weights(bins: pd.DataFrame, order: int, rounds: int = 60) -> np.ndarray:
    """Mixture weights by bucket, by expectation-maximisation; a bucket without tokens takes its neighbour's."""
    out = np.full((BUCKETS, order + 1), np.nan)
    for bucket, rows in bins.groupby("bucket"):
        n = rows["n"].to_numpy(float)
        p = rows[[f"p{i}" for i in range(order + 1)]].to_numpy() / n[:, None]
        w = np.full(order + 1, 1 / (order + 1))
        for _ in range(rounds):
            share = p * w
            share /= share.sum(1, keepdims=True)
            w = n @ share / n.sum()
        w = np.maximum(w, 1e-6)
        out[int(bucket)] = w / w.sum()
    told = np.flatnonzero(~np.isnan(out[:, 0]))
    if not len(told):
        return np.full_like(out, 1 / (order + 1))
    return out[told[np.abs(np.arange(BUCKETS)[:, None] - told[None]).argmin(1)]]


def score_texts(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", order: int = 2,
                deleted_share: int = 10) -> DataFrame:
    """id, n_tokens, n_known, train_tokens, base_score, score for every row of ``docs``.

    One in ``deleted_share`` training documents, by hash of the id, is in the deleted part.
    """
    part = (F.when(~F.coalesce(train, F.lit(False)), OTHER)
            .when(F.expr(f"pmod(xxhash64(`{id_col}`), {deleted_share})") == 0, DELETED).otherwise(KEPT))
    blocks = stored(to_blocks(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), part.alias("part")), END), "lm-blocks")
    kinds = list(range(1, order + 1))
    shards = width(docs.sparkSession, block_totals(blocks)[1], SHARD_KEYS)
    replies = stored(count_keys(blocks, kinds, distinct_ngrams, shards), "lm-counts")
    size = {r["part"]: (r["tokens"], r["docs"]) for r in blocks.groupBy("part").agg(F.sum("tokens").alias("tokens"), F.sum("docs").alias("docs")).collect()}
    words = replies.filter("kind = 1").agg(F.coalesce(F.sum("distinct"), F.lit(0))).first()[0]
    kept_tokens, kept_docs = size.get(KEPT, (0, 0))
    more_tokens, more_docs = size.get(DELETED, (0, 0))
    columns = [f"p{i}" for i in range(order + 1)]

    def bins(part: int, block: Block, found: dict) -> pd.DataFrame:
        bucket, p = estimates(*token_counts(block, order, found, lambda f: f[0]), kept_tokens, kept_docs, words)
        level = np.where(p > 0, np.maximum(LOWEST, np.round(2 * np.log2(np.maximum(p, 1e-30)))), 1).astype(np.int64)
        key = bucket
        for i in range(order + 1):
            key = key * (2 - LOWEST) + level[:, i] - LOWEST
        _, first, at = np.unique(key, return_index=True, return_inverse=True)
        out = {"bucket": bucket[first], "key": key[first], "n": np.bincount(at)}
        return pd.DataFrame(out | {c: np.bincount(at, p[:, i]) for i, c in enumerate(columns)})

    schema = "bucket long, key long, n long, " + ", ".join(f"{c} double" for c in columns)
    gone = blocks.filter(F.col("part") == DELETED)
    own = replies.join(gone.select("block"), "block", "left_semi")
    # one row per bucket and combination of binned estimates, however large the corpus
    summed = with_replies(gone, own, bins, schema).groupBy("bucket", "key").agg(F.sum("n").alias("n"), *(F.sum(c).alias(c) for c in columns))
    weights = learn_weights(summed.toPandas(), order)
    tokens, starts = kept_tokens + more_tokens, kept_docs + more_docs

    def answer(part: int, block: Block, found: dict) -> pd.DataFrame:
        counts, contexts = token_counts(block, order, found, lambda f: f[0] + f[1])
        bucket, p = estimates(counts, contexts, tokens, starts, words)
        begin = block.starts
        total = lambda x: np.add.reduceat(x, begin)  # noqa: E731  every document has a token
        return pd.DataFrame({"id": pd.array(block.ids, "Int64"), "n_tokens": block.sizes.astype(np.int64), "n_known": total((counts[0] > 0).astype(np.int64)),
                             "train_tokens": tokens, "base_score": total(np.log10((counts[0] + 1) / (tokens + words + 1))),
                             "score": total(np.log10((p * weights[bucket]).sum(1))) if tokens else 0.0})

    return with_replies(blocks, replies, answer, "id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")
