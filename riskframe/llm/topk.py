"""Exact top-k inner products by a Voronoi kNN join.

1. Vectors become integers. Identical vectors are one distinct vector with its
   2k smallest ids, no id more than k times: a query asks for k rows of other ids
   than its own, ties to the smaller id, so copies never need more.
2. Pivots are a seeded sample of distinct vectors; each vector belongs to the
   cell of its nearest pivot. A cell's summary is its largest distance to the
   pivot and largest norm.
3. A query's k-th best score is at least its k-th best among the pivots, which
   are rows themselves. A cell can hold a better one only if
   q.p + |q| * radius (or |q| * largest norm) reaches that bound; the query is
   replicated to those cells only.
4. Cells are cut into chunks of bounded size; each chunk is held by a task
   while the queries sent to it stream past in blocks.
5. The best k of all chunks' answers are ranked.

Vectors that are null, empty, or hold a null or non-finite component take no
part, nor do rows with a null id. Vectors of unequal length are padded with
zeros. Rows that repeat an id are rows of their own, except that no row of the
query's own id is its candidate. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import stored


def quantised(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))


def usable(vector: Column) -> Column:
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.exists(vector, bad)


def smallest_ids(vectors: DataFrame, k: int) -> DataFrame:
    """vec, ids: each distinct vector with its 2k smallest ids, at most k of one id, so that k are left
    without any one id; copies shrink before and after the shuffle."""
    keep = 2 * k

    def per_batch(batches):
        for b in batches:
            pdf = pd.DataFrame({"vec": b.column(1).to_pylist(), "id": b.column(0).to_numpy(zero_copy_only=False)})
            pdf["vec"] = [np.array(v, "<i8").tobytes() for v in pdf["vec"]]
            pdf = pdf.sort_values("id").groupby(["vec", "id"], sort=False).head(k).groupby("vec", sort=False).head(keep)
            yield pa.RecordBatch.from_pandas(pdf, preserve_index=False)

    few = vectors.mapInArrow(per_batch, "vec binary, id long")
    own, rank = Window.partitionBy("vec", "salt", "id").orderBy("id"), Window.partitionBy("vec", "salt").orderBy("id")
    salted = (few.withColumn("salt", F.expr("pmod(xxhash64(id), 64)"))
              .withColumn("copy", F.row_number().over(own)).filter(F.col("copy") <= k)
              .withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= keep))
    return salted.groupBy("vec").agg(F.slice(F.array_sort(F.collect_list("id")), 1, keep).alias("ids"))  # 64 * keep ids at most


def pad(vectors: list[bytes], size: int) -> np.ndarray:
    out = np.zeros((len(vectors), size))
    for i, v in enumerate(vectors):
        x = np.frombuffer(v, "<i8")
        out[i, :len(x)] = x
    return out


def top_k(embeddings: DataFrame, queries: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10,
          scale: int = 1024, pivots: int | None = None, chunk_rows: int = 4096, seed: int = 11) -> DataFrame:
    """query_id, rank, vec_id, score for the rows that ``queries`` selects, against all rows.

    ``pivots`` is by default the square root of the distinct vectors, at most 4096 (a bounded broadcast).
    Scores are exact while they stay below 2**53.
    """
    spark = embeddings.sparkSession
    rows = (embeddings.filter(usable(F.col(vector_col)) & F.col(id_col).isNotNull())
            .select(F.col(id_col).cast("long").alias("id"), quantised(F.col(vector_col), scale).alias("vec"),
                    F.coalesce(queries, F.lit(False)).alias("asked")))
    distinct = stored(smallest_ids(rows.select("id", "vec"), k), "knn-vectors")
    n, size = distinct.agg(F.count(F.lit(1)), F.coalesce(F.max(F.octet_length("vec")), F.lit(0))).first()
    size //= 8
    count = min(4096, pivots or max(1, int(n ** 0.5)))
    chosen = distinct.orderBy(F.xxhash64(F.lit(seed), "vec"), "vec").limit(count).collect()
    centres = pad([r["vec"] for r in chosen], size)
    # ids and scores at the pivots give every query its bound
    owners = [list(r["ids"]) for r in chosen]
    shared = spark.sparkContext.broadcast((centres, owners))

    def nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        d = (x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1)[None]
        at = d.argmin(1)
        return at, np.sqrt(np.maximum(0, d[np.arange(len(x)), at]))

    def to_cells(batches):
        c, _ = shared.value
        for b in batches:
            x = pad(b.column(0).to_pylist(), size)
            at, far = nearest(x, c)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(at), pa.array(far),
                                              pa.array(np.sqrt((x * x).sum(1)))], names=["vec", "ids", "cell", "far", "norm"])

    placed = distinct.mapInArrow(to_cells, "vec binary, ids array<long>, cell long, far double, norm double")
    summary = placed.groupBy("cell").agg(F.max("far").alias("far"), F.max("norm").alias("norm"),
                                         F.count(F.lit(1)).alias("n")).collect()  # one row per pivot at most
    far, norm, chunks = np.zeros(len(centres)), np.zeros(len(centres)), np.zeros(len(centres), np.int64)
    for r in summary:
        far[r["cell"]], norm[r["cell"]], chunks[r["cell"]] = r["far"], r["norm"], -(-r["n"] // chunk_rows)
    bounds = spark.sparkContext.broadcast((far, norm, chunks))

    def route(batches):
        c, owners = shared.value
        far, norm, chunks = bounds.value
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            vecs = [np.array(v, "<i8").tobytes() for v in b.column(1).to_pylist()]
            x = pad(vecs, size)
            scores, length = x @ c.T, np.sqrt((x * x).sum(1))
            reach = np.minimum(scores + length[:, None] * far, length[:, None] * norm) * (1 + 1e-9) + 1e-6
            cell, chunk, who = [], [], []
            for i, me in enumerate(ids):
                known = sorted((s for s, own in zip(scores[i], owners) for o in own if o != me), reverse=True)
                need = known[k - 1] if len(known) >= k else -np.inf
                for at in np.flatnonzero((reach[i] >= need) & (chunks > 0)):
                    many = int(chunks[at])
                    cell += [at] * many
                    chunk += range(many)
                    who += [i] * many
            yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int64()), pa.array(chunk, pa.int64()), pa.array(ids[np.array(who, np.int64)]),
                                              pa.array([vecs[i] for i in who], pa.binary())], names=["cell", "chunk", "id", "vec"])

    parts = spark.createDataFrame([(c, int(n)) for c, n in enumerate(chunks) if n > 1] or [(-1, 1)], "cell long, chunks long")
    data = (placed.join(F.broadcast(parts), "cell", "left")
            .select("cell", F.expr("pmod(xxhash64(vec), coalesce(chunks, 1))").alias("chunk"),
                    F.lit(0).alias("kind"), F.lit(None).cast("long").alias("id"), "vec", "ids"))
    asked = (rows.filter("asked").select("id", "vec").distinct().mapInArrow(route, "cell long, chunk long, id long, vec binary")
             .select("cell", "chunk", F.lit(1).alias("kind"), "id", "vec", F.lit(None).cast("array<long>").alias("ids")))
    dealt = data.unionByName(asked).repartition("cell", "chunk").sortWithinPartitions("cell", "chunk", "kind")

    def answers(x: np.ndarray, ids: list, vecs: list[bytes], asks: np.ndarray):
        """The best k rows of the held vectors for each query, ties to the smaller id."""
        scores = (pad(vecs, size) @ x.T).astype(np.int64)
        alone: dict[int, list[int]] = {}        # vectors that no other id holds can't answer that id
        for j, held in enumerate(ids):
            if held[0] == held[-1]:
                alone.setdefault(int(held[0]), []).append(j)
        for s, me, vec in zip(scores, asks, vecs):
            s[alone.get(int(me), [])] = np.iinfo(np.int64).min
            edge = np.partition(s, -min(len(s), k))[-min(len(s), k)]
            best = sorted((-int(s[j]), int(o)) for j in np.flatnonzero(s >= edge) for o in ids[j] if o != me)[:k]
            for score, o in best:
                yield int(me), o, -score, vec

    def solve(batches):
        place, held, ids = None, [], []
        x = None
        for b in batches:
            cells, chunk, kind = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            edges = np.flatnonzero(np.diff(cells) | np.diff(chunk) | np.diff(kind)) + 1
            for lo, hi in zip(np.r_[0, edges], np.r_[edges, len(cells)]):
                if lo == hi:
                    continue
                part, at = b.slice(int(lo), int(hi - lo)), (cells[lo], chunk[lo])
                if at != place:
                    place, held, ids, x = at, [], [], None
                if kind[lo] == 0:
                    held += part.column(4).to_pylist()
                    ids += part.column(5).to_pylist()
                elif held:
                    x = pad(held, size) if x is None else x
                    for start in range(0, part.num_rows, 256):
                        block = part.slice(start, 256)
                        vecs = block.column(4).to_pylist()
                        found = list(answers(x, ids, vecs, block.column(3).to_numpy(zero_copy_only=False)))
                        columns = zip(*found) if found else [[]] * 4
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                                                         names=["query_id", "vec_id", "score", "vec"])

    found = dealt.mapInArrow(solve, "query_id long, vec_id long, score long, vec binary")
    best = Window.partitionBy("query_id", "vec").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
