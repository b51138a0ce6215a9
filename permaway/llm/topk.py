"""Exact top-k inner products by branch and bound over a vertical layout."""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Queries held at once; larger query sets are taken in blocks by hash, one scan of the candidates for each.
QUERY_BLOCK = 16_384
#: Candidates in one vertical block and dimensions accumulated before the next compaction.
CANDIDATES, DIMS = 4096, 16
#: Vectors with a quantised component of this size or more are scored by whole numbers of any length.
WIDE = float(1 << 28)
#: Scores beyond these come as the nearer one.
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def quantized(rows: DataFrame, vec: str = "embedding", key: str = "vec_id") -> DataFrame:
    """(id, q array<double>): floor(256 * x), whole numbers that a double holds whatever their size.
    Vectors that are null or empty, or hold a null or a non-finite component, take no part;
    neither does a null id."""
    x = rows.select(F.col(key).alias("id"), F.col(vec).alias("v")).where("id is not null and size(v) > 0")
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    # Spark's floor ends at the range of a long; beyond 2^52 a double has no fraction.
    floor = lambda y: F.when(F.abs(y) < F.lit(float(1 << 52)), F.floor(y).cast("double")).otherwise(y)
    return x.where(F.coalesce(fine, F.lit(False))).select("id", F.transform("v", lambda c: floor(F.lit(256.0) * c.cast("double"))).alias("q"))


class BestFound:
    """The k best of each of m queries so far: score down, id up."""

    def __init__(self, m: int, k: int):
        self.k, self.bar = k, np.full(m, -np.inf)
        self.q, self.score, self.id = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, q: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        q, score, ids = np.concatenate((self.q, q)), np.concatenate((self.score, score)), np.concatenate((self.id, ids))
        order = np.lexsort((ids, -score, q))
        q, score, ids = q[order], score[order], ids[order]
        new = np.r_[True, (q[1:] != q[:-1]) | (score[1:] != score[:-1]) | (ids[1:] != ids[:-1])][: len(q)]
        q, score, ids = q[new], score[new], ids[new]  # repeated rows count once
        first = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if len(q) else np.zeros(0, np.int64)
        rank = np.arange(len(q)) - np.repeat(first, np.diff(np.r_[first, len(q)]))
        keep = rank < self.k
        last = rank == self.k - 1
        self.q, self.score, self.id = q[keep], score[keep], ids[keep]
        self.bar[q[last]] = score[last]


def search_block(queries: np.ndarray, query_ids: np.ndarray, best: BestFound, block: np.ndarray, ids: np.ndarray, dims: int = DIMS) -> None:
    """Score a block of candidates against all queries, DIMS dimensions at a time.

    After each step the partial score plus the product of the norms of what is left
    bounds the full score from above. While many pairs survive, a step is one matrix
    product; once few do, only the compacted pairs are carried on. A pair goes only if
    its bound is below the k-th best score, so ties are kept. All sums are integers of
    under 2^53, exact in float64 (checked), and in int64 otherwise.
    """
    n = queries.shape[1]
    biggest = int(np.abs(queries).max(initial=0)) * int(np.abs(block).max(initial=0)) * n
    kind = np.float64 if biggest < 1 << 53 else np.int64
    queries, columns = queries.astype(kind), np.ascontiguousarray(block.T.astype(kind))
    left_q = np.sqrt(np.cumsum(queries[:, ::-1].astype(np.float64) ** 2, axis=1))[:, ::-1]
    left_c = np.sqrt(np.cumsum(columns[::-1].astype(np.float64) ** 2, axis=0))[::-1]
    best_pairs = len(query_ids) * len(ids)
    sums, pairs = np.zeros((len(queries), len(ids)), kind), None
    for d in range(0, n, dims):
        stop = min(n, d + dims)
        if pairs is None:
            sums += queries[:, d:stop] @ columns[d:stop]
        else:
            qi, ci = pairs
            for j in range(d, stop):
                sums += queries[qi, j] * columns[j, ci]
        slack = 0.0 if stop == n else 1.0  # rounding of the norms
        if pairs is None:
            bound = sums if stop == n else sums + np.outer(left_q[:, stop], left_c[stop]) + slack
            alive = bound >= best.bar[:, None]
            if stop == n:
                if len(ids) > best.k + 1 and len(np.unique(ids)) == len(ids):
                    # The candidate itself is no partner, so the (k+1)-th best is a safe bar.
                    bar = np.partition(sums, len(ids) - best.k - 1, axis=1)[:, len(ids) - best.k - 1]
                    alive &= sums >= bar[:, None]
                pairs = np.nonzero(alive)
                sums = sums[pairs]
            elif np.count_nonzero(alive) < 0.05 * best_pairs:
                pairs = np.nonzero(alive)
                sums = sums[pairs]
        else:
            qi, ci = pairs
            bound = sums if stop == n else sums + left_q[qi, stop] * left_c[stop, ci] + slack
            alive = bound >= best.bar[qi]
            pairs, sums = (qi[alive], ci[alive]), sums[alive]
    qi, ci = pairs
    other = query_ids[qi] != ids[ci]
    best.add(qi[other], sums[other].astype(np.int64), ids[ci[other]])


def search_wide(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, block: np.ndarray, k: int):
    """(query_id, vec_id, score, value) of the best of a block by whole numbers of any length, where a
    query or a candidate is wide; value tells scores apart that a long does not hold."""
    left, right = ([[int(x) for x in v] for v in m.tolist()] for m in (queries, block))
    for i, x in zip(query_ids.tolist(), left, strict=True):
        found = {(sum(a * b for a, b in zip(x, y, strict=True)), -j) for j, y in zip(ids.tolist(), right, strict=True) if j != i}
        for score, j in heapq.nlargest(k, found):
            near = min(max(score, LEAST), MOST)
            value = 0.0 if near == score else float(score) if score.bit_length() < 1024 else math.copysign(math.inf, score)
            yield i, -j, near, value


def top_k(rows: DataFrame, is_query, k: int = 5, vec: str = "embedding", key: str = "vec_id", query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best candidates of every query row.

    A query's candidates are the rows of another id and as many dimensions. Queries
    are counted, then taken in blocks of bounded size by a hash of the id; each block
    is sent to the executors, which scan all candidates where they are, so candidates
    are never shuffled. Each task returns at most 2k rows a query. Repeated ids count as
    one row if their vectors agree, else each may appear. Finite vectors of any size take
    part; a score that no long holds comes as the nearest one and ranks by its value as a
    double. Columns other than the two are not read; an empty table gives none.
    """
    spark = rows.sparkSession
    vectors = quantized(rows, vec, key)
    queries = vectors.where(is_query(F.col("id")))
    blocks = max(1, -(-queries.count() // query_block))
    out = None
    for b in range(blocks):
        held = queries.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).toPandas()
        by_dims = {}
        for size, g in held.groupby(held.q.map(len)):
            ids, q = g.id.to_numpy(np.int64), np.array(g.q.tolist(), np.float64)
            wide = np.abs(q).max(axis=1) >= WIDE
            by_dims[int(size)] = (ids[~wide], q[~wide].astype(np.int64), ids[wide], q[wide])
        sent = spark.sparkContext.broadcast(by_dims)

        def searched(batches, sent=sent):
            best, rest = {}, []
            for batch in batches:
                ids, q = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
                sizes = np.asarray(q.value_lengths())
                flat, at = q.flatten().to_numpy(zero_copy_only=False), np.r_[0, np.cumsum(sizes)]
                for n in np.unique(sizes).tolist():
                    if n not in sent.value:
                        continue
                    query_ids, vecs, wide_ids, wide_vecs = sent.value[n]
                    found = best.setdefault(n, BestFound(len(query_ids), k))
                    rows = np.flatnonzero(sizes == n)
                    step = max(64, min(CANDIDATES, (1 << 22) // max(len(query_ids), 1)))
                    for i in range(0, len(rows), step):
                        part = rows[i : i + step]
                        block, own = flat[at[part][:, None] + np.arange(n)], ids[part]
                        wide = np.abs(block).max(axis=1) >= WIDE
                        if len(query_ids) and not wide.all():
                            search_block(vecs, query_ids, found, block[~wide].astype(np.int64), own[~wide])
                        if len(wide_ids):
                            rest += search_wide(wide_ids, wide_vecs, own, block, k)
                        if wide.any():
                            rest += search_wide(query_ids, vecs, own[wide], block[wide], k)
                        if len(rest) > 1 << 16:
                            rest = best_of(rest, k)
            for n, found in best.items():
                rest += zip(sent.value[n][0][found.q].tolist(), found.id.tolist(), found.score.tolist(), [0.0] * len(found.id), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rest, strict=True)) or [[]] * 4, (pa.int64(),) * 3 + (pa.float64(),), strict=True)], ["query_id", "vec_id", "score", "value"])

        one = vectors.mapInArrow(searched, "query_id bigint, vec_id bigint, score bigint, value double")
        out = one if out is None else out.unionByName(one)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.desc("value"), "vec_id")
    ranked = out.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def best_of(rows: list[tuple], k: int) -> list[tuple]:
    """The k best of each query."""
    rows, out, last, n = sorted(set(rows), key=lambda r: (r[0], -r[2], -r[3], r[1])), [], None, 0
    for r in rows:
        n = n + 1 if r[0] == last else 1
        last = r[0]
        if n <= k:
            out.append(r)
    return out


SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0)
SELECT query_id, rank::INT AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""


def op6_exact_top_k(spark, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), lambda i: i % 50 == 0)
