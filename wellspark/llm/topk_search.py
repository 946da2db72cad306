"""Exact top-k search: aggregation over sorted lists without random access.

For one component the candidates, sorted by value, form a list; a query reads
the lists of its positive components from the top and those of its negative ones
from the bottom. After reading every list down to some depth, a candidate's score
lies between two bounds: components not read yet are at most the value at the
reading position and at least the list's last value. A candidate whose upper
bound is below the k-th best lower bound cannot qualify and is dropped; reading
goes on until the outsiders are gone or the lists are read out, and the scores of
those that are left are then resolved.

For a block of candidates the lists' prefixes are masks, and the bounds of many
queries at once are two matrix products: with top = values at or above the reading
position v, the upper bound is q+ . max(X, v) + q- . min(X, u).

Queries and candidates meet block by block: every pair of a query block and a
candidate block is one group of bounded size, and the k best of each group are
merged by a window per query. The depths at which bounds are compared are a
setting; they change the work, not the result.

Defined cases: vectors that are NULL or hold NULL, NaN or infinite components
take no part, neither do rows without a vec_id; shorter vectors count as padded
with zeros, an empty one scores 0; rows that repeat vec_id and vector count once,
and a query never meets a row with its own vec_id; ties go to the smaller vec_id;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stage, table

QUERY_BLOCK = 16_384
CANDIDATE_BLOCK = 8_192
DEPTHS = (0.1, 0.2, 0.4, 0.7)  # shares of every list that are read before bounds are compared again
SLICE = 512


def quantised(vectors: DataFrame, scale: int = 256, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, v array<bigint>): floor(scale * x), unusable vectors left out."""
    x = F.col("v0")
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    return (vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v0"))
            .filter(F.col("vec_id").isNotNull() & x.isNotNull() & ~bad)
            .select("vec_id", F.transform(x, lambda e: F.floor(F.lit(float(scale)) * e)).alias("v"))
            .distinct())


def _matrix(col: pa.ChunkedArray, width: int) -> np.ndarray:
    arr = pa.concat_arrays(col.chunks) if col.num_chunks != 1 else col.chunk(0)
    lens = np.diff(arr.offsets.to_numpy())
    flat = arr.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lens), width), dtype=np.int64)
    rows = np.repeat(np.arange(len(lens)), lens)
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(lens) - lens, lens)] = flat
    return out


def _width(*cols: pa.ChunkedArray) -> int:
    return max([1, *(int(np.diff(c.offsets.to_numpy()).max()) for col in cols for c in col.chunks if len(c))])


def _exact_type(x: np.ndarray, q: np.ndarray):
    """The cheapest number type in which every inner product of these rows is exact."""
    most = float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * x.shape[1]
    return np.float32 if most < 2 ** 24 else np.float64 if most < 2 ** 53 else object


def nra_block(q_ids, q, x_ids, x, k: int, depths=DEPTHS) -> tuple[list, list, list]:
    """The k best candidates of the block for every query: (query ids, candidate ids, scores)."""
    kind = _exact_type(x, q)
    order = np.argsort(x_ids, kind="stable")
    x_ids, x = x_ids[order], x[order].astype(kind)
    q = q.astype(kind)
    n = len(x_ids)
    slack = k + int(np.unique(x_ids, return_counts=True)[1].max(initial=1))  # a query may meet its own rows
    live = np.ones((len(q), n), dtype=bool)
    if kind is not object and n > 4 * slack:
        plus, minus = np.maximum(q, 0), np.minimum(q, 0)
        lists = np.sort(x, axis=0)                  # every component's sorted list
        for depth in depths:
            at = int(depth * n)
            v, u = lists[n - 1 - at], lists[at]     # reading positions from the top and from the bottom
            lower = plus @ np.where(x >= v, x, lists[0]).T + minus @ np.where(x <= u, x, lists[-1]).T
            upper = plus @ np.maximum(x, v).T + minus @ np.minimum(x, u).T
            kth = np.partition(lower, n - slack, axis=1)[:, n - slack]
            live &= upper >= kth[:, None]           # outsiders that cannot qualify any more
            if live.sum(axis=1).max() <= 4 * slack:
                break
    out_q, out_c, out_s = [], [], []
    for i in range(len(q)):
        some = np.flatnonzero(live[i] & (x_ids != q_ids[i]))
        score = x[some] @ q[i]                      # resolve the final scores
        if len(some) > k and kind is not object:
            near = score >= np.partition(score, len(score) - k)[len(score) - k]
            some, score = some[near], score[near]
        best = sorted(range(len(some)), key=lambda j: (-score[j], some[j]))[:k]  # places follow the ids: ties to the smaller
        out_q += [q_ids[i]] * len(best)
        out_c += [x_ids[some[j]] for j in best]
        out_s += [max(-2 ** 63, min(2 ** 63 - 1, int(score[j]))) for j in best]
    return out_q, out_c, out_s


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 5, query_block: int = QUERY_BLOCK,
          candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score) from two frames of (vec_id, v array<bigint>)."""
    n_q, n_c = queries.count(), candidates.count()
    qb, cb = max(1, -(-n_q // query_block)), max(1, -(-n_c // candidate_block))
    block = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = candidates.withColumn("cb", block(cb)).withColumn("qb", every(qb))
    right = queries.withColumn("qb", block(qb)).withColumn("cb", every(cb))

    def run(cands: pa.Table, qs: pa.Table) -> pa.Table:
        rows = ([], [], [])
        if len(cands) and len(qs):
            width = _width(cands["v"], qs["v"])
            x, q = _matrix(cands["v"], width), _matrix(qs["v"], width)
            ids, q_ids = cands["vec_id"].to_numpy(), qs["vec_id"].to_numpy()
            for i in range(0, len(q), SLICE):
                for have, new in zip(rows, nra_block(q_ids[i:i + SLICE], q[i:i + SLICE], ids, x, k)):
                    have.extend(new)
        return pa.table([pa.array(r, pa.int64()) for r in rows], names=["query_id", "vec_id", "score"])

    near = (left.groupBy("cb", "qb").cogroup(right.groupBy("cb", "qb"))
            .applyInArrow(run, "query_id bigint, vec_id bigint, score bigint"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (near.distinct().withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op7_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = stage(quantised(table(spark, sf_dir, "embeddings")), "vectors")
    return top_k(vectors.filter("vec_id % 50 = 0"), vectors, 5)


OP7_SQL = """
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
           FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND
                 len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5"""
