import math

import numpy as np

from tests.oracle import compare, duck
from wellspark.llm.topk_search import OP7_SQL, nra_block, op7_exact_topk, quantised, top_k

from .helpers import SF

SCHEMA = "vec_id bigint, embedding array<float>, v int, cb int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2) for i, v in rows], SCHEMA)


def brute(rows, queries, k):
    ok = {(i, tuple(math.floor(256 * float(np.float32(x))) for x in v)) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for qi, q in sorted(ok):
        if qi in queries:
            best = sorted((-sum(a * b for a, b in zip(q, c)), ci) for ci, c in ok if ci != qi)[:k]
            out += [(qi, r + 1, ci, -s) for r, (s, ci) in enumerate(best)]
    return out


def run(spark, rows, queries, k, **blocks):
    v = quantised(frame(spark, rows))
    got = top_k(v.filter(v.vec_id.isin(list(queries))), v, k, **blocks)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, got.collect()))


def test_whole_table_matches_sql(spark):
    r = compare(spark, duck(SF), "op7", SF, op7_exact_topk, OP7_SQL)
    assert r["ok"], r


def test_ties_blocks_and_bad_vectors(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(40)]                       # ties
    rows += [(2000, None), (2001, [1.0, None]), (2002, [float("nan")]), (2003, [float("inf")]), (None, [1.0]),
             (2004, []), (2005, [2.0]), (5, rows[5][1])]
    queries = {0, 7, 2004, 2005, 1003}
    want = brute(rows, queries, 5)
    for blocks in ({}, {"query_block": 2, "candidate_block": 60}):
        assert run(spark, rows, queries, 5, **blocks) == want


def test_bounds_never_lose_a_winner():
    rng = np.random.default_rng(1)
    for scale in (3, 100, 10 ** 6, 10 ** 12):
        x = rng.integers(-scale, scale + 1, size=(500, 8))
        q = rng.integers(-scale, scale + 1, size=(20, 8))
        q_, c, s = nra_block(np.arange(10_000, 10_020), q, np.arange(500), x, 7)
        for i in range(20):
            want = sorted((-int(sum(int(a) * int(b) for a, b in zip(q[i], v))), j) for j, v in enumerate(x))[:7]
            have = [(-s[j], c[j]) for j in range(len(q_)) if q_[j] == 10_000 + i]
            limit = [(max(-2 ** 63 + 1, min(2 ** 63, a)), b) for a, b in want]
            assert [b for _, b in have] == [b for _, b in want] and [a for a, _ in have] == [a for a, _ in limit]


def test_few_rows_and_none(spark):
    rows = [(0, [1.0, 2.0]), (50, [0.5, 0.0])]
    assert run(spark, rows, {0, 50}, 5) == brute(rows, {0, 50}, 5)
    assert run(spark, [], {0}, 5) == []
