"""Importance resampling against SQL and against a plain Python version."""

import hashlib
import math
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from tests.llm.helpers import SF, documents, prose
from tests.oracle import compare, duck
from wellspark.llm import resampling as R


def brute(rows, target, order, buckets, seed, min_words, percent):
    def grams(text):
        words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+",
                           "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        return len(words), [zlib.crc32(" ".join(words[i:i + n]).encode()) % buckets
                            for n in range(1, order + 1) for i in range(len(words) - n + 1)]

    s = Counter(g for _, text in rows for g in grams(text)[1])
    t = Counter(g for text in target for g in grams(text)[1])
    n_s, n_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = {b: math.floor(1000 * math.log((t[b] + 1.0) * n_s / ((s[b] + 1.0) * n_t))) for b in s}
    out = []
    for doc_id, text in rows:
        n_words, found = grams(text)
        weight = sum(gain[g] for g in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + .5) / 2 ** 32))),
                    n_words])
    can = sorted((x for x in out if x[4] >= min_words),
                 key=lambda x: (-x[3], x[0] is None, x[0] or 0, -x[2], -x[1]))
    rank = {id(x): i + 1 for i, x in enumerate(can[:percent * len(can) // 100])}
    return sorted((tuple(map(repr, x[:4] + [rank.get(id(x))])) for x in out))


def test_query_matches_sql(spark):
    r = compare(spark, duck(SF), "op11_resampling", SF, R.op11_resampling, R.OP11_SQL)
    assert r["ok"], r


def test_edges_against_brute_force(spark):
    rows = [(i, prose(3 + i % 40, seed=i)) for i in range(120)]
    rows += [(7, prose(25, seed=7)), (7, prose(25, seed=7)), (None, prose(30, seed=1)), (None, prose(31, seed=2))]
    rows += [(500, None), (501, ""), (502, " ..! "), (503, "ÉCOLE École école STRASSE straße Z9 9z" * 4),
             (504, prose(60_000, seed=3)), (505, "a" * 100_000)]
    target = [prose(200, seed=99, vocabulary=20), None, "", "École"]
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id bigint, text string")
    docs = documents(spark, rows, rank=1, score=2, weight=3, key="k", bucket=4, eligible=True)
    for order, percent, pivots in ((1, 10, 16), (2, 50, 2), (3, 100, 1)):
        got = R.resample(docs, bench, order=order, buckets=97, seed=5, min_words=20, percent=percent, pivots=pivots)
        assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
        assert sorted(tuple(map(repr, r)) for r in got.collect()) == brute(rows, target, order, 97, 5, 20, percent)


def test_empty_tables(spark):
    bench = spark.createDataFrame([(1, "some words")], "item_id bigint, text string")
    assert R.resample(documents(spark, []), bench).count() == 0
    few = [(1, prose(30)), (2, "short"), (3, None)]
    got = R.resample(documents(spark, few), bench.limit(0), percent=100).collect()
    assert sorted((r.doc_id, r.rank) for r in got) == [(1, 1), (2, None), (3, None)]
    assert all(r.rank is None for r in R.resample(documents(spark, few), bench, percent=10).collect())


def test_quickselect_finds_every_key(spark):
    scores = [(i * 7 % 5, i % 9 if i % 11 else None) for i in range(60)]
    rows = (spark.createDataFrame(scores, "score bigint, doc_id bigint").withColumn("key", R._key()))
    order = sorted((-s, d is None, d or 0) for s, d in scores)
    for k in (1, 2, 13, 30, 59, 60):
        assert tuple(R.kth_key(rows, k, pivots=3)) == order[k - 1]
    assert R.kth_key(rows, 61, pivots=3) is None


def test_ranks_run_over_all_tasks(spark):
    rows = spark.range(1000).select((F.col("id") % 100).alias("score"), "id")
    got = R.rank_rows(rows.repartition(16), [F.desc("score"), F.asc("id")]).orderBy("rank").collect()
    assert [r.rank for r in got] == list(range(1, 1001))
    assert [(r.score, r.id) for r in got] == sorted(((i % 100, i) for i in range(1000)), key=lambda x: (-x[0], x[1]))
