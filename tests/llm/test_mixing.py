import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from wellspark.llm.common import WORD_PATTERN
from wellspark.llm.mixing import mix, mix_documents, op10_mixing, source_targets

from .helpers import SF, documents, prose


def targets(sizes, cycle=(5, 2, 1), cap=3.0):
    """Resharing by hand: cap the sources above their limit, share the rest again, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: cycle[i % len(cycle)] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), {}
    while True:
        left = [s for s in order if s not in capped]
        share = {s: (total - sum(capped.values())) * weight[s] / sum(weight[x] for x in left) for s in left}
        over = [s for s in left if share[s] > cap * sizes[s]]
        if not over:
            return share | capped
        capped |= {s: cap * sizes[s] for s in over}


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 20, "c": 30}, {"a": 1, "b": 1000, "c": 1000, "d": 5, None: 3}, {"a": 0, "b": 7}, {"x": 4},
    {"a": 1, "b": 1, "c": 98, "d": 1}, {"a": 5, "b": 2, "c": 1, "d": 5, "e": 2}, {f"s{i}": i * i for i in range(12)}])
def test_targets_match_resharing(spark, sizes):
    sized = spark.createDataFrame([(s, n, 1) for s, n in sizes.items()], "source string, size bigint, n bigint")
    got = {r.source: r.target for r in source_targets(sized).collect()}
    assert got == pytest.approx(targets(sizes))


def test_targets_of_many_sources_over_many_tasks(spark):
    """Sources such as domains: ranked and summed up task by task, not in one window."""
    sizes = {f"host{i:05d}": (i * 7919) % 1000 for i in range(3000)} | {None: 17}
    sized = spark.createDataFrame([(s, n, 1) for s, n in sizes.items()], "source string, size bigint, n bigint")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.source: r.target for r in source_targets(sized).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert got == pytest.approx(targets(sizes))


def test_every_document_is_as_likely_as_its_neighbours(spark):
    """Inclusion document by document: right on average whatever the size, and drawn anew with every seed."""
    docs = documents(spark, [(i, "w " * (1, 6, 30)[i // 3 % 3], "abc"[i % 3]) for i in range(540)])
    seeds, count, ratio, extra = 12, defaultdict(int), {}, defaultdict(int)
    for seed in range(seeds):
        for r in mix(docs, group=16, seed=seed).collect():
            ratio[r.source] = r.target / r.source_size
            count[r.doc_id] += r.copies
            extra[r.source, r["size"]] += r.copies
    for (source, size), n in extra.items():
        assert abs(n / (seeds * 60) - ratio[source]) < 0.08, (source, size)
    for k, source in enumerate("abc"):
        p = ratio[source] % 1
        drawn = [count[i] - seeds * int(ratio[source]) for i in range(k, 540, 3)]
        mean = sum(drawn) / len(drawn)
        spread = sum((d - mean) ** 2 for d in drawn) / len(drawn)
        assert 0.6 * seeds * p * (1 - p) < spread < 1.4 * seeds * p * (1 - p)   # as of independent draws


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = op10_mixing(spark, SF)
    rows = out.collect()
    size = {r.doc_id: len(re.findall(WORD_PATTERN, r.text or "")) for r in docs.collect()}
    assert {r.doc_id: r["size"] for r in rows} == size and len(rows) == len(size)
    assert all(r.taken % r["size"] == 0 and 0 <= r.taken <= 3 * r["size"] for r in rows if r["size"])
    per = defaultdict(list)
    for r in rows:
        per[r.source].append(r)
    want = targets({s: sum(r["size"] for r in rs) for s, rs in per.items()})
    for s, rs in per.items():
        assert rs[0].target == pytest.approx(want[s]) and rs[0].source_size == sum(r["size"] for r in rs)
        # one undecided document at most
        assert abs(sum(r.taken for r in rs) - want[s]) <= max(r["size"] for r in rs) + 1e-6
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, op10_mixing(spark, SF).collect()), key=str)


def test_rounding_is_unbiased(spark):
    docs = documents(spark, [(i, prose(20 + i % 7, i), "abc"[i % 3]) for i in range(600)])
    copies, ratio, seeds = defaultdict(int), {}, 8
    for seed in range(seeds):
        for r in mix(docs, group=8, seed=seed).collect():
            copies[r.source] += r.copies
            ratio[r.source] = r.target / r.source_size
    for s, n in copies.items():
        assert abs(n / seeds / 200 - ratio[s]) < 0.04


def test_tree_of_many_levels_keeps_the_words(spark):
    docs = documents(spark, [(i, "w " * (1 + i % 50), "ab"[i % 2]) for i in range(3000)])
    per = {r.source: r for r in mix(docs, group=4).groupBy("source").agg(
        F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max("size").alias("big")).collect()}
    assert all(abs(r.taken - r.target) <= r.big for r in per.values())


def test_edges(spark):
    rows = [(1, None, "a"), (2, "", None), (3, "one two", None), (None, "x y z", "a"), (5, "k", "b"), (5, "k", "b"),
            (6, "w " * 50_000, "c"), (7, " \t\n", "zero")]
    docs = documents(spark, rows, size=1, grp=2, p=3, item="i", target=9)
    got = mix_documents(docs)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "grp", "p", "item",
                           "size", "source_size", "target", "copies", "taken"]
    assert len(got.collect()) == len(rows)
    assert all(r.taken == r.copies * r["size"] and r.copies <= 3 for r in got.collect())
    assert mix(documents(spark, [])).count() == 0
    assert [(r.taken, r.target) for r in mix(documents(spark, [(1, None)])).collect()] == [(0, 0.0)]
    same = documents(spark, [(1, "a b c", "s")] * 400 + [(2, "d e", "t")] * 100)
    assert mix(same, group=16).agg(F.sum("taken")).first()[0] == pytest.approx(1400, abs=3)
