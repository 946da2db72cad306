from collections import defaultdict

import numpy as np

from wellspark.llm.near_dedup import (bag_min_hash, components, keep_one_of_each, near_classes, op6_minhash_near_dedup,
                                      signatures, tell_apart)
from wellspark.llm.shingles import multiset, weighted_jaccard, words

from .helpers import SF, documents, prose


def brute(rows):
    """Classes by union-find over all pairs that share a shingle."""
    bags = [multiset(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = defaultdict(list)
    for i, (h, _) in enumerate(bags):
        for s in h:
            holders[int(s)].append(i)
    for a, b in {(x, y) for ids in holders.values() for x in ids for y in ids if x < y}:
        if weighted_jaccard(bags[a], bags[b]) >= 0.8:
            root[max(find(a), find(b))] = min(find(a), find(b))
    classes = defaultdict(set)
    for i in range(len(rows)):
        classes[find(i)].add(rows[i][0])
    return {frozenset(c) for c in classes.values()}


def classes(df):
    got = defaultdict(set)
    for r in df.collect():
        got[(r.class_key, None if r.class_key is not None else r.doc_id)].add(r.doc_id)
    return {frozenset(c) for c in got.values()}


def test_signatures_are_unbiased_for_weighted_jaccard():
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 2 ** 63, 300).astype(np.uint64)
    for share in (0.2, 0.8):
        a = rng.integers(0, 9, 300)
        b = np.where(rng.random(300) < share, a, rng.integers(0, 9, 300))
        sig = bag_min_hash([(keys[a > 0], a[a > 0]), (keys[b > 0], b[b > 0])], 8192)
        assert abs((sig[0] == sig[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.025


def test_whole_table_matches_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert classes(near_classes(spark.read.parquet(f"{SF}/documents.parquet"))) == brute(rows)


def test_chains_and_shared_passages(spark):
    base = prose(300, 1, 10_000).split()
    # Each step drops a few words more at the end: neighbours are similar, the ends of the chain are not.
    chain = [(i, " ".join(base[:300 - 20 * i])) for i in range(8)]
    passage = prose(60, 2, 10_000)
    sharing = [(100 + i, passage + " " + prose(40 + i % 5, 50 + i, 10_000)) for i in range(60)]
    copies = [(200 + i, " ".join(base[::-1][:100 + i % 3])) for i in range(40)]
    rows = chain + sharing + copies
    got = classes(near_classes(documents(spark, rows)))
    assert got == brute(rows)
    assert frozenset(range(8)) in got


def test_edges_and_one_of_each(spark):
    long = prose(40_000, 6, 5_000)
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A, b!"), (6, "a b c"), (None, "a b"), (8, long),
            (9, long + " tail"), (10, "x " * 50), (11, "x " * 49), (12, "x " * 20), (4, "a b"), (13, "é ü"), (13, "é ü")]
    docs = documents(spark, rows, node=1, raw="r", bands=2, class_id=3)
    got = classes(near_classes(docs))
    assert {frozenset({4, 5, None}), frozenset({6}), frozenset({8, 9}), frozenset({10, 11}), frozenset({12}),
            frozenset({1}), frozenset({2}), frozenset({3}), frozenset({13})} == got
    kept = keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4, 6, 8, 10, 12, 13]
    assert near_classes(documents(spark, [])).count() == 0


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i + 1, i) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5000 + 1)]
    got = components(spark.createDataFrame(edges, "a bigint, b bigint"))
    roots = {r.node: r.root for r in got.collect()}
    assert all(roots.get(i, 0) == 0 for i in range(201)) and all(roots[1000 + i] == 1000 for i in range(1, 300))
    assert roots[5001] == 5000


def test_words_ignore_case_and_marks():
    assert words("The (quick) FOX, 42!") == ["the", "quick", "fox", "42"] and words(None) == []


def test_texts_without_words_are_those_of_the_classes(spark):
    """Java's and Python's ideas of a word character differ on these."""
    wordless = ["❤️", "Ⓐ", "‍", "‿", "ั", None, "", "!?"]
    rows = [(i, t) for i, t in enumerate(wordless)] + [(0, wordless[0]), (None, wordless[0]), (None, None)]
    rows += [(20, "½"), (21, "½"), (21, "½"), (22, "²"), (23, "²"), (24, "a b")]
    kept = keep_one_of_each(documents(spark, rows, node=1, raw="r"))
    want = [r for r in rows if not words(r[1])] + [(20, "½"), (22, "²"), (24, "a b")]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(want, key=str)


def test_word_sequences_that_share_a_node_stay_apart(spark):
    rows = [(1, 10, 7, 100, 1, [5]), (2, 11, 7, 100, 1, [5]), (3, 12, 7, 101, 1, [6]), (4, 13, 7, 102, 1, [6]),
            (5, 14, 8, 100, 1, [7]), (6, 15, None, None, 0, [])]
    sigs = spark.createDataFrame(rows, "doc_id bigint, raw bigint, node bigint, check bigint, n bigint, bands array<bigint>")
    got = {r.doc_id: r.node for r in tell_apart(sigs).collect()}
    assert got[1] == got[2] == 7 and got[5] == 8 and got[6] is None
    assert len({got[1], got[3], got[4], got[5]}) == 4
    same = signatures(documents(spark, [(1, "some words here"), (2, "Some, WORDS here!"), (3, "some words there")]))
    pairs = {r.doc_id: (r.node, r.check) for r in same.collect()}
    assert pairs[1] == pairs[2] and pairs[1][0] != pairs[3][0] and pairs[1][1] != pairs[3][1] and pairs[1][0] != pairs[1][1]


def all_links(texts, threshold=0.8):
    """Every pair of different texts with a similarity of ``threshold`` or more: exact, by their rarest shingles.

    Of two multisets that similar, the rarest 1 - threshold of one (and one more) must hold a shingle of
    the other's: texts that share none of these are not similar enough.
    """
    bags = [multiset(t) for t in texts]
    spread = defaultdict(int)
    for h, _ in bags:
        for s in h:
            spread[int(s)] += 1
    holders, links = defaultdict(list), []
    for i, (h, c) in enumerate(bags):
        size = int(c.sum())
        left, candidates = size - int(np.ceil(threshold * size - 1e-9)) + 1, set()
        for k in sorted(range(len(h)), key=lambda k: (spread[int(h[k])], int(h[k]))):
            if left <= 0:
                break
            left -= int(c[k])
            candidates.update(holders[int(h[k])])
            holders[int(h[k])].append(i)
        for j in candidates:
            other = int(bags[j][1].sum())
            if min(size, other) >= threshold * max(size, other) and weighted_jaccard(bags[i], bags[j]) >= threshold:
                links.append((j, i))
    return links


def test_no_link_is_lost_at_sf01(spark):
    """All links of the 10,000 documents, against all pairs: recall 1, and no class that they do not make."""
    sf = SF.replace("sf0.01", "sf0.1")
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    by_words = defaultdict(list)
    for doc_id, text in rows:
        by_words[tuple(words(text))].append(doc_id)
    texts = [(ids, " ".join(w)) for w, ids in by_words.items() if w]
    links = all_links([t for _, t in texts])
    got = {r.doc_id: r.class_id for r in op6_minhash_near_dedup(spark, sf).collect()}
    found = [got[texts[a][0][0]] == got[texts[b][0][0]] for a, b in links]
    assert len(links) > 50 and sum(found) == len(found)
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        root[max(find(a), find(b))] = min(find(a), find(b))
    want = defaultdict(set)
    for i, (ids, _) in enumerate(texts):
        want[find(i)].update(ids)
    have = defaultdict(set)
    for doc_id, class_id in got.items():
        have[class_id].add(doc_id)
    blank = {frozenset([i]) for i in by_words.get((), [])}
    assert {frozenset(v) for v in have.values()} - blank == {frozenset(v) for v in want.values()} - blank
