"""Near duplicates: BagMinHash signatures, banding, exact multiset overlap.

A text is the multiset of its five-word shingles. Every shingle of count c owns a
Poisson process over the weights [0, c), which is laid out in dyadic intervals
[0, 1), [1, 2), [2, 4), ...: each has a process of its own with a rate of its
length, and points above c are thinned out, so that two texts share exactly the
points below the smaller of their counts. A point falls to a random component of
the signature, which keeps the earliest one. Two texts then agree in a component
with a probability of exactly their weighted Jaccard similarity. Points are drawn
in the order of time and a process ends once it is later than every component,
so a long text costs little more than one draw per shingle.

Signatures are cut into bands. Texts that agree in a band are candidates, but
never all pairs of a bucket: every member is compared with the bucket's most
popular text, which of a group of near copies is one of the least altered, and
the exact overlap decides. Linked texts are joined to classes (alternating
large-star and small-star steps), and from then on only members outside the class
of a text are compared with it: with a few more representatives of the bucket,
and whoever is still apart then with all members it can be close to. Three
bounds, none of which loses a link, say which those are: shingles that no other
class has cannot overlap; sizes; and, one minus the weighted Jaccard similarity
being a metric, the distances from the leader. (They must also agree in a second
band.) A large group of near copies thus costs a few comparisons a member.

Equal word sequences are one text from the start; nothing of them is paired. They are
told apart by 128 bits: a 64-bit id, and where other 64 bits disagree under one id, ids of
their own.

The only chance for a link to be missed is in the bands: at a similarity of 0.8
two texts agree in none of 42 bands of 6 with a probability of 3e-6, and a stray
and a member in less than two with 5e-5; both fall steeply above 0.8.

Defined cases: words are runs of letters, digits and underscores, case ignored; a
text of fewer than five words is a single shingle; texts without words (NULL,
empty) are each a class of their own; repeated rows are in one class; a NULL doc_id
is ignored when a class is named (a class of only such rows has a NULL class_id);
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stage, table
from .shingles import GOLDEN, mix, multiset, shingle_hashes, weighted_jaccard, word_hashes, words

SIZE = 5
THRESHOLD = 0.8
BANDS, ROWS = 42, 6
TEXTS_AT_ONCE = 256
KEPT_MULTISETS = 128
REPRESENTATIVES = 4


def _times_golden(k: int) -> np.uint64:
    return np.uint64(k * int(GOLDEN) % 2 ** 64)


def bag_min_hash(texts: list[tuple[np.ndarray, np.ndarray]], m: int) -> np.ndarray:
    """Signatures of multisets (hashes, counts): earliest arrival times, len(texts) x m."""
    sig = np.full((len(texts), m), np.inf)
    flat = sig.reshape(-1)
    owner = np.repeat(np.arange(len(texts)), [len(h) for h, _ in texts])
    x = np.concatenate([h for h, _ in texts]) if texts else np.zeros(0, np.uint64)
    c = np.concatenate([n for _, n in texts]) if texts else np.zeros(0, np.int64)
    # The processes: interval [0, 1), then [2^(j-1), 2^j) for j = 1, 2, ... as far as counts reach.
    seeds, lows, who, count = [mix(x)], [np.zeros(len(x))], [owner], [c]
    low = 1
    while (more := c > low).any():
        seeds.append(mix(x[more] + _times_golden(low)))
        lows.append(np.full(int(more.sum()), float(low)))
        who.append(owner[more])
        count.append(c[more])
        low *= 2
    s, lo, who, c = np.concatenate(seeds), np.concatenate(lows), np.concatenate(who), np.concatenate(count)
    rate = np.maximum(lo, 1.0)
    t = np.zeros(len(s))
    r = 0
    while len(s):
        r += 1
        draw = mix(s + _times_golden(r))
        t = t - np.log(((draw >> np.uint64(12)).astype(np.float64) + 0.5) / 2.0 ** 52) / rate
        draw = mix(draw)
        component = ((draw >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
        level = lo + np.floor((draw & np.uint64(0xFFFFFFFF)).astype(np.float64) / 2.0 ** 32 * rate) * (lo > 0)
        hit = level < c
        np.minimum.at(flat, who[hit] * m + component[hit].astype(np.int64), t[hit])
        live = t < sig.max(axis=1)[who]
        s, lo, rate, who, c, t = s[live], lo[live], rate[live], who[live], c[live], t[live]
    return sig


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band, with the band's number in it."""
    bits = np.ascontiguousarray(sig).view(np.uint64).reshape(len(sig), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(sig), bands))
    for k in range(rows):
        key = mix(key * GOLDEN + bits[:, :, k])
    return key.view(np.int64)


def signatures(docs: DataFrame, size: int = SIZE, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, raw, node, check, n, bands): text hash, two hashes of the word sequence, number of shingles, band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, TEXTS_AT_ONCE):
                part = b.slice(i, TEXTS_AT_ONCE)
                bags, nodes, checks, n = [], [], [], []
                for text in part.column("text").to_pylist():
                    h = word_hashes(words(text))
                    sh = shingle_hashes(h, size)
                    nodes.append(int(mix(_sequence(h)).view(np.int64)[0]) if len(h) else None)
                    checks.append(int(mix(_sequence(mix(h + GOLDEN))).view(np.int64)[0]) if len(h) else None)
                    bags.append(np.unique(sh, return_counts=True))
                    n.append(len(sh))
                keys = band_keys(bag_min_hash(bags, bands * rows), bands, rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("raw"), pa.array(nodes, pa.int64()), pa.array(checks, pa.int64()),
                     pa.array(n, pa.int64()), pa.array([list(k) if m else [] for k, m in zip(keys, n)], pa.list_(pa.int64()))],
                    names=["doc_id", "raw", "node", "check", "n", "bands"])

    return (docs.select("doc_id", raw_key(F.col("text")).alias("raw"), "text")
            .mapInArrow(run, "doc_id bigint, raw bigint, node bigint, check bigint, n bigint, bands array<bigint>"))


def tell_apart(sigs: DataFrame) -> DataFrame:
    """``sigs`` without ``check``, word sequences that share a node but not the check under nodes of their own.

    Of 1e10 texts some three pairs share a node: what is joined is tiny, mostly empty.
    """
    shared = (sigs.filter("node IS NOT NULL").groupBy("node").agg(F.min("check").alias("lo"), F.max("check").alias("hi"))
              .filter("lo <> hi").select(F.col("node").alias("__node"), F.col("lo").alias("__first")))
    shared = stage(shared, "near-shared")
    own = F.xxhash64("node", "check")
    node = F.when(F.col("check") != F.col("__first"), own).otherwise(F.col("node"))
    return (sigs.join(shared, sigs["node"] == shared["__node"], "left").withColumn("node", node)
            .drop("check", "__node", "__first"))


def _sequence(h: np.ndarray) -> np.ndarray:
    """Position-dependent hash of a whole word sequence."""
    at = np.arange(1, len(h) + 1, dtype=np.uint64)
    return np.array([mix(h + mix(at * GOLDEN)).sum(dtype=np.uint64) + np.uint64(len(h))], dtype=np.uint64)


def raw_key(text):
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _overlaps(pairs: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """(a, b, sim) of the pairs (a, b), by the exact multiset overlap of their texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: OrderedDict = OrderedDict()

        def bag(node, text):
            if node not in kept:
                kept[node] = multiset(text, size)
                if len(kept) > KEPT_MULTISETS:
                    kept.popitem(last=False)
            return kept[node]

        for b in batches:
            a_, b_, ta, tb = (b.column(c).to_pylist() for c in ("a", "b", "text_a", "text_b"))
            sims = [weighted_jaccard(bag(m, x), bag(n, y)) for m, x, n, y in zip(a_, ta, b_, tb)]
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(sims, pa.float64())],
                                             names=["a", "b", "sim"])

    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(left, "a").join(right, "b").mapInArrow(run, "a bigint, b bigint, sim double")


def _buckets(nodes: DataFrame) -> DataFrame:
    """(bkey, node, n, pop) of the buckets with more than one text.

    ``pop`` adds up the sizes of a text's buckets: of a group of near copies, the
    least altered ones are in the largest buckets and so the most popular.
    """
    keyed = nodes.select("node", "n", F.explode("bands").alias("bkey"))
    sizes = keyed.groupBy("bkey").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    members = stage(keyed.join(sizes, "bkey"), "near-members")
    popular = members.groupBy("node").agg(F.sum("members").alias("pop"))
    return stage(members.join(popular, "node").select("bkey", "node", "n", "pop"), "near-buckets")


def _relabel(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, root) after more links (a, b): only the roots they connect are joined anew."""
    if labels is None:
        return components(links)
    root = lambda c: labels.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}"))
    between = (links.join(root("a"), "a", "left").join(root("b"), "b", "left")
               .select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b")).filter("a <> b"))
    moved = components(between).withColumnsRenamed({"node": "old", "root": "new"})
    kept = (labels.join(moved, labels["root"] == moved["old"], "left")
            .select("node", F.coalesce("new", "root").alias("root")))
    first = moved.join(labels, moved["old"] == labels["node"], "left_anti").select(F.col("old").alias("node"),
                                                                                 F.col("new").alias("root"))
    return stage(kept.unionByName(first), "near-labels")


def near_labels(nodes: DataFrame, texts_of, size: int = SIZE, threshold: float = THRESHOLD) -> DataFrame:
    """(node, root): texts that are connected by overlaps of ``threshold`` or more have the same root.

    ``nodes`` has node, n and bands; ``texts_of(nodes)`` gives (node, text).
    """
    members = _buckets(nodes)
    texts = stage(texts_of(members.select("node").distinct()), "near-texts")

    # Every member with the most popular text of its bucket.
    leaders = (members.groupBy("bkey").agg(F.max(F.struct("pop", "node")).alias("top"))
               .select("bkey", F.col("top.node").alias("leader")))
    led = stage(members.join(leaders, "bkey"), "near-led")
    first = led.filter("node <> leader").select(F.greatest("node", "leader").alias("a"),
                                                F.least("node", "leader").alias("b")).distinct()
    compared = stage(_overlaps(first, texts, size), "near-compared")
    labels = _relabel(None, compared.filter(F.col("sim") >= threshold).select("a", "b"))
    of_leader = ((F.greatest("node", "leader") == F.col("a")) & (F.least("node", "leader") == F.col("b")))
    led = (led.join(compared, of_leader, "left")
           .select("bkey", "node", "n", F.coalesce("sim", F.lit(1.0)).alias("sim")))
    led = stage(led, "near-distances")

    def open_buckets(of: DataFrame) -> DataFrame:
        """The buckets whose members are not in one class yet, with their classes."""
        placed = of.join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
        mixed = placed.groupBy("bkey").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi")
        return stage(placed.join(mixed.select("bkey"), "bkey"), "near-open")

    def link(pairs: DataFrame) -> None:
        nonlocal compared, labels
        new = stage(_overlaps(pairs.join(compared, ["a", "b"], "left_anti"), texts, size), "near-compared")
        compared = compared.unionByName(new)
        labels = _relabel(labels, new.filter(F.col("sim") >= threshold).select("a", "b"))

    # Only shingles that another class has too can overlap with it: a bound for all that is still apart.
    here = open_buckets(led)
    led = stage(here.drop("root").join(_outside(here, texts, size), "node"), "near-bounded")
    share = F.lit(threshold / (1 + threshold))  # an overlap of `threshold` takes this share of both sizes

    def possible(x: str, y: str):
        enough = F.least(f"out_{x}", f"out_{y}") >= share * (F.col(f"n_{x}") + F.col(f"n_{y}")) - 1e-9
        return enough & (F.least(f"n_{x}", f"n_{y}") >= F.lit(threshold - 1e-9) * F.greatest(f"n_{x}", f"n_{y}"))

    def side(frame: DataFrame, name: str, *more: str) -> DataFrame:
        return frame.select("bkey", F.col("node").alias(name), F.col("n").alias(f"n_{name}"),
                            F.col("sim").alias(f"sim_{name}"), F.col("outside").alias(f"out_{name}"),
                            F.col("root").alias(f"root_{name}"), *more)

    # A few more representatives of each bucket, for the members outside their class.
    here = open_buckets(led)
    draw = Window.partitionBy("bkey").orderBy(F.xxhash64("node"), "node")
    some = here.withColumn("_rn", F.row_number().over(draw)).filter(F.col("_rn") <= REPRESENTATIVES)
    link(side(here, "x").join(side(some, "y"), "bkey").filter((F.col("root_x") != F.col("root_y")) & possible("x", "y"))
         .select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct())

    # Then every member outside its bucket's largest class with all members of other classes that it can
    # be close to. A pair is taken from the first of the buckets it shares, so it comes up once.
    here = open_buckets(led)
    largest = (here.groupBy("bkey", "root").agg(F.count(F.lit(1)).alias("k"))
               .groupBy("bkey").agg(F.max(F.struct("k", "root")).alias("top")).select("bkey", F.col("top.root").alias("main")))
    here = stage(here.join(largest, "bkey").join(nodes.select("node", "bands"), "node"), "near-apart")
    stray = side(here.filter("root <> main"), "x", F.col("bands").alias("bands_x"))
    other = side(here, "y", F.col("bands").alias("bands_y"), (F.col("root") == F.col("main")).alias("in_main"))
    reach = F.abs(F.col("sim_x") - F.col("sim_y")) <= 1 - threshold + 1e-9
    once = F.col("in_main") | (F.col("x") > F.col("y"))
    shared = F.array_intersect("bands_x", "bands_y")
    twice = (F.size(shared) >= 2) & (F.array_min(shared) == F.col("bkey"))
    link(stray.join(other, "bkey")
         .filter((F.col("root_x") != F.col("root_y")) & once & reach & possible("x", "y") & twice)
         .select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct())
    return labels


def _outside(here: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """(node, outside): how many of a text's shingles are found in texts of other classes of ``here``, too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for node, root, text in zip(*(b.column(c).to_pylist() for c in ("node", "root", "text"))):
                h, c = multiset(text, size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(h), node, np.int64)), pa.array(np.full(len(h), root, np.int64)),
                     pa.array(h.view(np.int64)), pa.array(c.astype(np.int64))], names=["node", "root", "sh", "c"])

    rows = stage(here.select("node", "root").distinct().join(texts, "node").select("node", "root", "text")
                 .mapInArrow(run, "node bigint, root bigint, sh bigint, c bigint"), "near-shingles")
    spread = stage(rows.groupBy("sh").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
                   .filter("lo <> hi").select("sh"), "near-spread")
    return rows.join(spread, "sh").groupBy("node").agg(F.sum("c").alias("outside"))


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root): every node of the undirected edges (a, b) with the smallest node it is connected to.

    Alternating large-star and small-star steps; each round is written, the number of rounds is
    logarithmic in the length of the longest chain.
    """
    edges = stage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "star0")
    before = None
    for k in range(1, most_rounds + 1):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = (both.join(low, "a").filter("b > a AND b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")))
        large = large.distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        small = (small.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        edges = stage(small, f"star{k}")
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")


def near_classes(docs: DataFrame, threshold: float = THRESHOLD, size: int = SIZE) -> DataFrame:
    """(doc_id, raw, node, class_id, class_key): one row per row of ``docs``.

    ``class_id`` is the smallest doc_id of the class, ``class_key`` names it even without one.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sigs = tell_apart(stage(signatures(slim, size), "near-signatures"))
    nodes = stage(sigs.filter("node IS NOT NULL").groupBy("node")
                  .agg(F.min("raw").alias("raw"), F.first("n").alias("n"), F.first("bands").alias("bands")), "near-nodes")

    def texts_of(some: DataFrame) -> DataFrame:
        needed = nodes.select("node", "raw").join(some, "node")
        keyed = slim.select(raw_key(F.col("text")).alias("raw"), "text")
        return keyed.join(needed, "raw").dropDuplicates(["node"]).select("node", "text")

    roots = near_labels(nodes, texts_of, size, threshold)
    placed = sigs.select("doc_id", "raw", "node").join(roots, "node", "left")
    placed = placed.select("doc_id", "raw", "node", F.coalesce("root", "node").alias("class_key"))
    placed = stage(placed, "near-placed")
    names = placed.filter("class_key IS NOT NULL").groupBy("class_key").agg(F.min("doc_id").alias("class_id"))
    names = stage(names, "near-names")  # between two plain exchanges a large class can be split
    return (placed.join(names, "class_key", "left")
            .select("doc_id", "raw", "node", "class_key",
                    F.when(F.col("class_key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id")))


def keep_one_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each class of near duplicates: the smallest doc_id's (texts without words all stay)."""
    classes = near_classes(docs, threshold)
    kept = (classes.filter("class_key IS NOT NULL").groupBy("class_key")
            .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "raw")).alias("k"))
            .select(F.col("k.doc_id").alias("__id"), F.col("k.raw").alias("__kept")).distinct())
    blank = classes.filter("node IS NULL").select(F.col("doc_id").alias("__id"), F.col("raw").alias("__kept")).distinct()
    keyed = docs.withColumn("__raw", raw_key(F.col("text").cast("string")))
    same = (F.col("__raw") == F.col("__kept")) & F.col("doc_id").cast("long").eqNullSafe(F.col("__id"))
    one = keyed.join(kept, same).dropDuplicates(["__raw", "__id"])
    return one.select(*docs.columns).unionByName(keyed.join(blank, same, "left_semi").select(*docs.columns))


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id")
