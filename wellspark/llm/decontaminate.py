"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, exact check.

A document is contaminated by a benchmark item if one of its windows, as many
words long as the item, has a weighted five-word-shingle similarity of 0.8 or
more with it.

Windows: a document's shingle that is one of an item's is a match of that item's
length. Moving a window to the right, up to its first match (or the document's
end), only lets go of shingles that no item of that length has, so one of the
best windows starts at a match; such a window is laid at every match. A window
with s shingles and an item with r have a similarity of t or more only with
t / (1 + t) * (s + r) matches in the window; windows with fewer are never made,
which loses none, wherever in the window the item's parts have gone. In the
documents that are left, windows are also laid so that a match falls on its own
place in the item: of equally similar windows the first one is reported. Windows
of equal words, in however many documents, are fingerprinted once.

Search: window and item get a 64-bit SimHash of their shingles. The fingerprints
are cut into RADIUS + 1 blocks; two of them within RADIUS bits agree in at least
one whole block, so the join on (size, block number, block value) finds all of
them. Two texts with a similarity of 0.8 are 9.7 bits apart on average (standard
deviation 2.9); the radius of 23 is 4.6 deviations away.

Verification: the weighted Jaccard similarity of the shingle multisets, exact.

DataFrame and SQL functions only.

Defined cases: words are runs of letters, digits and underscores, case ignored;
NULL or empty texts and items without words match nothing; an item of fewer than
five words is one shingle; a document shorter than an item is itself the window;
rows that share doc_id and text give one result; a NULL doc_id is reported as
NULL; equal items are each reported; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fingerprint, stage, table

SIZE = 5
THRESHOLD = 0.8
BITS = 64
RADIUS = 23
BROADCAST_NUMBERS = 2_000_000   # 16 MB of numbers, those in arrays counted; beyond it both sides are shuffled
WORDS = r"[\p{L}\p{N}_]+"


def word_hashes(text: Column) -> Column:
    found = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORDS), F.lit(0))
    return F.transform(found, lambda w: F.xxhash64(w))


def _shingle(h: Column, at: Column, k: int) -> Column:
    return F.xxhash64(F.lit(k), *[F.get(h, at + j) for j in range(k)])


def _shingles(h: Column, k: int) -> Column:
    """Shingle hashes of a word-hash array with at least one word."""
    return F.transform(F.sequence(F.lit(0), F.greatest(F.size(h) - k, F.lit(0))), lambda i: _shingle(h, i, k))


def _counted(frame: DataFrame, key: str) -> DataFrame:
    """(key, sh, c): every shingle of a text with its count."""
    return frame.select(key, F.explode("shingles").alias("sh")).groupBy(key, "sh").agg(F.count(F.lit(1)).alias("c"))


def simhash(counted: DataFrame, key: str) -> DataFrame:
    """(key, simhash, weight): the sign of every bit's weighted vote, as a 64-bit integer."""
    votes = [F.sum(F.when(F.shiftright("sh", b).bitwiseAND(F.lit(1)) == 1, F.col("c")).otherwise(-F.col("c")))
             .alias(f"b{b}") for b in range(BITS)]
    summed = counted.groupBy(key).agg(*votes, F.sum("c").alias("weight"))
    # Four 16-bit pieces, then one number: 64 nested ORs would make one very deep expression.
    pieces = []
    for q in range(4):
        piece = F.lit(0).cast("long")
        for b in range(16):
            piece = piece + F.when(F.col(f"b{16 * q + b}") > 0, F.lit(1 << b).cast("long")).otherwise(0)
        pieces.append(piece.alias(f"p{q}"))
    summed = summed.select(key, "weight", *pieces)
    whole = F.col("p0")
    for q in range(1, 4):
        whole = whole.bitwiseOR(F.shiftleft(f"p{q}", 16 * q))
    return summed.select(key, "weight", whole.alias("simhash"))


def blocks(simhash_: Column, radius: int = RADIUS) -> Column:
    """array<struct<no, value>>: the radius + 1 blocks that the multi-index joins on."""
    n, at, out = radius + 1, 0, []
    for no in range(n):
        width = BITS // n + (1 if no < BITS % n else 0)
        value = F.shiftrightunsigned(simhash_, at).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
        out.append(F.struct(F.lit(no).alias("no"), value.alias("value")))
        at += width
    return F.array(*out)


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD,
                 radius: int = RADIUS) -> DataFrame:
    """(key, doc_id, item_id, start, n_words, hamming, similarity): the best window for each document and item.

    ``key`` is the fingerprint of doc_id and text (``document_key``).
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), word_hashes(F.col("text")).alias("h"))
    items = (items.filter(F.size("h") > 0).distinct()
             .withColumns({"n": F.size("h"), "iid": fingerprint(F.col("item_id"), F.xxhash64("h"))}))
    items = stage(items, "items")
    slim = docs.select(document_key(docs).alias("key"), F.col("doc_id").cast("long").alias("doc_id"),
                       word_hashes(F.col("text")).alias("h"))
    lengths = [r.k for r in items.select(F.least("n", F.lit(SIZE)).alias("k")).distinct().collect()]  # at most SIZE
    empty = docs.sparkSession.createDataFrame([], "key bigint, doc_id bigint, item_id bigint, start int, n_words int, "
                                                  "hamming int, similarity double")
    out = empty
    for k in lengths:
        out = out.unionByName(_with_shingles_of(slim, items.filter(F.least("n", F.lit(SIZE)) == k), k, threshold, radius))
    return out


def document_key(docs: DataFrame) -> Column:
    return fingerprint(F.col("doc_id"), F.col("text"))


def _starts(found: DataFrame, k: int, threshold: float) -> DataFrame:
    """(key, n, starts): where to lay windows of n words, from a document's sorted matches ``pos`` and ``aligned``."""
    last = F.greatest(F.col("size") - F.col("n"), F.lit(0))
    in_window = F.greatest(F.least("n", "size") - k, F.lit(0)) + 1
    need = F.ceil(F.lit(threshold / (1 + threshold)) * (in_window + F.col("n") - k + 1) - 1e-9)
    found = found.withColumns({"last": last, "in_window": in_window,
                               "need": F.greatest(need, F.lit(1)).cast("int")})
    # The need-th match from a start on lies in the window. Past ``last`` the first match counts for all.
    start = lambda p: F.least(p, F.col("last"))
    enough = lambda p, i: F.get("pos", i + F.col("need") - 1) < start(p) + F.col("in_window")
    at_match = F.transform(F.filter("pos", enough), start)
    aligned = F.transform("aligned", lambda a: F.greatest(F.lit(0), start(a)))
    return (found.withColumn("at_match", at_match).filter(F.size("at_match") > 0)
            .select("key", "n", F.array_union("at_match", aligned).alias("starts")))


def _broadcast_if_small(df: DataFrame, numbers: Column) -> DataFrame:
    """``df``, a staged table, marked for broadcast if all its rows together hold few enough ``numbers``."""
    return F.broadcast(df) if (df.agg(F.sum(numbers)).first()[0] or 0) <= BROADCAST_NUMBERS else df


def _with_shingles_of(slim: DataFrame, items: DataFrame, k: int, threshold: float, radius: int) -> DataFrame:
    items = items.withColumn("shingles", _shingles(F.col("h"), k))
    laid = (items.select("n", F.posexplode("shingles").alias("at", "sh"))
            .groupBy("sh").agg(F.collect_set(F.struct("at", "n")).alias("places")))
    laid = stage(laid, "item-shingles")
    laid = _broadcast_if_small(laid, 2 + 2 * F.size("places"))
    words_ = slim.filter(F.size("h") > 0).select("key", "h", F.posexplode("h").alias("pos", "__w"))
    at_word = words_.filter(F.col("pos") <= F.greatest(F.size("h") - k, F.lit(0))) \
        .select("key", F.size("h").alias("size"), "pos", _shingle(F.col("h"), F.col("pos"), k).alias("sh"))
    found = (at_word.join(laid, "sh").select("key", "size", "pos", F.explode("places").alias("place"))
             .groupBy("key", "size", F.col("place.n").alias("n"))
             .agg(F.array_sort(F.collect_set("pos")).alias("pos"),
                  F.collect_set(F.col("pos") - F.col("place.at")).alias("aligned")))
    starts = stage(_starts(found, k, threshold), "window-starts")
    # A document has one row here for each length of item, so its words meet few rows.
    windows = (slim.join(_broadcast_if_small(starts, 8 + F.size("starts")), "key")
               .select("key", "doc_id", "n", "h", F.explode("starts").alias("start"))
               .select("key", "doc_id", "n", "start", F.slice("h", F.col("start") + 1, F.col("n")).alias("win")).distinct())
    wid = [F.xxhash64(F.lit(1), "n", "win").alias("w1"), F.xxhash64(F.lit(2), "n", "win").alias("w2")]
    windows = stage(windows.select("key", "doc_id", "n", "start", "win", F.struct(*wid).alias("wid")), "windows")

    bags = windows.select("wid", "n", "win").distinct().withColumn("shingles", _shingles(F.col("win"), k))
    bags = stage(bags.select("wid", "n", "shingles"), "window-shingles")
    win_counts, item_counts = _counted(bags, "wid"), _counted(items, "iid")
    prints = simhash(win_counts, "wid").join(bags.select("wid", "n"), "wid")
    item_prints = simhash(item_counts, "iid").join(items.select("iid", "item_id", "n"), "iid")
    keyed = lambda f, *cols: f.select(*cols, "n", F.explode(blocks(F.col("simhash"), radius)).alias("b")) \
        .select(*cols, "n", "b.no", "b.value")
    left = keyed(prints.withColumnsRenamed({"simhash": "simhash_w", "weight": "weight_w"})
                 .withColumn("simhash", F.col("simhash_w")), "wid", "simhash_w", "weight_w")
    right = keyed(item_prints.withColumnsRenamed({"simhash": "simhash_i", "weight": "weight_i"})
                  .withColumn("simhash", F.col("simhash_i")), "iid", "item_id", "simhash_i", "weight_i")
    hamming = F.bit_count(F.col("simhash_w").bitwiseXOR(F.col("simhash_i")))
    near = (left.join(right, ["n", "no", "value"]).withColumn("hamming", hamming).filter(F.col("hamming") <= radius)
            .select("wid", "iid", "item_id", "weight_w", "weight_i", "hamming").distinct())
    near = stage(near, "window-candidates")

    common = (near.join(win_counts, "wid").join(item_counts.withColumnRenamed("c", "ci"), ["iid", "sh"])
              .groupBy("wid", "iid", "item_id", "weight_w", "weight_i", "hamming")
              .agg(F.sum(F.least("c", "ci")).alias("common")))
    similar = common.withColumn("similarity", F.col("common") / (F.col("weight_w") + F.col("weight_i") - F.col("common")))
    similar = stage(similar.filter(F.col("similarity") >= threshold)
                    .select("wid", "item_id", "hamming", "similarity"), "window-hits")
    best = F.max_by(F.struct("start", "n", "hamming", "similarity"), F.struct("similarity", -F.col("start")))
    return (windows.select("key", "doc_id", "n", "start", "wid").join(similar, "wid")
            .groupBy("key", "doc_id", "item_id").agg(best.alias("m"))
            .select("key", "doc_id", "item_id", "m.start", F.col("m.n").alias("n_words"), "m.hamming", "m.similarity"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item."""
    hits = contaminated(docs, benchmark, threshold).select(F.col("key").alias("__key")).distinct()
    return docs.withColumn("__key", document_key(docs)).join(hits, "__key", "left_anti").select(*docs.columns)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return hits.select("doc_id", "item_id", "start", "n_words", "hamming", "similarity")
