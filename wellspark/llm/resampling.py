"""Importance resampling towards a target distribution: hashed n-gram gains, then distributed quickselect.

Every text is a bag of word n-grams, hashed into ``buckets`` buckets. A bucket's
gain is the log ratio of its smoothed share in the target texts to its share in
all documents; a document's weight is the mean gain of its n-grams. Gumbel noise,
drawn from a hash of the document's id, turns the ``k`` highest of weight plus
noise into a sample without replacement in proportion to exp(weight).

The bucket counts are two arrays of ``buckets`` numbers, whatever the corpus: each
task sums its own, Spark adds them up by bucket. The array of gains goes back
to the tasks, which look a document's n-grams up in it. The documents are then rows
of four numbers, staged once. The k-th best of them is found by quickselect: pivots
drawn at random (by hash) among the keys still in question, one aggregate that
counts exactly how many keys lie before and on each pivot, and the interval between
the two pivots around the k-th key for the next round. A key is (score downwards,
doc_id upwards), so repeated scores cannot stop the narrowing. Only the winners are
sorted, by range over all tasks, and numbered.

Defined cases: a NULL or empty text has no n-gram, weight 0, and too few words to
be drawn; texts of any length are read whole; equal scores go to the smaller
doc_id, a NULL doc_id last; rows with the same doc_id draw the same noise and are
documents of their own, equal keys in the order of their weight and n_features; an
empty table gives an empty result, an empty target leaves gains that follow from the
smoothing alone; other columns are ignored.
"""

from __future__ import annotations

import itertools
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ASCII_LOWER, ASCII_UPPER, fingerprint, stage, table

BUCKETS = 10_000
ORDER = 1          # longest n-gram
MIN_WORDS = 20
PERCENT = 10
SEED = 2024
PIVOTS = 16        # drawn in each round of the quickselect
GAIN = 1000        # gains, weights and noise are whole thousandths

# Bytes of words: 0-9, a-z and all of a non-ASCII character; A-Z become a-z, all else separates.
_WORD_BYTES = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32
                    for b in range(256))
_MEMO_KEPT = 500_000  # the memo of a task's n-gram buckets is emptied beyond this


class Hasher:
    """Buckets of all n-grams of a text, as an array, repeats included."""

    def __init__(self, order: int, buckets: int):
        self.order, self.buckets, self.memo = order, buckets, {}

    def __call__(self, text: str | None) -> tuple[int, np.ndarray]:
        """(number of words, bucket of every n-gram)."""
        words = (text or "").encode().translate(_WORD_BYTES).split()
        grams = list(words)
        for n in range(2, self.order + 1):
            grams += [b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)]
        memo = self.memo
        if len(memo) > _MEMO_KEPT:
            memo.clear()
        for g in set(grams).difference(memo):
            memo[g] = zlib.crc32(g) % self.buckets
        return len(words), np.fromiter(map(memo.__getitem__, grams), dtype=np.int64, count=len(grams))


def bucket_counts(texts: DataFrame, order: int = ORDER, buckets: int = BUCKETS) -> np.ndarray:
    """How many n-grams of the whole column ``text`` fall into each bucket: ``buckets`` numbers."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, total = Hasher(order, buckets), np.zeros(buckets, dtype=np.int64)
        for b in batches:
            for text in b.column(0).to_pylist():
                total += np.bincount(hasher(text)[1], minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held], pa.int64())],
                                         names=["bucket", "n"])

    out = np.zeros(buckets, dtype=np.int64)
    each = texts.select(F.col("text").cast("string")).mapInArrow(count, "bucket bigint, n bigint")
    for r in each.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most one row a bucket
        out[r.bucket] = r.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the ratio of the smoothed shares) for every bucket."""
    buckets = len(corpus)
    s_all, t_all = int(corpus.sum()) + buckets, int(target.sum()) + buckets
    return np.array([math.floor(GAIN * math.log(float(t + 1) * s_all / (float(s + 1) * t_all)))
                     for s, t in zip(corpus.tolist(), target.tolist())], dtype=np.int64)


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """floor(1000 * a Gumbel draw), from the first 32 bits of sha256('seed:doc_id'); a NULL doc_id is empty."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-float(GAIN)) * F.ln(-F.ln((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def score_documents(docs: DataFrame, target: DataFrame, order: int = ORDER, buckets: int = BUCKETS,
                    seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every row of ``docs``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    gain = docs.sparkSession.sparkContext.broadcast(
        gains(bucket_counts(docs, order, buckets), bucket_counts(target, order, buckets)))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, of = Hasher(order, buckets), gain.value
        for b in batches:
            rows = []
            for text in b.column("text").to_pylist():
                n_words, found = hasher(text)
                rows.append((n_words, len(found), int(of[found].sum()) // len(found) if len(found) else 0))
            columns = np.array(rows, dtype=np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(c) for c in columns.T)],
                                             names=["doc_id", "n_words", "n_features", "weight"])

    scored = docs.mapInArrow(weigh, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")
    return scored.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))


def _key() -> Column:
    """Ascending keys stand for descending scores; a NULL doc_id follows all others."""
    return F.struct((-F.col("score")).alias("s"), F.col("doc_id").isNull().alias("none"),
                    F.coalesce("doc_id", F.lit(0).cast("long")).alias("id"))


def _literal(key) -> Column:
    return F.struct(F.lit(key.s).cast("long").alias("s"), F.lit(key.none).alias("none"),
                    F.lit(key.id).cast("long").alias("id"))


def kth_key(rows: DataFrame, k: int, pivots: int = PIVOTS):
    """The k-th smallest (from 1) value of the column ``key``, or None if there are fewer.

    A round costs two scans of the narrow staged rows: one draws the pivots, one counts.
    Some ``pivots``-th part of the keys is left after it, so rounds grow with the
    logarithm of the rows.
    """
    low = high = None      # the k-th key lies strictly between these
    below = 0              # rows up to and including ``low``
    for turn in itertools.count():
        inside = rows
        if low is not None:
            inside = inside.filter((F.col("score") <= -low.s) & (F.col("key") > _literal(low)))
        if high is not None:
            inside = inside.filter((F.col("score") >= -high.s) & (F.col("key") < _literal(high)))
        drawn = (inside.withColumn("draw", fingerprint(F.col("key.s"), F.col("key.none"), F.col("key.id"), seed=turn))
                 .orderBy("draw").limit(pivots).select("key.*").collect())  # ``pivots`` rows
        if not drawn:
            return None
        order = sorted(set(drawn))
        sums = [F.count_if(F.col("key") < _literal(p)).alias(f"less{i}") for i, p in enumerate(order)]
        sums += [F.count_if(F.col("key") == _literal(p)).alias(f"same{i}") for i, p in enumerate(order)]
        counts, base = inside.agg(*sums).first(), below
        for i, pivot in enumerate(order):
            before = base + counts[f"less{i}"]
            if k <= before:
                high = pivot
                break
            if k <= before + counts[f"same{i}"]:
                return pivot
            low, below = pivot, before + counts[f"same{i}"]


def rank_rows(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` with ``rank`` (1, 2, 3 ...) in the given order: sorted by range, numbered task by task.

    Rows equal in all of ``order`` are numbered as they come.
    """
    at = F.monotonically_increasing_id()
    placed = (rows.repartitionByRange(*order).sortWithinPartitions(*order)
              .withColumn("__at", at))
    placed = stage(placed.withColumns({"__part": F.shiftright("__at", 33),
                                       "__place": F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))}), "ranked")
    parts = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("n"))  # one row a task of the sort
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(F.col("__part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))
    return (placed.join(F.broadcast(offsets), "__part")
            .withColumn("rank", F.col("__before") + F.col("__place") + 1)
            .drop("__at", "__part", "__place", "__before"))


def resample(docs: DataFrame, target: DataFrame, order: int = ORDER, buckets: int = BUCKETS, seed: int = SEED,
             min_words: int = MIN_WORDS, percent: int = PERCENT, pivots: int = PIVOTS) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of ``docs``; rank is NULL where it is not drawn.

    ``percent`` of the documents with at least ``min_words`` words are drawn.
    """
    scored = score_documents(docs, target, order, buckets, seed)
    eligible = F.col("n_words") >= min_words
    scored = stage(scored.select("doc_id", "n_features", "weight", "score", eligible.alias("eligible")),
                   "resampling-scores").withColumn("key", _key())
    can = scored.filter("eligible")
    k = percent * can.count() // 100
    last = kth_key(can, k, pivots) if k else None
    columns = ["doc_id", "n_features", "weight", "score"]
    none = F.lit(None).cast("long").alias("rank")
    if last is None:
        return scored.select(*columns, none)
    won = F.col("eligible") & (F.col("key") <= _literal(last))
    by = [F.desc("score"), F.asc_nulls_last("doc_id"), F.desc("weight"), F.desc("n_features")]
    ranked = rank_rows(scored.filter(won).select(*columns), by)
    return (ranked.select(*columns, F.when(F.col("rank") <= k, F.col("rank")).alias("rank"))
            .unionByName(scored.filter(~won).select(*columns, none)))


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# crc32 of a text: DuckDB has none, so it is folded byte by byte, a byte in eight shifts.
CRC32_SQL = """(xor(list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(range(0, octet_length(encode({text}))), lambda i: ('0x' || substr(hex(encode({text})), 2*i+1, 2))::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [1::BIGINT, 2, 3, 4, 5, 6, 7, 8]),
        lambda v, step: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384::BIGINT) ELSE v // 2 END)), 4294967295::BIGINT))"""


def crc32_sql(text: str) -> str:
    return CRC32_SQL.format(text=text)


OP11_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  regexp_extract_all(translate(text, '{ASCII_UPPER}', '{ASCII_LOWER}'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS words
           FROM documents),
b AS (SELECT regexp_extract_all(translate(text, '{ASCII_UPPER}', '{ASCII_LOWER}'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS words
      FROM benchmark),
dw AS (SELECT r, unnest(words) AS w FROM d),
bw AS (SELECT unnest(words) AS w FROM b),
vocabulary AS (SELECT w, {crc32_sql("w")} % {BUCKETS} AS bucket
               FROM (SELECT w FROM dw UNION SELECT w FROM bw)),
s AS (SELECT bucket, count(*) AS n FROM dw JOIN vocabulary USING (w) GROUP BY 1),
t AS (SELECT bucket, count(*) AS n FROM bw JOIN vocabulary USING (w) GROUP BY 1),
totals AS (SELECT (SELECT count(*) FROM dw) AS s_all, (SELECT count(*) FROM bw) AS t_all),
g AS (SELECT bucket, floor({GAIN} * ln((coalesce(t.n, 0) + 1)::DOUBLE * (s_all + {BUCKETS})
                                      / ((s.n + 1)::DOUBLE * (t_all + {BUCKETS}))))::BIGINT AS gain
      FROM s LEFT JOIN t USING (bucket) CROSS JOIN totals),
weights AS (SELECT r, count(*) AS n, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
            FROM dw JOIN vocabulary USING (w) JOIN g USING (bucket) GROUP BY r),
scored AS (SELECT r, doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
                  coalesce(weight, 0) + floor(-{GAIN} * ln(-ln(
                      (('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
                      / 4294967296::DOUBLE)))::BIGINT AS score
           FROM d LEFT JOIN weights USING (r)),
drawn AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, weight DESC, n_features DESC) AS place,
                 count(*) OVER () AS n
          FROM scored WHERE n_features >= {MIN_WORDS})
SELECT doc_id, n_features, weight, score, CASE WHEN place <= {PERCENT} * n // 100 THEN place END AS rank
FROM scored LEFT JOIN drawn USING (r)"""
