"""LM scoring: stupid backoff over n-gram count tables partitioned by hash.

S(w | u) is count(u w) / count(u) if the bigram was seen ``min_count`` times or
more, else BACKOFF * count(w) / N; longer orders back off one word at a time. All
counts are over all documents. A document's score is the sum of log S over its
words.

The relations are kept in columns, not in a row per n-gram, which would shuffle
many times the input:

1. Documents are dealt into chunks of bounded size. Each chunk explodes its texts
   into n-grams, counts them (the map-side combine) and sends, to every hash range
   of the count table, one row with the sorted n-gram hashes of that range.
2. A hash range of the count table sums the counts of all chunks and joins the
   totals back to each chunk's n-grams, as an array in the order they were sent.
3. A chunk joins the totals to its exploded n-grams and sums per document.

N itself is the n-gram of order 0. Logarithms are rounded to a millionth and
summed as integers, so scores do not depend on the order of rows.

Defined cases: words are runs of letters, digits and underscores, case ignored;
NULL and empty texts have no words, score 0 and a NULL mean; any length is read
whole; repeated rows count and are scored as often as they occur; n-grams do not
cross documents; an empty table gives an empty result; other columns are ignored.
n-grams are told apart by 64-bit hashes. Rows that repeat both doc_id and text
are in one chunk.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .shingles import mix, word_hashes, words

ORDER = 2
MIN_COUNT = 2
BACKOFF = 0.4
CHUNK_CHARS = 10_000_000    # texts of a chunk, about: the memory of one task
RANGE_WORDS = 1_000_000     # words of the corpus per hash range of the count table
MICRO = 1_000_000
_MUL = np.uint64(0xD6E8FEB86659FD93)


def _grams(texts: list[str | None], order: int):
    """Per order from 1: n-gram hashes of all positions (0 where a document has none ending there), and lengths."""
    hashes = [word_hashes(words(t)) for t in texts]
    lens = np.array([len(h) for h in hashes], dtype=np.int64)
    h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    del hashes
    place = np.arange(len(h)) - np.repeat(np.cumsum(lens) - lens, lens)  # position in its document
    out = []
    for n in range(1, order + 1):
        key = np.full(len(h), np.uint64(n))
        for k in range(n - 1, -1, -1):
            key = key * _MUL + np.roll(h, k)
        key = np.maximum(mix(key), np.uint64(1))
        key[place < n - 1] = 0
        out.append(key)
    return out, lens, place


def _count_table(grams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-gram hashes of a chunk with counts; the first, 0, counts the words."""
    every = np.concatenate([g[g > 0] for g in grams])
    keys, n = np.unique(every, return_counts=True)
    return np.concatenate([np.zeros(1, np.uint64), keys]), np.concatenate([[len(grams[0])], n])


def _score(grams, lens, place, keys, totals, min_count: int, backoff: float) -> np.ndarray:
    """Sum of rounded logarithms per document."""
    n_words = float(totals[0])
    counts = [totals[np.searchsorted(keys, g)].astype(np.float64) for g in grams]
    value = counts[0] / n_words                         # S of the unigram
    shrunk = backoff * counts[0] / n_words              # ... after one backoff
    for n in range(1, len(grams)):
        has = place >= n
        context = np.roll(counts[n - 1], 1)             # the n-gram before the last word ends one word earlier
        seen = has & (counts[n] >= min_count)
        new = np.where(seen, counts[n] / np.where(has, context, 1.0), np.where(has, shrunk, value))
        shrunk = np.where(has, backoff * new, shrunk)
        value = new
    micro = np.rint(np.log(value) * MICRO).astype(np.int64)
    sums = np.concatenate([np.zeros(1, np.int64), np.cumsum(micro)])
    ends = np.cumsum(lens)
    return sums[ends] - sums[ends - lens]


def stupid_backoff(docs: DataFrame, order: int = ORDER, min_count: int = MIN_COUNT, backoff: float = BACKOFF,
                   chunk_chars: int = CHUNK_CHARS, range_words: int = RANGE_WORDS) -> DataFrame:
    """(doc_id, n_words, log_score_micro, mean_log_score), one row per row of ``docs``."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    chars = slim.agg(F.coalesce(F.sum(F.char_length("text")), F.lit(0))).first()[0]
    chunks = max(1, -(-chars // chunk_chars))
    bits = max(0, int(np.ceil(np.log2(max(1, chars / 6 / range_words)))))
    dealt = slim.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int"))

    def count(t: pa.Table) -> pa.Table:
        keys, n = _count_table(_grams(t["text"].to_pylist(), order)[0])
        part = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
        parts, at = np.unique(part, return_index=True)
        ends = np.append(at, len(keys))
        return pa.table({"part": pa.array(parts, pa.int32()),
                         "chunk": pa.array([t["chunk"][0].as_py()] * len(parts), pa.int32()),
                         "grams": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys.view(np.int64))),
                         "n": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(n.astype(np.int32)))})

    def total(t: pa.Table) -> pa.Table:
        grams = t["grams"].combine_chunks()
        grams = grams if isinstance(grams, pa.Array) else pa.concat_arrays(grams.chunks)
        n = np.concatenate([c.flatten().to_numpy() for c in t["n"].chunks])
        lens = np.diff(grams.offsets.to_numpy())
        _, at = np.unique(grams.flatten().to_numpy(), return_inverse=True)
        totals = np.bincount(at, weights=n).astype(np.int64)[at]
        return pa.table({"part": t["part"], "chunk": t["chunk"], "totals": pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(lens)]), pa.int32()), pa.array(totals))})

    def score(t: pa.Table, totals: pa.Table) -> pa.Table:
        grams, lens, place = _grams(t["text"].to_pylist(), order)
        keys, _ = _count_table(grams)
        order_ = np.argsort(totals["part"].to_numpy())
        found = totals["totals"].combine_chunks()
        found = found if isinstance(found, pa.Array) else pa.concat_arrays(found.chunks)
        found = np.concatenate([found[int(i)].values.to_numpy() for i in order_])
        sums = _score(grams, lens, place, keys, found, min_count, backoff)
        return pa.table({"doc_id": t["doc_id"], "n_words": pa.array(lens), "log_score_micro": pa.array(sums)})

    tables = (dealt.groupBy("chunk")
              .applyInArrow(count, "part int, chunk int, grams array<bigint>, n array<int>")
              .groupBy("part").applyInArrow(total, "part int, chunk int, totals array<bigint>"))
    scored = (dealt.groupBy("chunk").cogroup(tables.groupBy("chunk"))
              .applyInArrow(score, "doc_id bigint, n_words bigint, log_score_micro bigint"))
    return scored.withColumn("mean_log_score", F.when(
        F.col("n_words") > 0, F.col("log_score_micro") / F.col("n_words") / F.lit(float(MICRO))))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stupid_backoff(table(spark, sf_dir, "documents"))


OP3_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
                  regexp_extract_all(lower(coalesce(text, '')), '[\p{{L}}\p{{N}}_]+') AS ws FROM documents),
t AS (SELECT rid, unnest(ws) AS w, unnest(range(len(ws))) AS pos FROM d),
p AS (SELECT a.rid, a.pos, a.w, b.w AS u FROM t a LEFT JOIN t b ON b.rid = a.rid AND b.pos = a.pos - 1),
c1 AS (SELECT w, count(*) AS c FROM t GROUP BY w),
c2 AS (SELECT u, w, count(*) AS c FROM p WHERE u IS NOT NULL GROUP BY u, w),
n AS (SELECT count(*)::DOUBLE AS n FROM t),
s AS (SELECT p.rid, CASE WHEN p.u IS NULL THEN cw.c / n.n
                         WHEN c2.c >= {MIN_COUNT} THEN c2.c::DOUBLE / cu.c
                         ELSE {BACKOFF}::DOUBLE * cw.c / n.n END AS v
      FROM p CROSS JOIN n JOIN c1 cw ON cw.w = p.w LEFT JOIN c1 cu ON cu.w = p.u
      LEFT JOIN c2 ON c2.u = p.u AND c2.w = p.w),
z AS (SELECT rid, sum(round(ln(v) * {MICRO})::BIGINT)::BIGINT AS m FROM s GROUP BY rid)
SELECT d.doc_id, len(d.ws)::BIGINT AS n_words, coalesce(z.m, 0)::BIGINT AS log_score_micro,
       CASE WHEN len(d.ws) > 0 THEN z.m::DOUBLE / len(d.ws) / {MICRO}::DOUBLE END AS mean_log_score
FROM d LEFT JOIN z USING (rid)"""
