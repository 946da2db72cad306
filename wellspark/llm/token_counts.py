"""Token counts: rollups maintained by signed deltas.

The totals by source, language and tokenizer version are additive: an insert
adds a document's counts, a delete takes them away, and a revision is both. A
batch of changes is summed up to one signed row per key and committed under its
batch id; a batch that is committed already is not applied again, so a job can be
rerun from any point. The totals are the sum of the committed batches; compaction
folds them into one base that remembers which batches it holds.

Counting runs next to the data, in Arrow batches, with public tokenizer files
whose folder is a parameter; only one small row per document and tokenizer leaves a task.
A tokenizer's version is its name and the digest of the file that it was read from
(``name@1a2b3c4d5e6f``): a file that changes under its name is another version, and its
counts never mix with the old ones.

Defined cases: a NULL or empty text has 0 tokens; NULL source or language is a
key of its own; repeated rows count as often as they occur; an empty batch
commits and changes nothing; a key whose documents are all deleted stays out of
the totals; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import CODEC, stage, table

TOKENIZER_DIR = "/opt/tokenizers"
TOKENIZERS = ("byte_bpe_50k", "byte_bpe_multi_50k")
KEYS = ["source", "lang", "tokenizer"]
SUMS = ["docs", "tokens", "chars"]
DELTAS = "source string, lang string, tokenizer string, docs bigint, tokens bigint, chars bigint"

_LOADED: dict = {}


def load_tokenizer(name: str, folder: str = TOKENIZER_DIR):
    """(version, a function from a text to its number of tokens); loaded once per Python worker."""
    key = (name, folder)
    if key not in _LOADED:
        import tiktoken
        from public_tokenizers import PATTERN
        with open(os.path.join(folder, f"{name}.tiktoken"), "rb") as f:
            content = f.read()
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())}
        enc = tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        version = f"{name}@{hashlib.sha256(content).hexdigest()[:12]}"
        _LOADED[key] = version, lambda text: len(enc.encode_ordinary(text))
    return _LOADED[key]


def count_tokens(docs: DataFrame, tokenizers: tuple[str, ...] = TOKENIZERS,
                 folder: str = TOKENIZER_DIR) -> DataFrame:
    """(doc_id, source, lang, tokenizer, docs, tokens, chars): one row per document and tokenizer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or "" for t in b.column("text").to_pylist()]
            for name in tokenizers:
                version, count = load_tokenizer(name, folder)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), b.column("source"), b.column("lang"),
                     pa.array([version] * len(texts), pa.string()), pa.array([1] * len(texts), pa.int64()),
                     pa.array([count(t) for t in texts], pa.int64()),
                     pa.array([len(t) for t in texts], pa.int64())],
                    names=["doc_id", *KEYS, *SUMS])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, f"doc_id bigint, {DELTAS}")


def signed(counts: DataFrame, sign: int) -> DataFrame:
    return counts.select(*KEYS, *[(F.col(c) * F.lit(sign)).alias(c) for c in SUMS])


class TokenRollup:
    """The committed batches under one shared folder: ``batch-<id>`` and ``base-<n>`` folders of signed sums."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        return path, path(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _committed(self, prefix: str) -> list[str]:
        path, fs = self._fs()
        if not fs.exists(path(self.root)):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path(self.root))]
        return sorted(n for n in names if n.startswith(prefix) and fs.exists(path(f"{self.root}/{n}/_SUCCESS")))

    def _base(self) -> tuple[str | None, set[str]]:
        """The newest base and the batches that it holds."""
        bases = self._committed("base-")
        if not bases:
            return None, set()
        newest = max(bases, key=lambda n: int(n[5:]))
        held = self.spark.read.schema("batch string").parquet(f"{self.root}/held-{newest[5:]}")
        return newest, {r.batch for r in held.collect()}  # one row per batch since the beginning

    def committed(self, batch_id: str) -> bool:
        return f"batch-{batch_id}" in self._committed("batch-") or batch_id in self._base()[1]

    def apply(self, batch_id: str, inserted: DataFrame | None = None, deleted: DataFrame | None = None) -> bool:
        """Commit one batch of counted documents; False if it is committed already.

        A revised document is in ``deleted`` with its old counts and in ``inserted`` with its new ones.
        """
        if not re.fullmatch(r"[A-Za-z0-9_.-]+", batch_id):
            raise ValueError(f"a batch id is a file name: {batch_id!r}")
        if self.committed(batch_id):
            return False
        changes = self.spark.createDataFrame([], DELTAS)
        for counts, sign in ((inserted, 1), (deleted, -1)):
            if counts is not None:
                changes = changes.unionByName(signed(counts, sign))
        self._sums(changes).write.mode("overwrite").option("compression", CODEC).parquet(f"{self.root}/batch-{batch_id}")
        return True

    @staticmethod
    def _sums(deltas: DataFrame) -> DataFrame:
        return deltas.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS])

    def _deltas(self) -> tuple[DataFrame, list[str]]:
        base, held = self._base()
        fresh = [n for n in self._committed("batch-") if n[6:] not in held]
        folders = ([base] if base else []) + fresh
        if not folders:
            return self.spark.createDataFrame([], DELTAS), []
        return (self.spark.read.schema(DELTAS).parquet(*[f"{self.root}/{n}" for n in folders]),
                sorted(held | {n[6:] for n in fresh}))

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, docs, tokens, chars) over all committed batches."""
        return self._sums(self._deltas()[0]).filter("docs <> 0 OR tokens <> 0 OR chars <> 0")

    def compact(self) -> None:
        """Fold all committed batches into a new base; the old folders are removed once it is there."""
        deltas, batches = self._deltas()
        old = self._committed("base-")
        n = max((int(b[5:]) for b in old), default=-1) + 1
        self.spark.createDataFrame([(b,) for b in batches], "batch string").coalesce(1) \
            .write.mode("overwrite").option("compression", CODEC).parquet(f"{self.root}/held-{n}")
        self._sums(deltas).write.mode("overwrite").option("compression", CODEC).parquet(f"{self.root}/base-{n}")
        path, fs = self._fs()
        for name in [*old, *[f"held-{b[5:]}" for b in old], *[f"batch-{b}" for b in batches]]:
            fs.delete(path(f"{self.root}/{name}"), True)


def op8_token_counts(spark: SparkSession, sf_dir: str, batches: int = 4) -> DataFrame:
    """All documents through all kinds of change, by two tokenizers; the totals are those of the table.

    The documents arrive in batches, before their source is known. Each batch is then
    revised: its counts without a source are deleted, those with it inserted. Every batch
    id comes twice and counts once. One batch is withdrawn and restored; the rollup is
    compacted in between.
    """
    counts = stage(count_tokens(table(spark, sf_dir, "documents")), "token-counts")
    unknown = counts.withColumn("source", F.lit(None).cast("string"))
    rollup = TokenRollup(spark, scratch_path(spark, "token-rollup"))

    def part(of: DataFrame, b: int) -> DataFrame:
        return of.filter(F.pmod(F.xxhash64("doc_id"), F.lit(batches)) == b)

    for b in range(batches):
        for _ in range(2):
            rollup.apply(f"arrived-{b:04d}", inserted=part(unknown, b))
    rollup.compact()
    for b in range(batches):
        for _ in range(2):
            rollup.apply(f"revised-{b:04d}", inserted=part(counts, b), deleted=part(unknown, b))
    rollup.apply("withdrawn", deleted=part(counts, 0))
    rollup.compact()
    rollup.apply("restored", inserted=part(counts, 0))
    return rollup.totals()
