"""Quality classifier: nearest-neighbour voting among labelled latent-semantic vectors.

A document's terms are counted in four families: hashed byte trigrams; trigrams of
character classes (lower and upper case, digits, blanks, line ends, marks, non-ASCII); and,
for its words and for its lines, how far back each was last seen (in powers of two).
Every family is a distribution, whatever the text's length; its square roots, weighted by
inverse document frequency, are projected on the leading singular directions of a bounded
labelled sample (latent semantic analysis). Nothing but these latent vectors is compared. The
sample's vectors and labels are broadcast; their number is a parameter, so their size is
fixed. Every document's cosine with every labelled vector is computed exactly, block by
block, and its score is the vote of the nearest ones, weighted by similarity.

Defined cases: a NULL or empty text has the zero vector and gets the share of good
labels in the sample; any length is read whole; repeated rows score alike; without
usable labels every document scores 0.5; an empty table gives an empty result;
a column already named like the score is replaced, other extra columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table
from .labelled import held_out, training_sample

FOLDS, HELD = 4, 2
SAMPLE_ROWS = 4_000   # labelled vectors that are broadcast
BUCKETS = 1_024       # hashed byte trigrams
DIMENSIONS = 48       # latent directions
NEIGHBOURS = 25
SHARPNESS = 8.0       # a neighbour votes with similarity to this power
BLOCK = 256           # documents per cosine product

LOWER, UPPER, DIGIT, BLANK, LINE, MARK, OTHER = range(7)
CLASSES = OTHER + 1
_CLASS = np.array([LINE if b in (10, 13) else BLANK if b <= 32 else OTHER if b >= 128 else DIGIT if 48 <= b <= 57
                   else UPPER if 65 <= b <= 90 else LOWER if 97 <= b <= 122 else MARK for b in range(256)], dtype=np.int64)
WORD_GAPS, LINE_GAPS = 14, 8   # new, 1, 2-3, 4-7 ... words or lines back; the last one is all beyond
FAMILIES = (BUCKETS, CLASSES ** 3, WORD_GAPS, LINE_GAPS)
WIDTH = sum(FAMILIES)


def gaps(items: list[str], bins: int) -> np.ndarray:
    """How many items are new, and how many were last seen 1, 2-3, 4-7 ... items back."""
    last: dict[str, int] = {}
    out = [0] * bins
    for i, item in enumerate(items):
        back = i - last.get(item, i)
        out[min(bins - 1, back.bit_length())] += 1
        last[item] = i
    return np.array(out, dtype=np.float64)


def families(text: str | None) -> list[np.ndarray]:
    """Term counts of one text, family by family."""
    text = text or ""
    raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    if not len(raw):
        return [np.zeros(n) for n in FAMILIES]
    wide, classes = raw.astype(np.uint32), _CLASS[raw]
    code = wide[:-2] * np.uint32(0x9E3779B1) + wide[1:-1] * np.uint32(0x85EBCA6B) + wide[2:] * np.uint32(0xC2B2AE35)
    code ^= code >> np.uint32(15)
    runs = (classes[:-2] * CLASSES + classes[1:-1]) * CLASSES + classes[2:]
    return [np.bincount(code % BUCKETS, minlength=BUCKETS), np.bincount(runs, minlength=CLASSES ** 3),
            gaps(text.split(), WORD_GAPS), gaps(text.split("\n"), LINE_GAPS)]


def features(texts: list[str | None]) -> np.ndarray:
    """Rows of term frequencies: the square roots of every family's shares."""
    out = np.zeros((len(texts), WIDTH), dtype=np.float32)
    for i, text in enumerate(texts):
        out[i] = np.concatenate([np.sqrt(f / max(1.0, f.sum())) for f in families(text)])
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, size, out=np.zeros_like(x), where=size > 1e-12)


@dataclass
class NeighbourModel:
    idf: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def embed(self, x: np.ndarray) -> np.ndarray:
        return _unit((x * self.idf) @ self.directions)

    def score(self, texts: list[str | None]) -> np.ndarray:
        out = np.full(len(texts), self.prior)
        k = min(NEIGHBOURS, len(self.labels))
        for i in range(0, len(texts) if k else 0, BLOCK):
            z = self.embed(features(texts[i:i + BLOCK]))
            cosine = z @ self.vectors.T
            near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 0.0).astype(np.float64) ** SHARPNESS
            total = weight.sum(axis=1)
            vote = (weight * self.labels[near]).sum(axis=1)
            out[i:i + BLOCK] = np.where(total > 0, vote / np.where(total > 0, total, 1.0), self.prior)
        return np.clip(out, 0.0, 1.0)


def fit_neighbours(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS,
                   dimensions: int = DIMENSIONS) -> NeighbourModel:
    sample = training_sample(docs, labels, "quality", FOLDS, HELD, rows)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = features(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in x], pa.binary()), b.column("label")],
                                             names=["x", "label"])

    got = sample.mapInArrow(measure, "x binary, label int").collect()  # the sample: 6 KB a row
    x = np.array([np.frombuffer(r.x, dtype=np.float32) for r in got], dtype=np.float32).reshape(-1, WIDTH)
    y = np.array([r.label for r in got], dtype=np.float64)
    idf = (np.log((1 + len(x)) / (1 + (x > 0).sum(axis=0))) + 1).astype(np.float32)
    if not len(x):
        return NeighbourModel(idf, np.zeros((WIDTH, 1), np.float32), np.zeros((0, 1), np.float32), y, 0.5)
    weighted = (x * idf).astype(np.float64)
    _, vectors = np.linalg.eigh(weighted.T @ weighted)
    directions = np.ascontiguousarray(vectors[:, ::-1][:, :dimensions]).astype(np.float32)
    model = NeighbourModel(idf, directions, np.zeros((0, dimensions), np.float32), y, float(y.mean()))
    model.vectors = model.embed(x)
    return model


def score_quality(docs: DataFrame, model: NeighbourModel, out: str = "quality_score") -> DataFrame:
    """All rows and columns of ``docs`` plus the score, a double from 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # SAMPLE_ROWS x DIMENSIONS numbers, about 1 MB
    docs = docs.drop(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score = shared.value.score(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(score, pa.float64())], names=[*b.schema.names, out])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())]))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_neighbours(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs, model).select(
        "doc_id", held_out(F.col("doc_id"), FOLDS, HELD).alias("held_out"), F.col("quality_score").alias("score"),
        (F.col("quality_score") >= 0.7).cast("int").alias("predicted"))
