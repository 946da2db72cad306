"""A training corpus from raw documents: filter, clean, deduplicate, decontaminate, mix.

Every stage is a function (spark, docs, sf_dir) -> DataFrame that applies one
operator of ``wellspark.llm`` with its production parameters to all that the
stage before it kept. Between stages the documents are written as Parquet to the
shared folder of ``spark.checkpoint.dir`` and read back, so a lost executor costs
no more than the stage it was lost in. All stages but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wellspark.llm.common import scratch, stage, table
from wellspark.llm.decontaminate import drop_contaminated
from wellspark.llm.line_dedup import drop_frequent_lines
from wellspark.llm.mixing import mix_documents
from wellspark.llm.near_dedup import keep_one_of_each
from wellspark.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"), threshold=0.5)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in 10 documents or more go, n_chars follows the text."""
    return drop_frequent_lines(docs, min_docs=10, min_chars=1)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    return keep_one_of_each(docs, threshold=0.8)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"), threshold=0.8)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with how often the mix takes it (``copies``, 0 for not at all)."""
    return mix_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

# The stages fit models, draw hashes and join classes: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the whole ``documents`` table.

    The result is a manifest: every document left is one row, to be taken ``copies``
    times. ``copies`` = 0 means that the mix leaves the document out; whoever ignores
    the column has an unmixed corpus.
    """
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        with scratch(spark):  # an operator's own tables go as soon as its documents are written
            docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}", keep=True)
    return docs
