"""Small frames for the training-data operators."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SF = "/root/testdata/sf0.01"


def documents(spark, rows, **extra):
    """rows: (doc_id, text[, source]); extra columns are constant."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
    df = spark.createDataFrame(full, SCHEMA)
    return df.withColumns({k: F.lit(v) for k, v in extra.items()}) if extra else df


def prose(n, seed=0, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))
