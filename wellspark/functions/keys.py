"""Reproducible surrogate keys.

There is no sequence in Spark, and ``monotonically_increasing_id`` changes with
the partitioning. A key is instead a hash of the row's natural key folded into
the non-negative BIGINT range, so a re-run produces the same ids.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: upper bound (exclusive) of generated ids, below 2^63.
MAX_BIGINT_KEY = 9_000_000_000_000_000_000


def bounded_key(*cols: Column | str) -> Column:
    """``pmod(xxhash64(cols...), 9e18)`` -- always in [0, 9e18).

    ``xxhash64`` skips NULLs, so every column is preceded by whether it is NULL:
    (600, NULL) and (NULL, 600) get different ids. An id of 63 bits may still
    collide by chance; nothing uses it as a row's identity.
    """
    parts = []
    for c in (F.col(c) if isinstance(c, str) else c for c in cols):
        parts += [c.isNull(), c]
    return F.pmod(F.xxhash64(*parts), F.lit(MAX_BIGINT_KEY))
