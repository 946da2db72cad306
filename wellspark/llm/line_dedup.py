"""Line dedup: levelled sorted runs of line hashes.

A line's identity is its stripped, ASCII-lower-cased text; a 128-bit hash of it
stands for the line. The documents arrive in batches. The runs hold, sorted by
hash, in how many documents each line was seen; a new batch is merge-anti-joined
with the lines the runs already know to be frequent (those need no more
counting), the rest is counted and added as a run of its own, and whenever a
level holds ``fanout`` runs they are merged into one run of the next level.
Lines found in ``min_docs`` documents or more then lose all their occurrences.

Only hashes are shuffled for counting (a few dozen bytes a line); the texts move
once, to meet the positions of their dropped lines.

Defined cases: a NULL or empty text is one empty line; lines whose key has fewer
than ``min_chars`` code points are never dropped; rows that repeat both doc_id
and text are one document and all get the same answer; rows that share a doc_id
but not the text are different documents; an empty table gives an empty result;
extra columns pass through untouched.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ASCII_LOWER, ASCII_UPPER, CODEC, WHITE, ascii_lower, fingerprint, scratch_folder, stage, table


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_keys(text: Column) -> Column:
    """The comparison key of every line, in order."""
    lines = split_lines(ascii_lower(F.coalesce(text, F.lit(""))))
    return F.transform(lines, lambda x: F.btrim(x, F.lit(WHITE)))


class LineRuns:
    """Levelled sorted runs of (h1, h2, docs) under one shared folder.

    A run is a folder ``L<level>_<first>_<last>``: it covers the batches first
    to last. A merged run covers the runs it was made from, so after a crash in
    the middle of a compaction either the old runs or the new one count, never
    both. ``docs`` is additive: a line's count is the sum over the live runs.
    """

    SCHEMA = "h1 bigint, h2 bigint, docs bigint"

    def __init__(self, spark: SparkSession, root: str, fanout: int = 3):
        if fanout < 2:
            raise ValueError("fanout must be 2 or more")
        self.spark, self.root, self.fanout = spark, root.rstrip("/"), fanout

    def _fs(self):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        return jvm, path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def live(self) -> list[tuple[int, int, int]]:
        """(level, first, last) of the committed runs that no other run covers."""
        jvm, fs, path = self._fs()
        if not fs.exists(path):
            return []
        runs = []
        for status in fs.listStatus(path):
            m = re.fullmatch(r"L(\d+)_(\d+)_(\d+)", status.getPath().getName())
            if m and fs.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
                runs.append(tuple(int(x) for x in m.groups()))
        return sorted(r for r in runs
                      if not any(o[0] > r[0] and o[1] <= r[1] and r[2] <= o[2] for o in runs))

    def _read(self, run: tuple[int, int, int]) -> DataFrame:
        return self.spark.read.schema(self.SCHEMA).parquet(f"{self.root}/L{run[0]}_{run[1]}_{run[2]}")

    def _write(self, counts: DataFrame, run: tuple[int, int, int]) -> None:
        (counts.select("h1", "h2", "docs").sortWithinPartitions("h1", "h2")
         .write.mode("overwrite").option("compression", CODEC).parquet(f"{self.root}/L{run[0]}_{run[1]}_{run[2]}"))

    def _merged(self, runs: list[tuple[int, int, int]]) -> DataFrame:
        out = self.spark.createDataFrame([], self.SCHEMA)
        for k, run in enumerate(runs):
            out = self._read(run) if k == 0 else out.unionByName(self._read(run))
        return out.groupBy("h1", "h2").agg(F.sum("docs").alias("docs"))

    def counts(self) -> DataFrame:
        """(h1, h2, docs): each line once, over all live runs."""
        return self._merged(self.live())

    def frequent(self, min_docs: int) -> DataFrame:
        return self.counts().filter(F.col("docs") >= min_docs).select("h1", "h2")

    def add(self, lines: DataFrame, min_docs: int) -> None:
        """Add one batch of (d1, d2, h1, h2) rows; documents of a batch are not in any other.

        Lines the runs already hold in ``min_docs`` documents are anti-joined
        away: their fate is settled.
        """
        runs = self.live()
        counts = (lines.select("d1", "d2", "h1", "h2").distinct()
                  .groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("docs")))
        if runs:  # counted first: a hot line meets the runs as one row
            counts = counts.join(self.frequent(min_docs), ["h1", "h2"], "left_anti")
        seq = max((r[2] for r in runs), default=-1) + 1
        self._write(counts, (0, seq, seq))
        self.compact()

    def compact(self) -> None:
        """Merge levels that hold ``fanout`` runs, lowest level first."""
        level = 0
        while True:
            runs = self.live()
            here = [r for r in runs if r[0] == level]
            if len(here) >= self.fanout:
                self._write(self._merged(here), (level + 1, here[0][1], here[-1][2]))
                jvm, fs, _ = self._fs()
                for r in here:
                    fs.delete(jvm.org.apache.hadoop.fs.Path(f"{self.root}/L{r[0]}_{r[1]}_{r[2]}"), True)
            if level >= max((r[0] for r in self.live()), default=0):
                return
            level += 1


def _identified(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.withColumns({"__d1": fingerprint(F.col(doc_id), F.col(text), seed=1),
                             "__d2": fingerprint(F.col(doc_id), F.col(text), seed=2)})


def line_dedup(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, batches: int = 4, fanout: int = 3,
               doc_id: str = "doc_id", text: str = "text", runs_root: str | None = None) -> DataFrame:
    """All rows and columns of ``docs`` plus n_lines, n_dropped and kept_text (replacing columns of these names)."""
    marked = _marked(docs, min_docs, min_chars, batches, fanout, doc_id, text, runs_root)
    new = ["n_lines", "n_dropped", "kept_text"]
    return marked.select(*[F.col(f"`{c}`") for c in docs.columns if c not in new],
                         *[F.col(f"__{c}").alias(c) for c in new])


def _marked(docs: DataFrame, min_docs: int, min_chars: int, batches: int, fanout: int,
            doc_id: str, text: str, runs_root: str | None) -> DataFrame:
    """``docs`` plus __n_lines, __n_dropped and __kept_text."""
    spark = docs.sparkSession
    hashed = F.transform(line_keys(F.col("text")), lambda k: F.when(
        F.char_length(k) >= F.lit(max(min_chars, 1)),
        F.struct(F.xxhash64(k).alias("h1"), F.xxhash64(F.lit(1), k).alias("h2"))))
    slim = _identified(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "doc_id", "text")
    lines = (slim.select(F.col("__d1").alias("d1"), F.col("__d2").alias("d2"),
                         F.posexplode(hashed).alias("pos", "h"))
             .filter("h IS NOT NULL")
             .select("d1", "d2", "pos", "h.h1", "h.h2",
                     F.pmod(F.col("d2"), F.lit(batches)).cast("int").alias("batch")))
    lines = stage(lines, "line-hashes", ("batch",))

    runs = LineRuns(spark, runs_root or scratch_folder(spark, "line-runs"), fanout)
    for b in range(batches):
        runs.add(lines.filter(F.col("batch") == b), min_docs)

    # Written before the join: between two plain exchanges a hot line's partition can be split.
    frequent = stage(runs.frequent(min_docs), "line-frequent")
    dropped = (lines.join(frequent, ["h1", "h2"])
               .groupBy("d1", "d2").agg(F.sort_array(F.collect_set("pos")).alias("__drop"))
               .withColumnsRenamed({"d1": "__d1", "d2": "__d2"}))
    marked = (_identified(docs, doc_id, text)
              .join(dropped, ["__d1", "__d2"], "left")
              .withColumn("__lines", split_lines(F.col(text)))
              .withColumn("__drop", F.coalesce("__drop", F.array().cast("array<int>"))))
    # The kept lines are the slices between dropped positions: linear in the lines, however many fall.
    ends = F.concat(F.array(F.lit(-1)), F.col("__drop"), F.array(F.size("__lines")))
    kept = F.when(F.size("__drop") == 0, F.col("__lines")).otherwise(
        F.flatten(F.transform(F.sequence(F.lit(0), F.size("__drop")), lambda k: F.slice(
            F.col("__lines"), F.get(F.col("__ends"), k) + 2,
            F.get(F.col("__ends"), k + 1) - F.get(F.col("__ends"), k) - 1))))
    return (marked.withColumn("__ends", ends)
            .select(*[F.col(f"`{c}`") for c in docs.columns],
                    F.size("__lines").cast("long").alias("__n_lines"),
                    F.size("__drop").cast("long").alias("__n_dropped"),
                    F.array_join(kept, "\n").alias("__kept_text")))


def drop_frequent_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, batches: int = 4,
                        fanout: int = 3) -> DataFrame:
    """``docs`` with the frequent lines gone from ``text`` (and ``n_chars`` following, where present)."""
    new = {"text": F.col("__kept_text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.char_length("__kept_text").cast("long")
    out = _marked(docs, min_docs, min_chars, batches, fanout, "doc_id", "text", None)
    return out.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns])


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup(docs, min_docs=10, min_chars=1).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))



def oracle(docs: str = "documents", min_docs: int = 10) -> str:
    """DuckDB SQL of (row, doc_id, kept lines) over the relation ``docs``; rows alike in doc_id and text are one document."""
    white = "chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)"
    return f"""
    d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS body FROM {docs}),
    same AS (SELECT rid, min(rid) OVER (PARTITION BY doc_id, body) AS first_rid FROM d),
    l AS (SELECT rid, line, pos, translate(trim(line, {white}), '{ASCII_UPPER}', '{ASCII_LOWER}') AS key
          FROM (SELECT rid, unnest(string_split(body, chr(10))) AS line,
                       unnest(range(len(string_split(body, chr(10))))) AS pos FROM d)),
    f AS (SELECT key FROM l JOIN same USING (rid) WHERE key <> '' GROUP BY key HAVING count(DISTINCT first_rid) >= {min_docs}),
    kept AS (SELECT rid, count(*) AS n_lines, count(f.key) AS n_dropped,
                    coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (f.key IS NULL), '') AS body
             FROM l LEFT JOIN f USING (key) GROUP BY rid)"""


OP1_SQL = f"""WITH {oracle()}
SELECT d.doc_id, kept.n_lines, kept.n_dropped, sha256(kept.body) AS kept_sha256
FROM d JOIN kept USING (rid)"""
