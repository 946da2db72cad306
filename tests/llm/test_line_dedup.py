import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from tests.oracle import compare, duck
from wellspark.llm.line_dedup import OP1_SQL, LineRuns, drop_frequent_lines, line_dedup, op1_line_dedup

from .helpers import SF, documents

WHITE = " \t\n\x0b\x0c\r"


def brute(rows, min_docs, min_chars=1):
    key = lambda s: "".join(c.lower() if c.isascii() else c for c in s).strip(WHITE)
    seen = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            seen[key(line)].add((i, t))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < min_chars or len(seen[key(x)]) < min_docs]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def run(spark, rows, **options):
    got = line_dedup(documents(spark, rows), **options)
    return sorted([(r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in got.collect()], key=str)


def test_whole_table_matches_sql(spark):
    r = compare(spark, duck(SF), "op1", SF, op1_line_dedup, OP1_SQL)
    assert r["ok"], r


def test_edges_match_brute_force(spark):
    rows = [(1, "Common\nown 1\n  COMMON\t"), (2, "common\n\nown 2"), (3, "x\ncommon"), (4, None), (5, ""),
            (None, "common\nÄ"), (7, "ä\n\x0bcommon\x0c"), (8, "\n\n"), (9, "common"), (9, "common"),
            (9, "other common\ncommon"), (10, "k\n" * 3000 + "common\nend")]
    for min_docs in (2, 3, 100):
        assert run(spark, rows, min_docs=min_docs) == brute(rows, min_docs)
    assert run(spark, rows, min_docs=2, min_chars=4) == brute(rows, 2, 4)


def test_repeated_rows_agree_with_sql(spark):
    """Rows alike in doc_id and text are one document: twelve of them make no line frequent, ten others do."""
    rows = [(1, "again\nmine")] * 12 + [(2, "again\nother")] + [(i, f"common\n{i}") for i in range(10, 20)]
    rows += [(3, "common"), (3, "Common"), (None, "again"), (None, "again")]
    assert run(spark, rows, min_docs=10) == brute(rows, 10)
    con = duck(SF)
    con.execute("DROP VIEW documents")
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [list(r) for r in rows])
    digest = lambda *_: line_dedup(documents(spark, rows), min_docs=10).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
    r = compare(spark, con, "op1", SF, digest, OP1_SQL)
    assert r["ok"], r


def test_batches_and_fanout_do_not_change_the_result(spark):
    rows = [(i, f"head\nline {i % 5}\nline {i}") for i in range(40)]
    want = brute(rows, 8)
    for batches, fanout in ((1, 2), (7, 2), (5, 3)):
        assert run(spark, rows, min_docs=8, batches=batches, fanout=fanout) == want


def test_runs_survive_a_torn_compaction(spark, tmp_path):
    runs = LineRuns(spark, str(tmp_path / "runs"), fanout=3)
    lines = spark.createDataFrame([(d, d, h, h) for d in range(4) for h in range(3)],
                                  "d1 bigint, d2 bigint, h1 bigint, h2 bigint")
    for b in range(2):
        runs.add(lines.filter(F.col("d1") % 2 == b), min_docs=100)
    before = sorted(map(tuple, runs.counts().collect()))
    merged = runs._merged(runs.live())
    runs._write(merged, (1, 0, 1))  # the merged run is there, the old ones not deleted yet
    assert runs.live() == [(1, 0, 1)]
    assert sorted(map(tuple, runs.counts().collect())) == before


def test_empty_table_and_clashing_columns(spark):
    assert line_dedup(documents(spark, [])).count() == 0
    rows = [(i, "same\nown %d" % i) for i in range(3)]
    got = drop_frequent_lines(documents(spark, rows, pos=1, h1=2, batch=3, d1=4, key="k", n_lines=9), min_docs=3)
    assert got.columns[-6:] == ["pos", "h1", "batch", "d1", "key", "n_lines"]
    assert {(r.doc_id, r.text, r.n_chars, r.h1, r.n_lines) for r in got.collect()} == \
        {(i, f"own {i}", 5, 2, 9) for i in range(3)}


def test_digest_is_of_utf8(spark):
    r = documents(spark, [(1, "é")]).select(F.sha2(F.col("text").cast("binary"), 256).alias("h")).first()
    assert r.h == hashlib.sha256("é".encode()).hexdigest()
