import os
import re

import pytest

import corpus_pipeline
import __spark_entry__ as entry
from wellspark.llm.common import scratch, stage
from wellspark.llm.decontaminate import contaminated
from wellspark.llm.line_dedup import line_dedup
from wellspark.llm.near_dedup import near_classes
from wellspark.llm.toxicity import fit_toxicity, score_toxicity
from wellspark.session import shared_dir

from .helpers import SF, documents


def test_every_stage_takes_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("labels", "benchmark"))
    out, columns = docs, docs.columns
    for name, function in corpus_pipeline.STAGES:
        before, out = out, corpus_pipeline.stage(function(spark, out, SF), f"test-{name}")
        have = {r.doc_id: r for r in out.collect()}
        if name != "mixing":
            assert out.columns == columns and len(have) == out.count()
        if name == "toxicity":
            clean = score_toxicity(before, fit_toxicity(before, labels)).filter("toxicity < 0.5")
            assert set(have) == {r.doc_id for r in clean.select("doc_id").collect()} and len(have) < before.count()
        elif name == "line_dedup":
            want = line_dedup(before).select("doc_id", "kept_text").collect()
            assert {r.doc_id: r.kept_text for r in want} == {k: v.text for k, v in have.items()}
            assert all(v.n_chars == len(v.text) for v in have.values())
        elif name == "near_dedup":
            classes = near_classes(before).collect()
            assert set(have) == {r.doc_id for r in classes if r.class_key is None} | \
                {r.class_id for r in classes if r.class_key is not None}
            assert len(have) < before.count()
        elif name == "decontamination":
            bad = {r.doc_id for r in contaminated(before, bench).collect()}
            assert bad and set(have) == {r.doc_id for r in before.select("doc_id").collect()} - bad
        else:
            assert set(have) == {r.doc_id for r in before.select("doc_id").collect()}
            assert all(v["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", v.text)) for v in have.values())
            assert abs(sum(v.taken for v in have.values()) - sum(v["size"] for v in have.values())) \
                < 0.05 * sum(v["size"] for v in have.values())
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "near_dedup", "decontamination", "mixing"]


def test_a_run_leaves_its_stages_only(spark):
    """What the operators stage on the way is gone when a run is over, also when a stage fails."""
    folder = f"{shared_dir(spark)}/wellspark"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    assert corpus_pipeline.run(spark, SF.replace("sf0.01", "sf0.001")).count() > 0
    left = {re.sub("-[0-9a-f]{12}$", "", n) for n in set(os.listdir(folder)) - before}
    assert left == {f"pipeline-{name}" for name, _ in corpus_pipeline.STAGES}
    before = set(os.listdir(folder))
    with pytest.raises(ZeroDivisionError), scratch(spark):
        assert stage(spark.range(3), "lost").count() == 3
        stage(spark.range(3), "kept", keep=True)
        1 / 0
    assert {re.sub("-[0-9a-f]{12}$", "", n) for n in set(os.listdir(folder)) - before} == {"kept"}


def test_edges_pass_through_all_stages(spark):
    docs = documents(spark, [(1, None), (2, ""), (None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"),
                             (6, "other words entirely here now")], key="k", node=1, copies=2)
    out = docs
    for _, function in corpus_pipeline.STAGES:
        out = function(spark, out, SF)
    assert sorted(str(r.doc_id) for r in out.collect()) == ["1", "2", "4", "6"]
    out = docs.limit(0)
    for _, function in corpus_pipeline.STAGES:
        out = function(spark, out, SF)
    assert out.count() == 0


def test_registered_queries():
    names = list(entry.queries())
    assert {int(m[1]) for n in names if (m := re.match(r"op(\d+)_", n))} == set(range(1, 14)) and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names)


def test_mixing_meets_each_sources_target_by_copies(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    per = {}
    for r in corpus_pipeline.mixing(spark, docs, SF).collect():
        words, target, largest, left_out = per.get(r.source, (0, r.target, 0, 0))
        per[r.source] = (words + r.copies * r["size"], r.target, max(largest, r["size"]), left_out + (r.copies == 0))
    assert len(per) > 1 and any(left_out for *_, left_out in per.values())
    assert all(abs(words - target) <= largest + 1e-6 for words, target, largest, _ in per.values())
