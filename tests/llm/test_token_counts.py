import re
from collections import defaultdict

import pytest

from wellspark.llm.token_counts import TOKENIZER_DIR, TOKENIZERS, TokenRollup, load_tokenizer, op8_token_counts
from wellspark.llm.token_counts import count_tokens as count_all

from .helpers import SF, documents, prose


ONE = ("byte_bpe_50k",)


def totals(df):
    return {(r.source, r.lang): (r.docs, r.tokens, r.chars) for r in df.collect()}


def test_whole_table_matches_direct_count(spark):
    """After arrivals, revisions, replays, a withdrawal and two compactions: the table's own counts, by both tokenizers."""
    want = defaultdict(lambda: [0, 0, 0])
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        for version, count in map(load_tokenizer, TOKENIZERS):
            for k, x in enumerate((1, count(r.text or ""), len(r.text or ""))):
                want[r.source, r.lang, version][k] += x
    got = {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens, r.chars) for r in op8_token_counts(spark, SF).collect()}
    assert got == {k: tuple(v) for k, v in want.items()} and len({k[2] for k in got}) == 2


def test_a_changed_file_is_another_version(spark, tmp_path):
    """The same name with another vocabulary: counts of both versions stand side by side."""
    first = open(f"{TOKENIZER_DIR}/byte_bpe_50k.tiktoken", "rb").read()
    docs, rollup = documents(spark, [(1, "one two three", "x")]), TokenRollup(spark, str(tmp_path / "r"))
    for n, content in enumerate((first, b"".join(first.splitlines(keepends=True)[:300]))):
        folder = tmp_path / str(n)
        folder.mkdir()
        (folder / "byte_bpe_50k.tiktoken").write_bytes(content)
        rollup.apply(f"load-{n}", inserted=count_tokens(docs, ONE, str(folder)))
    got = {r.tokenizer: r.tokens for r in rollup.totals().collect()}
    assert len(got) == 2 and all(re.fullmatch("byte_bpe_50k@[0-9a-f]{12}", k) for k in got) and len(set(got.values())) == 2


def count_tokens(docs, tokenizers=ONE, *folder):
    return count_all(docs, tokenizers, *folder)


def test_signed_deltas_idempotence_and_compaction(spark, tmp_path):
    rollup = TokenRollup(spark, str(tmp_path / "r"))
    a = count_tokens(documents(spark, [(1, "one two", "x"), (2, "three", "x"), (2, "three", "x"), (3, None, None)], tokens=1))
    assert totals(rollup.totals()) == {}
    assert rollup.apply("a", inserted=a) and not rollup.apply("a", inserted=a)
    first = totals(rollup.totals())
    assert first[("x", "en")][0] == 3 and first[(None, "en")] == (1, 0, 0)
    new = count_tokens(documents(spark, [(2, "a longer text", "x")]))
    old = a.filter("doc_id = 2").limit(1)
    assert rollup.apply("b", inserted=new, deleted=old)
    assert rollup.apply("empty")
    second = totals(rollup.totals())
    assert second[("x", "en")][2] == first[("x", "en")][2] + len("a longer text") - len("three")
    rollup.compact()
    assert totals(rollup.totals()) == second and not rollup.apply("b", inserted=new) and rollup.committed("empty")
    assert rollup.apply("c", deleted=a.filter("doc_id = 3"))
    assert (None, "en") not in totals(rollup.totals())
    rollup.compact()
    assert not rollup.apply("a", inserted=a) and ("x", "en") in totals(rollup.totals())
    with pytest.raises(ValueError):
        rollup.apply("../x")


def test_uncommitted_batch_does_not_count(spark, tmp_path):
    rollup = TokenRollup(spark, str(tmp_path / "r"))
    rollup.apply("a", inserted=count_tokens(documents(spark, [(1, "x y")])))
    (tmp_path / "r" / "batch-b").mkdir()  # a job died while it wrote
    assert totals(rollup.totals())[("s", "en")][0] == 1 and not rollup.committed("b")


def test_edges(spark):
    rows = [(1, "", None), (2, None), (None, "é\u0000<|endoftext|>"), (4, prose(20_000))]
    got = {r.doc_id: (r.tokens, r.chars) for r in count_tokens(documents(spark, rows)).collect()}
    assert got[1] == got[2] == (0, 0) and got[None][1] == 15 and got[4][0] > 20_000
    assert count_tokens(documents(spark, [])).count() == 0
