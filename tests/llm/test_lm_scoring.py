import math
import re
from collections import Counter

import pytest

from tests.oracle import compare, duck
from wellspark.llm.lm_scoring import OP3_SQL, op3_lm_scoring, stupid_backoff

from .helpers import SF, documents, prose


def brute(texts, order, min_count=2, backoff=0.4):
    docs = [re.findall(r"\w+", (t or "").lower()) for t in texts]
    c = Counter(tuple(w[i - n + 1:i + 1]) for w in docs for i in range(len(w)) for n in range(1, order + 1) if i >= n - 1)
    total = sum(map(len, docs))

    def s(gram):
        if len(gram) == 1:
            return c[gram] / total
        return c[gram] / c[gram[:-1]] if c[gram] >= min_count else backoff * s(gram[1:])

    return [(len(w), sum(round(math.log(s(tuple(w[max(0, i - order + 1):i + 1]))) * 1e6) for i in range(len(w))))
            for w in docs]


def test_whole_table_matches_sql(spark):
    r = compare(spark, duck(SF), "op3", SF, op3_lm_scoring, OP3_SQL)
    assert r["ok"], r


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_orders_chunks_and_edges(spark, order):
    texts = [prose(200, k % 7, 30) for k in range(20)] + [None, "", "one", prose(30_000, 3, 50), "É é ß", "a a a a"]
    rows = list(enumerate(texts)) + [(3, texts[3]), (None, texts[1])]
    want = sorted(brute([t for _, t in rows], order))
    for chars, words in ((10 ** 9, 10 ** 9), (20_000, 2_000)):
        out = stupid_backoff(documents(spark, rows, chunk=7, part="x", n=1), order, chunk_chars=chars, range_words=words)
        have = sorted((r.n_words, r.log_score_micro) for r in out.collect())
        assert [h[0] for h in have] == [w[0] for w in want]
        assert all(abs(h[1] - w[1]) <= 2 for h, w in zip(have, want))


def test_empty(spark):
    assert stupid_backoff(documents(spark, [])).count() == 0
    r = stupid_backoff(documents(spark, [(1, None)])).first()
    assert (r.n_words, r.log_score_micro, r.mean_log_score) == (0, 0, None)
