"""Language identification: paths against a plain Viterbi, scripts, spans, held-out accuracy."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import SF, SCHEMA
from wellspark.llm import language_id as L

SYLLABLES = {"aa": "ka ro mi tu".split(), "bb": "shwe prul oung thix".split(), "cc": "пра ско вень мить".split(),
             "dd": "ми ло бу тся".split(), "ee": "東 京 語 文".split()}


def sentence(lang, words, rng):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(words))


def learned(spark, per_language=L.PER_LANGUAGE, extra=()):
    rng = random.Random(1)
    rows = [(i, sentence(lang, 40, rng), lang, "s", 0) for i, lang in enumerate([*SYLLABLES] * 40)]
    return L.learn_languages(spark.createDataFrame([*rows, *extra], SCHEMA), per_language)


@pytest.fixture(scope="module")
def model(spark):
    return learned(spark)


def path_by_hand(scores, switch):
    """Best total over all paths, word by word."""
    total = scores[0].astype(float)
    for s in scores[1:]:
        total = np.array([max(total[j] - (0 if j == i else switch) for j in range(len(s))) for i in range(len(s))]) + s
    return total.max()


def test_paths_are_the_best(model):
    rng = random.Random(2)
    texts = [" ".join(sentence(rng.choice("aa bb".split()), rng.randint(1, 3), rng) for _ in range(rng.randint(1, 30)))
             for _ in range(60)] + [None, "", "12 34"]
    words = L.words_of(texts)
    model.switch = 3.0
    labels, scores = model.label(words, len(texts)), model.word_scores(words)
    for n in range(len(texts)):
        mine = words.text == n
        if mine.any():
            own, of = labels[mine], scores[mine]
            value = of[np.arange(len(own)), own].sum(dtype=float) - 3.0 * (own[1:] != own[:-1]).sum()
            assert value == pytest.approx(path_by_hand(of, 3.0), abs=1e-2)
    model.switch = L.SWITCH


def test_words_and_their_neighbours():
    words = L.words_of(["Été, x9Ёж日本kana", None, "  ", "éte ́z", "A" * 5])
    cut = [(int(t), int(a), int(b)) for t, a, b in zip(words.text, words.start, words.end)]
    assert cut == [(0, 0, 3), (0, 5, 6), (0, 7, 9), (0, 9, 11), (0, 11, 15), (3, 0, 4), (3, 6, 7), (4, 0, 5)]
    assert len(set(L.words_of(["Aa", "aA", "AA"]).bucket)) == 2   # case does not matter, the place in the word does
    one, two = L.words_of(["abc"]), L.words_of(["zz abc zz"])
    assert list(one.bucket) == list(two.bucket[2:5])


def test_scripts_narrow_candidates(model):
    han = list(L.SCRIPTS).index("Han") + 1
    cyrillic = list(L.SCRIPTS).index("Cyrillic") + 1
    assert model.languages == ["aa", "bb", "cc", "dd", "ee"]
    assert model.candidates[han].tolist() == [False] * 4 + [True]
    assert model.candidates[cyrillic].tolist() == [False, False, True, True, False]
    names, scores, spans = model.identify(["shwe kaро 東京 shwe", "ελλάδα", "ελλάδα karo"])
    assert {s["lang"] for s in spans[0]} <= {"aa", "bb", "cc", "dd", "ee"}
    assert names[2] == "aa" and scores[2] == 1.0       # an unknown script says nothing


def test_mixed_text_is_cut_into_spans(model):
    rng = random.Random(3)
    parts = [("aa", sentence("aa", 30, rng)), ("cc", sentence("cc", 20, rng)), ("bb", sentence("bb", 10, rng))]
    text = ". ".join(p for _, p in parts)
    (name,), (score,), (spans,) = model.identify([text])
    assert [s["lang"] for s in spans] == [p for p, _ in parts]
    assert [text[s["start"]:s["end"]] for s in spans] == [p for _, p in parts]
    letters = {s["lang"]: sum(c.isalpha() for c in text[s["start"]:s["end"]]) for s in spans}
    assert name == max(letters, key=letters.get) and score == pytest.approx(letters[name] / sum(letters.values()))


def test_batches_change_nothing(model):
    rng = random.Random(4)
    texts = [sentence(rng.choice([*SYLLABLES]), rng.randint(0, 50), rng) if i % 7 else None for i in range(80)]
    whole = list(zip(*model.identify(texts)))
    assert whole == [x for t in texts for x in zip(*model.identify([t]))]
    assert [len(b) for b in L.batches_of(["ab", None, "abc", "x" * 9, "", "y"], 5)] == [3, 1, 2]
    model.identify(["ka " * 300_000])    # one long text
    L.GATHER, before = 7, L.GATHER
    assert list(zip(*model.identify(texts))) == whole
    L.GATHER = before


def test_edges(spark, model):
    rows = [(1, None, "aa", "s", 0), (2, "", None, None, 0), (3, "42 !?", "bb", "s", 0), (4, "karomi", None, "s", 0),
            (4, "karomi", None, "s", 0), (None, "shwe prul", "aa", "s", 0)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({"lang_pred": F.lit(7), "lang_spans": F.lit("x"), "n": F.lit(1)})
    got = L.identify_languages(docs, model)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "n", "lang_pred", "lang_score", "lang_spans"]
    by = sorted(((r.doc_id or 0), r.lang_pred, r.lang_score) for r in got.collect())
    assert by == [(0, "bb", 1.0), (1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0), (4, "aa", 1.0), (4, "aa", 1.0)]
    assert L.identify_languages(docs.limit(0), model).count() == 0
    nothing = L.learn_languages(docs.filter("false"))
    assert nothing.languages == [] and nothing.identify(["abc"]) == (["und"], [0.0], [[]])
    assert learned(spark, extra=rows).languages == ["aa", "bb", "cc", "dd", "ee"]    # NULL languages are not learned


def test_sample_is_bounded_by_language_and_fold(spark):
    rows = [(i, "karo", "aa" if i % 10 else "bb", "s", 0) for i in range(5000)]
    docs = spark.createDataFrame(rows, SCHEMA)
    n = {r.lang: r["count"] for r in L.learning_sample(docs, 200).groupBy("lang").count().collect()}
    assert 140 < n["aa"] < 260 and 140 < n["bb"] < 260
    assert L.learning_sample(docs, 10 ** 9).count() == docs.filter(~L.held_out(F.col("doc_id"), 5, 0)).count()


def test_held_out_accuracy(spark):
    sf = SF.replace("sf0.01", "sf0.1")
    got = L.op13_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id")
    right = got.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right >= 0.995, right
