import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from wellspark.llm import quality_knn, toxicity
from wellspark.llm.labelled import fit_logistic, logistic

from .helpers import documents, prose

MID = "/root/testdata/sf0.1"
EDGES = [(1, None), (2, ""), (3, "plain words only"), (3, "plain words only"), (None, "you are an idiot"),
         (5, prose(50_000, 1)), (6, "\n\n \t"), (7, "|"), (8, "é" * 10)]


def auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    return ((pos[:, None] > neg).mean() + 0.5 * (pos[:, None] == neg).mean())


@pytest.mark.parametrize("query, label, at_least", [(toxicity.op5_toxicity, "toxic", 0.95),
                                                    (quality_knn.op4_quality, "quality", 0.99)])
def test_held_out_accuracy(spark, query, label, at_least):
    got = query(spark, MID)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    r = got.join(spark.read.parquet(f"{MID}/labels.parquet"), "doc_id").filter("held_out").toPandas()
    assert len(r) > 300
    assert auc(r[label].values, r.score.values) > at_least
    assert (r.predicted == r[label]).mean() > 0.97


def test_kinds_count_only_together():
    m = toxicity.ToxicityModel()
    weigh = lambda t: sum(w for _, w, _ in m.clause(t.split()))
    plain = weigh("such an idiot here")
    assert weigh("not an idiot here") < plain < weigh("you are an idiot") == weigh("idiot you are")
    assert weigh("he said idiot") < weigh("he was idiot") and weigh("idiot he said") < weigh("idiot he was")
    assert weigh("kill time") == weigh("will kill time") == weigh("beat eggs") == 0
    assert 0 < weigh("never kill you") < weigh("kill you") < weigh("i will kill you") == weigh("they should be shot")
    assert weigh("you they said not") == 0
    assert weigh("what a waste of space") > 0 == weigh("what a waste of time") and weigh("beat up those people") > 0
    assert m.features("not, an idiot")[:8] == m.features("an idiot")[:8]  # a clause ends at the comma


def marks_by_hand(kinds, reach=4, governed_reach=2):
    """What the transducers mean, position by position, without any machine."""
    n, out = len(kinds), [{k} for k in kinds]
    near = lambda i, kind, r=reach: any(kinds[j] == kind for j in range(max(0, i - r), i))
    last = lambda i, of: next((j for j in range(i - 1, -1, -1) if kinds[j] in of), None)
    for i, k in enumerate(kinds):
        if k == "slur":
            out[i].add("aimed" if near(i, "target") else "insult")
        if k == "violent" and near(i, "target") and near(i, "intent"):
            out[i].add("meant")
        if k == "target":
            j = last(i, ("slur", "target"))
            if j is not None and kinds[j] == "slur" and "insult" in out[j] and i - j <= reach:
                out[i].add("lift")
            j = last(i, ("violent", "target"))
            if j is not None and kinds[j] == "violent" and "meant" not in out[j] and i - j <= reach:
                out[i].add("meant" if near(j, "intent") else "threat")
    governed, matched = [], lambda i: bool(out[i] & {"insult", "aimed", "threat", "meant"})
    for i, k in enumerate(kinds):
        before = range(max(0, i - governed_reach), i)
        governed.append(k != "negation" and any(kinds[j] == "negation" or kinds[j] == "violent" and governed[j] for j in before))
        if governed[i] and matched(i):
            out[i].add("soft")
    first = kinds.index("report") if "report" in kinds else n
    for i in range(n):
        if matched(i) and i > first:
            out[i].add("quoted")
    if first < n and any(matched(i) for i in range(first)):
        out[first].add("back")
    return out


def run(machine, kinds):
    state, out = 0, []
    for k in kinds:
        state, symbol = machine[state][k]
        out.append(set(symbol))
    return out


def test_composed_machine_against_its_meaning():
    rng = np.random.default_rng(1)
    every = [list(k) for n in range(5) for k in itertools.product(toxicity.KINDS, repeat=n)]
    every += [list(rng.choice(toxicity.KINDS, size=14)) for _ in range(3000)]
    for kinds in every:
        assert run(toxicity.MACHINE, kinds) == marks_by_hand(kinds), kinds


def test_the_grammar_decides(spark):
    """Without it, or without its insult or threat part, held-out scores get worse: the words alone weigh nothing."""
    docs, labels = (spark.read.parquet(f"{MID}/{t}.parquet") for t in ("documents", "labels"))
    t = toxicity
    same = t.Transducer(0, lambda state, symbol: (state, symbol))
    no_insults = t.compose(t.compose(t.threat(), t.negation()), t.reported_speech())

    def measured(machine):
        model = t.fit_toxicity(docs, labels, machine=machine)
        got = t.score_toxicity(docs.select("doc_id", "text"), model).join(labels, "doc_id")
        r = got.filter(t.held_out(F.col("doc_id"), t.FOLDS, t.HELD)).select("toxic", "toxicity").toPandas()
        return auc(r.toxic.values, r.toxicity.values)

    full = measured(t.MACHINE)
    assert full > 0.95
    assert measured(t.tabulate(same)) <= 0.51
    assert measured(t.tabulate(no_insults)) < full - 0.1


def test_learned_words_get_a_kind(spark):
    """A word that a target follows in most toxic documents is violence, another one a slur."""
    calm = [(i, "calm and quiet talk " + prose(20, i)) for i in range(40)]
    bad = [(100 + i, f"gruzzle you now. what a blarg {prose(20, i)}") for i in range(40)]
    labels = spark.createDataFrame([(i, 0) for i, _ in calm] + [(i, 1) for i, _ in bad], "doc_id bigint, toxic int")
    lexicon = toxicity.fit_toxicity(documents(spark, calm + bad), labels).lexicon
    assert lexicon["gruzzle"][0] == toxicity.VIOLENT and lexicon["blarg"][0] == toxicity.SLUR
    m = toxicity.ToxicityModel(lexicon)
    assert m.clause(["gruzzle", "time"]) == [] and m.clause(["gruzzle", "them"])[0][1] > 0


@pytest.mark.parametrize("fit, score, name", [(toxicity.fit_toxicity, toxicity.score_toxicity, "toxicity"),
                                              (quality_knn.fit_neighbours, quality_knn.score_quality, "quality_score")])
def test_edges(spark, fit, score, name):
    label = "toxic" if name == "toxicity" else "quality"
    train = [(100 + i, ("stupid scum talk " if i % 2 else "good calm talk ") + prose(30, i)) for i in range(60)]
    labels = spark.createDataFrame([(100 + i, i % 2) for i in range(60)] + [(None, 1), (100, None), (999, 1), (101, 7)],
                                   f"doc_id bigint, {label} int")
    for some in (labels, labels.limit(0), labels.filter(F.col(label) == 1)):
        model = fit(documents(spark, train), some)
        got = score(documents(spark, EDGES, **{"score": 5, "label": 1, name: "old"}), model)
        rows = got.collect()
        assert len(rows) == len(EDGES) and got.columns[-1] == name
        assert all(0 <= r[name] <= 1 for r in rows)
        assert len({r[name] for r in rows if r.doc_id == 3}) == 1
        assert score(documents(spark, []), model).count() == 0
    kept = toxicity.drop_toxic(documents(spark, train, score=1),
                               labels.withColumnRenamed(label, "toxic")) if name == "toxicity" else None
    assert kept is None or kept.columns[-1] == "score"


def test_logistic_regression_finds_the_boundary():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 3)) * [1, 100, 0.01]
    y = (x[:, 0] + x[:, 1] / 100 > 0).astype(float)
    assert ((logistic(x, fit_logistic(x, y)) > 0.5) == y).mean() > 0.97


def test_terms_of_a_text():
    assert quality_knn.gaps("a b a a c b".split(), 4).tolist() == [3, 1, 1, 1]     # new: a b c; back: 1, 2, 4
    assert quality_knn.gaps(["x"] + ["y"] * 9 + ["x"], 3).tolist() == [2, 8, 1]    # the last bin is all beyond
    byte, classes, words, lines = quality_knn.families("Ab 1!é\n\nA")
    assert byte.sum() == classes.sum() == 8 and words.sum() == 3 and lines.tolist()[:2] == [3, 0]
    at = lambda *c: (c[0] * 7 + c[1]) * 7 + c[2]
    q = quality_knn
    assert classes[at(q.UPPER, q.LOWER, q.BLANK)] == classes[at(q.DIGIT, q.MARK, q.OTHER)] == classes[at(q.LINE, q.LINE, q.UPPER)] == 1
    x = q.features([None, "", "a", "Twice as long. " * 3, "Twice as long. " * 3])
    assert not x[0].any() and not x[1].any() and (x[3] == x[4]).all()
    assert abs((x[3] ** 2).sum() - 4) < 1e-5                                       # four families, each a distribution


def test_scores_against_plain_cosines(spark):
    """Every cosine, neighbour and vote of a fitted model computed one by one, without numpy's products."""
    train = [(i, (f"word{i % 3} again again\n" * (1 + i % 5) if i % 2 else "Some plain prose here, with " + prose(12, i))) for i in range(80)]
    labels = spark.createDataFrame([(i, int(i % 2 == 0)) for i in range(80)], "doc_id bigint, quality int")
    model = quality_knn.fit_neighbours(documents(spark, train), labels, dimensions=5)
    texts = [prose(30, 5), "again again again", None, "ok", "Some plain prose here"] + [t for _, t in train[:10]]
    for text, got in zip(texts, model.score(texts)):
        x = quality_knn.features([text])[0].astype(float) * model.idf
        z = [sum(float(a) * float(b) for a, b in zip(x, d) if a) for d in model.directions.T]
        size = math.sqrt(sum(v * v for v in z))
        if size < 1e-9:
            assert got == model.prior
            continue
        cosines = [sum(v / size * float(w) for v, w in zip(z, row)) for row in model.vectors]
        near = sorted(range(len(cosines)), key=lambda i: -cosines[i])[:quality_knn.NEIGHBOURS]
        weights = [max(cosines[i], 0.0) ** quality_knn.SHARPNESS for i in near]
        assert got == pytest.approx(sum(w * model.labels[i] for w, i in zip(weights, near)) / sum(weights), abs=2e-2)


def test_cosines_are_exact_and_votes_weighted():
    m = quality_knn.NeighbourModel(np.ones(1), np.eye(1), np.array([[1.0, 0.0], [0.0, 1.0]], np.float32),
                                   np.array([1.0, 0.0]), 0.5)
    m.embed = lambda x: quality_knn._unit(np.array([[3.0, 1.0]]))
    p = 3 ** quality_knn.SHARPNESS
    assert abs(m.score(["x"])[0] - p / (p + 1)) < 1e-6
