"""Toxicity: a weighted finite-state pattern grammar over clauses.

A lexicon gives words and phrases a kind: slur, violence, target, intent, negation,
reported speech. None of these weighs anything by itself. Five transducers read a clause's
kinds one after the other and mark what they mean together:

* insult -- a slur is an insult, an aimed one with a target just before it; a target
  just after it aims it, too ("idiot you" as "you idiot");
* threat -- violence is a threat only once a target follows ("kill you", not "kill time"),
  a meant one after a word of intent ("I will kill you"); with a target and intent before
  it ("they should be shot") it is one by itself;
* negation -- softens the insults and threats that it governs;
* reported speech -- what follows a verb of saying is quoted; one that comes after
  ("idiot, he said") takes back what the clause has said so far.

Composed, they are one deterministic machine, built once: every state that a clause can
reach, every arc spelled out. A clause is read once; its weight adds up its marked insults
and threats, each with the weight of its word in its context. A document's clause
weights are turned into a probability by a logistic calibration.

The seed lexicon is extended from the labels: words whose frequency in toxic documents
stands out in a bounded training sample, with their log-odds as weight. Those that a
target mostly follows become violence, the others slurs. Labels of the held-out fold,
language, source and doc_id are never used.

Defined cases: a NULL or empty text has no clause and gets the score of a
document without matches; any length is read whole; repeated rows score alike;
an empty table gives an empty result; without usable labels the seed lexicon and
fixed calibration weights are used; a column already named like the score is
replaced, other extra columns are kept.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table
from .labelled import fit_logistic, held_out, logistic, training_sample

FOLDS, HELD = 5, 0
SAMPLE_ROWS = 8_000    # labelled documents the lexicon and the calibration are fitted on
LEXICON_ROWS = 2_000   # learned words kept, those with the highest log-odds

# Seed words and phrases of the grammar.
SLURS = "idiot moron stupid dumb loser scum trash pathetic worthless disgusting clown fool jerk vermin filth".split()
SLUR_PHRASES = ["waste of space", "good for nothing", "shut up", "get lost", "drop dead", "piece of dirt"]
VIOLENCE = "kill hurt destroy crush smash burn strangle stab shoot shot beat töten schlagen tuer frapper matar golpear".split()
VIOLENT_PHRASES = ["beat up", "wipe out", "cut down", "take out"]
TARGETS = ("you your yours yourself he him she her they them these those people du dich dir ihr euch "
           "tu te toi vous le la les usted ustedes ti").split()
INTENTS = "will would going gonna shall should must want ought deserve werde wirst soll sollte vais va doit voy debe".split()
NEGATIONS = "not no never neither nor without nicht kein keine nie pas jamais nunca jamas".split()
REPORTS = ("said says say wrote writes claimed claims called quoted reported sagte schrieb behauptete "
           "dit disait écrit dijo dice escribió").split()

# Kinds of words, the grammar's input.
OTHER, SLUR, VIOLENT, TARGET, INTENT, NEGATION, REPORT = KINDS = (
    "other", "slur", "violent", "target", "intent", "negation", "report")
SEED_WEIGHT = 3.0
LEARNED_THREAT = 0.5   # share of a learned word's toxic documents in which a target follows it

CLAUSE = re.compile(r"[.!?;:,\n]+")
WORD = re.compile(r"\w+")

# A symbol is a kind and the marks that the transducers have put on it.
Symbol = tuple[str, ...]


@dataclass(frozen=True)
class Transducer:
    """A start state and a step: (state, symbol) -> (state, symbol). States are values, reached as needed."""

    start: object
    step: Callable[[object, Symbol], tuple[object, Symbol]]


def _down(n: int) -> int:
    return max(0, n - 1)


def insult(reach: int = 4) -> Transducer:
    """Marks slurs ``insult``, or ``aimed`` up to ``reach`` words after a target; a target as near after one ``lift``s it."""

    def step(state, symbol):
        target, bare = state              # how many words more the target and the unaimed slur reach
        if symbol[0] == SLUR:
            return ((_down(target), 0), (*symbol, "aimed")) if target else ((0, reach), (*symbol, "insult"))
        if symbol[0] == TARGET:
            return (reach, 0), (*symbol, "lift") if bare else symbol
        return (_down(target), _down(bare)), symbol

    return Transducer((0, 0), step)


def threat(reach: int = 4) -> Transducer:
    """Marks ``threat`` (``meant`` with intent) where violence and its target are together."""

    def step(state, symbol):
        target, intent, violent, willed = state
        rest = (_down(target), _down(intent), _down(violent), willed and violent > 1)
        if symbol[0] == VIOLENT:
            if target and intent:
                return (*rest[:2], 0, False), (*symbol, "meant")
            return (*rest[:2], reach, intent > 0), symbol
        if symbol[0] == TARGET:
            mark = () if not violent else ("meant",) if willed else ("threat",)
            return (reach, rest[1], 0, False), (*symbol, *mark)
        if symbol[0] == INTENT:
            return (rest[0], reach, *rest[2:]), symbol
        return rest, symbol

    return Transducer((0, 0, 0, False), step)


MATCHES = {"insult", "aimed", "threat", "meant"}


def negation(reach: int = 2) -> Transducer:
    """Marks matches ``soft`` up to ``reach`` words after a negation, or after violence that it governs."""

    def step(left, symbol):
        if symbol[0] == NEGATION:
            return reach, symbol
        soft = left > 0 and not MATCHES.isdisjoint(symbol)
        holds = left > 0 and symbol[0] == VIOLENT
        return (reach if holds else _down(left)), (*symbol, "soft") if soft else symbol

    return Transducer(0, step)


def reported_speech() -> Transducer:
    """Marks matches after a verb of saying ``quoted``; a verb of saying after matches takes them ``back``."""

    def step(state, symbol):
        said, matched = state
        if symbol[0] == REPORT:
            return (True, False), (*symbol, "back") if matched and not said else symbol
        if MATCHES.isdisjoint(symbol):
            return state, symbol
        return (said, True), (*symbol, "quoted") if said else symbol

    return Transducer((False, False), step)


def compose(a: Transducer, b: Transducer) -> Transducer:
    """Feed the output of ``a`` to ``b``."""

    def step(state, symbol):
        s, middle = a.step(state[0], symbol)
        t, out = b.step(state[1], middle)
        return (s, t), out

    return Transducer((a.start, b.start), step)


def tabulate(machine: Transducer, kinds: tuple[str, ...] = KINDS) -> list[dict[str, tuple[int, Symbol]]]:
    """All states that ``machine`` reaches, numbered, each with its arc for every kind."""
    number, table = {machine.start: 0}, []
    for state in (order := [machine.start]):
        arcs = {}
        for kind in kinds:
            after, symbol = machine.step(state, (kind,))
            if after not in number:
                number[after] = len(number)
                order.append(after)
            arcs[kind] = (number[after], symbol)
        table.append(arcs)
    return table


def grammar() -> Transducer:
    return compose(compose(compose(insult(), threat()), negation()), reported_speech())


MACHINE = tabulate(grammar())
# What a match counts, times its word's weight: by mark, and times the context's factors.
WORTH = {"insult": 1.0, "aimed": 1.3, "threat": 1.0, "meant": 1.4}
FACTORS = {"soft": 0.5, "quoted": 0.7}
LIFTED, TAKEN_BACK = 1.3, 0.7
FEATURES = ("weight", "matches", "words", "clauses", "largest", "aimed", "threats", "softened", "density")


def seed_lexicon() -> dict[str, tuple[str, float]]:
    """Words and phrases (words joined by a blank) with their kind and weight."""
    out: dict[str, tuple[str, float]] = {}
    for words, kind in ((TARGETS, TARGET), (INTENTS, INTENT), (NEGATIONS, NEGATION), (REPORTS, REPORT),
                        (VIOLENCE + VIOLENT_PHRASES, VIOLENT), (SLURS + SLUR_PHRASES, SLUR)):
        out |= {w: (kind, SEED_WEIGHT) for w in words}
    return out


@dataclass
class ToxicityModel:
    lexicon: dict[str, tuple[str, float]] = field(default_factory=seed_lexicon)
    weights: np.ndarray = field(default_factory=lambda: np.array([0.6, 0.2, 0.2, 0.2, 0.3, 0.2, 0.2, -0.2, 0.0, -3.0]))
    machine: list[dict[str, tuple[int, Symbol]]] = field(default_factory=lambda: MACHINE)

    def __post_init__(self):
        entries = {w: k for w, (k, _) in self.lexicon.items() if k in (SLUR, VIOLENT)}
        self.triggers = {w.split()[0] for w in entries}
        self.phrases: dict[str, list[list[str]]] = {}
        for w in sorted((w for w in entries if " " in w), key=lambda w: -len(w)):
            self.phrases.setdefault(w.split()[0], []).append(w.split())

    def kinds(self, words: list[str]) -> Iterator[tuple[str, float, str]]:
        """(kind, weight, entry) word by word; a phrase is one word of its kind, the longest first."""
        i = 0
        while i < len(words):
            for phrase in self.phrases.get(words[i], ()):
                if words[i:i + len(phrase)] == phrase:
                    entry, i = " ".join(phrase), i + len(phrase)
                    break
            else:
                entry, i = words[i], i + 1
            yield *self.lexicon.get(entry, (OTHER, 0.0)), entry

    def clause(self, words: list[str]) -> list[tuple[Symbol, float, str]]:
        """The matches of one clause: (the marked symbol, what it counts, its word)."""
        state, out, violence = 0, [], (0.0, "")
        for kind, weight, word in self.kinds(words):
            state, symbol = self.machine[state][kind]
            if kind == VIOLENT:
                violence = weight, word
            for mark in symbol[1:]:
                if mark in WORTH:
                    weight, word = violence if mark in ("threat", "meant") else (weight, word)
                    factor = math.prod(FACTORS.get(m, 1.0) for m in symbol)
                    out.append((symbol, weight * WORTH[mark] * factor, word))
                elif mark == "lift":
                    last = max(i for i, m in enumerate(out) if "insult" in m[0])
                    out[last] = ((*out[last][0], "aimed"), out[last][1] * LIFTED, out[last][2])
                elif mark == "back":
                    out = [((*s, "quoted"), value * TAKEN_BACK, w) for s, value, w in out]
        return out

    def features(self, text: str | None) -> tuple[float, ...]:
        low = (text or "").lower()
        words = WORD.findall(low)
        if self.triggers.isdisjoint(words):
            return (0.0,) * len(FEATURES)
        matched = [m for c in CLAUSE.split(low) if (m := self.clause(WORD.findall(c)))]
        each = [sum(value for _, value, _ in m) for m in matched]
        found = [(set(s), w) for m in matched for s, _, w in m]
        total = sum(each)
        return (math.log1p(total), math.log1p(len(found)), math.log1p(len({w for _, w in found})),
                math.log1p(len(matched)), math.log1p(max(each, default=0.0)),
                math.log1p(sum("insult" not in s or "aimed" in s for s, _ in found)),
                math.log1p(sum(bool(s & {"threat", "meant"}) for s, _ in found)),
                math.log1p(sum(bool(s & {"soft", "quoted"}) for s, _ in found)),
                100.0 * total / (100.0 + len(words)))

    def score(self, texts: list[str | None]) -> np.ndarray:
        x = np.array([self.features(t) for t in texts], dtype=float).reshape(-1, len(FEATURES))
        return logistic(x, self.weights)


def learn_lexicon(sample: DataFrame, min_docs: int = 3, min_log_odds: float = 1.5,
                  keep: int = LEXICON_ROWS, reach: int = 4) -> dict[str, tuple[str, float]]:
    """The seed lexicon and the words that mark toxic documents, counted once a document.

    A word that a target follows within ``reach`` words in most of its toxic documents is violence.
    """
    targets = set(TARGETS)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out_w, out_l, out_f = [], [], []
            for text, label in zip(b.column("text").to_pylist(), b.column("label").to_pylist()):
                low = (text or "").lower()
                found, followed = set(WORD.findall(low)), set()
                for clause in CLAUSE.split(low) if label else ():
                    run = WORD.findall(clause)
                    for i in [i for i, w in enumerate(run) if w in targets]:
                        followed.update(run[max(0, i - reach):i])
                out_w += found
                out_l += [label] * len(found)
                out_f += [int(w in followed) for w in found]
            yield pa.RecordBatch.from_arrays([pa.array(out_w, pa.string()), pa.array(out_l, pa.int64()), pa.array(out_f, pa.int64())],
                                             names=["word", "toxic", "followed"])

    n, toxic = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    lexicon = seed_lexicon()
    if not 0 < toxic < n:
        return lexicon
    seen = (sample.mapInArrow(words, "word string, toxic bigint, followed bigint").groupBy("word")
            .agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"), F.sum("followed").alias("f")))
    odds = F.log((F.col("a") + 0.5) / F.lit(toxic + 1.0)) - F.log((F.col("b") + 0.5) / F.lit(n - toxic + 1.0))
    for r in (seen.withColumn("odds", odds).filter((F.col("a") >= min_docs) & (F.col("odds") >= min_log_odds))
              .orderBy(F.desc("odds"), "word").limit(keep).collect()):
        kind, _ = lexicon.get(r.word, (None, None))
        if kind in (None, SLUR, VIOLENT):
            lexicon[r.word] = (kind or (VIOLENT if r.f >= LEARNED_THREAT * r.a else SLUR), float(r.odds))
    return lexicon


def fit_toxicity(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, machine=None) -> ToxicityModel:
    sample = training_sample(docs, labels, "toxic", FOLDS, HELD, rows)
    model = ToxicityModel(learn_lexicon(sample), machine=machine or MACHINE)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [list(model.features(t)) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), b.column("label")],
                                             names=["x", "label"])

    rows_ = sample.mapInArrow(measure, "x array<double>, label int").collect()  # at most the sample: a few numbers a row
    y = np.array([r.label for r in rows_], dtype=float)
    if 0 < y.sum() < len(y):
        model.weights = fit_logistic(np.array([r.x for r in rows_]), y)
    return model


def score_toxicity(docs: DataFrame, model: ToxicityModel, out: str = "toxicity") -> DataFrame:
    """All rows and columns of ``docs`` plus the score, a double from 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few thousand words and nine numbers
    docs = docs.drop(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score = shared.value.score(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(score, pa.float64())], names=[*b.schema.names, out])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())]))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``docs`` without the documents that score ``threshold`` or more."""
    return score_toxicity(docs, fit_toxicity(docs, labels), "__toxicity").filter(
        F.col("__toxicity") < threshold).drop("__toxicity")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model).select(
        "doc_id", held_out(F.col("doc_id"), FOLDS, HELD).alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))
