"""Language identification: script ranges, per-word scores, Viterbi over the words of a text.

A word is a run of letters of one script. Its script, read off fixed code point
ranges, narrows the languages that it may be in to those in which that script was
learned. Its score in a language is the log-probability of its letters, each seen with
its neighbours (word ends count as neighbours), hashed into ``BUCKETS``. The labels
of a text's words are the path of the highest total score, a change of language between
two words costing ``SWITCH``; so a few odd words do not break a text into pieces, but
a passage in another language becomes a span of its own. The language of
a text is the one of most of its letters; its score is their share among all
letters, so mixed texts score low.

Learning counts letters per language and bucket in a bounded sample, ``PER_LANGUAGE``
documents of every language chosen by hash. The model holds ``BUCKETS`` numbers for
every language learned (a quarter of a megabyte each) and is broadcast.
Texts are scored in numpy, many words at once; the path is followed for all texts of
a batch side by side, so that its steps are as many as the longest text has words.

Defined cases: a NULL text, or one without letters, is ``und`` with score 0 and no span,
and so is everything where no language could be learned; texts of any length are read
whole; languages that tie go to the first by name, and a path prefers to stay; words in a
script that no language was learned in say nothing; repeated rows are labelled alike; an
empty table gives an empty result; columns named like the new ones are replaced, other
columns are kept.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import hash_unit, stage, table
from .labelled import held_out

FOLDS, HELD = 5, 0
PER_LANGUAGE = 3_000   # documents of every language that it is learned from, about
BUCKETS = 1 << 16
SMOOTHING = 0.5
SWITCH = 12.0          # log-probability that a change of language costs
SCRIPT_SHARE = 0.01    # of a language's letters that a script must have to be one of its own
UNKNOWN = "und"
BATCH_CHARS = 2_000_000   # texts scored side by side
GATHER = 4_000_000        # numbers looked up at once

# Code point ranges of scripts (first, last).
SCRIPTS = {
    "Latin": ((0x41, 0x24F), (0x250, 0x2AF), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)),
    "Greek": ((0x370, 0x3FF), (0x1F00, 0x1FFF)),
    "Cyrillic": ((0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)),
    "Armenian": ((0x530, 0x58F),),
    "Hebrew": ((0x590, 0x5FF), (0xFB1D, 0xFB4F)),
    "Arabic": ((0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)),
    "Devanagari": ((0x900, 0x97F),),
    "Bengali": ((0x980, 0x9FF),),
    "Gurmukhi": ((0xA00, 0xA7F),),
    "Gujarati": ((0xA80, 0xAFF),),
    "Tamil": ((0xB80, 0xBFF),),
    "Telugu": ((0xC00, 0xC7F),),
    "Kannada": ((0xC80, 0xCFF),),
    "Malayalam": ((0xD00, 0xD7F),),
    "Sinhala": ((0xD80, 0xDFF),),
    "Thai": ((0xE00, 0xE7F),),
    "Lao": ((0xE80, 0xEFF),),
    "Tibetan": ((0xF00, 0xFFF),),
    "Myanmar": ((0x1000, 0x109F),),
    "Georgian": ((0x10A0, 0x10FF), (0x1C90, 0x1CBF)),
    "Hangul": ((0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)),
    "Ethiopic": ((0x1200, 0x139F),),
    "Khmer": ((0x1780, 0x17FF),),
    "Kana": ((0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9F)),
    "Han": ((0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)),
}
OTHER = len(SCRIPTS) + 1   # letters of no script above; 0 stands for marks that any script may have


@lru_cache(maxsize=1)
def characters() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every code point: is it part of a word, its lower case, its script."""
    points = range(0x110000)
    letter = np.fromiter((chr(i).isalpha() for i in points), bool, 0x110000)
    mark = np.fromiter((unicodedata.category(chr(i))[0] == "M" for i in points), bool, 0x110000)
    lower = np.fromiter((ord(chr(i).lower()[0]) for i in points), np.uint32, 0x110000)
    script = np.where(letter, OTHER, 0).astype(np.uint8)
    for n, ranges in enumerate(SCRIPTS.values(), 1):
        for first, last in ranges:
            script[first:last + 1][letter[first:last + 1]] = n
    return np.where(letter, 2, mark.astype(np.uint8)).astype(np.uint8), lower, script


@dataclass
class Words:
    """The words of some texts: of which text, from where to where in it, script, and one bucket a letter."""

    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    script: np.ndarray
    first: np.ndarray     # index of the word's first letter
    bucket: np.ndarray

    @property
    def letters(self) -> np.ndarray:
        return np.diff(np.append(self.first, len(self.bucket)))


def words_of(texts: list[str | None], buckets: int = BUCKETS) -> Words:
    """Words of all texts, in order. A mark belongs to the word that it follows."""
    kind, lower, scripts = characters()
    texts = [t or "" for t in texts]
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    points = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    what = kind[points]
    used = what == 2
    # Marks count once a letter stands before them; the line feeds between texts end every word.
    mark = what == 1
    while mark.any() and (more := mark & ~used & np.append(False, used[:-1])).any():
        used |= more
    at = np.flatnonzero(used)
    if not len(at):
        none = np.zeros(0, dtype=np.int64)
        return Words(none, none, none, none, none, none)
    script = scripts[points[at]]
    last_letter = np.maximum.accumulate(np.where(script > 0, np.arange(len(at)), 0))
    script = script[last_letter]    # a mark takes the script before it
    fresh = np.append(True, (at[1:] != at[:-1] + 1) | (script[1:] != script[:-1]))
    first = np.flatnonzero(fresh)
    code = lower[points[at]].astype(np.uint64)
    ends = np.append(fresh[1:], True)
    before = np.where(fresh, np.uint64(0), np.append(np.uint64(0), code[:-1]))
    after = np.where(ends, np.uint64(0), np.append(code[1:], np.uint64(0)))
    mixed = ((before * np.uint64(0x9E3779B97F4A7C15)) ^ (code * np.uint64(0xC2B2AE3D27D4EB4F))
             ^ (after * np.uint64(0x165667B19E3779F9)))
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    begins = np.cumsum(np.append(0, sizes[:-1] + 1))
    text = np.searchsorted(begins, at[first], side="right") - 1
    return Words(text, at[first] - begins[text], at[np.flatnonzero(ends)] + 1 - begins[text],
                 script[first].astype(np.int64), first,
                 ((mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64))


@dataclass
class LanguageModel:
    languages: list[str]      # by name
    table: np.ndarray         # (buckets, languages): log-probability of a letter with its neighbours
    candidates: np.ndarray    # (scripts, languages): the script is one of the language's own
    switch: float = SWITCH

    def word_scores(self, words: Words) -> np.ndarray:
        """(words, languages); languages that do not use the word's script are out of the question."""
        out = np.zeros((len(words.first), len(self.languages)), dtype=np.float32)
        step = max(1, GATHER // max(1, len(self.languages)))
        low = 0
        while low < len(words.first):   # as many whole words as fit, or one
            high = max(low + 1, int(np.searchsorted(words.first, words.first[low] + step)))
            end = words.first[high] if high < len(words.first) else len(words.bucket)
            first = words.first[low:high]
            out[low:high] = np.add.reduceat(self.table[words.bucket[first[0]:end]], first - first[0], axis=0)
            low = high
        may = self.candidates[words.script]
        out[~may] = -1e9
        out[~may.any(axis=1)] = 0.0
        return out

    def label(self, words: Words, n_texts: int) -> np.ndarray:
        """The language of every word: the best path of each text, all texts in step."""
        scores = self.word_scores(words)
        count = np.bincount(words.text, minlength=n_texts)
        offset = np.cumsum(count) - count
        order = np.argsort(-count, kind="stable")
        offset, count = offset[order], count[order]
        active = np.searchsorted(-count, -np.arange(1, count[0] + 1 if len(count) else 1), side="right")
        total = np.zeros((n_texts, len(self.languages)))
        back = np.empty((len(words.first), len(self.languages)), dtype=np.int32)
        own = np.arange(len(self.languages), dtype=np.int32)
        for t, n in enumerate(active):
            stay, at = total[:n], offset[:n] + t
            top = stay.argmax(axis=1)
            moved = np.take_along_axis(stay, top[:, None], axis=1) - self.switch
            change = (stay < moved) if t else np.zeros(stay.shape, dtype=bool)
            back[at] = np.where(change, top[:, None], own)
            total[:n] = np.where(change, moved, stay) + scores[at]
        now, labels = total.argmax(axis=1), np.empty(len(words.first), dtype=np.int64)
        for t in range(len(active) - 1, -1, -1):
            n = active[t]
            at = offset[:n] + t
            labels[at] = now[:n]
            now[:n] = back[at, now[:n]]
        return labels

    def identify(self, texts: list[str | None]) -> tuple[list[str], list[float], list[list[dict]]]:
        """(language, score, spans) of every text."""
        n = len(texts)
        words = words_of(texts, len(self.table))
        if not self.languages or not len(words.first):
            return [UNKNOWN] * n, [0.0] * n, [[] for _ in range(n)]
        labels = self.label(words, n)
        wide = len(self.languages)
        letters = np.bincount(words.text * wide + labels, weights=words.letters, minlength=n * wide).reshape(n, wide)
        all_letters, top = letters.sum(axis=1), letters.argmax(axis=1)
        share = letters[np.arange(n), top] / np.maximum(all_letters, 1)
        spans: list[list[dict]] = [[] for _ in range(n)]
        edge = np.flatnonzero(np.append(True, (labels[1:] != labels[:-1]) | (words.text[1:] != words.text[:-1])))
        for a, b in zip(edge, np.append(edge[1:], len(labels)) - 1):
            spans[words.text[a]].append({"start": int(words.start[a]), "end": int(words.end[b]),
                                         "lang": self.languages[labels[a]]})
        names = [self.languages[i] if k else UNKNOWN for i, k in zip(top, all_letters)]
        return names, share.tolist(), spans


def batches_of(texts: list[str | None], most: int = BATCH_CHARS) -> Iterator[list[str | None]]:
    """``texts`` in runs of about ``most`` characters; a longer text is a run of its own."""
    run, size = [], 0
    for t in texts:
        if run and size + len(t or "") > most:
            yield run
            run, size = [], 0
        run.append(t)
        size += len(t or "")
    if run:
        yield run


def learning_sample(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """(text, lang) of about ``per_language`` documents of every language outside the held-out fold."""
    usable = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    usable = usable.filter("lang IS NOT NULL AND text IS NOT NULL").filter(~held_out(F.col("doc_id"), FOLDS, HELD))
    sizes = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).withColumnRenamed("lang", "__lang")
    keep = hash_unit(F.lit(23), F.col("doc_id")) <= F.lit(float(per_language)) / F.col("n")
    return usable.join(F.broadcast(sizes), F.col("lang") == F.col("__lang")).filter(keep).select("text", "lang")


def learn_languages(docs: DataFrame, per_language: int = PER_LANGUAGE, buckets: int = BUCKETS) -> LanguageModel:
    """Letter counts of a bounded sample, by language and bucket, and by language and script."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            by_lang: dict[str, list] = {}
            for text, lang in zip(b.column("text").to_pylist(), b.column("lang").to_pylist()):
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                for some in batches_of(texts):
                    words = words_of(some, buckets)
                    # letters by bucket, and behind the buckets letters by script
                    found, n = np.unique(np.append(words.bucket, buckets + np.repeat(words.script, words.letters)),
                                         return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), pa.array(found, pa.int64()),
                                                      pa.array(n, pa.int64())], names=["lang", "slot", "n"])

    sample = learning_sample(docs, per_language)
    counts = (sample.mapInArrow(count, "lang string, slot bigint, n bigint").groupBy("lang", "slot").agg(F.sum("n").alias("n")))
    found = stage(counts, "language-counts").toArrow()   # at most buckets + scripts rows a language
    languages = sorted(set(found.column("lang").to_pylist()))
    slots = np.zeros((buckets + OTHER + 1, len(languages)))
    place = {name: i for i, name in enumerate(languages)}
    slots[found.column("slot").to_numpy(), [place[x] for x in found.column("lang").to_pylist()]] = found.column("n").to_numpy()
    letters, scripts = slots[:buckets], slots[buckets:]
    table = np.log((letters + SMOOTHING) / (letters.sum(axis=0) + SMOOTHING * buckets)).astype(np.float32)
    return LanguageModel(languages, table, (scripts > 0) & (scripts >= SCRIPT_SHARE * scripts.sum(axis=0)))


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
                                  T.StructField("lang", T.StringType())]))
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))


def identify_languages(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """All rows and columns of ``docs`` plus lang_pred, lang_score and lang_spans (start, end in code points)."""
    new = ["lang_pred", "lang_score", "lang_spans"]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop(*new)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names, scores, spans = [], [], []
            for some in batches_of(b.column("text").to_pylist()):
                for whole, part in zip((names, scores, spans), shared.value.identify(some)):
                    whole += part
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64()),
                                              pa.array(spans, _SPANS)], names=[*b.schema.names, *new])

    schema = T.StructType([*docs.schema.fields, T.StructField(new[0], T.StringType()), T.StructField(new[1], T.DoubleType()),
                           T.StructField(new[2], SPANS)])
    return docs.mapInArrow(run, schema)


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learn_languages(docs)
    return identify_languages(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id"), FOLDS, HELD).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"),
        F.size("lang_spans").alias("n_spans"))
