"""Language identification with spans of mixed-language text.

Every word (a run of letters, with the marks that follow them) gets a score per language from its character bigrams and trigrams,
word boundaries included.  The script of the word narrows the candidates: a language that hardly
ever uses a script in the training texts cannot claim a word in it, as long as another can.
Viterbi then labels the words of a text with one language each, where every switch costs
``SWITCH``; runs of one label are the spans, and the language with most letters is the label
of the document.

Learning counts n-grams by (language, bucket), added up within a task before they move, so what
is shuffled and collected is bounded by languages times buckets, whatever the corpus.  Every
training row counts.  Labelling is one pass without a shuffle.  Most texts are of one language
throughout: if the greatest gains that any two other languages have over it on stretches of words
stay below one switch cost together, the constant path is optimal and Viterbi need not run.

Edge cases: a text that is missing or has no letter is ``und`` with score 0; without any training
row every text is ``und``; rows that repeat get the same label; a missing id stays missing; an
empty table gives no rows.  Ties go to the first language by code point.
"""

from __future__ import annotations

import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import ship
from tidemark.llm.pieces import groups, slices

UNDETERMINED = "und"
BUCKETS = 1 << 16
SWITCH = 15.0  # what a change of language costs, in units of log probability
SMOOTH = 0.5
SCRIPT_SHARE = 0.001  # a language uses a script from this share of its letters on
BARRED = -1000.0
AT_ONCE = 1_000_000  # characters scored together

# First and last code point of the main blocks of each script.
SCRIPTS = {
    "latin": [(0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFB00, 0xFB06), (0xFF21, 0xFF5A)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF), (0xFB1D, 0xFB4F)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F), (0xA8E0, 0xA8FF)],
    "bengali": [(0x980, 0x9FF)],
    "gurmukhi": [(0xA00, 0xA7F)],
    "gujarati": [(0xA80, 0xAFF)],
    "tamil": [(0xB80, 0xBFF)],
    "telugu": [(0xC00, 0xC7F)],
    "kannada": [(0xC80, 0xCFF)],
    "malayalam": [(0xD00, 0xD7F)],
    "sinhala": [(0xD80, 0xDFF)],
    "thai": [(0xE00, 0xE7F)],
    "lao": [(0xE80, 0xEFF)],
    "tibetan": [(0xF00, 0xFFF)],
    "myanmar": [(0x1000, 0x109F)],
    "georgian": [(0x10A0, 0x10FF), (0x1C90, 0x1CBF)],
    "ethiopic": [(0x1200, 0x139F)],
    "khmer": [(0x1780, 0x17FF)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9D)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)],
}
OTHER = len(SCRIPTS)


@lru_cache(maxsize=1)
def _characters() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lower-cased letter or mark or 0, script, whether it is a mark) of every code point."""
    lower, script, mark = np.zeros(0x110000, np.uint32), np.full(0x110000, OTHER, np.uint8), np.zeros(0x110000, bool)
    for c in range(0x110000):
        # Marks after a letter (accents, vowel signs) continue its word.
        if (kind := unicodedata.category(chr(c))[0]) in "LM":
            low = chr(c).lower()
            lower[c] = ord(low) if len(low) == 1 else c
            mark[c] = kind == "M"
    for i, blocks in enumerate(SCRIPTS.values()):
        for first, last in blocks:
            script[first : last + 1] = i
    return lower, script, mark


def _without_leading_marks(now: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """``now`` with 0 for marks that no letter of their run precedes, as behind an emoji."""
    inside = now > 0
    edge = np.diff(np.r_[False, inside, False].astype(np.int8))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    letters = np.r_[np.flatnonzero(inside & ~marks), len(now)]
    first = np.minimum(letters[np.searchsorted(letters, begin)], end)
    late = first > begin
    if not late.any():
        return now
    change = np.zeros(len(now) + 1, np.int64)
    change[begin[late]] += 1
    change[first[late]] -= 1
    return np.where(np.cumsum(change[:-1]) > 0, 0, now)


@dataclass
class Words:
    """The words of several texts: where they stand and the n-grams at every position."""

    begin: np.ndarray  # first position of each word, in the joined texts
    end: np.ndarray
    script: np.ndarray
    text: np.ndarray  # number of the text
    first: np.ndarray  # index into ``grams`` of each word's first n-gram
    grams: np.ndarray  # two buckets at every position of a word and the one after it
    starts: np.ndarray  # first position of each text


def words_of(texts: list[str | None]) -> Words:
    lower, script, mark = _characters()
    raw = "\n".join(t or "" for t in texts) + "\n"
    points = np.frombuffer(raw.encode("utf-32-le"), np.uint32)
    starts = np.r_[0, np.cumsum([len(t or "") + 1 for t in texts])].astype(np.int64)
    now = _without_leading_marks(lower[points], mark[points])
    inside = now > 0
    edge = np.diff(np.r_[False, inside].astype(np.int8))
    begin = np.flatnonzero(edge == 1)
    end = np.flatnonzero(edge == -1)
    # A boundary is code 0; the position after a word ends it and belongs to it.
    counted = inside.copy()
    counted[end] = True
    at = np.flatnonzero(counted)
    c0 = now[at].astype(np.uint64)
    c1 = np.where(at > 0, now[at - 1], 0).astype(np.uint64)
    c2 = np.where((at > 1) & (c1 > 0), now[at - 2], 0).astype(np.uint64)
    two = (c1 << np.uint64(21)) | c0
    three = (c2 << np.uint64(42)) | two
    shift = np.uint64(64 - BUCKETS.bit_length() + 1)
    grams = np.stack(
        [
            ((two + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)) >> shift,
            ((three + np.uint64(1 << 63)) * np.uint64(0xD6E8FEB86659FD93)) >> shift,
        ]
    ).astype(np.int64)
    return Words(
        begin, end, script[points[begin]], np.searchsorted(starts, begin, "right") - 1, np.searchsorted(at, begin), grams, starts
    )


@dataclass
class Model:
    languages: list[str]
    log: np.ndarray  # buckets by languages
    barred: np.ndarray  # scripts by languages: 0, or BARRED for a script the language does not use


_COUNTS = "lang string, bucket int, n long"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """n-grams and, behind the buckets, letters by script, for each language of a task."""
    total: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(BUCKETS + OTHER + 1, np.int64))
    for batch in batches:
        by_lang = defaultdict(list)
        for text, lang in zip(batch.column(0), batch.column(1).to_pylist()):
            by_lang[lang].append(text.as_py())
        for lang, texts in by_lang.items():
            for rows in groups(texts, AT_ONCE):
                words = words_of([texts[i] for i in rows])
                total[lang][:BUCKETS] += np.bincount(words.grams.ravel(), minlength=BUCKETS)
                letters = np.bincount(words.script, words.end - words.begin, OTHER + 1)
                total[lang][BUCKETS:] += letters.astype(np.int64)
    for lang, counts in total.items():
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(some), pa.string()), pa.array(some.astype(np.int32)), pa.array(counts[some])],
            names=["lang", "bucket", "n"],
        )


def learn(docs: DataFrame, allowed: Column) -> Model:
    """The n-gram model of all rows with a language for which ``allowed`` (over doc_id) holds."""
    ship(docs.sparkSession)
    rows = docs.where(allowed).select(F.col("text").cast("string"), F.col("lang").cast("string"))
    counts = rows.where("lang is not null and text is not null").mapInArrow(_count, _COUNTS)
    table = counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()  # languages * buckets rows at most
    lang = np.array(table["lang"].to_pylist(), object)
    languages = sorted(set(lang.tolist()))
    whole = np.zeros((BUCKETS + OTHER + 1, len(languages)))
    if languages:
        index = {x: i for i, x in enumerate(languages)}
        whole[table["bucket"].to_numpy(), [index[x] for x in lang]] = table["n"].to_numpy()
    grams, letters = whole[:BUCKETS], whole[BUCKETS:]
    log = np.log((grams + SMOOTH) / (grams.sum(axis=0) + SMOOTH * BUCKETS))
    uses = letters >= SCRIPT_SHARE * np.maximum(letters.sum(axis=0), 1)
    # A script that no language uses narrows nothing.
    barred = np.where(uses | ~uses.any(axis=1, keepdims=True), 0.0, BARRED)
    return Model(languages, log.astype(np.float32), barred)


def viterbi(scores: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best sequence of columns of ``scores`` (words by languages), paying ``switch`` per change."""
    n, many = scores.shape
    back, best, own = np.empty((n, many), np.int32), scores[0].copy(), np.arange(many)
    for i in range(1, n):
        top = int(best.argmax())
        stay = best >= best[top] - switch
        back[i] = np.where(stay, own, top)
        best = np.where(stay, best, best[top] - switch) + scores[i]
    path = np.empty(n, np.int32)
    path[-1] = best.argmax()
    for i in range(n - 1, 0, -1):
        path[i - 1] = back[i, path[i]]
    return path


def path_of(scores: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """As ``viterbi``; the constant path at once where no stretches of words can pay for changes.

    A path of k stretches in other languages pays k - 1 changes at least, as it may never use the best
    one; neighbours differ, so two languages that gain less than one change together never pay.
    """
    total = scores.sum(axis=0)
    best = int(total.argmax())
    gain = np.cumsum(scores - scores[:, best : best + 1], axis=0)
    low = np.minimum.accumulate(np.vstack([np.zeros(len(total)), gain]), axis=0)[:-1]
    most = np.sort((gain - low).max(axis=0))  # by language; 0 for the best one
    if most[-2:].sum() < switch:
        return np.full(len(scores), best, np.int32)
    return viterbi(scores, switch)


def label(texts: list[str | None], model: Model) -> list[tuple[str, float, list[dict]]]:
    """(language, score, spans) of each text; spans are (start, end, lang) in code points."""
    words = words_of(texts)
    out = [(UNDETERMINED, 0.0, [])] * len(texts)
    if not len(words.begin) or not model.languages:
        return out
    at_each = model.log[words.grams[0]] + model.log[words.grams[1]]
    scores = np.add.reduceat(at_each, words.first, axis=0).astype(np.float64) / 2 + model.barred[words.script]
    cuts = np.searchsorted(words.text, np.arange(len(texts) + 1))
    letters = (words.end - words.begin).astype(np.int64)
    for t in range(len(texts)):
        own = slice(cuts[t], cuts[t + 1])
        if own.start == own.stop:
            continue
        path = path_of(scores[own])
        share = np.bincount(path, letters[own], len(model.languages))
        best = int(share.argmax())
        mine = scores[own][path == best].sum(axis=0)
        sure = 1 / np.exp(np.clip(mine - mine[best], -700, 50)).sum()
        change = np.flatnonzero(np.diff(path)) + 1
        first, last = np.r_[0, change], np.r_[change, len(path)] - 1
        begin = words.begin[own][first] - words.starts[t]
        end = words.end[own][last] - words.starts[t]
        spans = [
            {"start": int(a), "end": int(b), "lang": model.languages[p]}
            for a, b, p in zip(begin, end, path[first])
        ]
        out[t] = (model.languages[best], float(share[best] / share.sum() * min(1.0, sure)), spans)
    return out


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))


def identify(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The columns ``keep`` with ``lang_pred``, ``score`` and ``spans`` of every row of ``docs``."""
    spark = ship(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)  # buckets times languages numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, len(keep)):
                labels, scores, spans = zip(*label(texts, shared.value))
                new = [pa.array(labels, pa.string()), pa.array(scores, pa.float64()), pa.array(spans, _SPANS)]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], *new], names=names)

    named = [f"__{i}" for i in range(len(keep))]
    names = [*named, "lang_pred", "score", "spans"]
    frame = docs.select(*(F.col(c).alias(n) for n, c in zip(named, keep)), F.col(text).cast("string").alias("__text"))
    kinds = [f"{n} {frame.schema[n].dataType.simpleString()}" for n in named]
    found = frame.mapInArrow(run, ", ".join([*kinds, "lang_pred string, score double, spans array<struct<start:int,end:int,lang:string>>"]))
    return found.select(*(F.col(n).alias(c) for n, c in zip(named, keep)), "lang_pred", "score", "spans")
