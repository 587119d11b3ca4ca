"""Quality rules under weak supervision.

Every rule looks at one measure of a document and votes good (1), bad (-1) or abstains (0).
Expectation-maximisation estimates, without labels, how often each rule is right on good and
on bad documents; the posterior probability of "good" given all votes replaces the usual
filter that demands that all rules pass.  An abstention says nothing.

Plan: one pass over the texts writes a narrow table of measures; votes are column
expressions; their combinations are counted by a partially aggregated ``groupBy`` that has at
most 3 ** rules rows, and only these counts reach the driver.  The posterior is again a
column expression.  Nothing depends on how documents are spread over keys or sources.

Edge cases: a missing text counts as empty, all its measures are 0; rows that repeat get the
same result each; a missing id stays missing; an empty table gives no rows and EM keeps its
starting point; other columns are not touched.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import ship
from tidemark.session import durable

BLANK = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MEASURES = (
    "n_words word_chars n_symbols n_dup_lines n_repeat_words n_lines n_shouted n_marks n_ends n_distinct n_adjacent"
    " n_affixed n_doubled n_other".split()
)


@dataclass(frozen=True)
class Rule:
    """Votes bad where ``value`` is over (or under) ``bad``, good where it keeps ``good``, else abstains."""

    name: str
    value: str
    good: str
    bad: str

    def vote(self) -> Column:
        value = F.expr(self.value)
        frame = F.when(F.expr(f"({self.value}) {self.bad}"), -1).when(F.expr(f"({self.value}) {self.good}"), 1)
        return F.when(value.isNull(), 0).otherwise(frame.otherwise(0)).cast("int").alias(f"vote_{self.name}")


# Each kind of damage shows in several measures, so that rules can confirm each other.
RULES = (
    Rule("symbols", "n_symbols / nullif(n_words, 0)", "< 0.02", "> 0.1"),
    Rule("affixes", "n_affixed / nullif(n_words, 0)", "< 0.02", "> 0.1"),
    Rule("others", "n_other / nullif(word_chars, 0)", "< 0.06", "> 0.09"),
    Rule("doubled", "n_doubled / nullif(n_words, 0)", "< 0.02", "> 0.1"),
    Rule("shouting", "n_shouted / nullif(n_words, 0)", "< 0.1", "> 0.3"),
    Rule("marks", "n_marks / nullif(n_words, 0)", "< 0.05", "> 0.2"),
    Rule("repeats", "n_repeat_words / nullif(n_words, 0)", "< 0.1", "> 0.4"),
    Rule("adjacent", "n_adjacent / nullif(n_words, 0)", "< 0.05", "> 0.2"),
    Rule("lines", "n_dup_lines / nullif(n_lines, 0)", "< 0.2", "> 0.5"),
    Rule("length", "word_chars / nullif(n_words, 0)", "between 2.5 and 12", "not between 1.5 and 20"),
    Rule("sentences", "n_ends / nullif(n_words, 0)", "between 0.01 and 0.5", "not between 0.002 and 0.9"),
)


_AFFIXES = tuple(c.encode() for c in SYMBOLS)
_DOUBLES = tuple(2 * c.encode() for c in SYMBOLS + "!?")
# Letters, white space and everything beyond ASCII; what is left are digits and marks.
_PLAIN = bytes(b for b in range(256) if b > 127 or chr(b).isalpha() or chr(b) in BLANK)


class _Numbers(dict):
    def __missing__(self, word):
        value = self[word] = len(self)
        return value


def repeated_words(numbers: np.ndarray, distinct: int) -> int:
    """Words inside windows of three words that occur twice or more in the text."""
    n = len(numbers)
    if n < 4:
        return 0
    pairs = numbers[:-1] * distinct + numbers[1:]
    if distinct >= 2_000_000:
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, which, count = np.unique(pairs[:-1] * distinct + numbers[2:], return_inverse=True, return_counts=True)
    twice = count[which] > 1
    covered = np.zeros(n, bool)
    for i in range(3):
        covered[i : n - 2 + i] |= twice
    return int(covered.sum())


def measure(text: str | None) -> tuple:
    """The values of ``MEASURES`` for one text."""
    text = text or ""
    raw = text.encode()
    words = raw.split()  # bytes split at ASCII white space only
    lines = [line for line in text.split("\n") if line.strip(BLANK)]
    seen = _Numbers()
    numbers = np.fromiter(map(seen.__getitem__, words), np.int64, len(words))
    marks = raw.translate(None, _PLAIN)
    return (
        len(words),
        len(text) - sum(map(text.count, BLANK)),
        sum(map(raw.count, map(str.encode, SYMBOLS))),
        len(lines) - len(set(lines)),
        repeated_words(numbers, len(seen)),
        len(lines),
        sum(map(bytes.isupper, words)),
        raw.count(b"!") + raw.count(b"?"),
        sum(w.endswith((b".", b"!", b"?")) for w in words),
        len(seen),
        int((numbers[1:] == numbers[:-1]).sum()),
        sum(w.endswith(_AFFIXES) for w in words),
        sum(map(raw.count, _DOUBLES)),
        len(marks),
    )


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [measure(t.as_py()) for t in batch.column(1)]
        columns = [pa.array(c, pa.int64()) for c in zip(*rows)] if rows else [pa.array([], pa.int64())] * len(MEASURES)
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", *MEASURES])


def estimate(votes: np.ndarray, counts: np.ndarray, rounds: int = 200, smooth: float = 0.5) -> tuple:
    """(share of good, right[rule, class]) by expectation-maximisation.

    ``right[j, 1]`` is the accuracy of rule j on good documents, ``right[j, 0]`` on bad ones, given
    that it votes.  Start: a document that any rule calls bad is bad with probability 0.8.
    """
    total = counts.sum()
    good = np.where((votes < 0).any(axis=1), 0.2, 0.95)
    share, right = 0.9, np.full((votes.shape[1], 2), 0.8)
    if not total:
        return share, right
    for _ in range(rounds):
        before = share
        # Smoothing in proportion to the data keeps results alike at every size.
        extra = max(smooth, 1e-4 * total)
        share = float(np.clip((counts * good).sum() / total, 0.01, 0.99))
        for j in range(votes.shape[1]):
            up, down = counts * (votes[:, j] > 0), counts * (votes[:, j] < 0)
            right[j, 1] = ((up * good).sum() + 4 * extra) / (((up + down) * good).sum() + 5 * extra)
            right[j, 0] = ((down * (1 - good)).sum() + extra) / (((up + down) * (1 - good)).sum() + 2 * extra)
            # A rule that votes bad more readily on good documents than on bad ones is no evidence.
            right[j, 0] = max(right[j, 0], 1 - right[j, 1])
        for_good, for_bad = weights(right)
        odds = math.log(share / (1 - share)) + (votes > 0) @ for_good + (votes < 0) @ for_bad
        good = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        if abs(share - before) < 1e-9:
            break
    return share, right


def weights(right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds that a good vote and a bad vote of each rule add."""
    return np.log(right[:, 1] / (1 - right[:, 0])), np.log((1 - right[:, 1]) / right[:, 0])


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Measures, votes and ``quality`` (posterior probability of good) of every row of ``docs``."""
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES)
    names = [f"vote_{r.name}" for r in rules]
    voted = durable(rows.mapInArrow(_measure, schema).select("*", *(r.vote() for r in rules)))
    seen = voted.groupBy(*names).agg(F.count("*").alias("n")).collect()  # at most 3 ** len(rules) rows
    votes = np.array([r[:-1] for r in seen], np.int64).reshape(-1, len(rules))
    share, right = estimate(votes, np.array([r[-1] for r in seen], float))
    for_good, for_bad = weights(right)
    odds = F.lit(math.log(share / (1 - share)))
    for name, up, down in zip(names, for_good.tolist(), for_bad.tolist()):
        odds = odds + F.when(F.col(name) > 0, up).when(F.col(name) < 0, down).otherwise(0.0)
    return voted.withColumn("quality", 1 / (1 + F.exp(-odds)))
