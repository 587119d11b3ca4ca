"""Quality classifier: hashed word n-grams, logistic regression, FTRL-proximal updates.

A document is a bag of hashed n-grams of its words and of its word shapes (letters by case,
digits, marks; a word that repeats the one before has a shape of its own), each weighted by its
share of the text, so that texts of any length compare.  Weights live in one table of
``BUCKETS`` numbers, whatever the vocabulary.

Training: at most ``SAMPLE`` labelled documents, chosen by a hash of the id, are dealt into
``SHARDS`` groups; each runs follow-the-regularised-leader over its documents, and the
weights of the groups are averaged.  The table of weights, one megabyte, is all that reaches the
driver.  Scoring: one pass, a document's score is the sparse dot product of its n-grams.

Edge cases: a missing or empty text has no n-grams and scores the bias; labels of ids that occur
several times, missing labels and missing ids do not train; rows that repeat score alike; without
any labels all scores are 0.5; an empty table gives no rows; other columns are not touched.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import MEMO, ngram_hashes, ship

BUCKETS = 1 << 18
SAMPLE, SHARDS, EPOCHS = 24_000, 8, 3
SCALE = 4.0
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.02, 0.5

_RUNS = re.compile(r"(.)\1+")
_REPEAT = 1


def shape(word: str) -> str:
    """Letters as a or A, digits as 0, the rest as it is; runs shortened to one."""
    kinds = "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word)
    return _RUNS.sub(r"\1", kinds)


class _Words(dict):
    """Hash of the lower-cased word in the high half, of its shape in the low half."""

    def __missing__(self, word: bytes) -> int:
        own = xxhash.xxh32_intdigest(word.lower()) << 32
        value = self[word] = own | (xxhash.xxh32_intdigest(shape(word.decode())) & 0xFFFFFFFE)
        return value


def grams(text: str | None, memo: _Words) -> np.ndarray:
    """Buckets of all n-grams of a text, with repetition."""
    words = (text or "").encode().split()
    if not words:
        return np.zeros(0, np.int64)
    if len(memo) > MEMO:
        memo.clear()
    both = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    own, form = both >> np.uint64(32), both & np.uint64(0xFFFFFFFF)
    form[1:][own[1:] == own[:-1]] = _REPEAT
    kinds = [ngram_hashes(own, 1), ngram_hashes(own, 2)]
    kinds += [ngram_hashes(form + np.uint64(1 << 40), n) for n in (1, 2, 3)]
    return (np.concatenate(kinds) >> np.uint64(20)).astype(np.int64) & (BUCKETS - 1)


def train(texts: list, labels: list[int], epochs: int = EPOCHS) -> np.ndarray:
    """Weights, the bias last, after FTRL over the documents in an order drawn anew each epoch."""
    memo, docs = _Words(), []
    for text in texts:
        found = grams(text, memo)
        index, count = np.unique(found, return_counts=True)
        docs.append((np.r_[index, BUCKETS].astype(np.int32), np.r_[count * (SCALE / max(1, len(found))), 1].astype(np.float32)))
    z, n = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)

    def weights(zi: np.ndarray, ni: np.ndarray) -> np.ndarray:
        shrunk = np.sign(zi) * L1 - zi
        return np.where(np.abs(zi) <= L1, 0.0, shrunk / ((BETA + np.sqrt(ni)) / ALPHA + L2))

    order = np.random.Generator(np.random.PCG64(7))
    for _ in range(epochs):
        for d in order.permutation(len(docs)):
            i, x = docs[d]
            w = weights(z[i], n[i])
            gradient = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - labels[d]) * x
            grown = n[i] + gradient * gradient
            z[i] += gradient - (np.sqrt(grown) - np.sqrt(n[i])) / ALPHA * w
            n[i] = grown
    return weights(z, n).astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, allowed: Column, label: str = "quality", sample: int = SAMPLE) -> np.ndarray:
    """Weights learned from labelled documents for which ``allowed`` (over doc_id) holds.

    Of more than ``sample`` such documents about that many are taken, by a hash of their ids.
    """
    ship(docs.sparkSession)
    marked = labels.select(F.col("doc_id").cast("long"), F.col(label).cast("int").alias("label"))
    marked = marked.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & allowed)
    marked = marked.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
    marked = marked.where("label = other").select("doc_id", "label")
    share = min(1.0, sample / max(1, marked.count()))
    chosen = marked.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(chosen, "doc_id")
    rows = rows.select("text", "label", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(SHARDS)).alias("shard"))

    def learn(table: pa.Table) -> pa.Table:
        data = sorted(zip(table["text"].to_pylist(), table["label"].to_pylist()), key=lambda r: (r[0] is None, r[0] or "", r[1]))
        texts, marks = zip(*data)
        return pa.table({"n": pa.array([len(marks)], pa.int64()), "w": pa.array([train(texts, marks).tobytes()], pa.binary())})

    parts = rows.groupBy("shard").applyInArrow(learn, "n long, w binary").collect()  # SHARDS tables of weights
    if not parts:
        return np.zeros(BUCKETS + 1, np.float32)
    tables = np.stack([np.frombuffer(r["w"], np.float32) for r in parts])
    return np.average(tables, axis=0, weights=[r["n"] for r in parts]).astype(np.float32)


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """(doc_id, score): the probability of label 1 for every row."""
    spark = ship(docs.sparkSession)
    shared = spark.sparkContext.broadcast(weights)  # BUCKETS + 1 numbers, always

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, table = _Words(), shared.value
        for batch in batches:
            scores = []
            for text in batch.column(1):
                found = grams(text.as_py(), memo)
                total = float(table[BUCKETS]) + SCALE * float(table[found].sum(dtype=np.float64)) / max(1, len(found))
                scores.append(1 / (1 + np.exp(-np.clip(total, -35, 35))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, score double")
