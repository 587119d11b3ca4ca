"""From raw documents to token ids: five stages, each reading all that its predecessor kept.

A stage is a function of (spark, docs, sf_dir); its result is written as Parquet and read again
as the next one's ``docs``.  All stages but the last return the columns of the documents they
were given, extra ones included.

1. language ID: learned from the rows of the stage whose id is not held out; documents without
   letters, or without a language that stands out, go.
2. n-gram Jaccard join: of each group of near duplicates the document with the smallest id stays, a
   missing id last; rows of the same id and text are one document, rows that share an id alone or
   have none are told apart by their texts.  Documents without words link with nothing and stay.
3. secret scans: every reported span is replaced by a mark; n_chars follows.  No document goes.
4. mixing: every document occurs as often as the mix takes it, from 0 to 2 times.
5. byte-level BPE: ids of every text, and digests of ids and decoded bytes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.llm import bpe, language, mixing, near_join, secrets
from tidemark.llm.common import WORD, row_key
from tidemark.llm.queries import held_out
from tidemark.session import durable

LEAST_LANGUAGE_SCORE = 0.3


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language.learn(docs, ~held_out())
    # Own names for the columns that pass through, whatever they are called.
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    found = language.identify(plain, model, keep=tuple(plain.columns), text=f"c{docs.columns.index('text')}")
    kept = found.where((F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= LEAST_LANGUAGE_SCORE))
    return kept.select(plain.columns).toDF(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = docs.withColumn("__row", row_key("doc_id", "text"))
    stay = durable(near_join.survivors(rows, F.col("__row")).select(F.col("mark").alias("__row")))
    wordy = F.coalesce(F.col("text").cast("string").rlike(WORD), F.lit(False))
    kept = rows.where(wordy).join(stay, "__row", "left_semi").dropDuplicates(["__row"])
    return kept.unionByName(rows.where(~wordy)).select(docs.columns)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = docs.withColumn("__row", row_key("doc_id", "text"))
    scanned = secrets.scan(rows, keep=("__row",))
    # Rows of one key have one text, and so the same spans.
    found = durable(scanned.where(F.size("found") > 0).dropDuplicates(["__row"]).select("__row", F.col("found").alias("__found")))
    spans = F.coalesce("__found", F.expr("cast(array() as array<struct<start:int,end:int,kind:int>>)"))
    joined = rows.join(found, "__row", "left")
    cleaned = secrets.redact(F.col("text"), spans)
    length = F.when(F.size("__found") > 0, F.char_length(cleaned).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    new = {"text": cleaned, "n_chars": length}
    return joined.select(*(new.get(c, F.col(c)).alias(c) for c in docs.columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = docs.withColumn("__row", row_key("doc_id", "source", "text"))
    mixed = mixing.mix(rows.select("doc_id", "source", "text", "__row"), weight=F.log(2.0 + F.col("size")), keep=("__row",))
    # Rows of one key differ by one copy at most: some have the least number, the others one more.
    times = mixed.groupBy("__row").agg(F.count("*").alias("__n"), F.min("times").alias("__least"), F.sum("times").alias("__all"))
    times = durable(times.where("__all > 0"))
    taken = rows.join(times.where("__n = 1"), "__row").withColumn("__times", F.col("__all").cast("int"))
    if times.where("__n > 1").limit(1).count():
        place = F.row_number().over(Window.partitionBy("__row").orderBy("__n"))
        more = (place <= F.col("__all") - F.col("__n") * F.col("__least")).cast("int")
        several = rows.join(times.where("__n > 1"), "__row").withColumn("__times", (F.col("__least") + more).cast("int"))
        taken = taken.unionByName(several.where("__times > 0"))
    repeated = taken.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times"))))
    return repeated.select(*(F.col(c) for c in docs.columns))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = ("doc_id", "lang", "source")
    coded = bpe.round_trip(docs.select(*kept, "text"), keep=kept)
    listed = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select(
        *kept, F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"), "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("secret_scans", secret_scans),
    ("mixing", mix_sources),
    ("byte_bpe", encode),
]

# A language model and a tokenizer are part of the chain, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the table of documents, each result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
