"""The registered corpus queries: each operator over the whole table of documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.llm import (
    bpe,
    conversations,
    hard_negatives,
    language,
    mixing,
    near_join,
    order_minhash,
    pii,
    quality_model,
    quality_rules,
    secrets,
    sharding,
    token_files,
)
from tidemark.llm.common import documents
from tidemark.llm.oracles import CONVERSATIONS, HARD_NEGATIVES


def held_out():
    """The third of the documents, by crc32 of the id as text, that no model learns from."""
    text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(3)) == 1


def op1_quality_rules(spark, sf_dir):
    """Measures, the base rule and the verdict of weak supervision for every document."""
    judged = quality_rules.judge(documents(spark, sf_dir))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    measures = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select(
        "doc_id", *measures, failed.alias("base_failed"), (~failed & (F.col("quality") >= 0.5)).alias("kept"), "quality"
    )


def op2_ngram_jaccard_join(spark, sf_dir):
    """Size of the shingle set and component of links for every document."""
    return near_join.near_groups(documents(spark, sf_dir))


def op3_document_fingerprints(spark, sf_dir):
    """Order MinHash of every text and of its edited text, with likenesses."""
    return order_minhash.fingerprints_with_edits(documents(spark, sf_dir))


def op4_byte_bpe(spark, sf_dir):
    """Ids of every text and what they decode to, as digests."""
    coded = bpe.round_trip(documents(spark, sf_dir).select(F.col("doc_id").cast("long"), "text"))
    listed = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_secret_scans(spark, sf_dir):
    """Counts and spans of secrets in every text."""
    return secrets.report(secrets.scan(documents(spark, sf_dir).select(F.col("doc_id").cast("long"), "text")))


def op6_quality_classifier(spark, sf_dir):
    """Probability of good quality for every document, learned without the held-out third."""
    docs = documents(spark, sf_dir)
    weights = quality_model.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), ~held_out())
    scored = quality_model.score(docs, weights)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_mixing(spark, sf_dir):
    """Words of every document that the mix of sources takes."""
    docs = documents(spark, sf_dir).select("doc_id", "source", "text")
    # Longer documents are somewhat likelier to be repeated.
    mixed = mixing.mix(docs, weight=F.log(2.0 + F.col("size")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op8_language_id(spark, sf_dir):
    """Language of every document, learned without the held-out third."""
    docs = documents(spark, sf_dir)
    found = language.identify(docs.select(F.col("doc_id").cast("long"), "text"), language.learn(docs, ~held_out()))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))


def op9_token_files(spark, sf_dir):
    """Place, number and checksum of the ids of every document, read back from the files."""
    back = token_files.read(token_files.write(documents(spark, sf_dir)))
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op10_sharding(spark, sf_dir):
    """Shard and slot of every document, equal texts together, under the law of equal bytes."""
    placed = sharding.shard(documents(spark, sf_dir).select("doc_id", "text"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_pii(spark, sf_dir):
    """Counts and spans of personal data in every text."""
    return pii.report(pii.scan(documents(spark, sf_dir).select(F.col("doc_id").cast("long"), "text")))


def op12_hard_negatives(spark, sf_dir):
    """The first negatives within the window of each positive of every hundredth vector."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows, label=label, anchor=F.col("vec_id") % 100 == 0)


def op13_conversation_repair(spark, sf_dir):
    """Faults and the cheapest repair of every conversation after its damage."""
    return conversations.damage_and_repair(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES = {
    name: function for name, function in list(globals().items()) if name.startswith("op") and callable(function)
}
SQL = {"op12_hard_negatives": HARD_NEGATIVES, "op13_conversation_repair": CONVERSATIONS}
