"""The registered queries of the training-data operators."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from cardmill.llm import classifier, conversations, pii, secret_scan, spelling
from cardmill.llm.common import registry, table
from cardmill.llm.exact import exact_dedup
from cardmill.llm.lines import dedup_lines
from cardmill.llm.mixing import mix
from cardmill.llm.packing import pack, token_pieces
from cardmill.llm.quality import quality_rules, train
from cardmill.llm.sharding import minimax_shards
from cardmill.llm.simhash import simhash_groups
from cardmill.llm.tokenfile import read_tokens, write_tokens

QUERIES, query = registry()


def vocabulary(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query
def op1_packing(spark, sf_dir):
    """All documents cut into pieces and packed into sequences of 2,048 ids."""
    pieces = token_pieces(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))
    return pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


@query
def op2_simhash(spark, sf_dir):
    """Near-duplicate group of every document."""
    return simhash_groups(table(spark, sf_dir, "documents")).drop("first")


@query
def op3_pii(spark, sf_dir):
    """Personal data in every document."""
    return pii.digest(pii.personal_data(table(spark, sf_dir, "documents")))


@query
def op4_line_dedup(spark, sf_dir):
    """Lines of every document, those removed, and the hash of what remains."""
    cleaned = dedup_lines(table(spark, sf_dir, "documents"))
    clean = F.sha2(F.coalesce("text", F.lit("")), 256).alias("clean_sha256")
    return cleaned.select("doc_id", "n_lines", "n_removed", F.length("text").cast("long").alias("clean_chars"), clean)


@query
def op5_quality(spark, sf_dir):
    """Verdict of the quality rules on every document."""
    docs = table(spark, sf_dir, "documents")
    return quality_rules(docs, train(docs, table(spark, sf_dir, "labels")))


@query
def op6_token_file(spark, sf_dir):
    """All documents written as token files and read back."""
    path = write_tokens(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))
    return read_tokens(spark, path).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query
def op7_sharding(spark, sf_dir):
    """All documents in 16 shards of nearly equal bytes; equal texts stay together."""
    return minimax_shards(table(spark, sf_dir, "documents")).withColumns(
        {"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")}
    )


@query
def op8_exact_dedup(spark, sf_dir):
    """Class of equal texts of every document."""
    return exact_dedup(table(spark, sf_dir, "documents"))


@query
def op9_mixing(spark, sf_dir):
    """Words that the mix takes of every document."""
    return mix(table(spark, sf_dir, "documents"))


@query
def op10_secret_scan(spark, sf_dir):
    """Secrets in every document."""
    return secret_scan.digest(secret_scan.secret_scan(table(spark, sf_dir, "documents")))


@query
def op11_conversation_repair(spark, sf_dir):
    """Faults of every damaged conversation, its cheapest repair and the hash of what that leaves."""
    rows = table(spark, sf_dir, "conversations")
    repaired, report = conversations.repair(conversations.damaged(rows))
    found = report.join(conversations.digests(repaired).withColumnRenamed("conv_id", "own"), F.col("conv_id").eqNullSafe(F.col("own")), "left")
    found = found.drop("own").withColumnRenamed("conv_id", "own")
    every = rows.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("own")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = F.lit(hashlib.sha256().hexdigest())
    return every.select(
        "conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256")
    )


@query
def op12_spelling_variants(spark, sf_dir):
    """Near words, form and root of every word of the documents."""
    return spelling.variants(spelling.words(table(spark, sf_dir, "documents")))


@query
def op13_quality_classifier(spark, sf_dir):
    """Quality score of every document by a model of the labels that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return classifier.classify(docs, classifier.train(docs, table(spark, sf_dir, "labels")))


ORACLE: dict[str, str] = {
    "op8_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
            FROM documents
        )
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = min(doc_id) OVER w AS kept, text_sha256
        FROM t WINDOW w AS (PARTITION BY text_sha256)
    """,
}
