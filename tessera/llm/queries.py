"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

import secrets
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (
    archives, decontaminate, near_dedup, oracle, oracle_words, packing, pii, quality_cnn, quality_rules, sharding, spelling,
    substring_dedup, token_counts, token_files, whitening,
)
from tessera.llm.common import land, read_table
from tessera.session import scratch_dir

#: The longest context a document may fill before op1 flags it.
TOKEN_LIMIT = 2048


def vocabulary(name: str) -> str:
    """Place of a public tokenizer file; the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: Tokenizer ids, keyed pseudonyms, a fitted network and count sketches have no
#: SQL form; those queries are tested against brute-force versions.
ORACLE_SQL: dict[str, str] = {
    "op2_minhash_near_dedup": oracle.NEAR_DEDUP,
    "op6_substring_dedup": oracle.SUBSTRING_DEDUP,
    "op8_arc_to_warc": oracle.ARC_TO_WARC,
    "op10_quality_rules": oracle.QUALITY_RULES,
    "op12_spelling_variants": oracle_words.SPELLING,
    "op13_rendezvous_sharding": oracle_words.SHARDING,
}


def _register(fn):
    QUERIES[fn.__name__] = fn
    return fn


@_register
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count of every whole text, from its prefix table."""
    counted = token_counts.prefix_token_counts(read_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


@_register
def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document at Jaccard >= 0.85."""
    found = near_dedup.near_duplicates(read_table(spark, sf_dir, "documents"), percent=85)
    return found.select("doc_id", "n_shingles", "component_id",
                        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


@_register
def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in which benchmark items are found, one row per item."""
    found = decontaminate.contaminations(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_windows", "item_windows", "verbatim")


#: Session setting with the pseudonym key (Spark redacts settings named so).
PII_KEY = "spark.tessera.pii.secret"
_ONE_TIME_KEYS: dict[str, str] = {}


def pii_key(spark: SparkSession) -> str:
    """The configured key; without one, a random key of this application that is
    kept nowhere: values stay linked within it and can never be traced back."""
    configured = spark.conf.get(PII_KEY, None)
    return configured or _ONE_TIME_KEYS.setdefault(spark.sparkContext.applicationId, secrets.token_hex(32))


@_register
def op4_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text with pseudonyms, and how many values changed."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, pii_key(spark), count_col="n_pseudonyms")


@_register
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coded token files of all documents, read back."""
    ids = land(token_files.token_ids(read_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json")), "op5-ids")
    folder = scratch_dir(spark, "op5-files")
    files = token_files.write_token_files(ids, folder)
    if files.isEmpty():
        return ids.select("doc_id", F.lit(0).cast("bigint").alias("start"), F.lit(0).cast("bigint").alias("n_tokens"),
                          F.lit(0).cast("bigint").alias("ids_crc32"))
    back = token_files.read_token_files(spark, folder)
    return back.join(files.select("part", "seq", "start"), ["part", "seq"]).select(
        "doc_id", (F.col("start") + F.col("in_file")).alias("start"), "n_tokens", F.crc32("ids").alias("ids_crc32"))


@_register
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removed lines and passages of all documents with their offsets and kept occurrence."""
    return substring_dedup.removed_spans(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", "n_words", "kept_doc_id", "kept_start")


@_register
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens."""
    pieces = packing.pack(read_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset", "window", "step_id")


@_register
def op8_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page through ARC files and their conversion to WARC, read back."""
    arcs, warcs = scratch_dir(spark, "op8-arc"), scratch_dir(spark, "op8-warc")
    if archives.write_arc(read_table(spark, sf_dir, "pages"), arcs).isEmpty():
        return spark.createDataFrame([], "page_id bigint, payload_bytes bigint, payload_digest string, "
                                         "record_type string, refers_to bigint")
    archives.convert(spark, arcs, warcs)
    return archives.read_warc(spark, warcs).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@_register
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document by a network fitted on labelled rows."""
    docs = read_table(spark, sf_dir, "documents")
    net = quality_cnn.train(docs, read_table(spark, sf_dir, "labels"))
    return quality_cnn.score(docs, net).select(
        "doc_id", quality_cnn.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= quality_cnn.THRESHOLD).cast("int").alias("predicted"))


@_register
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every document."""
    features = land(quality_rules.document_features(read_table(spark, sf_dir, "documents")), "op10-features")
    return quality_rules.verdicts(features).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@_register
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the leading whitened components of all vectors."""
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


@_register
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near words, form and root of every word of all documents."""
    return spelling.spelling_variants(read_table(spark, sf_dir, "documents")).select(
        "word", "form", "root", "n", "n_near", "form_n")


#: Shards that op13 writes.
SHARDS = 8


@_register
def op13_rendezvous_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard and place in it, from the shards' files."""
    return sharding.shard_digest(read_table(spark, sf_dir, "documents").select("doc_id", "text"), SHARDS)
