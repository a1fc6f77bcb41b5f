"""One query for each corpus operator, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import archives, bestfit, crf, dialogues, graph, lines, mixing, near, packing, phrases, pseudonyms, repetition, spellings
from .common import scratch

TOKENIZER = "word_bpe_49k.json"
#: Parameters of the registered queries.
ENTROPY_SHARE, MOST_REPEATS, MIX_SEED = 0.99, 4.0, "mix"
MAX_COVERED, MAX_LONGEST = 0.30, 60
PSEUDONYM_KEY = "demonstration key"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), TOKENIZER)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each time that the mixture takes a document."""
    docs = _table(spark, sf_dir, "documents")
    taken = mixing.mixed_sources(docs, None, ENTROPY_SHARE, MOST_REPEATS, seed=MIX_SEED)
    return taken.select("doc_id", "source", F.col("mix_tokens").alias("n_tokens"), F.col("mix_epoch").alias("epoch"), "mix_order")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrases.without_repeats(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op5_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, the text with pseudonyms, and how many values of each kind were replaced."""
    done = pseudonyms.pseudonymised(_table(spark, sf_dir, "documents"), PSEUDONYM_KEY)
    counts = [F.col("pii_counts")[kind].alias(f"n_{kind}") for kind in pseudonyms.PATTERNS | pseudonyms.SECRETS]
    return done.select("doc_id", "text", *counts)


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crf.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repetition.repetition_rules(_table(spark, sf_dir, "documents"), MAX_COVERED, MAX_LONGEST)
    return found.drop("longest_repeat")


def op8_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.linked_vectors(_table(spark, sf_dir, "embeddings"))


def op9_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bestfit.pack_ids(_table(spark, sf_dir, "documents"), TOKENIZER)


def op10_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, the lines there were and how many went, and a digest of the text that is left."""
    docs = _table(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit(""))
    breaks = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit("")))
    counted = docs.withColumn("n_lines", (breaks + 1).cast("long"))
    left = lines.without_repeated_lines(counted)
    return left.select("doc_id", "n_lines", F.col("lines_removed").alias("n_removed"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spellings.spelling_variants(_table(spark, sf_dir, "documents"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the pages as archives in the shared folder and reads them back."""
    folder = scratch(spark, "archives")
    archives.write_archives(_table(spark, sf_dir, "pages"), folder)
    found = archives.records(archives.read_archives(spark, folder))
    return found.select(
        archives.page_of("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        archives.page_of("refers_to").alias("refers_to"),
    )


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogues.conversation_trie(_table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_packing,
        op2_mixing,
        op3_substring_dedup,
        op4_minhash,
        op5_pseudonyms,
        op6_quality_classifier,
        op7_repetition,
        op8_embeddings,
        op9_token_ids,
        op10_fuzzy_lines,
        op11_spelling_variants,
        op12_warc,
        op13_conversation_trie,
    )
}
