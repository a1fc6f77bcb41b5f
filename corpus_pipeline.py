"""Documents to packed windows: rules, line and near-duplicate removal, mixing, packing.

STAGES are (name, function) in order; each function takes (spark, docs, sf_dir)
and gives a DataFrame that is written as Parquet and read again as the next
one's docs. All but the last give the columns of documents.

The mixture covers: every document that is left is taken at least once, and
small sources up to MOST_PASSES times as often as the largest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyboard.llm import lines, mixing, near, packing, repetition
from tallyboard.llm.common import stored

ENTROPY_SHARE, MOST_PASSES = 0.95, 1.5
#: SQL cannot express fuzzy lines, MinHash candidates or packing; the tests hold run() against a plain version.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return repetition.without_repetitive(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    left = lines.without_repeated_lines(docs)
    changed = left.withColumn("n_chars", F.when(F.col("lines_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("long"))
    return changed.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near.without_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed = mixing.mixed_sources(docs, None, ENTROPY_SHARE, MOST_PASSES, cover=True)
    return mixed.select(*docs.columns)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("minhash_near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("packing", pack_windows),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed windows of documents; every stage's table is written in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
