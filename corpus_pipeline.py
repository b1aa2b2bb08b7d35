"""The corpus pipeline: five stages over `documents`, each written as Parquet and read by the next.

Every stage takes (spark, docs, sf_dir) and returns what it keeps; all but the last return the columns of docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm.common import cut, free_names, table
from tagloom.llm.decontaminate import find_leaks
from tagloom.llm.minhash import near_duplicates
from tagloom.llm.mixing import ADDED, mix
from tagloom.llm.quality import accepted
from tagloom.llm.token_output import ordered_token_output


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return accepted(docs)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8): the one of the least doc_id.

    Of rows of one doc_id and one group, that of the least hash of text stays, once. Texts without words are copies of
    nothing but equal ones. A row without doc_id cannot stand for a group and stays.
    """
    id_, print_, again = free_names(docs.columns, "doc_id", "text_hash", "text_md5")
    kept = near_duplicates(spark, docs, percent=80).where("kept")
    alone = F.when(F.col("component_key").isNull(), F.col("text_hash"))  # texts without words are in no group
    kept = kept.groupBy(F.col("doc_id").alias(id_), "component_key", alone.alias("alone")).agg(F.min("text_hash").alias(print_)).select(id_, print_)
    first = docs.withColumn(print_, F.xxhash64("text"))
    first = first.join(kept, (first["doc_id"] == kept[id_]) & (first[print_] == kept[print_]), "left_semi")
    first = first.withColumn(again, F.md5("text")).dropDuplicates(["doc_id", print_, again])
    return first.select(*docs.columns).union(docs.where("doc_id is null"))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item was found."""
    id_, print_ = free_names(docs.columns, "leaked_id", "leaked_hash")
    leaks = find_leaks(spark, docs, table(spark, sf_dir, "benchmark")).where("leaked").select(F.col("doc_id").alias(id_), F.col("text_hash").alias(print_))
    return docs.join(leaks, F.col("doc_id").eqNullSafe(F.col(id_)) & (F.xxhash64("text") == F.col(print_)), "left_anti")


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mix: rows are range-partitioned and sorted by position."""
    names = free_names(docs.columns, *ADDED)
    return mix(spark, docs, added=tuple(names)).orderBy(names[-1]).select(*docs.columns)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all documents in the order of the mix, and what was read back from them.

    A table keeps no order, so the places of the mix are worked out again: mixing gives the same rows the same places.
    """
    return ordered_token_output(spark, mix(spark, docs.select("doc_id", "text", "source")), "position")


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", minhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", source_mixing),
    ("token-ID / binary output", token_files),
]

#: Latent semantic retrieval has no SQL form; tests/llm holds the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(spark, stage(spark, docs, sf_dir), name.split()[0])
    return STAGES[-1][1](spark, docs, sf_dir)
