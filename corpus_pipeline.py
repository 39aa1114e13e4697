"""Corpus pipeline over ``documents``: quality rules, line deduplication, near-duplicates,
benchmark decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; all
but the last return the columns of ``documents``. Rows without a doc_id pass the near-duplicate
stage; an empty table passes through every stage.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strivelake.llm.common import delete_folder, fresh, read_table, scratch_scope, stage
from strivelake.llm.decontaminate import clean_documents
from strivelake.llm.line_dedup import dedup_lines
from strivelake.llm.mixing import mix
from strivelake.llm.quality import filter_quality
from strivelake.llm.setsketch import keep_representatives
from strivelake.session import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised rules keep."""
    return filter_quality(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, later repeated runs cut from their texts; n_chars follows the text."""
    found = dedup_lines(docs)
    if "n_chars" in found.columns:
        found = found.withColumn("n_chars", F.length("text").cast("long"))
    return found


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates."""
    return keep_representatives(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item; decided by each row's own text."""
    return clean_documents(docs, read_table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes words of, with size, source_size, target and taken.

    Rows that share a doc_id share the words taken of it.
    """
    taken = mix(docs).filter("taken > 0").groupBy("doc_id").agg(
        F.max("size").alias("size"), F.max("source_size").alias("source_size"),
        F.max("target").alias("target"), F.max("taken").alias("taken"))
    plain = docs.select(*[c for c in docs.columns
                          if c not in ("size", "source_size", "target", "taken")])
    name = fresh(plain, "__doc_id")
    drawn = stage(taken.withColumnRenamed("doc_id", name), "mixed")
    return plain.join(drawn.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col(name))).drop(name)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

# Expectation maximisation and connected components are not SQL; tests/llm holds run()
# against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what a stage staged, and the table it read, go when its result is written."""
    docs, before = read_table(spark, sf_dir, "documents"), None
    for name, step in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        with scratch_scope(spark):
            found = step(spark, docs, sf_dir)
            found.write.parquet(path)
        docs = spark.read.schema(found.schema).parquet(path)
        if before is not None:
            delete_folder(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
