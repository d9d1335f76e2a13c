"""A training corpus from ``documents``: five stages, each one operator.

Each stage gets what its predecessor kept, written and read again, and all but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm import byte_bpe, decontaminate, line_dedup, near_dup, quality
from tallybook.llm.common import documents, release, stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.accepted(docs)


def shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of three documents or more stay in the last of them; n_chars follows."""
    left = line_dedup.drop_lines(docs).drop("__n_lines", "__n_dropped")
    return left.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in left.columns else left


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: five-word shingles, 0.8 or more."""
    return near_dup.one_each(docs, k=5, percent=80)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item of five words or more go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), min_words=5)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, the ids, and digests of the ids and of what they decode to."""
    return byte_bpe.encode(docs).selectExpr(
        "doc_id", "n_tokens", "ids", "sha2(array_join(transform(ids, i -> string(i)), ' '), 256) as ids_sha256",
        "sha2(decoded, 256) as decoded_sha256")


STAGES = [("quality rules", quality_rules), ("line dedup", shared_lines), ("MinHash near-dedup", near_duplicates),
          ("benchmark decontamination", benchmark_leaks), ("byte-level BPE", encoded)]

#: No SQL says perfect hashes, edit distances and merges; tests/llm hold the
#: stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = documents(spark, sf_dir)
    for name, apply in STAGES[:-1]:
        before, docs = docs, stage(apply(spark, docs, sf_dir), name.replace(" ", "-"))
        release(before)
    return STAGES[-1][1](spark, docs, sf_dir)
