"""A training corpus from documents: each stage works on what the one before it kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame,
which is written as Parquet and read again as the next one's docs. All but the last return the
columns of documents:

1. ``quality_classifier`` drops documents that score below 0.5; it learns from the labels of the
   documents at hand.
2. ``quality_rules`` drops documents that fail a rule of the current policy.
3. ``near_duplicates`` keeps one document of each group, the one with the smallest doc_id. Of rows
   that repeat a doc_id one stays; rows without a doc_id belong to no group and all stay.
4. ``decontamination`` drops documents in which a benchmark item is found.
5. ``packing`` cuts what is left into sequences of 4096 ids.

All stages share the executors, whose memory grows with each: Arrow batches are bounded by bytes.

Nulls and empty texts are handled as the operators define; a stage that keeps nothing returns an
empty table with its columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dimload.llm import bradley_terry, containment, hilbert_pack, rule_ledger, setjoin
from dimload.llm.queries import tokenizer_path
from dimload.llm.tables import without_leftovers
from dimload.session import bound_batches, remove_path, scratch_path


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return bradley_terry.keep(docs, bradley_terry.fit(docs, labels))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return rule_ledger.keep(docs, rule_ledger.VERSION)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return setjoin.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return containment.keep(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 4096 ids along the Hilbert curve, one row for each piece of a document."""
    return hilbert_pack.pack(docs, tokenizer_path(), size=4096, end_id=2)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]

ORACLE_SQL = None  # a fitted model and a tokenizer decide: tested against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, over the whole documents table. What a stage kept is removed once the next one's is written."""
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        kept = stage(spark, docs, sf_dir)
        with without_leftovers(spark):
            kept.write.parquet(path)
        docs = spark.read.parquet(path)
        if last:
            remove_path(spark, last)
        last = path
    return docs
