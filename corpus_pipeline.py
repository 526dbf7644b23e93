"""A training corpus from raw documents: STAGES in order, each over all that its predecessor kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a frame; its result is
written as Parquet and read again as the next stage's ``docs``. All but the
last return the columns of ``documents``. Null and empty texts fail the
quality rules; repeated rows count as copies, of which one stays; an empty
table passes through as an empty table.
"""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curata.llm import decontaminate, mixture, ngram_join, pii, quality_cascade
from curata.session import scratch_path
from curata.sources import fs

#: The session setting that holds the secret key of the surrogates.
SURROGATE_KEY = "spark.curata.surrogateKey"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("text").alias("judged_text"))
    return quality_cascade.judge(rows, "judged_text").where("kept").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal or near-equal texts: that of the smallest id."""
    return ngram_join.keep_one(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced; ``n_chars`` follows the text.

    The key comes from the session setting ``SURROGATE_KEY``. Without it the
    key printed in ``pii`` is used, with a warning: fit for trials only.
    """
    key = spark.conf.get(SURROGATE_KEY, None)
    if not key:
        warnings.warn(f"{SURROGATE_KEY} is not set: surrogates are made with a public key", stacklevel=2)
    out = pii.replace(docs, key=key or pii.KEY)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with the words it takes of each (``taken``, repeats counted) and their source's target."""
    return mixture.mix(docs).where("taken > 0")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_leaks", benchmark_leaks),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
]

ORACLE_SQL = None      # groups of near copies and surrogates aren't SQL; see tests/llm/test_pipeline.py


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over ``documents``; results are kept below the shared checkpoint folder, so a lost executor repeats one stage's tasks at most.

    A stage's table goes once the next one is written; the last one stays, as the result reads it.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = scratch_path(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(f"{base}/{k}-{name}")
        docs = spark.read.parquet(f"{base}/{k}-{name}")
        if k:
            fs.delete(spark, f"{base}/{k - 1}-{STAGES[k - 1][0]}")
    return docs
