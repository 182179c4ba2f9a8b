"""Throughput, storage and GPU use."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from paperledger.functions.paths import artifact_class
from paperledger.functions.text import INTEGER_PATTERN, file_name, strip


def throughput_hourly(attempts: DataFrame) -> DataFrame:
    """Per hour: distinct chunks and attempts recorded."""
    return attempts.filter("processed_at IS NOT NULL").groupBy(
        F.date_trunc("hour", "processed_at").alias("hour")
    ).agg(F.count_distinct("chunk_file").alias("chunks"), F.count(F.lit(1)).alias("documents"))


def storage_by_artifact(artifacts: DataFrame) -> DataFrame:
    """Per kind of output file: files, bytes, documents, and mean bytes per document."""
    # Folded per document first; what remains to be counted is one row per document and kind.
    per_doc = artifacts.groupBy(artifact_class(file_name("path")).alias("artifact"), "pmid").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")
    )
    return per_doc.groupBy("artifact").agg(
        F.sum("files").alias("files"), F.sum("bytes").alias("bytes"), F.count("pmid").alias("documents")
    ).withColumn("bytes_per_doc", F.col("bytes") / F.nullif(F.col("documents"), F.lit(0)))


def gpu_utilization(samples: DataFrame, by: Sequence[str] = ("node", "gpu_name")) -> DataFrame:
    """Samples whose utilization is a whole number: how many, and their mean rounded down."""
    used = strip("utilization")
    return samples.filter(used.rlike(INTEGER_PATTERN)).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_samples"),
        F.call_function("div", F.sum(used.cast("long")), F.count(F.lit(1))).alias("avg_utilization"),
    )
