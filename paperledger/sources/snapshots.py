"""Registry persistence: one Parquet snapshot for each version.

`{root}/v=N` is the registry as version N left it; `{root}/published` tells which versions are complete, so that readers never meet
a half-written one. One writer at a time is assumed.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from paperledger.operators.registry import duplicate_ids
from paperledger.schema import REGISTRY, conform, empty

PUBLISHED_SCHEMA = "version long, note string, published_at timestamp"


def published_versions(spark: SparkSession, root: str) -> DataFrame:
    try:
        return spark.read.schema(PUBLISHED_SCHEMA).json(f"{root}/published")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], PUBLISHED_SCHEMA)


def latest_version(spark: SparkSession, root: str) -> int | None:
    return published_versions(spark, root).agg(F.max("version")).first()[0]


def is_published(spark: SparkSession, root: str, note: str) -> bool:
    return not published_versions(spark, root).filter(F.col("note") == note).isEmpty()


def load_registry(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The latest published registry, or the given version; empty if there is none yet."""
    version = latest_version(spark, root) if version is None else version
    if version is None:
        return empty(spark, REGISTRY)
    # Older versions may lack columns added since: they are read as NULL.
    return spark.read.schema(REGISTRY).parquet(f"{root}/v={version}")


def publish_registry(df: DataFrame, root: str, note: str = "", verify: bool = True) -> int:
    """Write `df` as the next version and publish it.

    Rows are sorted by status within files, so that a filter on status skips most row groups.
    With `verify` a registry with repeated ids is refused before it is published.
    """
    spark = df.sparkSession
    version = (latest_version(spark, root) or 0) + 1
    target = f"{root}/v={version}"
    conform(df, REGISTRY).hint("rebalance").sortWithinPartitions("status", "pmid").write.mode("overwrite").parquet(target)
    if verify:
        twice = duplicate_ids(spark.read.schema(REGISTRY).parquet(target)).limit(1).collect()
        if twice:
            raise ValueError(f"id {twice[0][0]} occurs {twice[0][1]} times; version {version} not published")
    row = spark.range(1).select(
        F.lit(version).cast("long").alias("version"), F.lit(note).alias("note"), F.current_timestamp().alias("published_at"))
    row.coalesce(1).write.mode("append").json(f"{root}/published")
    return version


def query_registry(spark: SparkSession, registry: DataFrame, sql: str) -> DataFrame:
    """Free SQL over the registry, which the text names `registry`."""
    registry.createOrReplaceTempView("registry")
    return spark.sql(sql)


def write_tsv(df: DataFrame, path: str) -> None:
    """Tab-separated text with a header, NULL as nothing."""
    df.write.mode("overwrite").options(header=True, sep="\t", nullValue="", emptyValue="").csv(path)
