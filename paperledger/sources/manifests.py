"""Manifests (id and path per document) and id lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from paperledger.functions.text import blank_to_null, stem, strip
from paperledger.schema import MANIFEST, conform
from paperledger.sources.csv_files import CSV_OPTIONS, FILE_ORDER, read_csv_text


def clean_manifest(raw: DataFrame, require_id: bool = True) -> DataFrame:
    """Trimmed rows with a path. Without an id: dropped if `require_id`, else id = file stem."""
    order = tuple(c for c in raw.columns if c not in MANIFEST.names)
    df = conform(raw, MANIFEST, keep=order)
    df = df.withColumns({c: blank_to_null(c) for c in MANIFEST.names}).filter("pdf_path IS NOT NULL")
    if require_id:
        return df.filter("pmid IS NOT NULL")
    return df.withColumn("pmid", F.coalesce("pmid", stem("pdf_path")))


def read_manifest(spark: SparkSession, path: str, require_id: bool = True) -> DataFrame:
    """Manifest CSV as `pmid, pdf_path` and the row's place in the source."""
    return clean_manifest(read_csv_text(spark, path), require_id)


def read_raw_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Every physical row, blank ones too: what `manifest_slice` counts."""
    return conform(read_csv_text(spark, path), MANIFEST, keep=FILE_ORDER)


def read_id_list(spark: SparkSession, path: str) -> DataFrame:
    """One id per line; blank lines and `#` comments do not count."""
    lines = spark.read.text(path).select(strip("value").alias("pmid"))
    return lines.filter((F.col("pmid") != "") & ~F.startswith(F.col("pmid"), F.lit("#")))


def write_manifest(df: DataFrame, path: str) -> bool:
    """`pmid,pdf_path` ordered by id: part files in order, each sorted. Nothing written when empty."""
    rows = df.select(*MANIFEST.names)
    if rows.isEmpty():
        return False
    rows.orderBy("pmid").write.mode("overwrite").options(**CSV_OPTIONS).option("header", True).csv(path)
    return True
