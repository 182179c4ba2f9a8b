"""Incremental ingest: new result files and new documents as they arrive."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from paperledger.functions.paths import without_scheme
from paperledger.operators.attempts import clean_results
from paperledger.operators.registry import apply_results, insert_if_absent
from paperledger.schema import ATTEMPT, BINARY_FILE
from paperledger.sources.attempts import ATTEMPT_ORDER
from paperledger.sources.csv_files import CSV_OPTIONS, file_place
from paperledger.sources.listings import PDF_GLOB_ANY_CASE, ids_from_listing
from paperledger.sources.snapshots import is_published, load_registry, publish_registry

# Attempts as they stand in the files: text, to be cleaned when applied.
RAW_ATTEMPT = T.StructType([T.StructField(f, T.StringType()) for f in ATTEMPT.names])


def numbered(files: DataFrame) -> DataFrame:
    """Adds `row_idx`, which grows along each file: a file is read whole by one task, in order."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 0
        for batch in batches:
            yield batch.append_column("row_idx", pa.array(range(at, at + len(batch)), pa.int64()))
            at += len(batch)

    return files.mapInArrow(number, T.StructType([*files.schema.fields, T.StructField("row_idx", T.LongType())]))


def latest_attempts(attempts: DataFrame) -> DataFrame:
    """Per id its last attempt by (file, row) of all so far, and whether it came with this batch: `pmid, last, is_new`.

    Streamed, the state store keeps one attempt for each id. A later batch changes it only by an attempt that lies behind
    it, whatever order files arrive in; a batch that a restart delivers again meets the state it met before.
    """
    kept = [c for c in attempts.columns if c != "pmid"]
    arrived = attempts.withColumn("arrived", F.current_timestamp())  # one time for a batch, the same if delivered again
    found = arrived.groupBy("pmid").agg(
        F.max_by(F.struct(*kept, "arrived"), F.struct(*ATTEMPT_ORDER)).alias("last"), F.max("arrived").alias("arrived"))
    return found.select("pmid", "last", (F.col("last.arrived") == F.col("arrived")).alias("is_new"))


def apply_batch(changed: DataFrame, batch_id: int, registry_root: str, log: str) -> None:
    """Apply the attempts that are the last of their id and new; they are kept under the number of their batch.

    A stale file so does not undo a retry. A batch delivered again changes nothing: its version is published once.
    """
    spark = changed.sparkSession
    stored, note = f"{log}/batch_id={batch_id}", f"attempts batch {batch_id} of {log}"
    # Written whole and first, published before or not: the state store keeps up only with what is read.
    changed.filter("is_new").select("pmid", "last.*").drop("arrived").write.mode("overwrite").parquet(stored)
    fresh = spark.read.parquet(stored)
    if not is_published(spark, registry_root, note) and not fresh.isEmpty():
        publish_registry(apply_results(load_registry(spark, registry_root), fresh, F.current_timestamp()), registry_root, note)


def ingest_stream(
    spark: SparkSession, src: str, registry_root: str, log: str, checkpoint: str, glob: str = "chunk_*.csv"
) -> StreamingQuery:
    """Apply all result files not yet seen, then stop. `log` belongs to one checkpoint.

    A stream needs its schema beforehand: the files have the columns of ATTEMPT, in that order.
    Files with another header are refused.
    """
    files = (
        spark.readStream.schema(RAW_ATTEMPT).options(**CSV_OPTIONS)
        .option("header", True).option("enforceSchema", False).option("multiLine", True).option("pathGlobFilter", glob).csv(src)
        .select("*", file_place().alias("chunk_file"))
    )
    return (
        latest_attempts(clean_results(numbered(files))).writeStream.outputMode("update")
        .foreachBatch(lambda df, batch_id: apply_batch(df, batch_id, registry_root, log))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def scan_stream(spark: SparkSession, pdf_dir: str, registry_root: str, checkpoint: str) -> StreamingQuery:
    """Take all documents not yet seen into the registry as pending, then stop."""

    def insert(batch: DataFrame, batch_id: int) -> None:
        found = ids_from_listing(batch)
        if not found.isEmpty():
            registry = load_registry(spark, registry_root)
            publish_registry(insert_if_absent(registry, found, F.current_timestamp()), registry_root, f"scan batch {batch_id}")

    listing = (
        spark.readStream.format("binaryFile").schema(BINARY_FILE)
        .option("recursiveFileLookup", True).option("pathGlobFilter", PDF_GLOB_ANY_CASE).load(pdf_dir)
        .select(without_scheme("path").alias("path"), "length")
    )
    return (
        listing.writeStream.foreachBatch(insert).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
