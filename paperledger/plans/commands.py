"""The whole commands: read the published registry, change it, publish the next version."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from paperledger.functions.paths import bare_path, parent_dir, without_scheme
from paperledger.functions.text import id_prefix
from paperledger.operators import registry as ops
from paperledger.operators.attempts import keep_last, merge_summary, run_summary
from paperledger.operators.audit import INPUT_MISSING, pending_work, skipped_work
from paperledger.operators.extract import (
    TIMEOUT_SECONDS, Backend, Extractor, extract_by_backend, extract_documents, outcome_elements,
)
from paperledger.schema import COMPLETED, FAILED, PENDING
from paperledger.session import shared_dir
from paperledger.sources.attempts import CHUNK_PATTERN, read_attempts, read_results, write_attempts, write_merged
from paperledger.sources.content import write_by_prefix
from paperledger.sources.csv_files import FILE_ORDER
from paperledger.sources.listings import OUTPUT_GLOB, PDF_GLOB_ANY_CASE, ids_from_listing, list_tree, outputs_from_listing
from paperledger.sources.manifests import read_manifest, write_manifest
from paperledger.sources.snapshots import load_registry, publish_registry, query_registry


@dataclass
class Ledger:
    """A registry at `root`. Methods that change it return the version published."""

    spark: SparkSession
    root: str

    def registry(self) -> DataFrame:
        return load_registry(self.spark, self.root)

    def _publish(self, df: DataFrame, note: str) -> int:
        return publish_registry(df, self.root, note)

    def init(self, manifest: str, as_of: datetime) -> int:
        new = read_manifest(self.spark, manifest)
        return self._publish(ops.insert_if_absent(self.registry(), new, as_of, FILE_ORDER), "init")

    def scan_pdfs(self, pdf_dir: str, as_of: datetime) -> int:
        found = ids_from_listing(list_tree(self.spark, pdf_dir, PDF_GLOB_ANY_CASE))
        return self._publish(ops.insert_if_absent(self.registry(), found, as_of, ("pdf_path",)), "scan_pdfs")

    def update(self, results: str, as_of: datetime) -> int:
        return self._publish(ops.apply_results(self.registry(), read_results(self.spark, results), as_of), "update")

    def merge(self, input_dir: str, output: str, pattern: str = CHUNK_PATTERN, as_of: datetime | None = None) -> DataFrame:
        """Write the merged attempts and return their summary; with `as_of` update the registry too.

        The result files are read once and kept as Parquet where all executors can read them.
        """
        kept = f"{shared_dir(self.spark)}/merge-{uuid.uuid4().hex}"
        read_attempts(self.spark, input_dir, pattern).write.parquet(kept)
        attempts = self.spark.read.parquet(kept)
        write_merged(keep_last(attempts).drop("chunk_file", "row_idx"), output)
        if as_of is not None:
            self._publish(ops.apply_results(self.registry(), attempts, as_of), "merge")
        return merge_summary(attempts)

    def scan_outputs(self, output_dir: str, as_of: datetime) -> int:
        outputs = outputs_from_listing(list_tree(self.spark, output_dir, OUTPUT_GLOB))
        return self._publish(ops.complete_from_outputs(self.registry(), outputs, as_of), "scan_outputs")

    def retry_failed(self, as_of: datetime) -> int:
        return self._publish(ops.retry_failed(self.registry(), as_of), "retry_failed")

    def update_sizes(self, pdf_dir: str) -> int:
        return self._publish(ops.backfill_sizes(self.registry(), list_tree(self.spark, pdf_dir)), "update_sizes")

    def demote_missing(self, output_dir: str, as_of: datetime) -> int:
        """Fail what claims to be complete and has no output; where the recorded output is there, that counts.

        A recorded path stands for its file or, as `process` writes them, for the folder that holds it. Records of
        outputs elsewhere are not this folder's to judge.
        """
        listing = list_tree(self.spark, output_dir)
        outputs = outputs_from_listing(listing).select("pmid")
        registry = self.registry()
        places = listing.select("path").unionByName(listing.select(parent_dir("path").alias("path"))).distinct()
        recorded = registry.select("pmid", without_scheme("json_path").alias("path")).filter("path IS NOT NULL")
        there = recorded.join(places, "path", "left_semi").select("pmid")
        root = without_scheme(F.lit(output_dir.rstrip("/") + "/"))
        elsewhere = recorded.filter(F.col("path").startswith("/") & ~F.col("path").startswith(root)).select("pmid")
        outputs = outputs.unionByName(there).unionByName(elsewhere)
        return self._publish(ops.demote_missing(registry, outputs, as_of), "demote_missing")

    def process(
        self,
        extractor: Extractor | Mapping[str, Backend],
        out: str,
        run_id: str,
        as_of: datetime,
        input_listing: DataFrame,
        backend: str | Column = "pipeline",
        timeout_s: float = TIMEOUT_SECONDS,
        partitions: int | None = None,
        output_listing: DataFrame | None = None,
        batches: int = 1,
    ) -> DataFrame:
        """Extract all pending documents, record the attempts, update the registry; return the run's counts.

        `backend` names the extractor's, or, where several are given, is an expression over the registry that chooses one for
        each document. Documents that `output_listing` shows an output for are skipped, and counted as such. Outcomes are written before
        anything is made of them, in `batches` parts by a hash of the id; a run started again under its id
        extracts only what no finished part holds. Attempts go to `{out}/attempts`, elements to
        `{out}/elements/run_id=…` by id prefix.
        """
        chosen = backend if isinstance(backend, Column) else F.lit(backend)
        pending = self.registry().filter(F.col("status") == PENDING).select("pmid", "pdf_path", chosen.alias("backend"))
        skipped = None
        if output_listing is not None:
            skipped = skipped_work(pending, output_listing)
            pending = pending_work(pending, output_listing)
        todo = mark_missing(pending, input_listing)
        folder = f"{out}/outcomes/run_id={run_id}"
        for batch in range(batches):
            stored = f"{folder}/batch={batch}"
            if not is_written(self.spark, stored):
                part = todo.filter(F.pmod(F.xxhash64("pmid"), F.lit(batches)) == batch)
                done = _extracted(part, extractor, backend, timeout_s, "pdf_path", partitions)
                done.join(part.select("pmid", "pdf_path"), "pmid", "left").write.mode("overwrite").parquet(stored)
        outcomes = self.spark.read.parquet(folder).drop("batch")

        elements = f"{out}/elements/run_id={run_id}"
        write_by_prefix(outcome_elements(outcomes), elements)
        place = F.concat(F.lit(f"{elements}/prefix="), id_prefix("pmid"))
        attempts = outcomes.drop("elements").withColumns({
            "json_path": F.when(F.col("status") == COMPLETED, place), "chunk_file": F.lit(run_id), "row_idx": F.lit(0),
        })
        write_attempts(attempts, f"{out}/attempts", run_id)
        self._publish(ops.apply_results(self.registry(), attempts, as_of), f"process {run_id}")
        return run_summary(attempts, skipped)

    def export_pending(self, path: str) -> bool:
        return write_manifest(ops.export_status(self.registry(), PENDING), path)

    def export_failed(self, path: str) -> bool:
        return write_manifest(ops.export_status(self.registry(), FAILED), path)

    def export_by_size(self, path: str, min_mb: float | None = None, max_mb: float | None = None) -> bool:
        return write_manifest(ops.export_by_size(self.registry(), min_mb, max_mb), path)

    def status(self) -> DataFrame:
        return ops.status_counts(self.registry(), total_row=True)

    def mean_time(self) -> DataFrame:
        return ops.avg_time_completed(self.registry())

    def latest_failures(self) -> DataFrame:
        return ops.recent_failures(self.registry())

    def query(self, sql: str) -> DataFrame:
        return query_registry(self.spark, self.registry(), sql)


def is_written(spark: SparkSession, path: str) -> bool:
    """True if a Spark job has finished writing this folder."""
    jvm = spark.sparkContext._jvm
    done = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done)


def mark_missing(manifest: DataFrame, input_listing: DataFrame) -> DataFrame:
    """Adds `known_error`, a message for rows whose file is not listed."""
    files = input_listing.select(bare_path("path").alias("_bare"), F.lit(True).alias("listed")).distinct()
    message = F.when(F.col("listed").isNull(), F.concat(F.lit(INPUT_MISSING + ": "), "pdf_path"))
    marked = manifest.withColumn("_bare", bare_path("pdf_path")).join(files, "_bare", "left")
    return marked.withColumn("known_error", message).drop("listed", "_bare")


def _extracted(
    todo: DataFrame, extractor: Extractor | Mapping[str, Backend], backend: str | Column, timeout_s: float, source: str,
    partitions: int | None,
) -> DataFrame:
    """Outcomes by the one extractor, or by the one that the column `backend` names."""
    if isinstance(extractor, Mapping):
        return extract_by_backend(todo, extractor, timeout_s, source, partitions, known_error="known_error")
    return extract_documents(todo, extractor, backend, timeout_s, source, partitions, known_error="known_error")


def process_manifest(
    manifest: DataFrame,
    input_listing: DataFrame,
    output_listing: DataFrame,
    extractor: Extractor | Mapping[str, Backend],
    backend: str | Column = "pipeline",
    timeout_s: float = TIMEOUT_SECONDS,
    partitions: int | None = None,
    source: str = "pdf_path",
) -> DataFrame:
    """Outcomes of the documents that have no output yet; those whose file is not listed fail at once.

    The extractor is given the column `source`: the path, or the text where the manifest carries it. Where several are given,
    `backend` is an expression over the manifest that chooses one for each document.
    """
    todo = mark_missing(pending_work(manifest, output_listing), input_listing)
    if isinstance(extractor, Mapping):
        todo = todo.withColumn("backend", backend if isinstance(backend, Column) else F.lit(backend))
    return _extracted(todo, extractor, backend, timeout_s, source, partitions)
