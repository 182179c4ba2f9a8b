"""One callable per operator: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from paperledger.functions.paths import with_output_path
from paperledger.functions.text import (
    blank_to_null, canonical_latex, id_prefix, local_time, safe_double, size_band, stem,
)
from paperledger.operators import alignment, attempts as att, audit, chunks, compare, content, layout, registry as reg, usage
from paperledger.operators.extract import Backend, extract_documents, outcome_elements, paragraphs
from paperledger.plans.commands import process_manifest
from paperledger.schema import FAILED, PENDING, REGISTRY, conform, empty
from paperledger.session import shared_dir
from paperledger.sources import attempts as src, content as content_io, csv_files, listings, logs, manifests, snapshots
from paperledger.streaming.ingest import ingest_stream
from workload.views import AS_OF, DOC, table, view

Query = Callable[[SparkSession, str], DataFrame]
REGISTERED: dict[str, Query] = {}


def query(f: Query) -> Query:
    REGISTERED[f.__name__] = f
    return f


def scratch(spark: SparkSession) -> str:
    """A new folder where all executors can read and write."""
    return f"{shared_dir(spark)}/run-{uuid.uuid4().hex}"


def _slots(spark: SparkSession) -> int:
    return spark.sparkContext.defaultParallelism


def rounded(df: DataFrame, *cols: str) -> DataFrame:
    """Means rounded to 6 places: sums of doubles depend on the order of the rows."""
    return df.withColumns({c: F.round(c, 6) for c in cols})


def shown(registry: DataFrame) -> DataFrame:
    """A registry for comparison: times as doubles, sizes without NULLs, whether it was touched."""
    return registry.select(
        "pmid", "pdf_path", "json_path", "md_path", "status", "error_msg",
        F.col("processing_time").cast("double").alias("processing_time"),
        F.coalesce("file_size", F.lit(-1)).alias("file_size"),
        (F.col("updated_at") == F.lit(AS_OF).cast("timestamp_ntz")).alias("touched"),
    )


def typed(registry: DataFrame) -> DataFrame:
    return conform(registry, REGISTRY)


# --- registry reports and exports ------------------------------------------------------

@query
def ledger_status(spark, sf):
    """Flagship: attempts merged, applied to the manifest's registry, counted by status."""
    manifest = view(spark, sf, "fx_manifest")
    registry = reg.insert_if_absent(empty(spark, REGISTRY), manifest, AS_OF, ("row_idx",))
    return reg.status_counts(reg.apply_results(registry, view(spark, sf, "fx_raw_attempts"), AS_OF))


@query
def status_counts(spark, sf):
    return reg.status_counts(view(spark, sf, "fx_registry"), total_row=True)


@query
def avg_time_completed(spark, sf):
    return rounded(reg.avg_time_completed(view(spark, sf, "fx_registry")), "avg_time")


@query
def recent_failures(spark, sf):
    return reg.recent_failures(view(spark, sf, "fx_registry")).select("pmid", "message")


@query
def export_pending(spark, sf):
    return reg.export_status(view(spark, sf, "fx_registry"), PENDING)


@query
def export_failed(spark, sf):
    return reg.export_status(view(spark, sf, "fx_registry"), FAILED)


@query
def export_by_size(spark, sf):
    return reg.export_by_size(view(spark, sf, "fx_registry"), min_mb=1, max_mb=5)


@query
def export_by_size_exclusive(spark, sf):
    return reg.export_by_size(view(spark, sf, "fx_registry"), max_mb=5, max_exclusive=True)


@query
def size_histogram(spark, sf):
    return reg.size_histogram(view(spark, sf, "fx_registry"))


# --- registry state changes ------------------------------------------------------------

@query
def insert_if_absent(spark, sf):
    found = listings.ids_from_listing(view(spark, sf, "fx_listing"))
    return shown(reg.insert_if_absent(view(spark, sf, "fx_registry"), found, AS_OF))


@query
def insert_manifest(spark, sf):
    manifest = manifests.clean_manifest(view(spark, sf, "fx_raw_manifest"), require_id=False)
    pending = typed(view(spark, sf, "fx_registry")).filter(F.col("status") != PENDING)
    return shown(reg.insert_if_absent(pending, manifest, AS_OF, ("row_idx",)))


@query
def ingest_counts(spark, sf):
    found = listings.ids_from_listing(view(spark, sf, "fx_listing"))
    return reg.ingest_counts(view(spark, sf, "fx_registry"), found)


@query
def apply_results(spark, sf):
    return shown(reg.apply_results(view(spark, sf, "fx_registry"), view(spark, sf, "fx_raw_attempts"), AS_OF))


@query
def complete_from_outputs(spark, sf):
    outputs = listings.outputs_from_listing(view(spark, sf, "fx_files"))
    return shown(reg.complete_from_outputs(view(spark, sf, "fx_registry"), outputs, AS_OF))


@query
def demote_missing(spark, sf):
    return shown(reg.demote_missing(view(spark, sf, "fx_registry"), view(spark, sf, "fx_outputs"), AS_OF))


@query
def retry_failed(spark, sf):
    return shown(reg.retry_failed(view(spark, sf, "fx_registry"), AS_OF))


@query
def size_backfill(spark, sf):
    return shown(reg.backfill_sizes(view(spark, sf, "fx_registry"), view(spark, sf, "fx_listing")))


@query
def size_backfill_counts(spark, sf):
    return reg.backfill_counts(view(spark, sf, "fx_registry"), view(spark, sf, "fx_listing"))


@query
def duplicate_ids(spark, sf):
    return reg.duplicate_ids(view(spark, sf, "fx_attempts"))


# --- attempts --------------------------------------------------------------------------

@query
def results_clean(spark, sf):
    return att.clean_results(view(spark, sf, "fx_raw_attempts")).select(
        "pmid", "status", "json_path", "md_path", "error_msg", "processing_time", "row_idx"
    )


@query
def attempt_times(spark, sf):
    """Times as the attempts carry them, ISO text, read as times; what is no time is NULL."""
    raw = view(spark, sf, "fx_raw_attempts")
    text = F.when(F.col("row_idx") % 17 == 3, "soon").otherwise(F.concat_ws("T", F.date_format("processed_at", "yyyy-MM-dd"), F.date_format("processed_at", "HH:mm:ss")))
    return raw.select("row_idx", local_time(text).alias("processed_at"))


@query
def merged_results(spark, sf):
    """Merged attempts written as one row per id, read back as a results file."""
    path = f"{scratch(spark)}/merged.parquet"
    attempts = src.read_attempts(spark, _attempt_files(spark, sf), "part-*.csv")
    src.write_merged(att.keep_last(attempts).drop("chunk_file", "row_idx"), path)
    return att.clean_results(src.read_results(spark, path)).select("pmid", "status", "error_msg", "processing_time")


@query
def attempts_mixed_headers(spark, sf):
    """Result files with three headers in one folder, columns by name."""
    path = f"{scratch(spark)}/mixed"
    rows = view(spark, sf, "fx_attempts").select("pmid", "status", "processing_time", "row_idx")
    shapes = {"a": ["pmid", "status"], "b": ["processing_time", "status", "pmid"], "c": ["status", "pmid", "row_idx"]}
    for i, (name, columns) in enumerate(shapes.items()):
        rows.filter(F.col("row_idx") % 3 == i).select(*columns).write.options(**csv_files.CSV_OPTIONS).option("header", True).csv(f"{path}/{name}")
    attempts = src.read_attempts(spark, [f"{path}/{name}" for name in shapes], "part-*.csv")
    return att.clean_results(attempts).groupBy("pmid", "status").agg(F.count(F.lit(1)).alias("n"), F.count("processing_time").alias("timed"))


@query
def merge_keep_last(spark, sf):
    return att.keep_last(att.clean_results(view(spark, sf, "fx_raw_attempts"))).drop("processed_at")


@query
def merge_summary(spark, sf):
    return rounded(att.merge_summary(view(spark, sf, "fx_raw_attempts")), "avg_time")


@query
def run_summary(spark, sf):
    skipped = audit.skipped_work(view(spark, sf, "fx_manifest"), view(spark, sf, "fx_files"))
    return att.run_summary(view(spark, sf, "fx_attempts"), skipped)


@query
def suspect_fast(spark, sf):
    return att.suspect_fast(view(spark, sf, "fx_attempts")).select("pmid", "processing_time", "chunk_file", "row_idx")


# --- manifests, slices, chunks ---------------------------------------------------------

def _manifest_file(spark, sf) -> str:
    """The raw manifest as a CSV folder whose part files and rows follow row_idx."""
    path = f"{scratch(spark)}/manifest"
    (
        view(spark, sf, "fx_raw_manifest").orderBy("row_idx")
        .select(F.col("pmid").alias(" PMID "), F.col("pdf_path").alias("Pdf_Path"))
        .write.options(**csv_files.CSV_OPTIONS).option("header", True)
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    )
    return path


@query
def manifest_strict(spark, sf):
    return manifests.read_manifest(spark, _manifest_file(spark, sf)).select("pmid", "pdf_path")


@query
def manifest_lenient(spark, sf):
    return manifests.read_manifest(spark, _manifest_file(spark, sf), require_id=False).select("pmid", "pdf_path")


@query
def manifest_slice(spark, sf):
    indexed = chunks.with_file_index(manifests.read_raw_manifest(spark, _manifest_file(spark, sf)))
    return chunks.manifest_slice(indexed, start=20, count=100)


@query
def manifest_export(spark, sf):
    path = f"{scratch(spark)}/pending"
    manifests.write_manifest(reg.export_status(view(spark, sf, "fx_registry"), PENDING), path)
    return manifests.read_manifest(spark, path).select("pmid", "pdf_path")


@query
def strict_insert(spark, sf):
    """The registry command `init`: the manifest read strictly, its first row per id inserted where the id is not known."""
    registry = view(spark, sf, "fx_registry").filter("status <> 'pending'")
    new = manifests.read_manifest(spark, _manifest_file(spark, sf))
    return reg.insert_if_absent(typed(registry), new, AS_OF, csv_files.FILE_ORDER).select("pmid", "pdf_path", "status")


@query
def id_list(spark, sf):
    path = f"{scratch(spark)}/ids"
    view(spark, sf, "fx_id_list").write.text(path)
    return manifests.read_id_list(spark, path)


@query
def chunk_assignment(spark, sf):
    return chunks.assign_chunks(view(spark, sf, "fx_manifest").select("pmid", "pdf_path"), 40, ["pmid"]).select(
        "pmid", "row_idx", "chunk_no", "chunk_id", "start_index"
    )


@query
def chunk_plan(spark, sf):
    return chunks.chunk_plan(view(spark, sf, "fx_manifest"))


@query
def cleanup_chunks(spark, sf):
    ids = view(spark, sf, "fx_files").select("pmid").distinct()
    return chunks.chunk_plan(ids, chunks.CLEANUP_CHUNK_SIZE, ["pmid"])


@query
def trial_chunks(spark, sf):
    return chunks.trial_chunks(chunks.chunk_plan(view(spark, sf, "fx_manifest")), 5)


# --- listings, paths, layout -----------------------------------------------------------

@query
def scan_ids(spark, sf):
    return listings.ids_from_listing(view(spark, sf, "fx_listing"))


@query
def stem_ids(spark, sf):
    return listings.with_stem_id(view(spark, sf, "fx_listing"))


@query
def scan_outputs(spark, sf):
    return listings.outputs_from_listing(view(spark, sf, "fx_files"))


@query
def output_paths(spark, sf):
    return with_output_path(view(spark, sf, "fx_files").select("path"))


@query
def layout_plan(spark, sf):
    return layout.layout_plan(view(spark, sf, "fx_files"))


@query
def layout_plan_for_ids(spark, sf):
    return layout.layout_plan(view(spark, sf, "fx_files"), mode="flatten", ids=view(spark, sf, "fx_manifest"))


@query
def pending_work(spark, sf):
    return audit.pending_work(view(spark, sf, "fx_manifest"), view(spark, sf, "fx_files")).select("pmid", "pdf_path")


@query
def missing_inputs(spark, sf):
    gone = audit.missing_inputs(view(spark, sf, "fx_manifest"), view(spark, sf, "fx_listing"))
    return gone.select("pmid", "pdf_path", "status", "error_msg")


@query
def scalar_functions(spark, sf):
    raw = view(spark, sf, "fx_raw_attempts")
    return raw.select(
        "row_idx",
        blank_to_null("pmid").alias("pmid"),
        id_prefix("pmid").alias("prefix"),
        stem("pdf_path").alias("stem"),
        stem("json_path").alias("json_stem"),
        safe_double("processing_time").alias("seconds"),
        size_band(F.floor(safe_double("processing_time") * 100000)).alias("band"),
    )


@query
def latex_canonical(spark, sf):
    return view(spark, sf, "fx_runs").select("pmid", "run", canonical_latex("text").alias("text"))


# --- audits ----------------------------------------------------------------------------

@query
def completion_audit(spark, sf):
    return audit.completion_audit(view(spark, sf, "fx_attempts"), view(spark, sf, "fx_outputs"))


@query
def missing_outputs(spark, sf):
    return audit.missing_outputs(view(spark, sf, "fx_attempts"), view(spark, sf, "fx_outputs"))


@query
def overlapping_outputs(spark, sf):
    return audit.overlapping_outputs(view(spark, sf, "fx_attempts"), view(spark, sf, "fx_outputs"))


@query
def unrecorded_outputs(spark, sf):
    return audit.unrecorded_outputs(view(spark, sf, "fx_attempts"), view(spark, sf, "fx_outputs"))


@query
def failure_by_node(spark, sf):
    df = audit.failure_by_node(
        view(spark, sf, "fx_attempts"), view(spark, sf, "fx_outputs"), view(spark, sf, "fx_nodes")
    )
    return rounded(df, "avg_time")


@query
def time_by_outcome(spark, sf):
    return audit.time_by_outcome(view(spark, sf, "fx_attempts"), view(spark, sf, "fx_outputs"))


@query
def time_bands(spark, sf):
    """Times from sketches kept by run and merged; `within` tells that each band lies where it should among all attempts."""
    attempts = view(spark, sf, "fx_attempts").withColumn("run_id", F.coalesce("backend", F.lit("none")))
    outputs = view(spark, sf, "fx_outputs")
    path = f"{scratch(spark)}/times"
    audit.time_sketches(attempts, outputs).write.parquet(path)
    bands = audit.time_bands(spark.read.parquet(path))
    ranked = bands.select("outcome", "attempts", F.explode(F.arrays_zip(F.col("bands"), F.array(*map(F.lit, audit.BANDS)).alias("rank"))).alias("b"))
    ranked = ranked.select("outcome", "attempts", F.col("b.bands").alias("band"), F.col("b.rank").alias("rank"))
    below = audit.timed_outcomes(attempts, outputs).join(ranked, "outcome").groupBy("outcome", "attempts", "rank").agg(
        F.count_if(F.col("processing_time") <= F.col("band")).alias("n"))
    within = below.groupBy("outcome").agg(F.bool_and(F.abs(F.col("n") / F.col("attempts") - F.col("rank")) <= 0.01 + 1 / F.col("attempts")).alias("within"))
    return bands.drop("bands").join(within, "outcome")


@query
def sketched_audit(spark, sf):
    """The audit from theta sketches of two runs, each kept as one row."""
    path = f"{scratch(spark)}/sketches"
    attempts, outputs = view(spark, sf, "fx_attempts"), view(spark, sf, "fx_outputs")
    first = F.coalesce(F.col("backend") == "pipeline", F.lit(False))
    for run, of, where in (("first", attempts.filter(first), "pmid < '5'"), ("second", attempts.filter(~first), "pmid >= '5'")):
        audit.audit_sketches(of, outputs.filter(where), run).write.mode("append").parquet(path)
    return audit.sketched_audit(spark.read.parquet(path))


# --- comparisons -----------------------------------------------------------------------

@query
def gpu_backend_pivot(spark, sf):
    return rounded(compare.backend_pivot(view(spark, sf, "fx_timings")), *compare.REPORT_BACKENDS, compare.OTHER_BACKEND)


@query
def attempt_timings(spark, sf):
    timings = compare.attempt_timings(view(spark, sf, "fx_attempts"), view(spark, sf, "fx_nodes"))
    return rounded(compare.backend_pivot(timings), *compare.REPORT_BACKENDS, compare.OTHER_BACKEND)


@query
def relative_speed(spark, sf):
    return compare.relative_speed(view(spark, sf, "fx_timings"))


@query
def element_types(spark, sf):
    return compare.element_types(view(spark, sf, "fx_elements"))


@query
def doc_structure(spark, sf):
    return compare.doc_structure(view(spark, sf, "fx_elements"))


@query
def backend_structure(spark, sf):
    df = compare.backend_structure(view(spark, sf, "fx_elements"))
    return rounded(df, "avg_elements", "avg_chars", "avg_md_lines", "avg_json_bytes")


@query
def content_digests(spark, sf):
    return compare.content_digests(view(spark, sf, "fx_elements"), ["pmid", "backend"])


@query
def output_consistency(spark, sf):
    return compare.output_consistency(compare.text_digests(view(spark, sf, "fx_runs")))


@query
def output_consistency_tolerant(spark, sf):
    return compare.backend_consistency(compare.text_digests(view(spark, sf, "fx_runs"), tolerant=True))


@query
def agreeing_runs(spark, sf):
    return compare.agreeing_runs(compare.text_digests(view(spark, sf, "fx_runs"), tolerant=True))


# --- usage -----------------------------------------------------------------------------

@query
def throughput_hourly(spark, sf):
    df = usage.throughput_hourly(view(spark, sf, "fx_attempts"))
    return df.withColumn("hour", F.date_format("hour", "yyyy-MM-dd HH:mm"))


@query
def storage_by_artifact(spark, sf):
    return rounded(usage.storage_by_artifact(view(spark, sf, "fx_files")), "bytes_per_doc")


@query
def gpu_utilization(spark, sf):
    return usage.gpu_utilization(logs.label_gpu_samples(view(spark, sf, "fx_telemetry")), ["node", "gpu_short"])


@query
def gpu_samples(spark, sf):
    path = f"{scratch(spark)}/samples"
    samples = view(spark, sf, "fx_telemetry")
    samples.write.options(**csv_files.CSV_OPTIONS).option("ignoreLeadingWhiteSpace", False).csv(path)
    return logs.read_gpu_samples(spark, path)


@query
def log_lines(spark, sf):
    return logs.parse_log_lines(view(spark, sf, "fx_logs"))


@query
def log_attempts(spark, sf):
    return logs.log_attempts(view(spark, sf, "fx_logs"))


@query
def chunk_nodes(spark, sf):
    return logs.chunk_nodes(view(spark, sf, "fx_logs"))
@query
def run_differences(spark, sf):
    """Elements kept, moved, changed, removed and inserted from each run of a document to the next."""
    runs = view(spark, sf, "fx_element_runs")
    boxed = runs.withColumn("bbox", F.array("x", F.lit(0.0), F.col("x") + 5.0, "height"))
    return alignment.run_differences(alignment.aligned_elements(boxed)).drop("max_drift")


# --- content ---------------------------------------------------------------------------

@query
def page_elements(spark, sf):
    return content.page_elements(table(spark, sf, "pages")).select("page_id", "seq", "type", "text")


@query
def page_outcomes(spark, sf):
    return content.page_outcomes(table(spark, sf, "pages"))


@query
def text_elements(spark, sf):
    return content.text_elements(table(spark, sf, "documents")).select("doc_id", "seq", "type", "text")


def _tree(spark, files: DataFrame) -> str:
    """A new folder with a file for each row (`path`, `body`), written by the tasks that hold the rows."""
    root = f"{scratch(spark)}/tree"

    def put(batches):
        from pyarrow import fs

        system, inner = fs.FileSystem.from_uri(re.sub("^file:/+", "/", root))
        n = 0
        for batch in batches:
            for path, body in zip(batch["path"], batch["body"]):
                system.create_dir(f"{inner}/{path}".rsplit("/", 1)[0])
                with system.open_output_stream(f"{inner}/{path}") as out:
                    out.write((body or "").encode())
            n += len(batch)
        yield pd.DataFrame({"n": [n]})

    files.select("path", "body").repartition(_slots(spark)).mapInPandas(put, "n long").collect()
    return root


@query
def content_elements(spark, sf):
    """Content lists as files, read as element rows with a field that no column is made for; some lists are broken."""
    pages = table(spark, sf, "pages")
    captioned = F.transform(content.html_elements("html"), lambda e: e.withField("img_caption", F.concat(F.lit("page "), F.col("page_id"))))
    name = F.concat(F.col("page_id"), F.lit("_content_list.json"))
    lists = pages.select(name.alias("path"), F.to_json(captioned).alias("body"))
    broken = pages.filter("length(url) % 7 = 0").select(F.concat(F.lit("broken/"), name).alias("path"), F.lit('{"type": "text"}').alias("body"))
    rows = content_io.read_content_lists(spark, _tree(spark, lists.unionByName(broken)))
    return rows.select(
        F.col("pmid").cast("long").alias("page_id"), "seq", "type", "text", F.col("page_idx").cast("long").alias("page_idx"),
        content_io.element_field("img_caption").alias("img_caption"), "error")


@query
def discovered_pdfs(spark, sf):
    """A tree of input files listed by tasks; only names that end in .pdf count."""
    manifest = view(spark, sf, "fx_manifest")
    ending = F.when(F.col("file_size") < 600_000, ".PDF").when(F.col("file_size") < 900_000, ".pdf.part").otherwise(".pdf")
    root = _tree(spark, manifest.select(F.concat(id_prefix("pmid"), F.lit("/"), "pmid", ending).alias("path"), F.col("pmid").alias("body")))
    found = listings.discover_pdfs(spark, root)
    return found.select("pmid", F.replace("pdf_path", F.lit(re.sub("^file:/+", "/", root) + "/"), F.lit("")).alias("pdf_path"))


@query
def extracted_elements(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("pmid"), "text")
    outcomes = extract_documents(docs, paragraphs, source="text", timeout_s=60, partitions=_slots(spark))
    return outcomes.select("pmid", "status", "error_msg", "backend", F.size("elements").cast("long").alias("n_elements"))


@query
def extracted_text(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("pmid"), "text")
    return outcome_elements(extract_documents(docs, paragraphs, source="text", timeout_s=60, partitions=_slots(spark))).select(
        "pmid", "seq", "type", "text"
    )


@query
def processed_manifest(spark, sf):
    """Skip documents with output, fail those without a file, extract the text of the rest."""
    text = table(spark, sf, "documents").select(F.expr(DOC).alias("pmid"), "text")
    manifest = view(spark, sf, "fx_manifest").select("pmid", "pdf_path").join(text, "pmid")
    outcomes = process_manifest(
        manifest, view(spark, sf, "fx_listing"), view(spark, sf, "fx_files"), paragraphs, timeout_s=60,
        partitions=_slots(spark), source="text",
    )
    return outcomes.select("pmid", "status", "error_msg", F.size("elements").cast("long").alias("n_elements"))


def _whole(pmid: str, source: str) -> list:
    return [{"type": "text", "text": source, "page_idx": 0}] if source.strip() else []


@query
def processed_by_backend(spark, sf):
    """As `processed_manifest`, short documents by one backend and long ones by another; one language has a backend nobody knows."""
    docs = table(spark, sf, "documents").select(F.expr(DOC).alias("pmid"), "text", "lang")
    manifest = view(spark, sf, "fx_manifest").join(docs, "pmid")
    chosen = F.when(F.col("lang") == "de", "nova-engine").when(F.col("file_size") < 3_000_000, "pipeline").otherwise("vlm-auto-engine")
    outcomes = process_manifest(
        manifest, view(spark, sf, "fx_listing"), view(spark, sf, "fx_files"),
        {"pipeline": Backend(paragraphs), "vlm-auto-engine": Backend(_whole)}, chosen, timeout_s=60, partitions=_slots(spark), source="text",
    )
    return outcomes.select("pmid", "backend", "status", "error_msg", F.size("elements").cast("long").alias("n_elements"))


# --- files, snapshots, streams ---------------------------------------------------------

def _attempt_files(spark, sf, fmt: str = "csv") -> str:
    """Raw attempts as files whose names and rows follow (chunk_file, row_idx)."""
    path = f"{scratch(spark)}/attempts"
    columns = ["pmid", "pdf_path", "status", "json_path", "md_path", "processing_time", "error_msg", "processed_at"]
    ordered = view(spark, sf, "fx_raw_attempts").orderBy("chunk_file", "row_idx").select(*columns)
    writer = ordered.write.options(**csv_files.CSV_OPTIONS) if fmt == "csv" else ordered.write
    if fmt == "csv":
        writer = writer.options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    writer.format(fmt).save(path)
    return path


@query
def attempts_scan(spark, sf):
    attempts = src.read_attempts(spark, _attempt_files(spark, sf), "part-*.csv")
    return att.clean_results(attempts).select("pmid", "pdf_path", "status", "json_path", "md_path", "error_msg", "processing_time")


@query
def attempts_merged_from_csv(spark, sf):
    attempts = src.read_attempts(spark, _attempt_files(spark, sf), "part-*.csv")
    return att.keep_last(att.clean_results(attempts)).select("pmid", "status", "error_msg", "processing_time")


@query
def attempts_merged_from_parquet(spark, sf):
    attempts = src.read_attempts(spark, _attempt_files(spark, sf, "parquet"), "part-*.parquet")
    return att.keep_last(att.clean_results(attempts)).select("pmid", "status", "error_msg", "processing_time")


@query
def attempt_log(spark, sf):
    """Two runs appended, the second written twice; nothing lost, nothing doubled."""
    path = f"{scratch(spark)}/log"
    attempts = view(spark, sf, "fx_attempts")
    done = F.col("status") == "completed"
    src.write_attempts(attempts.filter(done), path, "first")
    for _ in range(2):
        src.write_attempts(attempts.filter(~done), path, "second")
    return src.read_attempt_log(spark, path).groupBy("run_id", "status").agg(F.count(F.lit(1)).alias("n"))


@query
def output_by_prefix(spark, sf):
    path = f"{scratch(spark)}/by_prefix"
    manifest = view(spark, sf, "fx_manifest")
    content_io.write_by_prefix(manifest, path)
    return content_io.read_by_prefix(spark, path, schema=manifest.schema).groupBy("prefix").agg(F.count(F.lit(1)).alias("n"))


@query
def registry_snapshot(spark, sf):
    root = f"{scratch(spark)}/registry"
    snapshots.publish_registry(view(spark, sf, "fx_registry"), root, "first")
    snapshots.publish_registry(reg.retry_failed(snapshots.load_registry(spark, root), AS_OF), root, "retry")
    return shown(snapshots.load_registry(spark, root))


@query
def registry_query(spark, sf):
    return snapshots.query_registry(
        spark, view(spark, sf, "fx_registry"),
        "SELECT status, count(*) AS n, count(json_path) AS with_json FROM registry GROUP BY status",
    )


@query
def registry_tsv(spark, sf):
    """Free SQL over the registry as tab-separated text, read back."""
    path = f"{scratch(spark)}/tsv"
    found = snapshots.query_registry(spark, view(spark, sf, "fx_registry"), "SELECT pmid, status, error_msg, file_size FROM registry")
    snapshots.write_tsv(found, path)
    return spark.read.options(header=True, sep="\t").csv(path)


@query
def older_registry(spark, sf):
    """A registry written before sizes were kept: they are read as NULL, and filled in."""
    root = f"{scratch(spark)}/registry"
    view(spark, sf, "fx_registry").drop("file_size").write.parquet(f"{root}/v=1")
    spark.range(1).selectExpr("1L AS version", "'old' AS note").write.json(f"{root}/published")
    snapshots.publish_registry(reg.backfill_sizes(snapshots.load_registry(spark, root), view(spark, sf, "fx_listing")), root, "sizes")
    old, new = (snapshots.load_registry(spark, root, v).select("pmid", F.col("file_size").alias(f"size_{v}")) for v in (1, 2))
    return old.join(new, "pmid")


@query
def ingest_attempt_stream(spark, sf):
    """Result files taken in as a stream leave the registry that the batch update leaves."""
    root = scratch(spark)
    snapshots.publish_registry(view(spark, sf, "fx_registry"), f"{root}/registry")
    stream = ingest_stream(
        spark, _attempt_files(spark, sf), f"{root}/registry", f"{root}/log", f"{root}/checkpoint", "part-*.csv"
    )
    stream.awaitTermination()
    return shown(snapshots.load_registry(spark, f"{root}/registry")).drop("touched")
