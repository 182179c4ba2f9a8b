"""Job logs and GPU samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from paperledger.functions.text import (
    chunk_id, memory_label, node_prefix, safe_double, short_gpu_name, status_from_glyph, strip,
)
from paperledger.operators.skew import detached
from paperledger.schema import GPU_SAMPLE, conform
from paperledger.sources.csv_files import CSV_OPTIONS

# Fixed values -------------------------------------------------------------
LOG_LINE = r"^\[(\d+)/(\d+)\] (✓|✗) (\S+) \(([\d.]+)s\)"
NODE_NAME = r"(cn[0-9]+)"
LOG_FILE = r"swarm_\d+_(\d+)\.o$"
COUNTED = r"^\[(\d+)/\d+\] "
RULE = r"^-{10,}\s*$"
# ---------------------------------------------------------------------------


def read_logs(spark: SparkSession, path: str, glob: str = "swarm_*_*.o") -> DataFrame:
    """Log lines as `chunk_no, line`, the chunk number taken from the file name, and their place."""
    lines = spark.read.option("pathGlobFilter", glob).text(path)
    chunk = F.regexp_extract(F.col("_metadata.file_name"), LOG_FILE, 1).try_cast("long")
    return lines.select(
        chunk.alias("chunk_no"),
        F.col("value").alias("line"),
        F.struct(
            F.col("_metadata.file_name"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()
        ).alias("line_no"),
    )


def parse_log_lines(lines: DataFrame, *keep: str) -> DataFrame:
    """Outcome lines as `chunk_no, n, total, status, pmid, seconds` and the columns to keep; other lines drop out."""
    # One pass of the pattern per line: its groups joined by a tab, which a group cannot hold.
    groups = F.split(F.regexp_replace("line", LOG_LINE + ".*$", "$1\t$2\t$3\t$4\t$5"), "\t")
    return (
        lines.filter(F.col("line").rlike(LOG_LINE))
        .select("chunk_no", *keep, groups.alias("g"))
        .select(
            "chunk_no", *keep,
            F.col("g")[0].try_cast("long").alias("n"),
            F.col("g")[1].try_cast("long").alias("total"),
            status_from_glyph(F.col("g")[2]).alias("status"),
            F.col("g")[3].alias("pmid"),
            safe_double(F.col("g")[4]).alias("seconds"),
        )
    )


def chunk_nodes(lines: DataFrame) -> DataFrame:
    """Node each chunk ran on, `chunk_no, node, node_prefix`: the first one named in its log."""
    named = lines.select("chunk_no", "line_no", F.regexp_extract("line", NODE_NAME, 1).alias("node")).filter("node <> ''")
    return (
        named.groupBy("chunk_no").agg(F.min_by("node", "line_no").alias("node"))
        .withColumn("node_prefix", node_prefix("node"))
    )


def log_islands(lines: DataFrame) -> DataFrame:
    """Counted lines as `chunk_no, run, n, line, line_no, detail`.

    A log may hold several runs of its chunk, one behind the other: where the counter does not grow, the next run begins, numbered
    from 0. `detail` is what follows a counted line up to the next one or a ruler, NULL if nothing does: an error's
    message may take many lines. A chunk's log is one task's: chunks are of bounded size.
    """
    order = Window.partitionBy("chunk_no").orderBy("line_no")
    counter = F.nullif(F.regexp_extract("line", COUNTED, 1), F.lit("")).try_cast("long")
    told = lines.select("chunk_no", "line_no", "line", counter.alias("n"))
    # Only counted lines have a counter: the last one before is that of the counted line before.
    last = F.last("n", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    told = told.withColumn("_falls", (F.col("n") <= last).cast("int"))
    starts = F.col("n").isNotNull() | F.col("line").rlike(RULE)
    here = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    told = told.withColumns({
        "run": F.coalesce(F.sum("_falls").over(here), F.lit(0)), "_island": F.sum(starts.cast("int")).over(here), "_starts": starts})
    # A line before all islands belongs to none.
    islands = told.filter("_island > 0").groupBy("chunk_no", "_island").agg(
        F.max_by(F.struct("run", "n", "line", "line_no"), F.col("_starts").cast("int")).alias("first"),
        F.array_sort(F.collect_list(F.when(~F.col("_starts"), F.struct("line_no", "line")))).alias("rest"))
    detail = F.nullif(F.array_join(F.transform("rest", lambda x: x["line"]), "\n"), F.lit(""))
    return islands.select("chunk_no", "first.*", detail.alias("detail")).filter("n IS NOT NULL")


def log_attempts(lines: DataFrame) -> DataFrame:
    """Attempts as the logs tell them, with the node class their chunk ran on.

    `pmid, status, processing_time, chunk_file, row_idx, run, detail, node_prefix`; the class is NULL where no
    line of the chunk names a node. `row_idx` grows with run and counter, so that the last attempt of a document is one of the
    last run that came to it.
    """
    chunk = chunk_id("chunk_no")
    nodes = chunk_nodes(lines).select(chunk.alias("chunk_file"), "node_prefix")
    outcomes = parse_log_lines(log_islands(lines), "run", "detail").select(
        "pmid", "status", F.col("seconds").alias("processing_time"), chunk.alias("chunk_file"),
        (F.shiftleft(F.col("run").cast("long"), 32) + F.col("n")).alias("row_idx"), F.col("run").cast("long").alias("run"), "detail")
    return outcomes.join(detached(nodes, "chunk_file"), "chunk_file", "left")


def read_gpu_samples(spark: SparkSession, path: str) -> DataFrame:
    """GPU samples from CSV without header, every field trimmed, plus two display labels."""
    raw = spark.read.options(**CSV_OPTIONS).schema(GPU_SAMPLE).csv(path)
    return label_gpu_samples(raw.select(*[strip(c).alias(c) for c in GPU_SAMPLE.names]))


def label_gpu_samples(samples: DataFrame) -> DataFrame:
    df = conform(samples, GPU_SAMPLE, keep=tuple(c for c in samples.columns if c not in GPU_SAMPLE.names))
    return df.withColumns({
        "gpu_short": short_gpu_name("gpu_name"),
        "memory": memory_label("memory_used", "memory_total"),
    })
