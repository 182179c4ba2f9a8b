"""Registry state changes and reports. Each change is registry' = f(registry, input, as_of)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from paperledger.functions.text import REPORT_CHARS, mb_to_bytes, size_band, truncated
from paperledger.operators.attempts import clean_results, keep_first, keep_last
from paperledger.schema import COMPLETED, FAILED, MANIFEST, PENDING, REGISTRY, conform
from paperledger.sources.attempts import ATTEMPT_ORDER

NO_OUTPUT = "No output files generated"


def _time(as_of: datetime | str | Column) -> Column:
    return (as_of if isinstance(as_of, Column) else F.lit(as_of)).cast("timestamp_ntz")


# --- taking documents in ---------------------------------------------------------------

def insert_if_absent(registry: DataFrame, new: DataFrame, as_of, order: tuple[str, ...] = ("pdf_path",)) -> DataFrame:
    """Registry plus the ids of `new` it lacks, as pending; the first row per id in `order` wins.

    The registry's own rows pass through; only its ids are shuffled.
    """
    first = keep_first(new, "pmid", order)
    absent = first.join(registry.select("pmid"), "pmid", "left_anti")
    added = conform(absent, REGISTRY).withColumns({
        "status": F.lit(PENDING), "created_at": _time(as_of), "updated_at": _time(as_of),
    })
    return conform(registry, REGISTRY).unionByName(added)


def ingest_counts(registry: DataFrame, new: DataFrame) -> DataFrame:
    """One row: existing, new, already known and total ids, as insert_if_absent would leave them."""
    sides = registry.select("pmid", F.lit(1).alias("old"), F.lit(0).alias("new")).unionAll(
        new.filter("pmid IS NOT NULL").select("pmid", F.lit(0), F.lit(1))
    )
    ids = sides.groupBy("pmid").agg(F.max("old").alias("old"), F.max("new").alias("new"))
    return ids.agg(
        F.count_if(F.col("old") == 1).alias("existing"),
        F.count_if(F.col("old") == 0).alias("added"),
        F.count_if((F.col("old") == 1) & (F.col("new") == 1)).alias("already_known"),
        F.count(F.lit(1)).alias("total"),
    )


# --- applying results and outputs ------------------------------------------------------

def apply_results(
    registry: DataFrame, attempts: DataFrame, as_of, order: tuple[str, ...] = ATTEMPT_ORDER
) -> DataFrame:
    """Registry with each id's last attempt written over it, NULLs included.

    Ids the registry does not know are ignored; created_at and file_size are kept. The source
    arrives partitioned by id from keep_last, so the join shuffles the registry alone.
    """
    fields = ("status", "json_path", "md_path", "error_msg", "processing_time")
    last = keep_last(clean_results(attempts).select("pmid", *fields, *order), order=order)
    src = last.select("pmid", F.struct(F.col("processing_time").cast("float").alias("processing_time"),
                                       *[f for f in fields if f != "processing_time"]).alias("src"))
    joined = conform(registry, REGISTRY).join(src, "pmid", "left")
    hit = F.col("src").isNotNull()
    changed = {f: F.when(hit, F.col(f"src.{f}")).otherwise(F.col(f)) for f in fields}
    changed["updated_at"] = F.when(hit, _time(as_of)).otherwise(F.col("updated_at"))
    return joined.withColumns(changed).select(*REGISTRY.names)


def complete_from_outputs(registry: DataFrame, outputs: DataFrame, as_of) -> DataFrame:
    """Registry with every id that has an output, and is known not to be completed, completed.

    Takes the paths of the first output by name; keeps the old error and time. A NULL status is
    left alone.
    """
    first = keep_first(outputs.select("pmid", "json_path", "md_path"), "pmid", ("json_path",))
    src = first.select("pmid", F.struct("json_path", "md_path").alias("src"))
    joined = conform(registry, REGISTRY).join(src, "pmid", "left")
    hit = F.col("src").isNotNull() & (F.col("status") != COMPLETED)
    return joined.withColumns({
        "json_path": F.when(hit, F.col("src.json_path")).otherwise(F.col("json_path")),
        "md_path": F.when(hit, F.col("src.md_path")).otherwise(F.col("md_path")),
        "updated_at": F.when(hit, _time(as_of)).otherwise(F.col("updated_at")),
        "status": F.when(hit, F.lit(COMPLETED)).otherwise(F.col("status")),
    }).select(*REGISTRY.names)


def demote_missing(registry: DataFrame, outputs: DataFrame, as_of) -> DataFrame:
    """Registry with every completed id that has no output turned to failed."""
    found = outputs.select("pmid").distinct().withColumn("found", F.lit(True))
    joined = conform(registry, REGISTRY).join(found, "pmid", "left")
    hit = (F.col("status") == COMPLETED) & F.col("found").isNull()
    return joined.withColumns({
        "error_msg": F.when(hit, F.lit(NO_OUTPUT)).otherwise(F.col("error_msg")),
        "updated_at": F.when(hit, _time(as_of)).otherwise(F.col("updated_at")),
        "status": F.when(hit, F.lit(FAILED)).otherwise(F.col("status")),
    }).select(*REGISTRY.names)


def retry_failed(registry: DataFrame, as_of) -> DataFrame:
    """Registry with failed turned to pending, error and time cleared, paths kept."""
    hit = F.col("status") == FAILED
    df = conform(registry, REGISTRY)
    return df.withColumns({
        "error_msg": F.when(hit, F.lit(None)).otherwise(F.col("error_msg")),
        "processing_time": F.when(hit, F.lit(None)).otherwise(F.col("processing_time")),
        "updated_at": F.when(hit, _time(as_of)).otherwise(F.col("updated_at")),
        "status": F.when(hit, F.lit(PENDING)).otherwise(F.col("status")),
    }).select(*REGISTRY.names)


def backfill_sizes(registry: DataFrame, listing: DataFrame) -> DataFrame:
    """Registry with unknown sizes taken from the listing, by path; files not listed stay unknown.

    Rows with a size skip the join, so a mostly complete registry is hardly shuffled.
    """
    df = conform(registry, REGISTRY)
    known = df.filter("file_size IS NOT NULL")
    sizes = listing.select(F.col("path").alias("pdf_path"), F.col("length").alias("found"))
    filled = df.filter("file_size IS NULL").join(sizes, "pdf_path", "left").withColumn("file_size", F.col("found"))
    return known.unionByName(filled.select(*REGISTRY.names))


def backfill_counts(registry: DataFrame, listing: DataFrame) -> DataFrame:
    """One row: rows whose size was unknown, how many the listing fills and how many it lacks."""
    lacking = registry.filter("file_size IS NULL").select("pdf_path")
    sizes = listing.select(F.col("path").alias("pdf_path"), F.lit(True).alias("found"))
    return lacking.join(sizes, "pdf_path", "left").agg(
        F.count(F.lit(1)).alias("unknown"),
        F.count("found").alias("updated"),
        F.count_if(F.col("found").isNull()).alias("missing"),
    )


def duplicate_ids(df: DataFrame, key: str = "pmid") -> DataFrame:
    """Ids that occur more than once: empty for a sound registry."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


# --- reports and exports ---------------------------------------------------------------

def status_counts(registry: DataFrame, total_row: bool = False) -> DataFrame:
    """Count and percent by status, in status order; optionally a last row for the total."""
    counts = registry.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    if total_row:
        counts = registry.rollup("status").agg(F.count(F.lit(1)).alias("n"), F.grouping("status").alias("is_total"))
        counts = counts.withColumn("total", F.expr("max(CASE WHEN is_total = 1 THEN n END) OVER ()"))
        counts = counts.withColumn("status", F.when(F.col("is_total") == 1, F.lit("Total")).otherwise(F.col("status")))
        by = ("is_total", "status")
    else:
        # The window runs over the few rows of the aggregate.
        counts = counts.withColumn("total", F.expr("sum(n) OVER ()"))
        by = ("status",)
    return (
        counts.withColumn("pct", F.when(F.col("total") > 0, F.round(100.0 * F.col("n") / F.col("total"), 1)).otherwise(0.0))
        .orderBy(*by).select("status", "n", "pct")
    )


def avg_time_completed(registry: DataFrame) -> DataFrame:
    """One row: mean time over completed rows with a time, and how many those are."""
    return registry.filter(F.col("status") == COMPLETED).agg(
        F.avg(F.col("processing_time").cast("double")).alias("avg_time"),
        F.count("processing_time").alias("n_timed"),
    )


def recent_failures(registry: DataFrame, k: int = 5) -> DataFrame:
    """The k latest failures with a shortened message."""
    message = F.when(F.col("error_msg").isNull() | (F.col("error_msg") == ""), F.lit("Unknown error"))
    return (
        registry.filter(F.col("status") == FAILED)
        .orderBy(F.desc("updated_at"), "pmid")
        .limit(k)
        .select("pmid", message.otherwise(truncated("error_msg", REPORT_CHARS)).alias("message"), "updated_at")
    )


def export_status(registry: DataFrame, *status: str) -> DataFrame:
    """`pmid, pdf_path` of the rows in any of the given states, ordered by id."""
    return registry.filter(F.col("status").isin(*status)).select(*MANIFEST.names).orderBy("pmid")


def export_by_size(
    registry: DataFrame, min_mb: float | None = None, max_mb: float | None = None, max_exclusive: bool = False
) -> DataFrame:
    """Pending and failed rows of known size within the bounds, both ends included.

    A bound of 0 or None is no bound. `max_exclusive` keeps a file of exactly the upper size out,
    so that neighbouring bands do not share it.
    """
    df = registry.filter(F.col("status").isin(PENDING, FAILED) & F.col("file_size").isNotNull())
    if max_mb:
        top = mb_to_bytes(max_mb)
        df = df.filter(F.col("file_size") < top if max_exclusive else F.col("file_size") <= top)
    if min_mb:
        df = df.filter(F.col("file_size") >= mb_to_bytes(min_mb))
    return df.select(*MANIFEST.names).orderBy("pmid")


def size_histogram(df: DataFrame, size: str = "file_size") -> DataFrame:
    """Count by size band, smallest first; unknown sizes do not count."""
    return (
        df.filter(F.col(size).isNotNull())
        .groupBy(size_band(size).alias("size_band"))
        .agg(F.count(F.lit(1)).alias("n"), F.min(size).alias("min_size"))
        .orderBy("min_size")
        .select("size_band", "n")
    )
