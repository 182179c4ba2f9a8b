"""Recorded success against actual output, and work still to do."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from paperledger.functions.paths import (
    CANONICAL, CONTENT_LIST_NAME, FLAT, NESTED, OUTPUT_SUBDIRS, bare_path, with_output_path,
)
from paperledger.operators.skew import detached
from paperledger.schema import ATTEMPT, COMPLETED, FAILED, conform

INPUT_MISSING = "PDF file not found"
KLL_K = 800
THETA_LG_K = 14
BANDS = (0.05, 0.25, 0.5, 0.75, 0.95)


def _flags(attempts: DataFrame, outputs: DataFrame) -> DataFrame:
    """One row per id that was ever completed or has an output: `pmid, recorded, has_output`.

    Both sides go through one aggregate on the id: a single shuffle, with each task's
    duplicates folded before it.
    """
    sides = (
        attempts.filter(F.col("status") == COMPLETED)
        .select("pmid", F.lit(True).alias("recorded"), F.lit(False).alias("has_output"))
        .unionAll(outputs.select("pmid", F.lit(False), F.lit(True)))
    )
    return (
        sides.filter("pmid IS NOT NULL").groupBy("pmid")
        .agg(F.bool_or("recorded").alias("recorded"), F.bool_or("has_output").alias("has_output"))
    )


def completion_audit(attempts: DataFrame, outputs: DataFrame) -> DataFrame:
    """One row over distinct ids: completed, with_output, overlap, missing, unrecorded, missing_pct."""
    recorded, has_output = F.col("recorded"), F.col("has_output")
    counts = _flags(attempts, outputs).agg(
        F.count_if(recorded).alias("completed"),
        F.count_if(has_output).alias("with_output"),
        F.count_if(recorded & has_output).alias("overlap"),
        F.count_if(recorded & ~has_output).alias("missing"),
        F.count_if(~recorded & has_output).alias("unrecorded"),
    )
    pct = F.when(F.col("completed") > 0, F.round(100.0 * F.col("missing") / F.col("completed"), 1)).otherwise(0.0)
    return counts.withColumn("missing_pct", pct)


def missing_outputs(attempts: DataFrame, outputs: DataFrame) -> DataFrame:
    """Distinct ids recorded as completed without an output: the re-run list."""
    return _flags(attempts, outputs).filter("recorded AND NOT has_output").select("pmid")


def overlapping_outputs(attempts: DataFrame, outputs: DataFrame) -> DataFrame:
    """Distinct ids both recorded as completed and with an output."""
    return _flags(attempts, outputs).filter("recorded AND has_output").select("pmid")


def unrecorded_outputs(attempts: DataFrame, outputs: DataFrame) -> DataFrame:
    """Distinct ids with an output nobody recorded."""
    return _flags(attempts, outputs).filter("has_output AND NOT recorded").select("pmid")


def _completed_with_flag(attempts: DataFrame, outputs: DataFrame, by: Sequence[str | Column]) -> DataFrame:
    """Completed attempts folded to one row per (by, id), with time totals and `has_output`.

    The fold comes before the join, so an id with very many attempts joins as a few rows.
    """
    seconds = F.col("processing_time")
    per_id = attempts.filter((F.col("status") == COMPLETED) & F.col("pmid").isNotNull()).groupBy(*by, "pmid").agg(
        F.count(F.lit(1)).alias("attempts"),
        F.sum(seconds).alias("seconds"),
        F.count(seconds).alias("timed"),
    )
    found = outputs.select("pmid").distinct().withColumn("has_output", F.lit(True))
    return per_id.join(found, "pmid", "left").withColumn("has_output", F.col("has_output").isNotNull())


def failure_by_node(attempts: DataFrame, outputs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Per node prefix and its GPU type: chunks, completed, with output, silent failures, rate, mean time.

    Documents count once per node prefix; the mean is over completed attempts. Prefixes the
    dimension does not know keep a NULL type; attempts without a prefix are a row of their own. `attempts`
    carries `node_prefix` and `chunk_file`.
    """
    stats = _completed_with_flag(attempts, outputs, ["node_prefix"]).groupBy(F.col("node_prefix").alias("class")).agg(
        F.count(F.lit(1)).alias("completed"),
        F.count_if("has_output").alias("with_output"),
        F.count_if(~F.col("has_output")).alias("silent_failures"),
        (F.sum("seconds") / F.sum("timed")).alias("avg_time"),
    )
    chunks = attempts.groupBy("node_prefix").agg(F.count_distinct("chunk_file").alias("chunks"))
    rate = F.round(100.0 * F.col("silent_failures") / F.col("completed"), 1)
    # Joined after the aggregates: one row per node prefix on every side.
    return (
        chunks.join(stats, F.col("node_prefix").eqNullSafe(F.col("class")), "left").join(nodes, "node_prefix", "left")
        .select(
            "node_prefix", "gpu_type", "chunks",
            *[F.coalesce(c, F.lit(0)).alias(c) for c in ("completed", "with_output", "silent_failures")],
            rate.alias("fail_pct"), "avg_time",
        )
    )


def timed_outcomes(attempts: DataFrame, outputs: DataFrame, *keep: str) -> DataFrame:
    """`outcome` (success, silent, failed) and time of each attempt that has a time, and the columns to keep."""
    found = detached(outputs.select("pmid").distinct(), "pmid").withColumn("has_output", F.lit(True))
    # The join only tells success from silent, so attempts that did not complete skip it. An id
    # with very many attempts is a skewed left side, which adaptive execution splits.
    timed = attempts.filter(F.col("processing_time").isNotNull()).select("pmid", "status", "processing_time", *keep)
    done = timed.filter(F.col("status") == COMPLETED).join(found, "pmid", "left").select(
        F.when(F.col("has_output"), F.lit("success")).otherwise(F.lit("silent")).alias("outcome"), "processing_time", *keep
    )
    return done.unionAll(timed.filter(F.col("status") == FAILED).select(F.lit(FAILED).alias("outcome"), "processing_time", *keep))


def time_by_outcome(attempts: DataFrame, outputs: DataFrame, accuracy: int = 100_000) -> DataFrame:
    """Elapsed time by outcome (success, silent, failed): attempts, min, median, max.

    The median is a sketch of bounded size, its rank off by at most 1/accuracy of the group.
    """
    return timed_outcomes(attempts, outputs).groupBy("outcome").agg(
        F.count(F.lit(1)).alias("attempts"),
        F.min("processing_time").alias("min_time"),
        F.percentile_approx("processing_time", 0.5, accuracy).alias("median_time"),
        F.max("processing_time").alias("max_time"),
    )


def time_sketches(attempts: DataFrame, outputs: DataFrame, run: str = "run_id", k: int = KLL_K) -> DataFrame:
    """Elapsed times by run and outcome as a table to keep: attempts, min, max and a KLL sketch of a few kilobytes."""
    return timed_outcomes(attempts, outputs, run).groupBy(run, "outcome").agg(
        F.count(F.lit(1)).alias("attempts"), F.min("processing_time").alias("min_time"), F.max("processing_time").alias("max_time"),
        F.kll_sketch_agg_double(F.col("processing_time").cast("double"), F.lit(k)).alias("times"),
    )


def time_bands(sketches: DataFrame, ranks: Sequence[float] = BANDS, k: int = KLL_K) -> DataFrame:
    """Times by outcome over all runs whose sketches are given: attempts, min, max, and `bands`, the time at each rank.

    No attempt is read again. A band's rank is off by about 2.3 / k^0.9 of the attempts at most, 99 times of 100: 0.6 % for the
    default k.
    """
    merged = sketches.groupBy("outcome").agg(
        F.sum("attempts").alias("attempts"), F.min("min_time").alias("min_time"), F.max("max_time").alias("max_time"),
        F.kll_merge_agg_double("times", F.lit(k)).alias("times"))
    return merged.withColumn("bands", F.kll_sketch_get_quantile_double("times", F.array(*map(F.lit, ranks)))).drop("times")


def audit_sketches(attempts: DataFrame, outputs: DataFrame, run: str, lg_k: int = THETA_LG_K) -> DataFrame:
    """One row for a run, to keep: theta sketches of the ids it completed and of those that have an output."""
    done = attempts.filter(F.col("status") == COMPLETED).select("pmid", F.lit(True).alias("done"))
    sides = done.unionAll(outputs.select("pmid", F.lit(False)))
    return sides.agg(
        F.theta_sketch_agg(F.when(F.col("done"), F.col("pmid")), F.lit(lg_k)).alias("recorded"),
        F.theta_sketch_agg(F.when(~F.col("done"), F.col("pmid")), F.lit(lg_k)).alias("with_output"),
    ).select(F.lit(run).alias("run_id"), "*")


def sketched_audit(sketches: DataFrame, lg_k: int = THETA_LG_K) -> DataFrame:
    """`completion_audit` over all runs whose sketches are given, from one row a run; a new run adds its own and no id is read again.

    Counts are exact up to 2^lg_k ids, beyond off by about 2 / 2^(lg_k / 2) of the larger set: 1.6 % for the default.
    """
    both = sketches.agg(
        F.theta_union_agg("recorded", F.lit(lg_k)).alias("recorded"), F.theta_union_agg("with_output", F.lit(lg_k)).alias("with_output"))
    sets = {
        "completed": F.col("recorded"), "with_output": F.col("with_output"), "overlap": F.theta_intersection("recorded", "with_output"),
        "missing": F.theta_difference("recorded", "with_output"), "unrecorded": F.theta_difference("with_output", "recorded"),
    }
    return both.select(*[F.theta_sketch_estimate(of).alias(name) for name, of in sets.items()])


def existing_ids(
    output_listing: DataFrame, subdirs: Sequence[str] = OUTPUT_SUBDIRS, root: str | None = None
) -> DataFrame:
    """Distinct ids whose folder, in one of the accepted layouts, holds a content list of whatever name.

    `root` restricts the listing to one output folder.
    """
    parsed = with_output_path(output_listing.filter(F.endswith("path", F.lit(CONTENT_LIST_NAME))).select("path"))
    hit = (
        F.col("layout").isin(CANONICAL, NESTED, FLAT)
        & F.col("subdir").isin(*subdirs)
        & ~F.contains("file", F.lit("/"))
    )
    if root is not None:
        hit = hit & (F.col("root") == root.rstrip("/"))
    return detached(parsed.filter(hit).select("pmid").distinct(), "pmid")


def pending_work(
    manifest: DataFrame, output_listing: DataFrame, subdirs: Sequence[str] = OUTPUT_SUBDIRS, root: str | None = None
) -> DataFrame:
    """Manifest rows whose document has no output yet."""
    return manifest.join(existing_ids(output_listing, subdirs, root), "pmid", "left_anti")


def skipped_work(
    manifest: DataFrame, output_listing: DataFrame, subdirs: Sequence[str] = OUTPUT_SUBDIRS, root: str | None = None
) -> DataFrame:
    """Manifest rows whose document has an output already."""
    return manifest.join(existing_ids(output_listing, subdirs, root), "pmid", "left_semi")


def missing_inputs(manifest: DataFrame, listing: DataFrame) -> DataFrame:
    """Failed attempt rows for manifest rows whose file is not listed."""
    files = listing.select(bare_path("path").alias("_bare"))
    gone = manifest.withColumn("_bare", bare_path("pdf_path")).join(files, "_bare", "left_anti")
    return conform(gone, ATTEMPT).withColumns({
        "status": F.lit(FAILED),
        "error_msg": F.concat(F.lit(INPUT_MISSING + ": "), "pdf_path"),
    })
