"""Attempt rows: clean-up, keep-last, and run summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from paperledger.functions.text import blank_to_null, safe_double, strip
from paperledger.schema import ATTEMPT, COMPLETED, FAILED, PENDING, conform
from paperledger.sources.attempts import ATTEMPT_ORDER

SUSPECT_SECONDS = 50.0  # fixed value: a completed run faster than this is suspect


def _seconds(attempts: DataFrame) -> Column:
    """Processing time as a number; text is parsed, a number is taken as it is."""
    if isinstance(attempts.schema["processing_time"].dataType, T.StringType):
        return safe_double("processing_time")
    return F.col("processing_time").cast("double")


def clean_results(attempts: DataFrame) -> DataFrame:
    """Attempts fit for the registry: trimmed, blanks as NULL, times as numbers, rows with an id.

    The status is trimmed but otherwise taken as it is, even empty.
    """
    present = set(attempts.columns)
    order = tuple(c for c in attempts.columns if c not in ATTEMPT.names)
    typed = attempts
    if "processing_time" in present:
        typed = typed.withColumn("processing_time", _seconds(attempts))
    df = conform(typed, ATTEMPT, keep=order)
    return df.withColumns({
        "pmid": strip("pmid"),
        "status": F.coalesce(strip("status"), F.lit("")),
        "json_path": blank_to_null("json_path"),
        "md_path": blank_to_null("md_path"),
        "error_msg": blank_to_null("error_msg"),
    }).filter("pmid <> ''")


def _first_per_key(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """First row per key. Rows with a blank key are set aside.

    Spark turns the filter on row number into a limit per key that each task applies before the
    shuffle: a key with very many rows sends one row per task, no more than any other.
    """
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.filter(strip(key) != "").withColumn("_place", place).filter("_place = 1").drop("_place")


def keep_last(attempts: DataFrame, key: str = "pmid", order: Sequence[str] = ATTEMPT_ORDER) -> DataFrame:
    """Last row per id in (file name, row position) order. Rows without an id are set aside."""
    return _first_per_key(attempts, key, [F.desc(c) for c in order])


def keep_first(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """First row per id in the given order. Rows without an id are set aside."""
    return _first_per_key(df, key, [F.asc(c) for c in order])


def suspect_fast(attempts: DataFrame, threshold_s: float = SUSPECT_SECONDS) -> DataFrame:
    """Completed attempts too fast to be true."""
    return attempts.filter((F.col("status") == COMPLETED) & (F.col("processing_time") < threshold_s))


def _percent(part, total):
    return F.when(total > 0, F.round(100.0 * part / total, 1)).otherwise(F.lit(0.0))


def merge_summary(attempts: DataFrame) -> DataFrame:
    """One row over all attempts, before any de-duplication.

    The mean takes every time that is a number above zero, whatever the status.
    """
    seconds = _seconds(attempts)
    usable = F.when((seconds > 0) & ~F.isnan(seconds), seconds)
    counts = attempts.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col("status") == s).alias(s) for s in (COMPLETED, FAILED, PENDING)],
        F.coalesce(F.avg(usable), F.lit(0.0)).alias("avg_time"),
        F.count_distinct(blank_to_null("pmid")).alias("unique_ids"),
    )
    return counts.select(
        "*", *[_percent(F.col(s), F.col("total")).alias(f"{s}_pct") for s in (COMPLETED, FAILED, PENDING)]
    )


def run_summary(attempts: DataFrame, skipped: DataFrame | None = None) -> DataFrame:
    """One row: completed, failed (whatever is not completed), skipped, and whether all went well."""
    outcome = attempts.select(F.when(F.col("status") == COMPLETED, F.lit(COMPLETED)).otherwise(FAILED).alias("outcome"))
    if skipped is not None:
        outcome = outcome.unionAll(skipped.select(F.lit("skipped").alias("outcome")))
    return outcome.agg(
        *[F.count_if(F.col("outcome") == o).alias(o) for o in (COMPLETED, FAILED, "skipped")]
    ).withColumn("ok", F.col(FAILED) == 0)
