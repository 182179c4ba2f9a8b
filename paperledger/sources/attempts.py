"""Attempt rows: what each run recorded per document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from paperledger.schema import ATTEMPT, conform
from paperledger.sources.csv_files import CSV_OPTIONS, file_place, files_by_header, place_in_file, read_csv_text

CHUNK_PATTERN = "chunk_*.csv"
ATTEMPT_ORDER = ("chunk_file", "row_idx")
LOGGED = ("backend", "node_prefix")
# An attempt as the log keeps it.
LOG = T.StructType([
    *ATTEMPT.fields, *(T.StructField(c, T.StringType()) for c in LOGGED),
    T.StructField("chunk_file", T.StringType()), T.StructField("row_idx", T.LongType()), T.StructField("run_id", T.StringType()),
])


def read_attempts(spark: SparkSession, path: str | list[str], pattern: str = CHUNK_PATTERN) -> DataFrame:
    """All files of `path` matching `pattern`, CSV or Parquet by its suffix.

    The raw attempt columns as strings, with `chunk_file` and `row_idx` to order them. Columns go by name
    in each file: files with other headers are read in groups of their own, what one lacks is NULL.
    """
    if pattern.endswith(".parquet"):
        df = spark.read.option("pathGlobFilter", pattern).parquet(*([path] if isinstance(path, str) else path))
        names = {c.lower().strip(): c for c in df.columns}
        return df.select(
            *[
                (F.col(f"`{names[n]}`").cast("string") if n in names else F.lit(None).cast("string")).alias(n)
                for n in ATTEMPT.names
            ],
            file_place().alias("chunk_file"),
            F.col("_metadata.row_index").alias("row_idx"),
        )

    def named(files: str | list[str], glob: str | None) -> DataFrame:
        df = read_csv_text(spark, files, glob=glob)
        present = set(df.columns)
        return df.select(
            *[(F.col(n) if n in present else F.lit(None).cast("string")).alias(n) for n in ATTEMPT.names],
            F.col("src_file").alias("chunk_file"),
            place_in_file().alias("row_idx"),
        )

    groups = files_by_header(spark, path, pattern)
    if len(groups) < 2:
        return named(path, pattern)
    return union_attempts(*(named(files, None) for files in groups))


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """One results file or folder, format by suffix."""
    return read_attempts(spark, path, "*.parquet" if path.rstrip("/").endswith(".parquet") else "*.csv")


def union_attempts(*parts: DataFrame) -> DataFrame:
    """Attempts of several sources by column name; a column one of them lacks is NULL there."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def read_attempt_log(spark: SparkSession, path: str) -> DataFrame:
    """Attempts written by `write_attempts`, of all runs, with backend and node class.

    `chunk_file` begins with the run id, so that the last row of an id is one of the last run. Run ids are text.
    """
    df = spark.read.schema(LOG).parquet(path)
    run_first = F.concat_ws("/", "run_id", "chunk_file")
    return df.withColumn("chunk_file", run_first).select(*LOG.names)


def write_attempts(df: DataFrame, path: str, run_id: str, fmt: str = "parquet") -> None:
    """Append one run's attempts under `run_id=…`; rows of other runs are never lost.

    Writing the same run again replaces it, so a repeated write changes nothing.
    """
    log = T.StructType([f for f in LOG.fields if f.name != "run_id"])
    if fmt == "csv":
        log = T.StructType([f for f in log.fields if f.name in ATTEMPT.names or f.name in df.columns])
    out = conform(df, log)
    writer = out.write.mode("overwrite")
    target = f"{path.rstrip('/')}/run_id={run_id}"
    if fmt == "csv":
        writer.options(**CSV_OPTIONS).option("header", True).csv(target)
    else:
        writer.parquet(target)


def write_merged(df: DataFrame, path: str, fmt: str | None = None) -> None:
    """One row per id (see `keep_last`), format by suffix unless given."""
    fmt = fmt or ("csv" if path.endswith(".csv") else "parquet")
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.options(**CSV_OPTIONS).option("header", True).csv(path)
    else:
        writer.parquet(path)
