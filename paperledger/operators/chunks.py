"""Row positions, slices and chunks of a manifest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from paperledger.functions.text import blank_to_null, chunk_id, stem
from paperledger.schema import MANIFEST
from paperledger.session import shared_dir
from paperledger.sources.csv_files import FILE_ORDER

CHUNK_SIZE = 100
CLEANUP_CHUNK_SIZE = 500
SLICE_BLOCK = 65_536  # physical rows that a slice counts together
ROW_BITS = 33  # monotonically_increasing_id keeps the row's place in its partition in these bits


def with_row_index(df: DataFrame, order: Sequence[str], name: str = "row_idx") -> DataFrame:
    """Dense 0-based position of each row in the given order, without a one-task window.

    Rows are cut into sorted ranges by sampled bounds; a hash of the whole row breaks ties, and
    the place in the input those of equal rows, which are interchangeable. So neither a common
    prefix nor a repeated row can overload a task. Position = rows in the ranges before + place
    in the range. The ranges are sampled anew each time they are computed, hence the checkpoint:
    both uses must see the same ones, also after an executor is lost.
    """
    shared_dir(df.sparkSession)
    ties = ("_tie", "_place")
    ranged = (
        df.withColumns({"_tie": F.xxhash64(*df.columns), "_place": F.monotonically_increasing_id()})
        .repartitionByRange(*order, *ties).sortWithinPartitions(*order, *ties).drop(*ties)
        .withColumn("_at", F.monotonically_increasing_id())
        .checkpoint()
    )
    part = F.shiftright("_at", ROW_BITS)
    # One row per partition of the step above.
    sizes = ranged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    # Broadcast for a table of two numbers per partition, whatever the number of rows.
    return (
        ranged.withColumn("_part", part).join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + F.col("_at").bitwiseAND((1 << ROW_BITS) - 1))
        .drop("_at", "_part", "_start")
    )


def with_file_index(df: DataFrame, name: str = "row_idx") -> DataFrame:
    """Dense 0-based position in the source, for rows that carry its `FILE_ORDER` columns.

    Rows of one split sit together in order, so a row's place is its split's start plus its
    distance from the split's first row. Only the per-split counts are shuffled. To be applied
    before any filter.
    """
    block = list(FILE_ORDER[:2])
    splits = df.groupBy(*block).agg(F.count(F.lit(1)).alias("_n"), F.min("src_pos").alias("_first"))
    # One row per split of the source, a list the driver holds anyway.
    before = Window.orderBy(*block).rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select(*block, "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return (
        df.join(starts, block)
        .withColumn(name, F.col("_start") + F.col("src_pos") - F.col("_first"))
        .drop("_start", "_first")
    )


def manifest_slice(manifest: DataFrame, start: int = 0, count: int | None = None) -> DataFrame:
    """Skip `start` physical rows, then take `count` rows that have a path; blank id = file stem.

    `manifest` carries `row_idx`, the position among all physical rows.
    """
    rows = (
        manifest.filter(F.col("row_idx") >= start)
        .withColumns({c: blank_to_null(c) for c in MANIFEST.names})
        .filter("pdf_path IS NOT NULL")
        .withColumn("pmid", F.coalesce("pmid", stem("pdf_path")))
        .select(*MANIFEST.names, "row_idx")
    )
    if count is None:
        return rows
    # Accepted rows are counted per block of positions; only the block in which the slice ends is numbered.
    rows = rows.withColumn("_block", F.floor(F.col("row_idx") / SLICE_BLOCK))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("_block").agg(F.count(F.lit(1)).alias("_n"))
    blocks = blocks.withColumn("_left", count - F.coalesce(F.sum("_n").over(before), F.lit(0))).filter("_left > 0")
    rows = rows.join(blocks, "_block")
    nth = F.row_number().over(Window.partitionBy("_block").orderBy("row_idx"))
    ending = rows.filter("_n > _left").withColumn("_nth", nth).filter("_nth <= _left").drop("_nth")
    return rows.filter("_n <= _left").unionByName(ending).drop("_block", "_n", "_left")


def assign_chunks(df: DataFrame, size: int = CHUNK_SIZE, order: Sequence[str] | None = None) -> DataFrame:
    """Adds `chunk_no`, `chunk_id`, `start_index`; rows in `row_idx` order, or in `order` if given."""
    rows = with_row_index(df, order) if order else df
    chunk = F.floor(F.col("row_idx") / F.lit(size))
    return rows.withColumns({
        "chunk_no": chunk, "chunk_id": chunk_id(chunk), "start_index": chunk * size,
    })


def chunk_plan(df: DataFrame, size: int = CHUNK_SIZE, order: Sequence[str] | None = None) -> DataFrame:
    """One row per chunk: number, id, start index, documents, first and last id."""
    return (
        assign_chunks(df, size, order)
        .groupBy("chunk_no", "chunk_id", "start_index")
        .agg(
            F.count(F.lit(1)).alias("n_docs"),
            F.min_by("pmid", "row_idx").alias("first_id"),
            F.max_by("pmid", "row_idx").alias("last_id"),
        )
    )


def trial_chunks(plan: DataFrame, n: int = 5) -> DataFrame:
    """The first n chunks, for a trial run."""
    return plan.filter(F.col("chunk_no") < n)
