"""Where output files lie and where they should: a plan, nothing is moved."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from paperledger.functions.paths import CANONICAL, FLAT, FLAT_NESTED, NESTED, UNKNOWN, with_output_path
from paperledger.operators.skew import detached

MODES = {"move": (FLAT, FLAT_NESTED), "flatten": (NESTED,), "all": (FLAT, FLAT_NESTED, NESTED)}


def layout_plan(output_listing: DataFrame, mode: str = "all", ids: DataFrame | None = None) -> DataFrame:
    """Per output file: `path, pmid, layout, dest, action, reason`.

    Files directly under the root MOVE to their prefix, unless the document already has a folder
    there (SKIP). Files of a doubled folder FLATTEN into it (and MOVE along if it is under the
    root), unless the folder has that subdirectory already (SKIP). Files in place have action
    NONE, as have those the mode does not cover and those of unknown layout. With `ids`, only those
    documents, and one SKIP row for each id that the mode finds nothing to do for, with the reason.
    """
    wanted = MODES[mode]
    files = with_output_path(output_listing.select("path")).withColumn(
        "under_prefix", F.col("layout").isin(CANONICAL, NESTED)
    )
    if ids is not None:
        asked = ids.select("pmid").distinct()
        files = files.join(detached(asked, "pmid"), "pmid", "left_semi")
    # Folders that stand in the way: one row per folder and what it holds. The window joins the
    # few folders of a document.
    folders = files.filter(F.col("layout") != UNKNOWN).groupBy("root", "pmid", "subdir").agg(
        F.bool_or(F.col("layout") == CANONICAL).alias("in_place"),
        F.bool_or(F.col("layout") == FLAT).alias("in_flat"),
        F.bool_or("under_prefix").alias("at_home"),
        F.bool_or(F.col("layout") == NESTED).alias("doubled"),
        F.bool_or(~F.col("under_prefix")).alias("under_root"),
    )
    flags = folders.withColumn("at_home", F.bool_or("at_home").over(Window.partitionBy("root", "pmid")))
    sound = files.filter(F.col("layout").isin(CANONICAL, UNKNOWN))
    # Files in place, the bulk of a sound tree, are not looked up and so not shuffled.
    blocked = (
        F.when(F.col("layout") == NESTED, F.col("in_place"))
        .when(F.col("layout") == FLAT, F.col("at_home"))
        .otherwise(F.col("at_home") | F.col("in_flat"))
    )
    cols, folder = ["path", "pmid", "layout", "dest"], ["root", "pmid", "subdir"]
    displaced = files.filter(~F.col("layout").isin(CANONICAL, UNKNOWN)).join(detached(flags, *folder), folder)
    plan = displaced.select(*cols, blocked.alias("taken")).unionByName(sound.select(*cols, F.lit(False).alias("taken")))

    covered = F.col("layout").isin(*wanted)
    taken = F.col("taken")
    action = (
        F.when(~covered, F.lit("NONE")).when(taken, F.lit("SKIP"))
        .when(F.col("layout") == NESTED, F.lit("FLATTEN")).otherwise(F.lit("MOVE"))
    )
    plan = plan.select(
        "path", "pmid", "layout", "dest", action.alias("action"),
        F.when(covered & taken, F.lit("destination exists")).alias("reason"),
    )
    if ids is None:
        return plan
    found = folders.groupBy("pmid").agg(*(F.bool_or(c).alias(c) for c in ("at_home", "doubled", "under_root")))
    idle = asked.join(detached(found, "pmid"), "pmid", "left")
    none = F.lit(None).cast("string")
    reason = {
        "all": F.when(F.col("at_home").isNull(), "source missing").otherwise(none),
        "move": F.when(F.coalesce("under_root", F.lit(False)), none).otherwise("source does not exist"),
        "flatten": F.when(F.col("at_home").isNull(), "destination does not exist")
        .when(~F.col("doubled") & F.col("at_home"), "nothing nested").when(~F.col("at_home"), "destination does not exist").otherwise(none),
    }[mode]
    idle = idle.select("pmid", F.lit("SKIP").alias("action"), reason.alias("reason")).filter("reason IS NOT NULL")
    return plan.unionByName(idle, allowMissingColumns=True)
