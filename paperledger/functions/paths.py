"""Output paths: which of the known layouts a file is in, and where it belongs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from paperledger.functions.text import PREFIX_LENGTH, _col

# Fixed values -------------------------------------------------------------
OUTPUT_SUBDIRS = ("auto", "hybrid_auto")
VLM_SUBDIR = "vlm"
IMAGES_DIR = "images"
CONTENT_LIST_NAME = "_content_list.json"
ARTIFACTS = [
    ("content_list", "_content_list.json"),
    ("middle", "_middle.json"),
    ("model", "_model.json"),
    ("markdown", ".md"),
    ("layout_pdf", ".pdf"),
]
# ---------------------------------------------------------------------------

CANONICAL, NESTED, FLAT, FLAT_NESTED, UNKNOWN = "canonical", "nested", "flat", "flat_nested", "unknown"
KNOWN_SUBDIRS = (*OUTPUT_SUBDIRS, VLM_SUBDIR)


def without_scheme(c: Column | str) -> Column:
    """`file:/a/b` as `/a/b`; other schemes are part of the address and stay."""
    return F.regexp_replace(_col(c), r"^file:/+", "/")


def bare_path(c: Column | str) -> Column:
    """A path without scheme and authority, so that `hdfs://host/in/a.pdf` and `/in/a.pdf` compare equal."""
    return F.regexp_replace(_col(c), r"^[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?/*(?=/)", "")


def parent_dir(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), r"/[^/]*$", "")


def with_output_path(df: DataFrame, path: str = "path", subdirs: Sequence[str] = KNOWN_SUBDIRS) -> DataFrame:
    """Adds `root, prefix, pmid, layout, subdir, file, dest` of each output file.

    The last known subdirectory in the path (`subdirs`) is the landmark: the folder before it is the id, all behind it is
    the file, with any folders of its own. What stands before the id tells the layout: `{prefix}/{id}` canonical,
    `{prefix}/{id}/{id}` nested, `{id}/{id}` flat_nested, else flat; the root is whatever is left. `dest` is the canonical
    place, `{root}/{prefix}/{pmid}/{subdir}/{file}`. Files that are in no known subdirectory of a folder have the layout
    unknown and nothing else: what they belong to cannot be told. Columns of `df` with these names are replaced.
    """
    added = ("root", "prefix", "pmid", "layout", "subdir", "file", "dest")
    keep = [c for c in df.columns if c not in added]

    # Step by step, so that each part is worked out once and not inside every later expression.
    steps = df.select(*keep, F.split(path, "/").alias("_parts"))
    # The place of the landmark, 1-based; the file itself is no folder, and an id must stand before it.
    places = F.transform(F.slice("_parts", F.lit(1), F.size("_parts") - 1), lambda p, i: F.when((i > 0) & p.isin(*subdirs), i + 1))
    steps = steps.withColumn("_at", F.array_max(places))

    def part(back: int) -> Column:
        return F.get("_parts", F.col("_at") - 1 - back)

    def tail(start: Column) -> Column:
        return F.array_join(F.slice("_parts", start, F.size("_parts")), "/")

    known = F.col("_at").isNotNull() & (part(1) != "")
    steps = steps.withColumns({
        "pmid": F.when(known, part(1)), "subdir": F.when(known, part(0)), "_before": part(2), "_before2": part(3),
        "file": F.when(known, tail(F.col("_at") + 1)).otherwise(F.element_at("_parts", -1)),
    })
    steps = steps.withColumn("prefix", F.substring("pmid", 1, PREFIX_LENGTH))
    before, before2 = F.col("_before"), F.col("_before2")
    steps = steps.withColumn(
        "layout",
        F.when(F.col("pmid").isNull(), F.lit(UNKNOWN))
        .when((before == F.col("pmid")) & (before2 == F.col("prefix")), F.lit(NESTED))
        .when(before == F.col("prefix"), F.lit(CANONICAL))
        .when(before == F.col("pmid"), F.lit(FLAT_NESTED))
        .otherwise(F.lit(FLAT)),
    )
    depth = F.when(F.col("layout") == NESTED, 4).when(F.col("layout") == FLAT, 2).otherwise(3)
    root = F.array_join(F.slice("_parts", F.lit(1), F.greatest(F.col("_at") - depth, F.lit(0))), "/")
    steps = steps.withColumn("root", F.when(F.col("pmid").isNotNull(), root))
    place = F.concat_ws("/", "prefix", "pmid", "subdir", "file")
    dest = F.when(F.col("root") == "", place).when(F.col("root").isNotNull(), F.concat_ws("/", F.col("root"), place))
    # A generator of one row: filters on the parts stay above it. Pushed down they would repeat
    # the whole parsing in their condition.
    parsed = F.struct(*added[:-1], dest.alias("dest"))
    return steps.select(*keep, F.inline(F.array(parsed)))


def artifact_class(c: Column | str) -> Column:
    """Kind of output file by the end of its name."""
    c = _col(c)
    out = F.lit(None).cast("string")
    for label, suffix in reversed(ARTIFACTS):
        out = F.when(F.endswith(c, F.lit(suffix)), F.lit(label)).otherwise(out)
    return F.coalesce(out, F.lit("other"))
