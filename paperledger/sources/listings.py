"""File listings as tables. Only path and size are read, never the content."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from paperledger.functions.paths import CONTENT_LIST_NAME, parent_dir, with_output_path, without_scheme
from paperledger.functions.text import file_name, id_from_name, stem, strip_suffix
from paperledger.schema import LISTING
from paperledger.session import shared_dir

PDF_GLOB = "*.pdf"
PDF_GLOB_ANY_CASE = "*.[pP][dD][fF]"
OUTPUT_GLOB = "*{_content_list.json,.md}"


def list_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """Files under `root`, at any depth, as `path, length`.

    For trees of many small files lower `spark.sql.files.openCostInBytes` for the job that
    writes the listing, and keep the listing as Parquet.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(root)
        .select(without_scheme("path").alias("path"), "length")
    )


# The schemes that a task can list itself.
TREE_SCHEMES = ("", "file", "hdfs", "viewfs", "s3", "gs", "gcs")
ENTRY = "path string, length long, is_dir boolean"
DIRS_PER_TASK = 64


def _entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """What lies directly in each folder. As for Spark's reader, names that begin with `.` or `_` are hidden, links are followed."""
    from pyarrow import fs

    def row(prefix: str, at: fs.FileInfo) -> tuple:
        return f"{prefix}{at.path}", at.size if at.is_file else None, not at.is_file

    def shown(at: fs.FileInfo) -> bool:
        name = at.base_name
        hidden = name.startswith(".") or name.startswith("_") and "=" not in name
        return at.type != fs.FileType.NotFound and not hidden and not name.endswith("._COPYING_")

    for batch in batches:
        for path in batch["path"]:
            local = re.match(r"^(?:file:)?/", path) is not None
            if local:
                system, inner, prefix = fs.LocalFileSystem(), re.sub(r"^file:/+", "/", path), ""
            else:
                system, inner = fs.FileSystem.from_uri(path)
                prefix = path[: len(path) - len(inner)] if path.endswith(inner) else ""
            here = os.path.realpath(inner) if local else ""
            found = [at for at in system.get_file_info(fs.FileSelector(inner)) if shown(at)]
            if local:  # a link to a folder above would never end
                found = [at for at in found if at.is_file or not (os.path.islink(at.path) and f"{here}/".startswith(os.path.realpath(at.path).rstrip("/") + "/"))]
            for start in range(0, len(found), 10_000):
                yield pd.DataFrame([row(prefix, at) for at in found[start:start + 10_000]], columns=["path", "length", "is_dir"]).astype({"length": "Int64"})


def glob_pattern(glob: str) -> str:
    """A file name glob (`*`, `?`, `[…]`, `{a,b}`) as a regular expression."""
    out, depth, inside = "", 0, False
    for c in glob:
        if inside:
            out, inside = out + c, c != "]"
        elif c == "[":
            out, inside = out + c, True
        elif c in "{}":
            depth += 1 if c == "{" else -1
            out += "(?:" if c == "{" else ")"
        else:
            out += {"*": ".*", "?": "."}.get(c) or ("|" if c == "," and depth else re.escape(c))
    return f"(?s)^{out}$"


def list_tree(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """What `list_files` gives, listed by tasks: level by level, until a level holds no folder.

    A level's folders are dealt to tasks, and what they hold is written to the shared folder, so that the driver counts
    folders and holds no file. One folder is one task's, whatever it holds. Stores that only Spark's readers reach are left to
    `list_files`.
    """
    if re.sub(r":.*", "", root) not in TREE_SCHEMES and not root.startswith("/"):
        return list_files(spark, root, glob)
    folder, levels = f"{shared_dir(spark)}/tree-{uuid.uuid4().hex}", 0
    level, n = spark.createDataFrame([(root.rstrip("/") or "/",)], "path string"), 1
    while n:
        width = max(min(n, spark.sparkContext.defaultParallelism), n // DIRS_PER_TASK)
        level.repartition(width).mapInPandas(_entries, ENTRY).write.parquet(f"{folder}/{levels}")
        level = spark.read.schema(ENTRY).parquet(f"{folder}/{levels}").filter("is_dir").select("path")
        levels, n = levels + 1, level.count()
    files = spark.read.schema(ENTRY).parquet(*(f"{folder}/{i}" for i in range(levels))).filter("NOT is_dir")
    if glob != "*":
        files = files.filter(file_name("path").rlike(glob_pattern(glob)))
    return files.select(without_scheme("path").alias("path"), "length")


def write_listing(listing: DataFrame, path: str) -> None:
    listing.select(*LISTING.names).write.mode("overwrite").parquet(path)


def with_stem_id(listing: DataFrame) -> DataFrame:
    """Listing as manifest rows, the id being the file stem."""
    return listing.select(stem("path").alias("pmid"), F.col("path").alias("pdf_path"))


def discover_pdfs(spark: SparkSession, root: str) -> DataFrame:
    """`*.pdf`, in that case only, with the stem as id, ordered by path."""
    return with_stem_id(list_tree(spark, root, PDF_GLOB)).orderBy("pdf_path")


def ids_from_listing(listing: DataFrame, pattern: str | None = None) -> DataFrame:
    """Files whose name holds an id, as `pmid, pdf_path, file_size`; the others are left out."""
    name = file_name("path")
    found = id_from_name(name, pattern) if pattern else id_from_name(name)
    return listing.select(
        found.alias("pmid"), F.col("path").alias("pdf_path"), F.col("length").alias("file_size")
    ).filter("pmid IS NOT NULL")


def outputs_from_listing(listing: DataFrame) -> DataFrame:
    """Content lists as `pmid, json_path, md_path`; md_path is a Markdown file beside it, the first by name.

    A document is named by its folder, as tools name files by the input's stem; only files in no known
    subdirectory of a folder go by their own name.
    """
    json = with_output_path(listing.filter(F.endswith("path", F.lit(CONTENT_LIST_NAME))).select("path")).select(
        F.coalesce("pmid", strip_suffix(stem("path"))).alias("pmid"), F.col("path").alias("json_path"), parent_dir("path").alias("folder")
    ).filter("pmid <> ''")
    md = listing.filter(F.endswith("path", F.lit(".md"))).groupBy(parent_dir("path").alias("folder")).agg(F.min("path").alias("md_path"))
    return json.join(md, "folder", "left").select("pmid", "json_path", "md_path")
