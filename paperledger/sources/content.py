"""Content lists: the JSON arrays of typed elements, one file per document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from paperledger.functions.paths import CONTENT_LIST_NAME
from paperledger.functions.text import id_prefix, stem, strip_suffix
from paperledger.schema import ELEMENT

NOT_A_LIST = "content list is no JSON array of objects"


def read_content_lists(spark: SparkSession, root: str) -> DataFrame:
    """Elements in reading order as `pmid, seq, type, text, text_level, page_idx, bbox, element, error`.

    One file is one text value; an element's place in the array is its place in the document.
    A file that is no JSON array of objects gives one row with an error and nothing else.
    """
    files = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"*{CONTENT_LIST_NAME}")
        .option("wholetext", True)
        .text(root)
        .select(strip_suffix(stem(F.col("_metadata.file_name"))).alias("pmid"), "value")
    )
    return explode_content(files, "value")


def explode_content(docs: DataFrame, json_column: str) -> DataFrame:
    """One row per element of the JSON array in `json_column`; other columns are kept.

    `element` is the whole element as a VARIANT, with all fields the tool wrote; those of `ELEMENT` are columns too, NULL where a
    value does not fit its type. Text that is no JSON array of objects, NULL too, is one row whose `error` says so.
    """
    rest = [c for c in docs.columns if c not in (json_column, "error")]
    listed = F.try_variant_get(F.try_parse_json(json_column), "$", "array<variant>")
    parsed = docs.select(*rest, listed.alias("_list"))
    broken = F.col("_list").isNull() | F.exists("_list", lambda e: ~F.coalesce(F.startswith(F.schema_of_variant(e), F.lit("OBJECT")), F.lit(False)))
    parsed = parsed.withColumn("error", F.when(broken, NOT_A_LIST))
    rows = parsed.select(*rest, "error", F.posexplode_outer(F.when(F.col("error").isNull(), F.col("_list"))).alias("seq", "element"))
    fields = [F.try_variant_get("element", f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in ELEMENT.fields]
    # An empty list has no elements and no error, hence no row.
    return rows.filter("seq IS NOT NULL OR error IS NOT NULL").select(*rest, F.col("seq").cast("long").alias("seq"), *fields, "element", "error")


def element_field(name: str, kind: str = "string") -> Column:
    """A field of `element` that is no column of its own, as a caption or a table's body; NULL where there is none of that kind."""
    return F.try_variant_get("element", f"$.{name}", kind)


def write_by_prefix(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Output laid out by the first characters of the id, which prunes reads by prefix.

    Ranges of (prefix, id) bring a prefix together for few files, and split one that holds much of the
    data over several tasks. Making the files is the work, so no range is merged with another.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = df.withColumn("prefix", id_prefix("pmid")).repartitionByRange(tasks, "prefix", "pmid")
    laid.write.mode("overwrite").partitionBy("prefix").format(fmt).save(path)


def read_by_prefix(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """Output of `write_by_prefix`, the prefix kept as text: `001` is no number.

    With the `schema` of what was written the folders are listed once.
    """
    found = schema or spark.read.format(fmt).load(path).schema
    fields = [f for f in found.fields if f.name != "prefix"]
    return spark.read.format(fmt).schema(T.StructType([*fields, T.StructField("prefix", T.StringType())])).load(path)
