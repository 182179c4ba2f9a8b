"""Table schemas and the one place where frames are fitted to them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

PENDING, COMPLETED, FAILED = "pending", "completed", "failed"

REGISTRY = T.StructType([
    T.StructField("pmid", T.StringType(), False),
    T.StructField("pdf_path", T.StringType()),
    T.StructField("json_path", T.StringType()),
    T.StructField("md_path", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("error_msg", T.StringType()),
    T.StructField("processing_time", T.FloatType()),
    T.StructField("file_size", T.LongType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("updated_at", T.TimestampNTZType()),
])

MANIFEST = T.StructType([
    T.StructField("pmid", T.StringType()),
    T.StructField("pdf_path", T.StringType()),
])

ATTEMPT = T.StructType([
    T.StructField("pmid", T.StringType()),
    T.StructField("pdf_path", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("json_path", T.StringType()),
    T.StructField("md_path", T.StringType()),
    T.StructField("processing_time", T.DoubleType()),
    T.StructField("error_msg", T.StringType()),
    T.StructField("processed_at", T.TimestampNTZType()),
])

LISTING = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("length", T.LongType()),
])

# What Spark's binaryFile source delivers; a stream over it needs the schema spelled out.
BINARY_FILE = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
])

ELEMENT = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("text_level", T.IntegerType()),
    T.StructField("page_idx", T.IntegerType()),
    T.StructField("bbox", T.ArrayType(T.DoubleType())),
])

GPU_SAMPLE = T.StructType([
    T.StructField("node", T.StringType()),
    T.StructField("gpu_name", T.StringType()),
    T.StructField("utilization", T.StringType()),
    T.StructField("temperature", T.StringType()),
    T.StructField("power", T.StringType()),
    T.StructField("memory_used", T.StringType()),
    T.StructField("memory_total", T.StringType()),
])


def conform(df: DataFrame, schema: T.StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """Project `df` to `schema`: a missing column becomes a typed NULL, others are cast.

    Columns named in `keep` follow the schema's own, unchanged. A value that cannot be cast
    becomes NULL.
    """
    present = set(df.columns)
    fields = [
        (F.col(f.name).try_cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ]
    return df.select(*fields, *[F.col(c) for c in keep])


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, in a form the optimizer sees through."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]).filter(F.lit(False))
