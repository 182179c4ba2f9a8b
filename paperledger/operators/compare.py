"""Hardware and backend comparisons, element types, output consistency."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from paperledger.functions.text import canonical_latex, markdown_lines
from paperledger.operators.skew import detached
from paperledger.schema import COMPLETED, ELEMENT

# Command-line names of the backends and their short names in reports.
BACKENDS = {"pipeline": "pipeline", "hybrid-auto-engine": "hybrid", "vlm-auto-engine": "vlm"}
REPORT_BACKENDS = tuple(BACKENDS.values())
BASELINE_BACKEND = "pipeline"
OTHER_BACKEND = "other"


def short_backend(c: Column) -> Column:
    out = c
    for name, short in BACKENDS.items():
        out = F.when(c == name, F.lit(short)).otherwise(out)
    return out


def report_backend(c: Column, backends: Sequence[str]) -> Column:
    """The column a row counts in: its backend's short name, or `other` for names the report does not know and NULL."""
    short = short_backend(c)
    return F.when(short.isin(*backends), short).otherwise(OTHER_BACKEND)


def attempt_timings(attempts: DataFrame, nodes: DataFrame) -> DataFrame:
    """Mean `seconds` of the `n` completed attempts per GPU type and backend, by the node they ran on.

    Attempts on a node class the dimension does not know, or on none, count under a NULL type. They are
    folded per node class before the join: a class holding most of the attempts joins as a few rows.
    """
    done = attempts.filter((F.col("status") == COMPLETED) & F.col("processing_time").isNotNull())
    per_class = done.groupBy("node_prefix", short_backend(F.col("backend")).alias("backend")).agg(
        F.sum("processing_time").alias("total"), F.count(F.lit(1)).alias("n")
    )
    return per_class.join(nodes, "node_prefix", "left").groupBy("gpu_type", "backend").agg(
        (F.sum("total") / F.sum("n")).alias("seconds"), F.sum("n").alias("n")
    )


def backend_pivot(timings: DataFrame, backends: Sequence[str] = REPORT_BACKENDS) -> DataFrame:
    """Mean seconds, one row per GPU type, one column per backend and `other`; NULL where none was timed.

    Where `timings` counts attempts in `n`, means are weighted by it.
    """
    named = timings.withColumn("backend", report_backend(F.col("backend"), backends))
    mean = F.avg("seconds")
    if "n" in timings.columns:
        mean = F.sum(F.col("seconds") * F.col("n")) / F.sum(F.when(F.col("seconds").isNotNull(), F.col("n")))
    return named.groupBy("gpu_type").pivot("backend", [*backends, OTHER_BACKEND]).agg(mean)


def relative_speed(
    timings: DataFrame, baseline: str = BASELINE_BACKEND, backends: Sequence[str] = REPORT_BACKENDS
) -> DataFrame:
    """Mean seconds over those of the baseline backend on the same GPU; NULL without a baseline."""
    base = F.nullif(F.col(baseline), F.lit(0.0))
    columns = [*backends, OTHER_BACKEND]
    return backend_pivot(timings, backends).select("gpu_type", *[F.round(F.col(b) / base, 1).alias(b) for b in columns])


def element_types(elements: DataFrame, backends: Sequence[str] = REPORT_BACKENDS) -> DataFrame:
    """Elements by type, one column per backend and `other`, 0 where there are none."""
    columns = [*backends, OTHER_BACKEND]
    named = elements.withColumn("backend", report_backend(F.col("backend"), backends))
    return named.groupBy("type").pivot("backend", columns).agg(F.count(F.lit(1))).na.fill(0, columns)


def doc_structure(elements: DataFrame) -> DataFrame:
    """Per document and backend: elements, characters of text, lines of Markdown, bytes of JSON.

    Each element is a block of Markdown, blocks being parted by one blank line. The JSON is the content list without
    white space: what the elements have of its fields, in brackets, with commas between.
    """
    fields = [c for c in ELEMENT.names if c in elements.columns]
    return elements.groupBy("pmid", "backend").agg(
        F.count(F.lit(1)).alias("n_elements"),
        (F.sum(F.octet_length(F.to_json(F.struct(*fields)))) + F.count(F.lit(1)) + 1).alias("json_bytes"),
        F.sum(F.length("text")).alias("n_chars"),
        (F.sum(markdown_lines("text")) + F.count(F.lit(1)) - 1).alias("md_lines"),
    )


def backend_structure(elements: DataFrame) -> DataFrame:
    """Means of `doc_structure` per backend."""
    return doc_structure(elements).groupBy("backend").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.avg("n_elements").alias("avg_elements"),
        F.avg("n_chars").alias("avg_chars"),
        F.avg("md_lines").alias("avg_md_lines"),
        F.avg("json_bytes").alias("avg_json_bytes"),
    )


def content_digests(elements: DataFrame, run: Sequence[str] = ("pmid", "backend", "run")) -> DataFrame:
    """One digest per document and run from its elements' places, types and texts.

    Element hashes are combined by exclusive or, which each task can do on its part; so no
    document has to be put together to be compared.
    """
    h = F.md5(F.concat_ws("\x1f", F.col("seq").cast("string"), "type", "text"))

    def half(start: int) -> Column:
        return F.conv(F.substring(h, start, 15), 16, 10).cast("long")

    return elements.groupBy(*run).agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(half(1)).alias("a"), F.bit_xor(half(16)).alias("b")
    ).select(*run, F.concat_ws("-", "n", "a", "b").alias("digest"))


def text_digests(outputs: DataFrame, tolerant: bool = False) -> DataFrame:
    """Digest of whole output texts; `tolerant` folds LaTeX variants first."""
    text = canonical_latex("text") if tolerant else F.col("text")
    return outputs.withColumn("digest", F.md5(text))


def output_consistency(digests: DataFrame, by: Sequence[str] = ("pmid", "backend")) -> DataFrame:
    """Runs and distinct digests per document and backend; `consistent` when all runs agree."""
    # Runs are first counted per digest, so a digest shared by very many runs is one row.
    per_digest = digests.groupBy(*by, "digest").agg(F.count(F.lit(1)).alias("runs"))
    return per_digest.groupBy(*by).agg(
        F.sum("runs").alias("runs"), F.count(F.lit(1)).alias("distinct_digests"), F.max("runs").alias("largest_group")
    ).withColumn("consistent", F.col("distinct_digests") == 1)


def backend_consistency(digests: DataFrame, by: Sequence[str] = ("pmid", "backend")) -> DataFrame:
    """Per backend: documents, documents whose runs all agree, runs, distinct digests."""
    return output_consistency(digests, by).groupBy("backend").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.count_if("consistent").alias("consistent_docs"),
        F.sum("runs").alias("runs"),
        F.sum("distinct_digests").alias("distinct_digests"),
    )


def agreeing_runs(digests: DataFrame, by: Sequence[str] = ("pmid", "backend"), run: str = "run") -> DataFrame:
    """Each run with the number of runs that gave the same digest, itself included.

    Counted apart and joined back rather than windowed: adaptive execution can split the join
    where very many runs share a digest, a window could not.
    """
    shared = digests.groupBy(*by, "digest").agg(F.count(F.lit(1)).alias("same_output"))
    return digests.join(detached(shared, *by, "digest"), [*by, "digest"]).select(*by, run, "digest", "same_output")
