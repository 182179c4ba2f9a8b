"""Running a pluggable extractor over documents, one outcome row each.

An extractor is a Python callable `(pmid, source) -> list of element dicts`, `source` being the
document's path or text. It stands for whatever tool turns a document into a content list. Several backends
work side by side, each with an extractor and task resources of its own.
"""

from __future__ import annotations

import multiprocessing as mp
import os
import signal
import subprocess
import sys
import time
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from datetime import datetime, timezone

import pandas as pd
from pyspark import cloudpickle
from pyspark.resource import ResourceProfile
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from paperledger.functions.text import EXCEPTION_CHARS, STDERR_CHARS
from paperledger.operators.registry import NO_OUTPUT
from paperledger.schema import COMPLETED, ELEMENT, FAILED

# The code in this module travels with the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Extractor = Callable[[str, str], list]

TIMEOUT_SECONDS = 1800  # fixed value
FLUSH_CHARS = 1_000_000  # text held by a worker before it hands rows on
ELEMENT_CHARS = 200  # what an element takes besides its text
DOCUMENTS_PER_TASK = 32
UNKNOWN_BACKEND = "Unknown backend"

OUTCOME = T.StructType([
    T.StructField("pmid", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("error_msg", T.StringType()),
    T.StructField("processing_time", T.DoubleType()),
    T.StructField("processed_at", T.TimestampNTZType()),
    T.StructField("backend", T.StringType()),
    T.StructField("elements", T.ArrayType(ELEMENT)),
])


def _fit(element: dict) -> dict:
    """An element with the fields and types of ELEMENT."""

    def cast(field: str, kind: type):
        value = element.get(field)
        return None if value is None else kind(value)

    box = element.get("bbox")
    return {
        "type": cast("type", str), "text": cast("text", str), "text_level": cast("text_level", int),
        "page_idx": cast("page_idx", int), "bbox": None if box is None else [float(x) for x in box],
    }


def _serve(extractor: Extractor, pipe) -> None:
    os.setsid()  # its own session: what it starts ends with it
    while True:
        try:
            pmid, source = pipe.recv()
        except EOFError:
            return
        try:
            pipe.send(([_fit(e) for e in extractor(pmid, source) or []], None))
        except ToolFailed as e:
            pipe.send((None, str(e)))
        except Exception as e:
            pipe.send((None, f"{type(e).__name__}: {str(e)[:EXCEPTION_CHARS]}"))


class ToolFailed(Exception):
    """A tool that ended badly: what it wrote as error, cut, or that it said nothing."""


def run_tool(*command: str) -> str:
    """What a command writes, for extractors that call one; ToolFailed with its error text if it ends badly."""
    done = subprocess.run(command, capture_output=True, text=True, errors="replace")
    if done.returncode:
        raise ToolFailed(done.stderr.strip()[:STDERR_CHARS] or "Unknown error")
    return done.stdout


class _Child:
    """The extractor in a process of its own, which can be killed when a document takes too long."""

    def __init__(self, extractor: Extractor):
        self.extractor = extractor
        self.process = None

    def start(self) -> None:
        """Before rows are read, so that the process does not keep the memory that they were in."""
        if self.process is None:
            ctx = mp.get_context("fork")
            self.pipe, theirs = ctx.Pipe()
            self.process = ctx.Process(target=_serve, args=(self.extractor, theirs))
            self.process.start()
            theirs.close()

    def run(self, pmid: str, source: str, timeout_s: float):
        self.start()
        try:
            self.pipe.send((pmid, source))
            if not self.pipe.poll(timeout_s):
                self.stop()
                return None, f"Processing timeout ({timeout_s:g} s)"
            return self.pipe.recv()
        except (EOFError, OSError):
            self.stop()
            return None, "Extractor process died"

    def stop(self) -> None:
        if self.process is not None:
            try:
                os.killpg(self.process.pid, signal.SIGKILL)
            except ProcessLookupError:  # ended, or not yet in its own session
                self.process.kill()
            self.process.join()
            self.pipe.close()
            self.process = None


@dataclass(frozen=True)
class Backend:
    """An extractor, and what its tasks and executors need beyond the session's default, as a GPU."""

    extractor: Extractor
    profile: ResourceProfile | None = None


def _has_profiles(spark: SparkSession) -> bool:
    """Local masters have one kind of executor and refuse a stage that asks for another."""
    return not spark.sparkContext.master.startswith("local")


def tasks_for(n: int, slots: int) -> int:
    """Tasks for `n` documents: about `DOCUMENTS_PER_TASK` each, and no core idle."""
    return max(1, min(n, max(slots, n // DOCUMENTS_PER_TASK)))


def extract_documents(
    df: DataFrame,
    extractor: Extractor,
    backend: str = "pipeline",
    timeout_s: float = TIMEOUT_SECONDS,
    source: str = "pdf_path",
    partitions: int | None = None,
    known_error: str | None = None,
    profile: ResourceProfile | None = None,
) -> DataFrame:
    """`pmid` and `source` in, one outcome row per document out.

    Completed only when elements came out. An exception, a timeout or a dying extractor makes a
    failed row, never a failed job; so does a message in the column `known_error`, for which the
    extractor is not run at all. Rows are dealt out evenly over `partitions`, so that large
    documents standing together in the input do not end up in one task; by default so that a
    task has about `DOCUMENTS_PER_TASK` of them and no core is idle, for which they are counted.
    The tasks run on executors of the resource `profile`; a local master, which has none, runs them as they are.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        child = _Child(extractor)
        child.start()
        try:
            for batch in batches:
                rows, chars = [], 0
                for pmid, src, known in zip(batch["pmid"], batch["source"], batch["known_error"]):
                    started = time.monotonic()
                    elements, error = (None, known) if known is not None else child.run(pmid, src, timeout_s)
                    if error is None and not elements:
                        error = NO_OUTPUT
                    seconds = None if known is not None else time.monotonic() - started
                    rows.append((
                        pmid, COMPLETED if error is None else FAILED, error, seconds,
                        datetime.now(timezone.utc).replace(tzinfo=None), backend,
                        elements or [],
                    ))
                    chars += sum(len(e["text"] or "") + ELEMENT_CHARS for e in elements or [])
                    if chars >= FLUSH_CHARS:
                        yield pd.DataFrame(rows, columns=OUTCOME.names)
                        rows, chars = [], 0
                yield pd.DataFrame(rows, columns=OUTCOME.names)
        finally:
            child.stop()

    known = F.col(known_error) if known_error else F.lit(None).cast("string")
    docs = df.select(F.col("pmid").cast("string").alias("pmid"), F.col(source).alias("source"), known.alias("known_error"))
    if partitions is None:
        partitions = tasks_for(df.count(), df.sparkSession.sparkContext.defaultParallelism)
    profile = profile if _has_profiles(df.sparkSession) else None
    return docs.repartition(partitions).mapInPandas(run, OUTCOME, profile=profile)


def extract_by_backend(
    df: DataFrame,
    backends: Mapping[str, Backend],
    timeout_s: float = TIMEOUT_SECONDS,
    source: str = "pdf_path",
    partitions: int | None = None,
    known_error: str | None = None,
    backend: str = "backend",
) -> DataFrame:
    """As `extract_documents`, each row by the backend that its column `backend` names, with that one's resources.

    The backends' tasks run side by side in one job. `partitions` holds for each; by default they follow from its documents,
    which one job counts for all. A document whose backend is NULL or none of `backends` fails with a message, its own error
    before that. No backends at all fail every document.
    """
    sizes: dict[str, int] = {}
    if partitions is None:
        counted = df.filter(F.col(backend).isin(*backends)).groupBy(backend).count()
        sizes = {r[0]: r[1] for r in counted.collect()}  # a row for each of `backends`
    slots = df.sparkSession.sparkContext.defaultParallelism
    message = F.concat(F.lit(f"{UNKNOWN_BACKEND}: "), F.coalesce(F.col(backend).cast("string"), F.lit("none")))
    own = F.col(known_error) if known_error else F.lit(None).cast("string")
    out = df.filter(~F.coalesce(F.col(backend).isin(*backends), F.lit(False))).select(
        F.col("pmid").cast("string").alias("pmid"), F.lit(FAILED).alias("status"), F.coalesce(own, message).alias("error_msg"),
        F.lit(None).cast("double").alias("processing_time"), F.localtimestamp().alias("processed_at"),
        F.col(backend).cast("string").alias("backend"), F.array().cast(T.ArrayType(ELEMENT)).alias("elements"),
    )
    for name, chosen in backends.items():
        tasks = partitions or tasks_for(sizes.get(name, 0), slots)
        out = out.unionByName(extract_documents(
            df.filter(F.col(backend) == name), chosen.extractor, name, timeout_s, source, tasks, known_error, chosen.profile))
    return out


def outcome_elements(outcomes: DataFrame) -> DataFrame:
    """Elements of completed documents as `pmid, backend, seq, type, text, …`."""
    return outcomes.filter(F.col("status") == COMPLETED).select(
        "pmid", "backend", F.posexplode("elements").alias("seq", "element")
    ).select("pmid", "backend", F.col("seq").cast("long").alias("seq"), "element.*")


def paragraphs(pmid: str, source: str) -> list:
    """The simplest extractor: a text's non-blank lines."""
    return [{"type": "text", "text": line.strip(), "page_idx": 0} for line in source.split("\n") if line.strip()]

