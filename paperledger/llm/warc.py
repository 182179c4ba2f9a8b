"""WARC archives: writing pages as records, and reading them back with segments put together.

Writing. Each page is a record whose block is an HTTP response with the html as chunked body. Of pages with equal payloads
of `min_bytes` or more the smallest page_id gets a response, the others revisit records that refer to it. A message longer
than `segment_chars` is cut: the first segment is the response, continuation records follow, which name its record as origin
and their number; the last one states the total length. Records are text rows, ended by the two line breaks that the
format asks for; chunks and segments end between characters, so every record is valid UTF-8, and a chunk ends inside
WARC/1.1 wherever a payload holds it. A header value that ends in it is followed by a blank, which readers take off.

Reading. Files, gzipped or not, are split into records at that string, by Spark's text reader. Continuation records are
grouped by the record they continue, put in order of segment number, checked to be numbered without gap and to have the
stated total length, then the chunked framing is taken off and the payload's digest compared. What fails keeps its row
with a `status` that says why. Revisit records take size and digest from the response they refer to.

A null html is an empty payload. Null page_ids refer to nothing and are responses. Rows that repeat are records of
their own: those of the smallest page_id are all responses. A record is one value in the end; no group is larger.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from paperledger.llm.frames import as_text, number
from paperledger.operators.skew import detached
from paperledger.session import shared_dir

# Fixed values of the format.
START = "WARC/1.1\r\n"
END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

CHUNK_CHARS = 4096
SEGMENT_CHARS = 16_384
FILE_RECORDS = 20_000
OK = "ok"

RECORD = (
    "record_id string, record_type string, uri string, page_id long, origin_id string, segment int, total long, refers_to long, "
    "payload_digest string, block binary, status string"
)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(text: str, size: int = CHUNK_CHARS) -> str:
    """Chunked transfer framing; no chunk holds WARC/1.1, so that no line break behind it, of whatever origin, starts a record."""
    out = []
    for part in re.split(r"(?<=WARC/)(?=1\.1)", text):
        for i in range(0, len(part), size):
            piece = part[i:i + size]
            out.append(f"{len(piece.encode()):x}\r\n{piece}\r\n")
    return "".join([*out, "0\r\n\r\n"])


def dechunked(body: bytes) -> bytes:
    """The body without its framing; ValueError if that is broken."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if not size:
            return b"".join(out)
        if body[at + size:at + size + 2] != b"\r\n":
            raise ValueError("chunk without end")
        out.append(body[at:at + size])
        at += size + 2


def payload_of(message: bytes) -> bytes:
    """The payload of an HTTP message."""
    head, sep, body = message.partition(END.encode())
    if not sep:
        raise ValueError("no HTTP header")
    return dechunked(body) if re.search(rb"(?im)^transfer-encoding:.*\bchunked\b", head) else body


def record(fields: dict[str, object], block: str) -> str:
    lines = [f"{k}: {re.sub(r'[\x00-\x1f\x7f]', lambda m: f'%{ord(m[0]):02X}', str(v))}" for k, v in fields.items() if v is not None]
    lines = [f"{line} " if line.endswith("WARC/1.1") else line for line in lines]
    return START + "\r\n".join([*lines, f"Content-Length: {len(block.encode())}"]) + END + block


def records(url: str | None, html: str | None, refers_to: str | None, name: str, segment_chars: int) -> Iterator[str]:
    """The record, or records, of one page."""
    html = html or ""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked{END}"
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit", "WARC-Record-ID": f"<{name}>", "WARC-Target-URI": url or None,
        "WARC-Payload-Digest": f"sha1:{digest(html.encode())}", "Content-Type": "application/http; msgtype=response",
    }
    if refers_to is not None:
        yield record(fields | {"WARC-Refers-To": f"<urn:page:{refers_to}>", "WARC-Profile": REVISIT_PROFILE}, head)
        return
    message = head + chunked(html)
    parts = [message[i:i + segment_chars] for i in range(0, len(message), segment_chars)]
    if len(parts) == 1:
        yield record(fields, message)
        return
    yield record(fields | {"WARC-Segment-Number": 1}, parts[0])
    for number, part in enumerate(parts[1:], 2):
        yield record({
            "WARC-Type": "continuation", "WARC-Record-ID": f"<{name}:{number}>", "WARC-Segment-Origin-ID": f"<{name}>",
            "WARC-Segment-Number": number, "WARC-Segment-Total-Length": len(message.encode()) if number == len(parts) else None,
        }, part)


def with_references(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, html, refers_to: the smallest page_id with an equal payload, null for its own rows.

    Payloads are compared by digest and size, and only those are shuffled by payload; the html joins by page_id.
    """
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("sha1", F.sha1("html")).withColumn("bytes", F.octet_length("html"))
    light = rows.filter(F.col("bytes") >= min_bytes).select("page_id", "sha1", "bytes")
    first = light.groupBy("sha1", "bytes").agg(F.min("page_id").alias("refers_to"))
    later = light.join(detached(first, "sha1"), ["sha1", "bytes"]).filter("page_id <> refers_to").distinct()
    return rows.join(later, ["page_id", "sha1", "bytes"], "left").select("page_id", "url", "html", "refers_to")


def write_archive(
    pages: DataFrame, path: str, min_bytes: int = 0, segment_chars: int = SEGMENT_CHARS, file_records: int = FILE_RECORDS, compression: str = "gzip"
) -> None:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        serial, task = 0, TaskContext.get().partitionId()
        for batch in batches:
            out = []
            for page_id, url, html, refers_to in batch[["page_id", "url", "html", "refers_to"]].itertuples(index=False):
                page = "null" if page_id is None else page_id
                out += records(url, html, refers_to, f"urn:page:{page}:{task}-{serial}", segment_chars)
                serial += 1
            yield pd.DataFrame({"value": out})

    rows = with_references(pages, min_bytes).select(as_text("page_id"), "url", "html", as_text("refers_to")).mapInPandas(run, "value string")
    rows.write.option("lineSep", END).option("compression", compression).option("maxRecordsPerFile", file_records).text(path)


def parsed(data: bytes) -> tuple | None:
    """One record from what stands behind its start; None if there is none."""
    head, sep, rest = data.partition(END.encode())
    if not data.strip():
        return None
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n"):
        key, colon, value = line.partition(":")
        if colon:
            fields[key.strip().lower()] = value.strip()

    def number(key: str) -> int | None:
        return int(fields[key]) if fields.get(key, "").isdigit() else None

    def page(key: str) -> int | None:
        found = re.match(r"<urn:page:(-?\d+)", fields.get(key, ""))
        return int(found[1]) if found else None

    length = number("content-length")
    block = rest[:length] if length is not None else rest
    status = OK if sep and length is not None and len(rest) >= length and "warc-type" in fields else "broken record"
    digest_ = fields.get("warc-payload-digest", "")
    return (
        fields.get("warc-record-id"), fields.get("warc-type"), fields.get("warc-target-uri"), page("warc-record-id"),
        fields.get("warc-segment-origin-id"), number("warc-segment-number"), number("warc-segment-total-length"), page("warc-refers-to"),
        digest_[5:] if digest_.startswith("sha1:") else None, block, status,
    )


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    fields = [f.split() for f in schema.split(", ")]
    kinds = {"long": "Int64", "int": "Int32"}
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pd.DataFrame({name: pd.array(list(c), kinds[kind]) if kind in kinds else pd.Series(list(c), dtype=object) for (name, kind), c in zip(fields, columns)})


def read_records(spark: SparkSession, path: str) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield _frame([r for r in map(parsed, batch["value"]) if r], RECORD)

    return spark.read.option("lineSep", START).text(path).select(F.col("value").cast("binary").alias("value")).mapInPandas(run, RECORD)


def reassembled(found: DataFrame) -> DataFrame:
    """One row for each response: record_id, uri, page_id, payload, payload_bytes, payload_digest, status."""
    schema = "record_id string, uri string, page_id long, payload binary, payload_bytes long, payload_digest string, status string"
    def put_together(parts: list[dict], stated: str | None) -> tuple[bytes | None, str]:
        if any(p["status"] != OK for p in parts):
            return None, "broken record"
        if all(p["record_type"] != "response" for p in parts):
            return None, "no first segment"
        if len(parts) > 1 or parts[0]["segment"] is not None:
            if [p["segment"] for p in parts] != list(range(1, len(parts) + 1)):
                return None, "segments missing or repeated"
            if parts[-1]["total"] is None or parts[-1]["total"] != sum(len(p["block"]) for p in parts):
                return None, "total length differs"
        try:
            payload = payload_of(b"".join(bytes(p["block"]) for p in parts))
        except ValueError:
            return None, "broken framing"
        return payload, OK if stated in (None, digest(payload)) else "digest differs"

    def finished(record_id: str, parts: list[dict]) -> tuple:
        first = next((p for p in parts if p["record_type"] == "response"), {})
        payload, status = put_together(parts, first.get("payload_digest"))
        known = payload is not None
        return (
            record_id, first.get("uri"), first.get("page_id"), payload, len(payload) if known else None, digest(payload) if known else first.get("payload_digest"), status)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_id, parts = None, []
        for batch in batches:
            out = []
            clean = batch.astype(object).where(batch.notna(), None)
            clean["page_id"] = pd.Series([number(v) for v in clean["page_id"]], index=clean.index, dtype=object)
            for part in clean.to_dict("records"):
                if part["whole_id"] != open_id:
                    if parts:
                        out.append(finished(open_id, parts))
                    open_id, parts = part["whole_id"], []
                parts.append(part)
            yield _frame(out, schema)
        if parts:
            yield _frame([finished(open_id, parts)], schema)

    # Sorted rather than collected: a task holds the segments of one record, and a batch of rows.
    columns = ["record_type", "uri", "page_id", "segment", "total", "payload_digest", "block", "status"]
    rows = found.filter("record_type IN ('response', 'continuation')").select(F.coalesce("origin_id", "record_id", F.lit("")).alias("whole_id"), *columns).withColumn("page_id", as_text("page_id"))
    return rows.repartition("whole_id").sortWithinPartitions("whole_id", F.col("segment").asc_nulls_first()).mapInPandas(run, schema)


def pages_of(found: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, status for each response and revisit record."""
    light = reassembled(found).drop("payload", "uri")
    responses = light.select("page_id", "payload_bytes", "payload_digest", F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to"), "status")
    original = responses.filter(f"status = '{OK}'").select(F.col("page_id").alias("refers_to"), "payload_digest", "payload_bytes").distinct()
    revisits = found.filter("record_type = 'revisit'").select("page_id", "payload_digest", "refers_to", F.col("status").alias("read"))
    revisits = revisits.join(original, ["refers_to", "payload_digest"], "left").select(
        "page_id", "payload_bytes", "payload_digest", F.lit("revisit").alias("record_type"), "refers_to",
        F.when(F.col("read") != OK, F.col("read")).when(F.col("payload_bytes").isNull(), "nothing to refer to").otherwise(OK).alias("status"),
    )
    return responses.unionByName(revisits)


def round_trip(pages: DataFrame, min_bytes: int = 0, segment_chars: int = SEGMENT_CHARS) -> DataFrame:
    """Pages written to a new folder that all executors reach, and read back."""
    path = f"{shared_dir(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    write_archive(pages, path, min_bytes, segment_chars)
    return pages_of(read_records(pages.sparkSession, path))
