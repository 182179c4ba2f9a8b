import gzip

import pytest
from hypothesis import given, strategies as st
from pyspark.sql import functions as F

from paperledger.llm import warc as w

SCHEMA = "page_id long, url string, html string, sha1 int, status string"
EVIL = "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n0\r\n\r\n"


@given(st.text(alphabet="aé\U0001f600\r\n0WARC/1."), st.integers(1, 7))
def test_framing_round_trip(text, size):
    framed = w.chunked(text, size)
    assert w.dechunked(framed.encode()) == text.encode()


@given(st.lists(st.sampled_from(["WARC/1.1\r\n", "WARC/", "1.1\r\n", "a", "\r\n"]), max_size=20).map("".join))
def test_no_record_start_inside(text):
    assert w.START not in w.chunked(text)


def test_broken_framing():
    for body in (b"", b"5\r\nabc", b"zz\r\n", b"3\r\nabcd\r\n0\r\n\r\n"):
        with pytest.raises(ValueError):
            w.dechunked(body)


def rows():
    texts = ["", None, "a", "a", "é" * 3000, "é" * 3000, EVIL, EVIL * 50, "x" * 9000, "WARC/1.1\r\n" * 700] + [f"page {i % 9}" for i in range(40)]
    out = [(100 - i, f"http://h/{i}\r\nX: y", t, 1, "clash") for i, t in enumerate(texts)]
    return [*out, (None, None, "a", 1, ""), (60, "http://h", "page 3", 1, ""), (60, "http://h", "page 3", 1, "")]


def brute(data, min_bytes):
    first = {}
    for page_id, _, html, *_ in data:
        if page_id is not None:
            first[html or ""] = min(first.get(html or "", page_id), page_id)
    out = []
    for page_id, _, html, *_ in data:
        payload = (html or "").encode()
        later = len(payload) >= min_bytes and page_id is not None and first[html or ""] != page_id
        out.append((page_id, len(payload), w.digest(payload), "revisit" if later else "response", first[html or ""] if later else None, "ok"))
    return out


@pytest.mark.parametrize("min_bytes,segment_chars", [(0, 16384), (0, 100), (7, 1000)])
def test_pages_come_back(spark, min_bytes, segment_chars):
    data = rows()
    got = w.round_trip(spark.createDataFrame(data, SCHEMA).repartition(3), min_bytes, segment_chars)
    got = got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "status").collect()
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(brute(data, min_bytes), key=key)


def test_payloads_come_back(spark, tmp_path):
    data = [(i, None, t, 0, "") for i, t in enumerate([EVIL * 40, "é\U0001f600" * 5000, "plain", ""])]
    path = str(tmp_path / "a")
    w.write_archive(spark.createDataFrame(data, SCHEMA), path, segment_chars=777, compression="none")
    got = {r.page_id: bytes(r.payload) for r in w.reassembled(w.read_records(spark, path)).collect()}
    assert got == {i: t.encode() for i, _, t, *_ in data}


def http(body):
    return b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n" + body


def test_foreign_archives_and_damage(spark, tmp_path):
    def rec(kind, name, block, **fields):
        head = [f"WARC-Type: {kind}", f"WARC-Record-ID: <{name}>", *(f"{k.replace('_', '-')}: {v}" for k, v in fields.items()), f"Content-Length: {len(block)}"]
        return b"WARC/1.1\r\n" + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"

    def cont(origin, number, block, **fields):
        return rec("continuation", f"{origin}:{number}", block, WARC_Segment_Origin_ID=f"<{origin}>", WARC_Segment_Number=number, **fields)

    whole = http(b"\xff\xfe binary \x00 body")
    total = len(whole)
    parts = [
        rec("warcinfo", "urn:info", b"software: x"), rec("response", "urn:page:1:a", whole),
        cont("urn:page:2:a", 3, whole[20:], WARC_Segment_Total_Length=total), rec("response", "urn:page:2:a", whole[:10], WARC_Segment_Number=1),
        cont("urn:page:2:a", 2, whole[10:20]),
        rec("response", "urn:page:3:a", whole[:10], WARC_Segment_Number=1), cont("urn:page:3:a", 3, whole[10:], WARC_Segment_Total_Length=total),
        rec("response", "urn:page:4:a", whole[:10], WARC_Segment_Number=1), cont("urn:page:4:a", 2, whole[10:-1], WARC_Segment_Total_Length=total),
        cont("urn:page:5:a", 2, whole[10:], WARC_Segment_Total_Length=total), rec("response", "urn:page:6:a", b"no header"),
        rec("response", "urn:page:7:a", whole, WARC_Payload_Digest="sha1:AAAA"), rec("response", "urn:page:8:a", whole)[:-20],
        rec("revisit", "urn:page:9:a", b"", WARC_Refers_To="<urn:page:1>", WARC_Payload_Digest=f"sha1:{w.digest(whole[len(http(b'')):])}"),
        rec("revisit", "urn:page:10:a", b"", WARC_Refers_To="<urn:page:77>", WARC_Payload_Digest="sha1:AAAA"),
    ]
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "x.warc.gz").write_bytes(b"".join(gzip.compress(p) for p in parts))
    found = w.read_records(spark, str(tmp_path / "f"))
    got = {r.record_id: r for r in w.reassembled(found).collect()}
    body = b"\xff\xfe binary \x00 body"
    assert bytes(got["<urn:page:1:a>"].payload) == bytes(got["<urn:page:2:a>"].payload) == body
    status = {k.split(":")[2]: r.status for k, r in got.items()}
    assert status == {
        "1": "ok", "2": "ok", "3": "segments missing or repeated", "4": "total length differs", "5": "no first segment", "6": "broken framing",
        "7": "digest differs", "8": "broken record"}
    revisits = {r.page_id: r for r in w.pages_of(found).filter("record_type = 'revisit'").collect()}
    assert revisits[9].payload_bytes == len(body) and revisits[9].status == "ok" and revisits[10].status == "nothing to refer to"


def test_version_at_the_end_of_html_url_chunk_and_segment(spark, tmp_path):
    mark = "WARC/1.1"
    texts = [mark, "x" * 9 + mark, "x" * (w.CHUNK_CHARS - len(mark)) + mark + "y", mark * 3000, mark[:5] + mark, *("x" * n + mark + "y" * 500 for n in range(0, 130, 7))]
    data = [(2 * i + k, f"http://h/{i}/{mark}", t, 0, "") for i, t in enumerate(texts) for k in range(2)]
    for segment_chars in (100, 16384):
        path = str(tmp_path / str(segment_chars))
        w.write_archive(spark.createDataFrame(data, SCHEMA), path, segment_chars=segment_chars)
        found = w.read_records(spark, path)
        assert found.filter(F.col("status") != "ok").count() == 0
        whole = {r.page_id: r for r in w.reassembled(found).collect()}
        assert {i: (r.uri, bytes(r.payload)) for i, r in whole.items()} == {i: (u, t.encode()) for i, u, t, *_ in data if i % 2 == 0}
        assert [r.uri for r in found.filter("record_type = 'revisit'").orderBy("page_id").collect()] == [u for i, u, *_ in data if i % 2]
        got = w.pages_of(found).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "status").collect()
        assert sorted(map(tuple, got)) == sorted(brute(data, 0))


def test_empty_table(spark):
    assert w.round_trip(spark.createDataFrame([], SCHEMA).filter(F.lit(True))).collect() == []
