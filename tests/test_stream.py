from datetime import datetime

import pytest

from paperledger.operators.registry import apply_results, insert_if_absent, retry_failed
from paperledger.schema import REGISTRY, empty
from paperledger.sources.attempts import read_attempts
from paperledger.sources.listings import PDF_GLOB_ANY_CASE, ids_from_listing, list_files
from paperledger.sources.snapshots import latest_version, load_registry, publish_registry
from paperledger.streaming import ingest
from paperledger.streaming.ingest import ingest_stream, scan_stream
from tests.compare import spark_rows
from tests.test_sources import HEADER, put

NOW = datetime(2025, 1, 9)


def lines(*rows):
    return HEADER + "".join(f"{pmid},p,{status},,,{t},\"m\nn\",x\n" for pmid, status, t in rows)


def start(spark, n=4):
    return spark.range(n).selectExpr("CAST(id AS STRING) AS pmid", "'pending' AS status")


def result(df):
    return spark_rows(df.drop("updated_at", "created_at"))


def test_stream_equals_batch_though_files_come_out_of_order(spark, tmp_path):
    root, src = str(tmp_path / "registry"), tmp_path / "src"
    publish_registry(start(spark), root)

    def run():
        ingest_stream(spark, str(src), root, str(tmp_path / "log"), str(tmp_path / "ckpt")).awaitTermination()

    put(src, "chunk_00005.csv", lines(("0", "failed", 1), ("1", "completed", 2), ("1", "failed", 3)))
    run()
    put(src, "chunk_00001.csv", lines(("0", "completed", 4), ("2", "completed", 5)))
    put(src, "chunk_00007.csv", lines(("1", "completed", 6), ("9", "completed", 1)))
    run()
    batch = apply_results(load_registry(spark, root, 1), read_attempts(spark, str(src)), NOW)
    assert result(load_registry(spark, root)) == result(batch)
    assert {r.pmid: r.status for r in batch.collect()} == {"0": "failed", "1": "completed", "2": "completed", "3": "pending"}
    before = latest_version(spark, root)
    run()  # nothing new
    assert latest_version(spark, root) == before


def test_files_with_other_columns_are_refused(spark, tmp_path):
    root = str(tmp_path / "registry")
    publish_registry(start(spark), root)
    put(tmp_path, "src/chunk_0.csv", "status,pmid,c,d,e,f,g,h\nfailed,0,,,,,,\n")
    query = ingest_stream(spark, str(tmp_path / "src"), root, str(tmp_path / "log"), str(tmp_path / "ckpt"))
    with pytest.raises(Exception):
        query.awaitTermination()
    assert latest_version(spark, root) == 1


def test_a_batch_delivered_twice_changes_nothing(spark, tmp_path, monkeypatch):
    """The first delivery dies after its version is out; a retry comes in between, and a restart delivers the batch again."""
    root, log, src, ckpt = (str(tmp_path / n) for n in ("registry", "log", "src", "ckpt"))
    publish_registry(start(spark), root)
    put(tmp_path, "src/chunk_0.csv", lines(("0", "failed", 1), ("1", "completed", 1)))

    def dies(*args):
        publish_registry(*args)
        raise RuntimeError("lost")

    monkeypatch.setattr(ingest, "publish_registry", dies)
    with pytest.raises(Exception, match="lost"):
        ingest_stream(spark, src, root, log, ckpt).awaitTermination()
    monkeypatch.undo()
    publish_registry(retry_failed(load_registry(spark, root), NOW), root)
    before = latest_version(spark, root)
    ingest_stream(spark, src, root, log, ckpt).awaitTermination()
    assert latest_version(spark, root) == before
    assert {r.pmid: r.status for r in load_registry(spark, root).collect()} == {"0": "pending", "1": "completed", "2": "pending", "3": "pending"}
    put(tmp_path, "src/chunk_1.csv", lines(("0", "completed", 1)))
    ingest_stream(spark, src, root, log, ckpt).awaitTermination()
    assert {r.pmid: r.status for r in load_registry(spark, root).collect()}["0"] == "completed"


def test_a_batch_that_dies_before_its_version_is_applied_later(spark, tmp_path, monkeypatch):
    root, log, src, ckpt = (str(tmp_path / n) for n in ("registry", "log", "src", "ckpt"))
    publish_registry(start(spark), root)
    put(tmp_path, "src/chunk_5.csv", lines(("0", "failed", 1)))

    def dies(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(ingest, "publish_registry", dies)
    with pytest.raises(Exception, match="lost"):
        ingest_stream(spark, src, root, log, ckpt).awaitTermination()
    monkeypatch.undo()
    put(tmp_path, "src/chunk_4.csv", lines(("0", "completed", 1)))
    ingest_stream(spark, src, root, log, ckpt).awaitTermination()
    assert {r.pmid: r.status for r in load_registry(spark, root).collect()}["0"] == "failed"


def test_a_stale_file_does_not_undo_a_retry(spark, tmp_path):
    root, log, src, ckpt = (str(tmp_path / n) for n in ("registry", "log", "src", "ckpt"))
    publish_registry(start(spark), root)

    def arrive(name, status):
        put(tmp_path, f"src/{name}", lines(("0", status, 1)))
        ingest_stream(spark, src, root, log, ckpt).awaitTermination()
        return {r.pmid: r.status for r in load_registry(spark, root).collect()}["0"]

    assert arrive("chunk_00005.csv", "failed") == "failed"
    publish_registry(retry_failed(load_registry(spark, root), NOW), root)
    assert arrive("chunk_00002.csv", "failed") == "pending"
    assert arrive("chunk_00006.csv", "completed") == "completed"
    assert arrive("chunk_00005b.csv", "failed") == "completed"


def test_the_state_store_keeps_one_row_an_id(spark, tmp_path):
    root, log, src, ckpt = (str(tmp_path / n) for n in ("registry", "log", "src", "ckpt"))
    publish_registry(start(spark), root)
    for n in range(2):
        put(tmp_path, f"src/chunk_{n}.csv", lines(*((str(i % 3), "failed", i) for i in range(30))))
        query = ingest_stream(spark, src, root, log, ckpt)
        query.awaitTermination()
    state = [p["stateOperators"] for p in query.recentProgress if p["stateOperators"]]
    assert state and state[-1][0]["numRowsTotal"] == 3


def test_scan_stream_equals_batch(spark, tmp_path):
    root, pdfs = str(tmp_path / "registry"), tmp_path / "pdfs"
    for names in (["a/111111.pdf", "x.pdf"], ["b/111111.pdf", "222222.PDF"]):
        for name in names:
            put(pdfs, name, "abc")
        scan_stream(spark, str(pdfs), root, str(tmp_path / "ckpt")).awaitTermination()
    found = ids_from_listing(list_files(spark, str(pdfs), PDF_GLOB_ANY_CASE))
    assert result(load_registry(spark, root)) == result(insert_if_absent(empty(spark, REGISTRY), found, NOW))
