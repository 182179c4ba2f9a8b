import os
import subprocess
import sys
from datetime import datetime

from pyspark.sql import functions as F

from paperledger.operators.extract import Backend, paragraphs
from paperledger.plans.commands import Ledger
from paperledger.sources.attempts import read_attempt_log
from tests.test_sources import HEADER, put

NOW = datetime(2025, 1, 9)


def states(ledger):
    return {r.pmid: r.status for r in ledger.registry().collect()}


def words(pmid, source):
    if pmid == "222222":
        return [{"type": 7, "text": 1.5, "page_idx": "2", "bbox": [1]}, {"type": "text"}]
    return "no list of dicts"


def test_process_extracts_once_and_updates(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "registry"))
    ledger.init(put(tmp_path, "m.csv", "pmid,pdf_path\n0111111,a\n222222,b\n333333,c\n"), NOW)
    listing = spark.createDataFrame([("a", 1), ("b", 1)], "path string, length long")
    out = str(tmp_path / "out")
    counts = ledger.process(words, out, "run1", NOW, listing, timeout_s=30).first()
    assert (counts.completed, counts.failed, counts.ok) == (1, 2, False)
    got = {r.pmid: r for r in ledger.registry().collect()}
    assert got["222222"].status == "completed" and got["222222"].json_path == f"{out}/elements/run_id=run1/prefix=222"
    assert got["0111111"].error_msg.startswith("AttributeError") and got["333333"].error_msg == "PDF file not found: c"
    rows = spark.read.parquet(got["222222"].json_path).orderBy("seq").collect()
    assert [(r.type, r.text, r.page_idx, r.bbox) for r in rows] == [("7", "1.5", 2, [1.0]), ("text", None, None, None)]
    ledger.retry_failed(NOW)
    assert ledger.process(words, out, "run2", NOW, listing, timeout_s=30).first().failed == 2
    assert read_attempt_log_runs(spark, out) == ["run1", "run1", "run1", "run2", "run2"]


def test_process_with_two_backends(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "registry"))
    ledger.init(put(tmp_path, "m.csv", "pmid,pdf_path\n111111,a\n222222,b\n333333,c\n444444,d\n"), NOW)
    listing = spark.createDataFrame([("a", 1), ("b", 1), ("d", 1)], "path string, length long")
    chosen = F.when(F.col("pdf_path") < "b", "pipeline").when(F.col("pdf_path") < "d", "vlm-auto-engine")
    backends = {"pipeline": Backend(paragraphs), "vlm-auto-engine": Backend(words)}
    out = str(tmp_path / "out")
    counts = ledger.process(backends, out, "run1", NOW, listing, backend=chosen, timeout_s=30).first()
    assert (counts.completed, counts.failed) == (2, 2)
    got = {r.pmid: (r.status, r.error_msg) for r in ledger.registry().collect()}
    assert got == {"111111": ("completed", None), "222222": ("completed", None), "333333": ("failed", "PDF file not found: c"),
                   "444444": ("failed", "Unknown backend: none")}
    rows = spark.read.parquet(f"{out}/elements/run_id=run1").select("pmid", "backend").distinct().collect()
    assert {tuple(r) for r in rows} == {("111111", "pipeline"), ("222222", "vlm-auto-engine")}
    logged = read_attempt_log(spark, f"{out}/attempts").select("pmid", "backend").collect()
    assert dict(map(tuple, logged)) == {"111111": "pipeline", "222222": "vlm-auto-engine", "333333": "vlm-auto-engine", "444444": None}


def test_process_skips_resumes_and_agrees_with_the_audit(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "registry"))
    ledger.init(put(tmp_path, "m.csv", "pmid,pdf_path\n" + "".join(f"{i},p{i}\n" for i in range(111111, 111119))), NOW)
    listing = spark.createDataFrame([(f"p{i}", 1) for i in range(111111, 111119)], "path string, length long")
    there = spark.createDataFrame([("x/111/111111/auto/paper_content_list.json", 1)], "path string, length long")
    out, seen = str(tmp_path / "work"), str(tmp_path / "seen")

    def notes(pmid, source):
        with open(seen, "a") as f:
            f.write(pmid + "\n")
        return [{"type": "text", "text": source}]

    counts = ledger.process(notes, out, "007", NOW, listing, output_listing=there, batches=3).first()
    assert (counts.completed, counts.failed, counts.skipped) == (7, 0, 1)
    assert sorted(open(seen).read().split()) == [str(i) for i in range(111112, 111119)]
    before = states(ledger)
    ledger.scan_outputs(out, NOW)
    ledger.demote_missing(out, NOW)
    assert states(ledger) == before

    # The same run again, its second batch lost: only that one is extracted anew.
    lost = f"{out}/outcomes/run_id=007/batch=1"
    again = {r.pmid for r in spark.read.parquet(lost).collect()}
    os.rename(f"{lost}/_SUCCESS", f"{lost}/_gone")
    ledger._publish(ledger.registry().withColumn("status", F.lit("pending")), "as before")
    open(seen, "w").close()
    ledger.process(notes, out, "007", NOW, listing, output_listing=there, batches=3)
    assert set(open(seen).read().split()) == again
    assert {(r.run_id, r.backend, r.pdf_path) for r in read_attempt_log(spark, f"{out}/attempts").filter("pmid = '111112'").collect()} == {("007", "pipeline", "p111112")}


def read_attempt_log_runs(spark, out):
    return sorted(r.run_id for r in read_attempt_log(spark, f"{out}/attempts").collect())


SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from paperledger.operators.extract import extract_documents, paragraphs
from paperledger.session import build_session
spark = build_session("t", "local[2]", spark__ui__enabled="false")
df = spark.createDataFrame([("1", "a")], "pmid string, pdf_path string")
print("status", extract_documents(df, paragraphs).first().status)
"""


def test_executors_need_no_copy_of_the_package(tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(repo=repo)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert "status completed" in done.stdout, done.stderr[-2000:]


def test_a_registry_from_manifest_to_retry(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "registry"))
    ledger.init(put(tmp_path, "m.csv", "PMID,pdf_path\n111111,pdfs/111111.pdf\n222222,pdfs/222222.pdf\n333333,x\n"), NOW)
    put(tmp_path, "pdfs/222222.pdf", "abcd")
    put(tmp_path, "pdfs/PMC444444.PDF", "abc")
    ledger.scan_pdfs(str(tmp_path / "pdfs"), NOW)
    assert states(ledger) == {i: "pending" for i in ("111111", "222222", "333333", "444444")}

    put(tmp_path, "results/chunk_00000.csv", HEADER + "111111,p,completed,j,,20.5,,x\n222222,p,failed,,,3,oops,x\n")
    put(tmp_path, "results/chunk_00001.csv", HEADER + "222222,p,completed,j,,4,,x\n333333,p,failed,,,1,late,x\n")
    summary = ledger.merge(str(tmp_path / "results"), str(tmp_path / "merged.parquet"), as_of=NOW).first()
    assert (summary.total, summary.unique_ids) == (4, 3)
    assert spark.read.parquet(str(tmp_path / "merged.parquet")).count() == 3
    assert states(ledger) == {"111111": "completed", "222222": "completed", "333333": "failed", "444444": "pending"}

    put(tmp_path, "out/222/222222/auto/222222_content_list.json", "[]")
    put(tmp_path, "out/333/333333/hybrid_auto/333333_content_list.json", "[]")
    ledger.scan_outputs(str(tmp_path / "out"), NOW)
    ledger.demote_missing(str(tmp_path / "out"), NOW)
    assert states(ledger) == {"111111": "failed", "222222": "completed", "333333": "completed", "444444": "pending"}

    assert ledger.export_failed(str(tmp_path / "failed"))
    ledger.retry_failed(NOW)
    assert not ledger.export_failed(str(tmp_path / "none"))
    assert ledger.query("SELECT count(*) AS n FROM registry WHERE status = 'pending'").first().n == 2
    assert [(r.status, r.n) for r in ledger.status().collect()] == [("completed", 2), ("pending", 2), ("Total", 4)]

    results = put(tmp_path, "one.csv", HEADER + "444444,p,completed,,,4,,x\n")
    ledger.update(results, NOW)
    ledger.update_sizes(str(tmp_path / "pdfs"))
    assert states(ledger)["444444"] == "completed"
    assert {r.pmid: r.file_size for r in ledger.registry().collect()}["444444"] == 3
    assert ledger.export_by_size(str(tmp_path / "small"), max_mb=1) is False
