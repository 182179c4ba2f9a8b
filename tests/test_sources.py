import pytest

from paperledger.operators.attempts import clean_results, keep_last
from paperledger.operators.chunks import with_file_index
from paperledger.sources import attempts, content, csv_files, listings, logs, manifests, snapshots


def put(folder, name, body):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(body, encoding="utf-8")
    return str(path)


def test_manifest_header_blanks_and_quotes(spark, tmp_path):
    path = put(tmp_path, "m.csv", '" PMID ",Pdf_Path\n 0012345678 ,pdfs/1/x.pdf\n,pdfs/1/a.pdf\n123456,\n"77","p/""q"",r.pdf"\n\n')
    strict = manifests.read_manifest(spark, path)
    assert sorted((r.pmid, r.pdf_path) for r in strict.collect()) == [("0012345678", "pdfs/1/x.pdf"), ("77", 'p/"q",r.pdf')]
    lenient = manifests.read_manifest(spark, path, require_id=False)
    assert ("a", "pdfs/1/a.pdf") in {(r.pmid, r.pdf_path) for r in lenient.collect()}


def test_manifest_newline_in_field_is_noticed(spark, tmp_path):
    path = put(tmp_path, "m.csv", 'pmid,pdf_path\n1,"a\nb.pdf"\n2,c.pdf\n')
    assert len(csv_files.spanning_files(spark, path)) == 1
    assert sorted((r.pmid, r.pdf_path) for r in manifests.read_manifest(spark, path).collect()) == [("1", "a\nb.pdf"), ("2", "c.pdf")]


def test_colliding_headers_last_wins(spark, tmp_path):
    path = put(tmp_path, "m.csv", "pmid,PMID ,pdf_path\n1,2,x.pdf\n")
    assert manifests.read_manifest(spark, path).first().pmid == "2"


def test_file_index_over_many_splits(spark, tmp_path):
    folder = tmp_path / "m"
    n = 0
    for part in range(3):
        lines = [f"{n + i:06d},p/{n + i}.pdf" for i in range(2000 + part)]
        put(folder, f"part-{part}.csv", "pmid,pdf_path\n" + "\n".join(lines) + "\n")
        n += len(lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    try:
        raw = manifests.read_raw_manifest(spark, str(folder))
        assert raw.rdd.getNumPartitions() > 5
        rows = with_file_index(raw).select("pmid", "row_idx").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rows) == n and all(int(r.pmid) == r.row_idx for r in rows)


def test_id_list(spark, tmp_path):
    path = put(tmp_path, "ids.txt", "# head\n123\n\n  456 \n#789\n")
    assert [r.pmid for r in manifests.read_id_list(spark, path).collect()] == ["123", "456"]


HEADER = "pmid,pdf_path,status,json_path,md_path,processing_time,error_msg,processed_at\n"


def test_attempts_last_by_file_then_row(spark, tmp_path):
    put(tmp_path, "chunk_00001.csv", HEADER + "1,p,failed,,,3.0,late,2025-01-01T00:00:00\n")
    put(tmp_path, "chunk_00000.csv", HEADER + "1,p,completed,j,m,1.5,,x\n2,p,failed,,,nan,\"a\n\"\"b\"\"\",x\n2,p,completed,j2,,2,,x\n,p,completed,,,1,,x\n")
    put(tmp_path, "chunk_00002.csv", "\n")  # all skipped: no header, no rows
    put(tmp_path, "other.csv", HEADER + "9,p,failed,,,1,,x\n")
    raw = attempts.read_attempts(spark, str(tmp_path))
    assert raw.count() == 5
    last = {r.pmid: (r.status, r.json_path, r.error_msg) for r in keep_last(clean_results(raw)).collect()}
    assert last == {"1": ("failed", None, "late"), "2": ("completed", "j2", None)}


def test_attempts_blank_first_file(spark, tmp_path):
    put(tmp_path, "chunk_00000.csv", "\n")
    put(tmp_path, "chunk_00001.csv", HEADER + "1,p,failed,,,3.0,late,x\n")
    assert attempts.read_attempts(spark, str(tmp_path)).select("pmid").collect()[0].pmid == "1"


def test_attempts_short_row_is_null(spark, tmp_path):
    put(tmp_path, "chunk_00000.csv", HEADER + "1,p,failed\n")
    row = clean_results(attempts.read_attempts(spark, str(tmp_path))).first()
    assert (row.pmid, row.status, row.error_msg, row.processing_time) == ("1", "failed", None, None)


def test_attempts_with_other_headers_go_by_name(spark, tmp_path):
    put(tmp_path, "chunk_00000.csv", HEADER + '1,p,failed,,,3.0,"late\nvery",x\n')
    put(tmp_path, "a b/chunk_00001.csv", "Status , PMID\nfailed,2\n")
    put(tmp_path, "chunk_00002.csv", HEADER + "3,p,completed,j,,1.0,,x\n")
    rows = attempts.read_attempts(spark, [str(tmp_path), str(tmp_path / "a b")]).collect()
    got = {r.pmid: (r.status, r.error_msg, r.processing_time) for r in rows}
    assert got == {"1": ("failed", "late\nvery", "3.0"), "2": ("failed", None, None), "3": ("completed", None, "1.0")}


def test_files_of_one_name_stay_apart(spark, tmp_path):
    put(tmp_path, "a/chunk_00000.csv", HEADER + "1,p,failed,,,3.0,late,x\n")
    put(tmp_path, "b/chunk_00000.csv", HEADER + "1,p,completed,j,,4.0,,x\n2,p,completed,j,,4.0,,x\n")
    rows = attempts.read_attempts(spark, [str(tmp_path / "a"), str(tmp_path / "b")])
    assert len({r.chunk_file for r in rows.collect()}) == 2
    assert {r.pmid: r.status for r in keep_last(rows).collect()} == {"1": "completed", "2": "completed"}


def test_attempt_log_keeps_run_backend_and_order(spark, tmp_path):
    df = spark.createDataFrame(
        [("1", "p", "completed", "nova", "cn23", "z", 5), ("2", "p", "failed", None, None, "z", 6)],
        "pmid string, pdf_path string, status string, backend string, node_prefix string, chunk_file string, row_idx long")
    log = str(tmp_path / "log")
    attempts.write_attempts(df, log, "007")
    attempts.write_attempts(df.filter("pmid = '1'").selectExpr("pmid", "pdf_path", "'failed' AS status", "'a' AS chunk_file", "0L AS row_idx"), log, "008")
    rows = attempts.read_attempt_log(spark, log)
    assert {(r.run_id, r.pmid, r.backend, r.node_prefix, r.pdf_path) for r in rows.collect()} == {
        ("007", "1", "nova", "cn23", "p"), ("007", "2", None, None, "p"), ("008", "1", None, None, "p")}
    assert {r.pmid: r.status for r in keep_last(rows).collect()} == {"1": "failed", "2": "failed"}


def test_attempts_parquet(spark, tmp_path):
    import pandas as pd

    pd.DataFrame({"PMID": ["1", "2", "1"], "status": ["failed", "completed", "completed"]}).to_parquet(tmp_path / "chunk_0.parquet")
    raw = attempts.read_attempts(spark, str(tmp_path), "chunk_*.parquet")
    assert {r.pmid: r.status for r in keep_last(clean_results(raw)).collect()} == {"1": "completed", "2": "completed"}


def test_write_attempts_keeps_other_runs(spark, tmp_path):
    df = spark.createDataFrame([("1", "failed")], "pmid string, status string")
    for run in ("a", "b", "b"):
        attempts.write_attempts(df, str(tmp_path / "log"), run)
    assert sorted(r.run_id for r in spark.read.parquet(str(tmp_path / "log")).collect()) == ["a", "b"]


def test_union_attempts_fills_missing_columns(spark):
    a = spark.createDataFrame([("1", "failed")], "pmid string, status string")
    b = spark.createDataFrame([("completed", "2", 1.5)], "status string, pmid string, processing_time double")
    got = {r.pmid: (r.status, r.processing_time) for r in attempts.union_attempts(a, b).collect()}
    assert got == {"1": ("failed", None), "2": ("completed", 1.5)}


def test_listings(spark, tmp_path):
    for name in ("d/123456.pdf", "PMC7654321.PDF", "12.pdf", "x.txt"):
        put(tmp_path, name, "abc")
    stems = [r.pmid for r in listings.discover_pdfs(spark, str(tmp_path)).collect()]
    assert stems == ["12", "123456"]
    found = listings.ids_from_listing(listings.list_files(spark, str(tmp_path), listings.PDF_GLOB_ANY_CASE))
    assert sorted((r.pmid, r.file_size) for r in found.collect()) == [("123456", 3), ("7654321", 3)]
    assert all(r.pdf_path.startswith(str(tmp_path)) for r in found.collect())


def test_tree_listing_equals_the_reader(spark, tmp_path):
    root = tmp_path / "t r%20é#"
    for name in ("a/b/1 x.pdf", "a/ü;[1].PDF", "a/b/c/d/e/2.md", "x=1/3_content_list.json", "_hidden/4.pdf", ".git/5.pdf", "_x=2/6.pdf", "_metadata", "7._COPYING_", "8", "a/new\nline.pdf"):
        put(root, name, name)
    (root / "empty/inner").mkdir(parents=True)
    (root / "far").symlink_to(put(tmp_path, "far/9.pdf", "nine").rsplit("/", 1)[0])
    (root / "10.pdf").symlink_to(root / "8")
    (root / "gone.pdf").symlink_to(root / "nowhere")
    rows = lambda df: sorted((r.path, r.length) for r in df.collect())
    for glob in ("*", "*.pdf", listings.PDF_GLOB_ANY_CASE, listings.OUTPUT_GLOB, "?.pdf"):
        want = rows(listings.list_files(spark, str(root), glob))
        assert rows(listings.list_tree(spark, str(root), glob)) == want and want, glob
        assert rows(listings.list_tree(spark, f"file://{root}/", glob)) == want
    (root / "a/loop").symlink_to(root)
    assert rows(listings.list_tree(spark, str(root))) == rows(listings.list_tree(spark, f"file:{root}"))


def test_tree_listing_keeps_no_file_in_the_driver(spark, tmp_path):
    for i in range(300):
        put(tmp_path / "t", f"{i % 17}/{i}.pdf", "x")
    found = listings.list_tree(spark, str(tmp_path / "t"))
    assert found.count() == 300 and len(found.inputFiles()) < 60 and not any(f.endswith(".pdf") for f in found.inputFiles())


def test_listing_reads_no_content(spark, tmp_path):
    put(tmp_path, "1.pdf", "abc")
    plan = listings.list_files(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


def test_outputs_and_content_lists(spark, tmp_path):
    put(tmp_path, "123/123456/auto/123456_content_list.json", '[{"type":"text","text":"a","page_idx":0,"bbox":[1,2.5]},{"type":"image","text":null}]')
    put(tmp_path, "123/123456/auto/123456.md", "a")
    put(tmp_path, "777777/vlm/paper_content_list.json", "{broken")
    outputs = listings.outputs_from_listing(listings.list_files(spark, str(tmp_path)))
    got = {r.pmid: r.md_path for r in outputs.collect()}
    assert got["123456"].endswith("123456.md") and got["777777"] is None
    rows = content.read_content_lists(spark, str(tmp_path)).orderBy("seq").collect()
    assert [(r.pmid, r.seq, r.type, r.bbox) for r in rows if r.error is None] == [("123456", 0, "text", [1.0, 2.5]), ("123456", 1, "image", None)]
    assert [(r.pmid, r.seq, r.type, r.error) for r in rows if r.error] == [("paper", None, None, content.NOT_A_LIST)]


def test_unknown_fields_of_elements_survive(spark, tmp_path):
    body = '[{"type":"table","table_body":"<td>1</td>","table_caption":["a","b"],"text_level":"x","bbox":[1,2]},{"type":"equation","text":5}]'
    put(tmp_path, "1_content_list.json", body)
    rows = content.read_content_lists(spark, str(tmp_path)).orderBy("seq")
    got = rows.select("type", "text", "text_level", content.element_field("table_body").alias("body"), content.element_field("table_caption", "array<string>").alias("caption")).collect()
    assert [tuple(r) for r in got] == [("table", None, None, "<td>1</td>", ["a", "b"]), ("equation", "5", None, None, None)]
    content.write_by_prefix(rows, str(tmp_path / "out"))
    kept = content.read_by_prefix(spark, str(tmp_path / "out"), schema=rows.schema)
    assert sorted(r[0] or "" for r in kept.select(content.element_field("table_body")).collect()) == ["", "<td>1</td>"]


def test_content_lists_of_other_shapes(spark):
    lists = [None, "", "5", "[1]", '{"type": "text"}', "[]", "[null]", '[{"type": "text"}]', '[{"type": "text"}']
    df = spark.createDataFrame(list(enumerate(lists)), "id int, content string")
    rows = {r.id: r for r in content.explode_content(df, "content").collect()}
    assert sorted(rows) == [0, 1, 2, 3, 4, 6, 7, 8] and [i for i, r in rows.items() if r.error is None] == [7]


def test_logs(spark, tmp_path):
    put(tmp_path, "swarm_99_7.o", "start on cn2355\n[1/3] ✓ 12657658 (21.5s)\n[2/3] ✗ PMC/1 (3.0s)\n[3/3] Skipping 5 (already processed)\ncn3001\n")
    lines = logs.read_logs(spark, str(tmp_path))
    rows = sorted(logs.parse_log_lines(lines).collect())
    assert [tuple(r) for r in rows] == [(7, 1, 3, "completed", "12657658", 21.5), (7, 2, 3, "failed", "PMC/1", 3.0)]
    assert [tuple(r) for r in logs.chunk_nodes(lines).collect()] == [(7, "cn2355", "cn23")]
    attempt = logs.log_attempts(lines).orderBy("row_idx").first()
    assert (attempt.pmid, attempt.chunk_file, attempt.node_prefix) == ("12657658", "chunk_00007", "cn23")


def test_runs_of_one_chunk_stay_apart(spark, tmp_path):
    put(tmp_path, "swarm_1_7.o", "on cn2355\n[1/3] ✓ a (21.5s)\n[2/3] ✗ b (3.0s)\n  Error: tool\n    at line 2\nTraceback\n[3/3] ✓ c (9.0s)\n" + "-" * 60 + "\nCompleted: 2\n"
        "[1/3] Skipping a (already processed)\n[2/3] ✓ b (40.0s)\n[3/3] Skipping c (already processed)\n" + "-" * 60 + "\nFailed: 0\n")
    put(tmp_path, "swarm_2_7.o", "[2/3] ✗ b (1.0s)\n")
    rows = logs.log_attempts(logs.read_logs(spark, str(tmp_path))).orderBy("row_idx").collect()
    assert [(r.pmid, r.run, r.status, r.detail) for r in rows] == [
        ("a", 0, "completed", None), ("b", 0, "failed", "  Error: tool\n    at line 2\nTraceback"), ("c", 0, "completed", None),
        ("b", 1, "completed", None), ("b", 2, "failed", None)]
    last = keep_last(logs.log_attempts(logs.read_logs(spark, str(tmp_path))))
    assert {r.pmid: (r.run, r.processing_time) for r in last.collect()} == {"a": (0, 21.5), "b": (2, 1.0), "c": (0, 9.0)}


def test_gpu_samples(spark, tmp_path):
    put(tmp_path, "s.csv", "cn1, Tesla V100-SXM2-32GB-LS with more, 97, 60, 250.1, 100, 16280\n")
    row = logs.read_gpu_samples(spark, str(tmp_path)).first()
    assert (row.gpu_short, row.memory, row.utilization) == ("Tesla V100-SXM2-32GB-LS ", "100/16280MB", "97")


def test_by_prefix_prunes(spark, tmp_path):
    df = spark.createDataFrame([("001234567",), ("0019",), ("5",)], "pmid string")
    path = str(tmp_path / "out")
    content.write_by_prefix(df, path)
    stored = content.read_by_prefix(spark, path)
    assert sorted((r.prefix, r.pmid) for r in stored.collect()) == [("001", "001234567"), ("001", "0019"), ("5", "5")]
    scan = stored.filter("prefix = '001'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(prefix" in scan


def test_manifest_written_in_order_and_not_when_empty(spark, tmp_path):
    df = spark.createDataFrame([("2", "b"), ("10", "a")], "pmid string, pdf_path string")
    assert manifests.write_manifest(df, str(tmp_path / "m"))
    body = "".join(p.read_text() for p in sorted((tmp_path / "m").glob("part-*.csv")))
    assert [line for line in body.split("\n") if line and "pmid" not in line] == ["10,a", "2,b"]
    assert not manifests.write_manifest(df.limit(0), str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()


def test_snapshots(spark, tmp_path):
    root = str(tmp_path / "r")
    assert snapshots.load_registry(spark, root).count() == 0
    one = spark.createDataFrame([("1", "pending")], "pmid string, status string")
    assert snapshots.publish_registry(one, root) == 1
    with pytest.raises(ValueError):
        snapshots.publish_registry(one.union(one), root)
    assert snapshots.latest_version(spark, root) == 1
    assert snapshots.publish_registry(snapshots.load_registry(spark, root), root) == 2
    assert snapshots.load_registry(spark, root).first().status == "pending"
    assert snapshots.query_registry(spark, snapshots.load_registry(spark, root), "SELECT count(*) n FROM registry").first().n == 1


def test_tsv(spark, tmp_path):
    snapshots.write_tsv(spark.createDataFrame([("1", None, 2)], "a string, b string, c int").coalesce(1), str(tmp_path / "t"))
    assert next((tmp_path / "t").glob("part-*")).read_text() == "a\tb\tc\n1\t\t2\n"
