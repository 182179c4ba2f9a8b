import pytest

from paperledger.operators import audit, compare, usage
from paperledger.operators.layout import layout_plan


def ids(spark, lo, hi, copies=1):
    return spark.range(lo, hi).selectExpr("CAST(id AS STRING) AS pmid", "'completed' AS status").union(
        spark.range(lo, lo + copies).selectExpr("CAST(id AS STRING)", "'completed'"))


def test_published_completion_audit(spark):
    """253,443 recorded, 134,688 with output, overlap 80,812: 172,631 missing, 53,876 unrecorded."""
    recorded = ids(spark, 0, 253_443, copies=50)
    outputs = ids(spark, 253_443 - 80_812, 253_443 - 80_812 + 134_688, copies=50).select("pmid")
    row = audit.completion_audit(recorded, outputs).first()
    assert (row.completed, row.with_output, row.overlap, row.missing, row.unrecorded) == (253_443, 134_688, 80_812, 172_631, 53_876)
    assert row.missing_pct == 68.1
    assert audit.missing_outputs(recorded, outputs).count() == 172_631
    assert audit.unrecorded_outputs(recorded, outputs).count() == 53_876
    assert audit.overlapping_outputs(recorded, outputs).count() == 80_812


def test_published_failure_rates(spark):
    """Completed and with output per node prefix as published; silent failures 10553, 9, 0, 2."""
    published = {"cn23": (10_553, 0, 393, "P100"), "cn30": (3_667, 3_658, 141, "K80"), "cn41": (458, 458, 16, "K80"), "cn42": (1_062, 1_060, 37, "K80")}
    attempts, outputs = None, None
    for node, (completed, found, chunks, _) in published.items():
        a = spark.range(completed).selectExpr(
            f"concat('{node}-', id) AS pmid", "'completed' AS status", f"concat('{node}-', id % {chunks}) AS chunk_file",
            f"'{node}' AS node_prefix", "CAST(10 AS DOUBLE) AS processing_time")
        o = spark.range(found).selectExpr(f"concat('{node}-', id) AS pmid")
        attempts = a if attempts is None else attempts.union(a)
        outputs = o if outputs is None else outputs.union(o)
    nodes = spark.createDataFrame([(n, p[3]) for n, p in published.items()], "node_prefix string, gpu_type string")
    got = {r.node_prefix: r for r in audit.failure_by_node(attempts.union(attempts), outputs, nodes).collect()}
    for node, (completed, found, chunks, gpu) in published.items():
        r = got[node]
        assert (r.completed, r.with_output, r.chunks, r.gpu_type, r.avg_time) == (completed, found, chunks, gpu, 10.0)
        assert r.silent_failures == completed - found
    assert [got[n].fail_pct for n in published] == [100.0, 0.2, 0.0, 0.2]


def test_time_by_outcome(spark):
    df = spark.createDataFrame(
        [("1", "completed", 200.0), ("1", "completed", 600.0), ("2", "completed", 10.0), ("3", "failed", 46.0), ("3", "failed", None)],
        "pmid string, status string, processing_time double")
    got = {r.outcome: tuple(r)[1:] for r in audit.time_by_outcome(df, spark.createDataFrame([("1",)], "pmid string")).collect()}
    assert got == {"success": (2, 200.0, 200.0, 600.0), "silent": (1, 10.0, 10.0, 10.0), "failed": (1, 46.0, 46.0, 46.0)}


def test_pending_work_knows_the_layouts(spark):
    manifest = spark.createDataFrame([(str(100000 + i), f"p{i}") for i in range(8)], "pmid string, pdf_path string")
    listing = spark.createDataFrame([(p, 1) for p in [
        "out/100/100000/auto/100000_content_list.json",
        "out/100/100001/100001/hybrid_auto/100001_content_list.json",
        "out/100002/auto/100002_content_list.json",
        "out/100/100003/vlm/100003_content_list.json",
        "out/100/100004/auto/paper_content_list.json",
        "out/100005/100005/auto/100005_content_list.json",
        "out/100/100006/auto/100006.md",
    ]], "path string, length long")
    assert sorted(r.pmid for r in audit.pending_work(manifest, listing).collect()) == [str(100000 + i) for i in (3, 5, 6, 7)]
    with_vlm = audit.pending_work(manifest, listing, subdirs=("auto", "hybrid_auto", "vlm"))
    assert with_vlm.filter("pmid = '100003'").count() == 0
    assert audit.skipped_work(manifest, listing).count() == 4
    assert audit.pending_work(manifest, listing, root="elsewhere").count() == 8


def test_missing_inputs(spark):
    manifest = spark.createDataFrame([("1", "a"), ("2", "b")], "pmid string, pdf_path string")
    row = audit.missing_inputs(manifest, spark.createDataFrame([("a", 1)], "path string, length long")).first()
    assert (row.pmid, row.status, row.error_msg, row.processing_time) == ("2", "failed", "PDF file not found: b", None)


def test_paths_compare_without_scheme(spark):
    manifest = spark.createDataFrame([("1", "/in/a.pdf"), ("2", "s3://b/in/b.pdf"), ("3", "in/c.pdf")], "pmid string, pdf_path string")
    listing = spark.createDataFrame([("hdfs://host/in/a.pdf", 1), ("file:/in/b.pdf", 1), ("in/c.pdf", 1)], "path string, length long")
    assert audit.missing_inputs(manifest, listing).count() == 0


def plan(spark, paths, **kw):
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    return {r.path or r.pmid: (r.action, r.dest, r.reason) for r in layout_plan(df, **kw).collect()}


def test_layout_cases(spark):
    flat, nested, home = "out/123456/auto/f", "out/123/123457/123457/auto/f", "out/123/123458/auto/f"
    got = plan(spark, [flat, nested, home])
    assert got[flat] == ("MOVE", "out/123/123456/auto/f", None)
    assert got[nested] == ("FLATTEN", "out/123/123457/auto/f", None)
    assert got[home][0] == "NONE"
    assert plan(spark, [flat, nested], mode="flatten")[flat][0] == "NONE"
    assert plan(spark, [flat, nested], mode="move")[nested][0] == "NONE"


def test_layout_conflicts(spark):
    paths = ["out/123456/auto/f", "out/123/123456/hybrid_auto/g", "out/123/123456/123456/hybrid_auto/f", "out/123/123456/123456/auto/f"]
    got = plan(spark, paths)
    assert got[paths[0]] == ("SKIP", "out/123/123456/auto/f", "destination exists")
    assert got[paths[2]][0] == "SKIP" and got[paths[3]][0] == "FLATTEN"
    both = plan(spark, ["out/123456/auto/f", "out/123456/123456/auto/g", "out/123456/123456/vlm/g"])
    assert both["out/123456/auto/f"][0] == "MOVE" and both["out/123456/123456/auto/g"][0] == "SKIP"
    assert both["out/123456/123456/vlm/g"] == ("MOVE", "out/123/123456/vlm/g", None)
    other_root = plan(spark, ["a/123456/auto/f", "b/123/123456/auto/f"])
    assert other_root["a/123456/auto/f"][0] == "MOVE"


def test_layout_for_ids(spark):
    ids = spark.createDataFrame([("123456",), ("999999",)], "pmid string")
    got = plan(spark, ["out/123456/auto/f", "out/123457/auto/f"], ids=ids)
    assert got == {"out/123456/auto/f": ("MOVE", "out/123/123456/auto/f", None), "999999": ("SKIP", None, "source missing")}
    flat = plan(spark, ["out/123456/auto/f", "out/123/123457/auto/f"], mode="flatten", ids=spark.createDataFrame([("123456",), ("123457",), ("9",)], "pmid string"))
    assert {k: v[2] for k, v in flat.items() if v[0] == "SKIP"} == {
        "123456": "destination does not exist", "123457": "nothing nested", "9": "destination does not exist"}
    moved = plan(spark, ["out/123456/auto/f", "out/123/123457/auto/f"], mode="move", ids=spark.createDataFrame([("123456",), ("123457",)], "pmid string"))
    assert moved["out/123456/auto/f"][0] == "MOVE" and moved["123457"] == ("SKIP", None, "source does not exist")


PUBLISHED = {"A100": (50, 167, 392), "V100x": (74, 349, 830), "V100": (74, 367, 881), "P100": (100, 415, 984), "K80": (462, None, None), "CPU": (536, None, None)}


def test_published_relative_speeds(spark):
    rows = [(g, b, float(s) if s else None) for g, t in PUBLISHED.items() for b, s in zip(compare.REPORT_BACKENDS, t)]
    timings = spark.createDataFrame(rows, "gpu_type string, backend string, seconds double")
    pivot = {r.gpu_type: tuple(r)[1:-1] for r in compare.backend_pivot(timings).collect()}
    assert pivot == {g: tuple(float(s) if s else None for s in t) for g, t in PUBLISHED.items()}
    got = {r.gpu_type: (r.pipeline, r.hybrid, r.vlm) for r in compare.relative_speed(timings).collect()}
    assert got == {"A100": (1.0, 3.3, 7.8), "V100x": (1.0, 4.7, 11.2), "V100": (1.0, 5.0, 11.9), "P100": (1.0, 4.2, 9.8), "K80": (1.0, None, None), "CPU": (1.0, None, None)}


def test_published_element_counts(spark):
    vlm = {"text": 110, "image": 37, "header": 22, "page_number": 16, "list": 7, "footer": 2, "equation": 2}
    pipe = {"text": 111, "image": 7, "equation": 2, "discarded": 20}
    rows = [("1", b, i, t, "x") for b, counts in (("pipeline", pipe), ("vlm", vlm)) for t, n in counts.items() for i in range(n)]
    df = spark.createDataFrame(rows, "pmid string, backend string, seq int, type string, text string")
    got = {r.type: (r.pipeline, r.hybrid, r.vlm) for r in compare.element_types(df).collect()}
    assert got == {t: (pipe.get(t, 0), 0, vlm.get(t, 0)) for t in set(pipe) | set(vlm)}
    assert {r.backend: r.n_elements for r in compare.doc_structure(df).collect()} == {"pipeline": 140, "vlm": 196}


def test_output_consistency(spark):
    rows = [("1", "vlm", g, t) for g, t in [("A100", r"$\mathbf{K}$ a"), ("V100", r"$\mathbb { K }$ a"), ("V100x", r"$\mathbb { K }$ a"), ("P100", "b")]]
    df = spark.createDataFrame(rows, "pmid string, backend string, run string, text string")
    raw = compare.output_consistency(compare.text_digests(df)).first()
    assert (raw.runs, raw.distinct_digests, raw.largest_group, raw.consistent) == (4, 3, 2, False)
    folded = compare.text_digests(df, tolerant=True)
    assert compare.output_consistency(folded).first().distinct_digests == 2
    assert {r.run: r.same_output for r in compare.agreeing_runs(folded).collect()} == {"A100": 3, "V100": 3, "V100x": 3, "P100": 1}


def test_content_digest_sees_order_and_not_partitions(spark):
    rows = [("1", "vlm", "a", 0, "text", "x"), ("1", "vlm", "a", 1, "text", "y"), ("1", "vlm", "b", 1, "text", "y"), ("1", "vlm", "b", 0, "text", "x"),
            ("1", "vlm", "c", 0, "text", "y"), ("1", "vlm", "c", 1, "text", "x")]
    df = spark.createDataFrame(rows, "pmid string, backend string, run string, seq long, type string, text string").repartition(4)
    digests = {r.run: r.digest for r in compare.content_digests(df).collect()}
    assert digests["a"] == digests["b"] != digests["c"]


def test_usage(spark):
    samples = spark.createDataFrame([("n", "g", u) for u in (" 10 ", "11", "[N/A]", "", "3.5")], "node string, gpu_name string, utilization string")
    assert [tuple(r) for r in usage.gpu_utilization(samples).collect()] == [("n", "g", 2, 10)]
    files = spark.createDataFrame([("1", "a/1_content_list.json", 10), ("2", "b/2_content_list.json", 20), ("1", "a/images/x.jpg", 5), ("1", "a/images/y.jpg", 5)],
                                  "pmid string, path string, length long")
    got = {r.artifact: (r.files, r.bytes, r.documents, r.bytes_per_doc) for r in usage.storage_by_artifact(files).collect()}
    assert got == {"content_list": (2, 30, 2, 15.0), "other": (2, 10, 1, 10.0)}


@pytest.mark.parametrize("empty_side", ["attempts", "outputs"])
def test_audit_of_nothing(spark, empty_side):
    full = ids(spark, 0, 3)
    a = full.limit(0) if empty_side == "attempts" else full
    o = (full.limit(0) if empty_side == "outputs" else full).select("pmid")
    row = audit.completion_audit(a, o).first()
    assert (row.missing, row.unrecorded) == ((0, 3) if empty_side == "attempts" else (3, 0))


def test_unknown_backends_and_classes_are_counted(spark):
    rows = [("1", "vlm-auto-engine", "text"), ("1", "pipeline", "text"), ("2", "nova", "text"), ("3", None, "list")]
    df = spark.createDataFrame(rows, "pmid string, backend string, type string")
    assert {r.type: tuple(r)[1:] for r in compare.element_types(df).collect()} == {"text": (1, 0, 1, 1), "list": (0, 0, 0, 1)}
    attempts = spark.createDataFrame(
        [("1", "completed", 2.0, None, "pipeline", "c"), ("2", "completed", 4.0, "cn99", "nova", "c"), ("3", "completed", 8.0, "cn23", "nova", "c")],
        "pmid string, status string, processing_time double, node_prefix string, backend string, chunk_file string")
    nodes = spark.createDataFrame([("cn23", "P100")], "node_prefix string, gpu_type string")
    pivot = {r.gpu_type: (r.pipeline, r.other) for r in compare.backend_pivot(compare.attempt_timings(attempts, nodes)).collect()}
    assert pivot == {None: (2.0, 4.0), "P100": (None, 8.0)}
    outputs = spark.createDataFrame([("2",)], "pmid string")
    got = {r.node_prefix: (r.chunks, r.completed, r.silent_failures) for r in audit.failure_by_node(attempts, outputs, nodes).collect()}
    assert got == {None: (1, 1, 1), "cn99": (1, 1, 0), "cn23": (1, 1, 1)}
