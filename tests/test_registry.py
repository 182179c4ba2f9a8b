import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from paperledger.operators import registry as reg
from paperledger.operators.attempts import clean_results, keep_first, keep_last, merge_summary, run_summary, suspect_fast
from paperledger.schema import REGISTRY, conform, empty
from tests.compare import spark_rows

THEN, NOW = datetime(2025, 1, 1), datetime(2025, 1, 9, 12)


def registry(spark, rows):
    """rows: dicts over the registry's columns."""
    full = [tuple({"created_at": THEN, "updated_at": THEN, **r}.get(f) for f in REGISTRY.names) for r in rows]
    return spark.createDataFrame(full, REGISTRY)


def attempts(spark, rows):
    names = ["pmid", "status", "json_path", "error_msg", "processing_time", "chunk_file", "row_idx"]
    schema = "pmid string, status string, json_path string, error_msg string, processing_time string, chunk_file string, row_idx long"
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def by_id(df):
    return {r.pmid: r for r in df.collect()}


def test_insert_first_wins_and_twice_is_once(spark):
    new = spark.createDataFrame(
        [("1", "b.pdf", 1), ("1", "a.pdf", 2), ("0012", "c.pdf", 3), (" ", "d.pdf", 4)], "pmid string, pdf_path string, n int"
    )
    once = reg.insert_if_absent(empty(spark, REGISTRY), new, NOW, ("n",))
    got = by_id(once)
    assert set(got) == {"1", "0012"} and got["1"].pdf_path == "b.pdf"
    assert got["1"].status == "pending" and got["1"].created_at == NOW
    assert spark_rows(reg.insert_if_absent(once, new, datetime(2026, 1, 1), ("n",))) == spark_rows(once)


def test_insert_keeps_known_rows(spark):
    old = registry(spark, [{"pmid": "1", "status": "completed", "pdf_path": "x"}])
    new = spark.createDataFrame([("1", "y", 5), ("2", "z", 6)], "pmid string, pdf_path string, file_size long")
    got = by_id(reg.insert_if_absent(old, new, NOW))
    assert got["1"].status == "completed" and got["1"].pdf_path == "x" and got["2"].file_size == 6
    counts = reg.ingest_counts(old, new).first()
    assert (counts.existing, counts.added, counts.already_known, counts.total) == (1, 1, 1, 2)


def test_apply_overwrites_with_null_and_ignores_unknown(spark):
    old = registry(spark, [
        {"pmid": "1", "status": "completed", "json_path": "j", "file_size": 7, "processing_time": 1.0},
        {"pmid": "2", "status": "pending"},
    ])
    new = attempts(spark, [
        {"pmid": "1 ", "status": "failed", "json_path": " ", "processing_time": "x", "chunk_file": "c1", "row_idx": 0},
        {"pmid": "1", "status": "completed", "json_path": "k", "chunk_file": "c0", "row_idx": 9},
        {"pmid": "9", "status": "completed", "chunk_file": "c0", "row_idx": 1},
    ])
    got = by_id(reg.apply_results(old, new, NOW))
    assert set(got) == {"1", "2"}
    one = got["1"]
    assert (one.status, one.json_path, one.processing_time, one.file_size) == ("failed", None, None, 7)
    assert (one.created_at, one.updated_at, got["2"].updated_at) == (THEN, NOW, THEN)


def test_complete_keeps_error_and_time_and_leaves_null_status(spark):
    old = registry(spark, [
        {"pmid": "1", "status": "failed", "error_msg": "e", "processing_time": 2.0},
        {"pmid": "2", "status": None},
        {"pmid": "3", "status": "completed", "json_path": "old"},
    ])
    out = spark.createDataFrame([("1", "b", None), ("1", "a", "a.md"), ("2", "c", None), ("3", "d", None)], "pmid string, json_path string, md_path string")
    got = by_id(reg.complete_from_outputs(old, out, NOW))
    assert (got["1"].status, got["1"].json_path, got["1"].md_path, got["1"].error_msg, got["1"].processing_time) == ("completed", "a", "a.md", "e", 2.0)
    assert got["2"].status is None and got["2"].json_path is None and got["3"].json_path == "old"


def test_retry_then_update_is_update(spark):
    old = registry(spark, [{"pmid": "1", "status": "failed", "json_path": "j", "error_msg": "e", "processing_time": 2.0}])
    retried = by_id(reg.retry_failed(old, NOW))["1"]
    assert (retried.status, retried.error_msg, retried.processing_time, retried.json_path) == ("pending", None, None, "j")
    new = attempts(spark, [{"pmid": "1", "status": "completed", "chunk_file": "c", "row_idx": 0}])
    assert spark_rows(reg.apply_results(reg.retry_failed(old, NOW), new, NOW)) == spark_rows(reg.apply_results(old, new, NOW))


def test_demote_and_backfill(spark):
    old = registry(spark, [
        {"pmid": "1", "status": "completed", "pdf_path": "a"}, {"pmid": "2", "status": "completed", "pdf_path": "b", "file_size": 3},
        {"pmid": "3", "status": "pending", "pdf_path": "c"}, {"pmid": "4", "status": None, "pdf_path": "d"},
    ])
    out = spark.createDataFrame([("2",), ("2",)], "pmid string")
    got = by_id(reg.demote_missing(old, out, NOW))
    assert [got[i].status for i in "1234"] == ["failed", "completed", "pending", None]
    listing = spark.createDataFrame([("a", 10), ("b", 99)], "path string, length long")
    sizes = by_id(reg.backfill_sizes(old, listing))
    assert [sizes[i].file_size for i in "1234"] == [10, 3, None, None]
    counts = reg.backfill_counts(old, listing).first()
    assert (counts.unknown, counts.updated, counts.missing) == (3, 1, 2)


def test_size_bounds(spark):
    mb5 = 5 * 1048576
    reg_df = registry(spark, [
        {"pmid": str(i), "status": s, "file_size": size, "pdf_path": "p"}
        for i, (s, size) in enumerate([("pending", mb5), ("failed", mb5 - 1), ("pending", mb5 + 1), ("completed", 5), ("pending", None)])
    ])

    def ids(**kw):
        return [r.pmid for r in reg.export_by_size(reg_df, **kw).collect()]

    assert ids(max_mb=5) == ["0", "1"] and ids(min_mb=5) == ["0", "2"] and ids(max_mb=5, max_exclusive=True) == ["1"]
    assert ids(min_mb=0, max_mb=0) == ["0", "1", "2"]


def test_reports(spark):
    df = registry(spark, [
        {"pmid": str(i), "status": "failed", "error_msg": ["", None, "x" * 80][i % 3], "updated_at": datetime(2025, 1, 1 + i // 2)}
        for i in range(7)
    ] + [{"pmid": "a", "status": "completed", "processing_time": 2.5}, {"pmid": "b", "status": None}])
    assert [(r.pmid, len(r.message)) for r in reg.recent_failures(df).collect()] == [("6", 13), ("4", 13), ("5", 60), ("2", 60), ("3", 13)]
    assert [tuple(r) for r in reg.status_counts(df, total_row=True).collect()] == [
        (None, 1, 11.1), ("completed", 1, 11.1), ("failed", 7, 77.8), ("Total", 9, 100.0)]
    assert reg.avg_time_completed(df).first().avg_time == 2.5
    assert reg.status_counts(empty(spark, REGISTRY)).count() == 0


def test_published_size_bands(spark):
    """Size bands as published: 116,559 + 266,098 + 46,580 + 20,738 = 449,975 documents."""
    mb = 1048576
    counts = [(116_559, 100), (266_098, mb), (46_580, 5 * mb), (20_738, 10 * mb)]
    df = spark.range(449_975).select(F.expr(
        "CASE WHEN id < 116559 THEN 100L WHEN id < 382657 THEN 1048576L WHEN id < 429237 THEN 5242880L ELSE 10485760L END"
    ).alias("file_size"))
    assert [(r.size_band, r.n) for r in reg.size_histogram(df).collect()] == list(zip(["<1MB", "1-5MB", "5-10MB", ">10MB"], [n for n, _ in counts]))


def test_keep_last_does_not_depend_on_partitions(spark):
    rng = random.Random(1)
    rows = [
        {"pmid": rng.choice(["hot", str(rng.randrange(40)), " "]), "status": rng.choice("abc"), "chunk_file": f"c{rng.randrange(9)}", "row_idx": i}
        for i in range(600)
    ]
    want = {}
    for r in sorted(rows, key=lambda r: (r["chunk_file"], r["row_idx"])):
        if r["pmid"].strip():
            want[r["pmid"]] = (r["status"], r["row_idx"])
    first = {}
    for r in sorted(rows, key=lambda r: r["row_idx"]):
        if r["pmid"].strip():
            first.setdefault(r["pmid"], r["row_idx"])
    for n in (1, 7):
        df = attempts(spark, rng.sample(rows, len(rows))).repartition(n)
        last = keep_last(df)
        assert {r.pmid: (r.status, r.row_idx) for r in last.collect()} == want
        assert {r.pmid: r.row_idx for r in keep_first(df, "pmid", ("row_idx",)).collect()} == first
    assert spark_rows(keep_last(last)) == spark_rows(last)


def test_merge_summary_before_dedup(spark):
    times = ["", "12.5", "abc", "nan", "0", "7.5", None]
    df = attempts(spark, [{"pmid": "1" if i else " ", "status": "completed" if i < 4 else "failed", "processing_time": t} for i, t in enumerate(times)])
    row = merge_summary(df).first()
    assert (row.total, row.completed, row.failed, row.pending, row.avg_time, row.unique_ids) == (7, 4, 3, 0, 10.0, 1)
    assert (row.completed_pct, row.failed_pct) == (57.1, 42.9)
    none = merge_summary(df.limit(0)).first()
    assert (none.total, none.avg_time, none.completed_pct) == (0, 0.0, 0.0)


def test_run_summary_and_suspects(spark):
    df = attempts(spark, [{"pmid": "1", "status": "completed", "processing_time": "49.9"}, {"pmid": "2", "status": "odd"}])
    row = run_summary(df, df.select("pmid")).first()
    assert (row.completed, row.failed, row.skipped, row.ok) == (1, 1, 2, False)
    assert [r.pmid for r in suspect_fast(clean_results(df)).collect()] == ["1"]


def test_additive_migration(spark):
    old = spark.createDataFrame([("1", "pending")], "pmid string, status string")
    new = conform(old, REGISTRY)
    assert new.schema.fieldNames() == REGISTRY.fieldNames()
    assert new.first().file_size is None and new.schema["file_size"].dataType.simpleString() == "bigint"


@pytest.mark.parametrize("bad", [None, ""])
def test_status_is_written_as_given(spark, bad):
    old = registry(spark, [{"pmid": "1", "status": "pending"}])
    new = attempts(spark, [{"pmid": "1", "status": bad, "chunk_file": "c", "row_idx": 0}])
    assert reg.apply_results(old, new, NOW).first().status == ""
