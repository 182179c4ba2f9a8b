import math

from pyspark.sql import functions as F

from paperledger.operators import chunks


def test_row_index_is_dense_and_ordered(spark):
    # A third of all rows share one id, another third one long prefix.
    df = spark.range(3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN concat('a-long-common-prefix-', lpad(id, 8, '0')) ELSE lpad(hash(id), 12, '0') END AS pmid",
        "id AS n")
    rows = chunks.with_row_index(df, ["pmid"]).collect()
    assert sorted(r.row_idx for r in rows) == list(range(3000))
    in_order = [r.pmid for r in sorted(rows, key=lambda r: r.row_idx)]
    assert in_order == sorted(in_order)


def test_hot_value_is_spread(spark):
    df = spark.range(20000).selectExpr("'hot' AS pmid", "id AS n")
    indexed = chunks.with_row_index(df, ["pmid"])
    assert indexed.selectExpr("max(row_idx) AS m", "count(DISTINCT row_idx) AS d").first() == (19999, 20000)


def test_chunks_partition_the_manifest(spark):
    n, size = 1634, 100
    df = spark.range(n).selectExpr("CAST(id AS STRING) AS pmid", "id AS row_idx")
    plan = chunks.chunk_plan(df, size).orderBy("chunk_no").collect()
    assert len(plan) == math.ceil(n / size)
    assert sum(r.n_docs for r in plan) == n and [r.start_index for r in plan] == [i * size for i in range(len(plan))]
    assert plan[3].chunk_id == "chunk_00003" and plan[3].first_id == "300" and plan[-1].n_docs == 34
    assert chunks.trial_chunks(chunks.chunk_plan(df, size), 5).count() == 5


def test_published_chunk_count(spark):
    df = spark.range(163_315).selectExpr("CAST(id AS STRING) AS pmid", "id AS row_idx")
    assert chunks.chunk_plan(df, 100).count() == 1634


def manifest(spark):
    return spark.createDataFrame(
        [(str(i), "" if i == 1 else f"p/{i}.pdf", i) for i in range(6)], "pmid string, pdf_path string, row_idx long").repartition(3)


def test_slice_counts_accepted_rows(spark):
    got = chunks.manifest_slice(manifest(spark), 0, 3).orderBy("row_idx").collect()
    assert [r.row_idx for r in got] == [0, 2, 3]
    assert [r.row_idx for r in chunks.manifest_slice(manifest(spark), 4).orderBy("row_idx").collect()] == [4, 5]


def test_slice_ends_inside_a_block(spark, monkeypatch):
    monkeypatch.setattr(chunks, "SLICE_BLOCK", 2)
    for count in range(7):
        got = chunks.manifest_slice(manifest(spark), 0, count)
        assert sorted(r.row_idx for r in got.collect()) == [0, 2, 3, 4, 5][:count] and got.columns == ["pmid", "pdf_path", "row_idx"]


def test_equal_rows_are_spread(spark):
    same = spark.range(200_000).select(F.lit("x").alias("pmid"), F.lit("p").alias("pdf_path"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = chunks.with_row_index(same, ["pmid"]).withColumn("part", F.spark_partition_id())
        sizes = [r["count"] for r in got.groupBy("part").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) > 1 and max(sizes) < 150_000
    assert got.agg(F.count_distinct("row_idx"), F.max("row_idx")).first() == (200_000, 199_999)
