"""Registered queries against their SQL, and the plans they get."""

import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from paperledger.functions.text import canonical_latex
from paperledger.operators import alignment, attempts as att, audit, chunks, compare, layout, registry as reg
from tests.compare import duck_rows, spark_rows
from workload.oracle import _LATEX, ORACLE as SQL
from workload.queries import REGISTERED
from workload.views import TABLES, VIEWS, view, with_views

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = REGISTERED, {name: with_views(sql) for name, sql in SQL.items()}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(VIEWS))
def test_views_agree(spark, duck, name):
    assert spark_rows(view(spark, SF, name)) == duck_rows(duck, with_views(f"SELECT * FROM {name}"))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    assert spark_rows(QUERIES[name](spark, SF)) == duck_rows(duck, ORACLE[name])


def test_latex_on_any_text(spark):
    rng = random.Random(5)
    parts = ["$", "$", "$$", "\\(", "\\)", "\\[", "\\]", "\\$", "\\\\", "{", "}", " ", "\n", "a", "K2", "*", "\\mathbf", "\\text", "\\alpha", "\\", "\u00e9\U0001f600"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(30))) for _ in range(4000)]
    rows = [(str(i), "vlm", 0, t) for i, t in enumerate(texts)]
    con = duckdb.connect()
    con.register("fx_runs", pd.DataFrame(rows, columns=["pmid", "backend", "run", "text"]))
    want = dict(con.execute(f"WITH {_LATEX} SELECT pmid, folded FROM canon").fetchall())
    df = spark.createDataFrame(rows, "pmid string, backend string, run int, text string")
    got = {r[0]: r[1] for r in df.select("pmid", canonical_latex("text")).collect()}
    assert got == want and sum(got[i] != t for i, _, _, t in rows) > 500


def test_every_sql_has_a_query():
    assert set(ORACLE) == set(QUERIES)


def test_entry_has_them_all():
    assert set(REGISTERED) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).columns == ["status", "n", "pct"]


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def stored(spark, tmp_path, name):
    path = str(tmp_path / name)
    view(spark, SF, name).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def test_no_cross_products(spark):
    for name in ("failure_by_node", "layout_plan", "processed_manifest", "run_summary", "insert_if_absent", "time_by_outcome"):
        plan = physical(QUERIES[name](spark, SF))
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name


def test_export_reads_three_columns_and_pushes_the_filter(spark, tmp_path):
    plan = physical(reg.export_by_size(stored(spark, tmp_path, "fx_registry"), min_mb=1, max_mb=5))
    assert "ReadSchema: struct<pmid:string,pdf_path:string,status:string,file_size:bigint>" in plan
    assert "In(status, [" in plan and "GreaterThanOrEqual(file_size,1048576)" in plan


def test_keep_last_limits_before_the_shuffle(spark, tmp_path):
    plan = physical(att.keep_last(stored(spark, tmp_path, "fx_raw_attempts")))
    assert plan.count("WindowGroupLimit") == 2 and plan.count("Exchange") == 1


def test_apply_shuffles_the_attempts_once(spark, tmp_path):
    registry, attempts = stored(spark, tmp_path, "fx_registry"), stored(spark, tmp_path, "fx_raw_attempts")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = physical(reg.apply_results(registry, attempts, "2025-01-01"))
        assert plan.count("Exchange hashpartitioning") == 2
        plan = physical(audit.completion_audit(attempts, registry))
        assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
        plan = physical(reg.insert_if_absent(registry, attempts, "2025-01-01"))
        assert plan.count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_recent_failures_is_a_top_k(spark, tmp_path):
    assert "TakeOrderedAndProject" in physical(reg.recent_failures(stored(spark, tmp_path, "fx_registry")))


def test_a_hot_id_is_folded_before_the_shuffle(spark):
    """A third of 600,000 attempts on one id: the shuffle carries few rows of it."""
    hot = spark.range(0, 600_000, 1, 16).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id % 1000 AS STRING) END AS pmid", "'completed' AS status",
        "CAST(id AS DOUBLE) AS processing_time", "'c' AS chunk_file", "id AS row_idx", "'cn23' AS node_prefix")
    outputs = hot.select("pmid")
    nodes = spark.createDataFrame([("cn23", "P100")], "node_prefix string, gpu_type string")
    for df in (att.keep_last(hot), audit.completion_audit(hot, outputs), audit.failure_by_node(hot, outputs, nodes)):
        df.collect()
        tree = df._jdf.queryExecution().executedPlan()
        written = [int(m) for m in _shuffle_records(tree)]
        assert written and max(written) <= 16 * 2 * 1001, written


@pytest.fixture
def eager_skew(spark):
    """Adaptive execution that splits already small partitions, and never broadcasts."""
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k in conf:
        spark.conf.unset(k)


def test_joins_split_a_hot_key(spark, eager_skew):
    hot = spark.range(0, 90_000, 1, 16).selectExpr(
        "CASE WHEN id % 3 = 0 THEN '999999' ELSE CAST(100000 + id % 700 AS STRING) END AS pmid", "id", "'completed' AS status",
        "CAST(id AS DOUBLE) AS processing_time", "'vlm' AS backend", "CAST(id AS STRING) AS run",
        "CASE WHEN id % 3 = 0 THEN 'same' ELSE CAST(id AS STRING) END AS digest")
    outputs = hot.select("pmid")
    manifest = hot.selectExpr("pmid", "concat('p', id) AS pdf_path")
    files = hot.selectExpr("concat('out/', pmid, '/auto/', id, '_content_list.json') AS path")
    ids = manifest.select("pmid")
    lists = hot.selectExpr("concat('out/', pmid, '/auto/', pmid, '_content_list.json') AS path")
    frames = {
        "time_by_outcome": audit.time_by_outcome(hot, outputs),
        "pending_work": audit.pending_work(manifest, lists),
        "skipped_work": audit.skipped_work(manifest, lists),
        "agreeing_runs": compare.agreeing_runs(hot),
        "layout_plan": layout.layout_plan(files),
        "layout_plan_ids": layout.layout_plan(files, ids=ids),
    }
    for name, df in frames.items():
        n = len(df.collect())
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString(), name
        assert n == {"time_by_outcome": 1, "pending_work": 0}.get(name, 90_000), name


def test_alignment_splits_a_hot_run(spark, eager_skew):
    hot = spark.range(0, 60_000, 1, 16).selectExpr(
        "CASE WHEN id % 3 = 0 THEN '999999' ELSE CAST(100000 + id % 700 AS STRING) END AS pmid", "'vlm' AS backend",
        "id % 2 AS run", "CAST(id / 2 AS BIGINT) AS seq", "'text' AS type", "'same' AS text")
    df = alignment.aligned_elements(hot)
    assert df.filter("op <> 'kept'").count() == 0
    assert len(df.collect()) == 10_000  # the other documents have one run each
    assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()


def _shuffle_records(plan):
    """shuffleRecordsWritten of every exchange in an executed adaptive plan."""
    text = plan.toString()
    assert "isFinalPlan=true" in text
    out, todo = [], [plan]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            todo.append(node.plan())
            continue
        if name == "ShuffleExchangeExec":
            out.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        todo.extend(children.apply(i) for i in range(children.size()))
    return out


def test_one_hot_row_index(spark):
    hot = spark.range(5000).select(F.lit("hot").alias("pmid"), F.col("id").alias("n"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        indexed = chunks.with_row_index(hot, ["pmid"])
        sizes = [r.n for r in indexed.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 5000 and max(sizes) < 5000 / 2
