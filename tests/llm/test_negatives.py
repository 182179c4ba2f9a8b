import math

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from paperledger.llm import negatives
from paperledger.llm.negatives import (
    BLOCKS, LAST, NONE, anchors_of, best, blocks_of, chosen, curve_keys, floors, hard_negatives, mined, pages_of, scores, tiles_of)
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<float>, label int, key string, address string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, label, "k", "a") for i, v, label in rows], SCHEMA)


def brute(rows, every=50):
    """All pairs in whole numbers, rows by their place."""
    whole = [(i, (label + 1) % 10 if i is not None and i % 7 == 0 else label, [math.floor(256 * float(np.float32(c))) for c in v])
             for i, v, label in rows
             if label is not None and v and all(c is not None and math.isfinite(c) for c in v)]
    by = lambda r: (-r[0], r[1] is None, r[1] or 0)
    out = []
    for at, (anchor, label, a) in enumerate(whole):
        if anchor is None or anchor % every:
            continue
        others = [(sum(x * y for x, y in zip(a, v)), i, own == label) for n, (i, own, v) in enumerate(whole) if n != at]
        for p, positive, _ in sorted((o for o in others if o[2]), key=by)[:5]:
            window = [o for o in others if not o[2] and 50 * p <= 100 * o[0] <= 95 * p]
            out += [(anchor, positive, rank, o[1], p, o[0]) for rank, o in enumerate(sorted(window, key=by)[:3], 1)]
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()), key=str)


def clustered(n, dims, seed=1, clusters=12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, dims))
    of = rng.integers(clusters, size=n)
    return [(i, [float(np.float32(c)) for c in centres[k] + rng.normal(size=dims) * 0.05], int(k % 4)) for i, k in enumerate(of)]


def test_random_rows_with_ties_and_nulls(spark):
    rng = np.random.default_rng(7)
    rows = [(i, [float(c) / 8 for c in rng.integers(-6, 12, size=4)], int(rng.integers(4))) for i in range(700)]
    rows += rows[:60] + [(None, v, label) for _, v, label in rows[100:150]] + [(50, [0.25, 0.5, 0.0, 1.0], 2)]
    rows += [(1000, None, 1), (1050, [], 1), (1100, [1.0, None, 1.0, 1.0], 1), (1150, [math.nan, 1.0, 1.0, 1.0], 1), (1200, [1.0] * 4, None)]
    assert result(mined(table(spark, rows))) == brute(rows)


def test_blocks_tiles_and_pages_do_not_change_the_result(spark):
    rows = clustered(900, 6)
    found = table(spark, rows).selectExpr(
        "CAST(vec_id AS string) AS id", "CAST(IF(vec_id % 7 = 0, (label + 1) % 10, label) AS long) AS label", "transform(embedding, c -> floor(256 * CAST(c AS double))) AS x")
    assert result(hard_negatives(found, 6, 50, block=32, tile=4, page=8)) == brute(rows)


def test_one_vector_in_a_third_of_all_rows(spark):
    rows = clustered(400, 5)
    rows = [(i, rows[3][1] if i % 3 == 0 else v, 1 if i % 3 == 0 else label) for i, v, label in rows]
    assert result(mined(table(spark, rows))) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(50, [1.0], 1)], [(50, None, 1)], [(1, [1.0], 1), (2, [1.0], 1)], [(50, [1.0, 1.0], 1), (51, [1.0, 1.0], 1)]])
def test_tables_without_a_result(spark, rows):
    assert mined(table(spark, rows)).collect() == []


def test_rows_of_another_length_or_too_large_take_no_part(spark):
    rows = [(50, [1.0, 1.0], 1), (51, [1.0, 1.0], 1), (52, [0.75, 0.75], 2), (53, [1.0], 2), (54, [3e30, 1.0], 2)]
    assert result(mined(table(spark, rows))) == brute(rows[:3]) != []


def test_given_embeddings(spark):
    given_rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    assert result(mined(given_rows.repartition(5))) == brute([(r.vec_id, r.embedding, r.label) for r in given_rows.collect()])


def test_bounds_spare_most_blocks_of_clustered_rows(spark):
    rows = clustered(4000, 8, clusters=40)
    found = table(spark, rows).selectExpr("CAST(vec_id AS string) AS id", "CAST(label AS long) AS label", "transform(embedding, c -> floor(256 * CAST(c AS double))) AS x")
    blocks = spark.createDataFrame(blocks_of(found, 8, 50, 32).collect(), BLOCKS)
    n = blocks.count()
    anchors = anchors_of(blocks, 8, 32)
    tiles = tiles_of(anchors.withColumn("floors", F.array(floors(F.lit(NONE), F.lit(LAST), F.col("least"), F.col("least_id")))))
    read = chosen(tiles, tiles.count(), pages_of(blocks, 2), 2, 8, True).selectExpr("sum(size(addresses))").first()[0]
    assert anchors.count() == 80 and read < 0.2 * 80 * n


@pytest.mark.parametrize("dims, bits", [(2, 3), (3, 2), (2, 2), (4, 1)])
def test_neighbours_on_the_curve_are_neighbours_in_space(dims, bits):
    cells = np.array(np.meshgrid(*[range(1 << bits)] * dims)).reshape(dims, -1).T
    keys = curve_keys(cells, bits)
    assert len(set(keys)) == len(cells)
    along = cells[np.argsort(np.array(keys, dtype=object), kind="stable")]
    assert np.all(np.abs(np.diff(along, axis=0)).sum(axis=1) == 1)


@settings(deadline=None)
@given(st.lists(st.lists(st.integers(-(1 << 30), 1 << 30), min_size=3, max_size=3), min_size=1, max_size=5))
def test_scores_are_exact(rows):
    q = np.array(rows, dtype=np.int64)
    assert scores(q, q).tolist() == [[sum(x * y for x, y in zip(a, b)) for b in rows] for a in rows]


def test_best_takes_the_first_of_equal_values():
    values = np.array([[3, 5, 5, 1]])
    assert [(int(a[0]), int(v[0])) for a, v in best(values, values > 1, 4)] == [(1, 5), (2, 5), (0, 3), (0, NONE)]
    assert negatives.NONE < 0
