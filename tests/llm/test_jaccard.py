import random
import re

import numpy as np
import pytest
from hypothesis import given, strategies as st
from pyspark.sql import functions as F

from paperledger.llm import components as components_
from paperledger.llm import jaccard as j
from paperledger.llm.components import apart, components


def shingle_set(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    w = [bytes(c + 32 if 65 <= c <= 90 else c for c in x) for x in w]
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(rows):
    """Smallest doc_id reachable, by comparing all pairs; union-find over rows."""
    sets = [shingle_set(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root(i)] = min(least.get(root(i), r[0]), r[0])
    return [(r[0], len(sets[i]), least.get(root(i)) if sets[i] else r[0]) for i, r in enumerate(rows)]


def corpus(seed, copies=30):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    passage = [r.choice(vocabulary) for _ in range(60)]
    rows = []
    for base in range(12):
        text = [r.choice(vocabulary) for _ in range(r.choice([3, 5, 8, 20, 60, 150]))]
        for _ in range(r.choice([1, 2, 4, copies])):
            x = list(text)
            for _ in range(r.randrange(4)):
                x[r.randrange(len(x))] = r.choice(vocabulary)
            if r.random() < 0.3:
                x = x[: len(x) - len(x) // 8]
            rows.append(" ".join(x))
    rows += [" ".join(passage + [r.choice(vocabulary) for _ in range(r.choice([5, 30, 200]))]) for _ in range(25)]
    rows += ["", None, " \n", "one", "ONE", "one ", "É é", "é É", "a b c d", "A b C d", "a b c d e", "x " * 3000]
    r.shuffle(rows)
    return [(i if i % 11 else None, t, "clash", 5) for i, t in enumerate(rows)] + [(4, "another text of doc four here", "x", 1)]


def result(df):
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] is None, r[2] or 0)
    return sorted(map(tuple, df), key=key)


@pytest.mark.parametrize("seed,tile,block,often,picked", [(1, 64, 512, 1 << 16, 1000), (2, 3, 4, 0, 1000), (3, 2, 3, 20, 0)])
def test_components_match_brute_force(spark, seed, tile, block, often, picked):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string, cls string, n long").repartition(3)
    got = j.jaccard_components(docs, tile=tile, block=block, often=often, picked=picked).select("doc_id", "n_shingles", "component_id").collect()
    assert result(got) == result(brute(rows))


def test_empty_table(spark):
    assert j.jaccard_components(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@given(st.text(alphabet="aAbB é\t\x0b\n", max_size=60))
def test_shingles_are_distinct_and_complete(text):
    assert len(j.shingles(text)) == len(shingle_set(text))


@given(st.sets(st.integers(0, 400), min_size=1), st.sets(st.integers(0, 400), min_size=1))
def test_bitmaps_never_lose_a_pair(a, b):
    x, y = (np.unique(np.array(sorted(s), np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for s in (a, b))
    if j.alike(len(a & b), len(a), len(b), 80):
        assert j.may_be_alike(len(a), j.bitmap(x), len(b), j.bitmap(y), 80)


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(203, 202), (202, 201), (201, 203)]
    random.Random(5).shuffle(edges)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {201: 201, 202: 201, 203: 201}
    assert components(spark.range(0).select(F.col("id").alias("a"), F.col("id").alias("b"))).collect() == []


@given(st.integers(1, 12), st.integers(0, 2**32))
def test_forest_spans_what_is_connected(n, seed):
    r = np.random.default_rng(seed)
    m = np.triu(r.random((n, n)) * (r.random((n, n)) < 0.3), 1)
    found = j.forest((m + m.T).astype(np.float32))

    def joined(pairs):
        group = list(range(n))
        for a, b in pairs:
            group = [group[a] if g == group[b] else g for g in group]
        return [[x == y for y in group] for x in group]

    assert joined(found.tolist()) == joined(np.argwhere(m > 0).tolist())
    assert len(found) == n - len({tuple(x) for x in joined(found.tolist())}) and all((m + m.T)[a, b] > 0 for a, b in found)


def test_a_hub_is_split(spark):
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        links = spark.range(0, 60_000, 1, 16).selectExpr("CASE WHEN id % 3 > 0 THEN 7 ELSE id + 100000 END AS a", "id + 1000000 AS b")
        least = links.groupBy("a").agg(F.min("b").alias("least"))
        df = links.join(apart(least, "a"), "a")
        assert len(df.collect()) == 60_000
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
        found = components(links)
        assert found.filter("node = 7 AND root = 7").count() == 1 and found.filter("root = 7").count() == 40_001
    finally:
        for k in conf:
            spark.conf.unset(k)


def test_stars_need_no_round(spark, monkeypatch):
    rounds = []
    monkeypatch.setattr(components_, "_stars", lambda links, go=components_._stars: rounds.append(1) or go(links))

    def roots(*links):
        found = components_.components(spark.createDataFrame(links, "a long, b long"))
        return sorted(map(tuple, found.collect()))

    assert roots((5, 1), (1, 3), (7, 6), (2, 2)) == [(1, 1), (3, 1), (5, 1), (6, 6), (7, 6)] and not rounds
    assert roots((5, 4), (4, 3), (3, 1), (5, 4)) == [(1, 1), (3, 1), (4, 1), (5, 1)] and rounds


def test_places_keep_order_of_sizes():
    tokens = np.array([0, 1 << 24, (1 << 64) - 1], np.uint64)
    for n in (1, 65_535, 65_536, 10 ** 7):
        found = j.places(tokens, n)
        assert (found >> j.SIZE_BITS).tolist() == [0, 1, (1 << 40) - 1]
        assert (found & 65_535).tolist() == [min(n, 65_535)] * 3
