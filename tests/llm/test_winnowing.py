import hashlib
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from paperledger.llm import winnowing as w

SCHEMA = "doc_id long, text string, _id string, fingerprint int"


def xx(data, seed=42):
    return xxhash.xxh64(data, seed=seed).intdigest()


def grams(text, k):
    hashes = [xx(x.encode()) for x in re.findall(r"[^\x20\x09-\x0D]+", text)]
    out = []
    for i in range(max(len(hashes) - k + 1, min(1, len(hashes)))):
        seed = 42
        for x in hashes[i:i + k]:
            seed = xx(x.to_bytes(8, "little"), seed)
        out.append(seed & 0x7FFFFFFF)
    return out


def brute(text, k, window):
    """Chosen (hash, position) by looking at every window."""
    g = grams(text, k)
    chosen = []
    for start in range(max(len(g) - window + 1, min(1, len(g)))):
        span = range(start, min(start + window, len(g)))
        best = min(span, key=lambda i: (g[i], -i))
        if not chosen or chosen[-1] != (g[best], best):
            chosen.append((g[best], best))
    return chosen


def like(a, b):
    a, b = {x for x, _ in a}, {x for x, _ in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def corpus(seed=1):
    r = random.Random(seed)
    texts = [" ".join(r.choice("a b c dd eee é \U0001f600x".split()) for _ in range(r.choice([0, 1, 3, 5, 8, 12, 40, 200]))) for _ in range(60)]
    texts += ["", None, " \n\t", "x" * 5001, "same same " * 300, "same same " * 300, " ".join(f"w{i}" for i in range(400))]
    rows = [(i * 7 - 50 if i % 13 else None, t, "clash", 1) for i, t in enumerate(texts)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("k,window,buckets", [(5, 8, None), (2, 4, 3), (3, 5, 64), (1, 1, 1)])
def test_fingerprints_match_brute_force(spark, k, window, buckets):
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = w.fingerprints(docs, k, window, buckets).collect()
    ordered = sorted(((i, t or "") for i, t, *_ in rows), key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode()))
    want = []
    for (doc_id, text), (_, after) in zip(ordered, ordered[1:] + ordered[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        own, changed = brute(text, k, window), brute(edited, k, window)
        show = lambda c: " ".join(f"{h:x}:{p}" for h, p in c)
        want.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), show(own), show(changed), like(own, changed), like(own, brute(after, k, window))))
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_shared_runs_are_found(spark):
    r = random.Random(4)
    shared = [f"s{i}" for i in range(w.K + w.WINDOW - 1)]
    rows = [(i, " ".join([f"x{r.random()}" for _ in range(r.randrange(60))] + shared + [f"y{r.random()}" for _ in range(r.randrange(60))]), None, None) for i in range(30)]
    got = w.fingerprints(spark.createDataFrame(rows, SCHEMA)).collect()
    assert all(x.near_next > 0 for x in got)


def test_one_row_and_no_rows(spark):
    docs = spark.createDataFrame([(3, "a b c d e f g", None, None)], SCHEMA)
    row = w.fingerprints(docs).first()
    assert row.near_next == 1 and row.n_chars == 13
    assert w.fingerprints(docs.filter(F.lit(False))).collect() == []
