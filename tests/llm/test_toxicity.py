import random
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from paperledger.llm import toxicity as t

DOCS = "doc_id long, text string, toxic int, label_id string"
LABELS = "doc_id long, quality int, toxic int"


def corpus(n=700, seed=3):
    """Toxic texts hold a word of a family whose endings vary, so that words alone do not tell."""
    r = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        w = ["".join(r.choice(["th", "en", "or", "la", "mi", "su"]) for _ in range(r.choice([1, 2, 3]))) for _ in range(r.choice([20, 80, 300]))]
        toxic = r.random() < 0.25
        if toxic:
            w[r.randrange(len(w))] = r.choice(["idiot", "Lowei", "vequ"]) + r.choice("abcdefghij") + r.choice(["an", "eu", "ch", "té"])
        rows.append((i, " ".join(w), None, "x"))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, DOCS)
    got = {r.doc_id: r for r in t.toxicity(docs, spark.createDataFrame(labels, LABELS)).collect()}
    assert len(got) == len(rows)
    table = Counter()
    for doc_id, _, toxic in labels:
        r = got[doc_id]
        assert r.held_out == (zlib.crc32(str(doc_id).encode()) % 3 == 1)
        assert r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1
        if r.held_out:
            table[toxic, r.predicted] += 1
    assert table[1, 1] / (table[1, 1] + table[1, 0]) > 0.9 and table[0, 1] / (table[0, 1] + table[0, 0]) < 0.02


def test_held_out_labels_are_not_seen(spark):
    rows, labels = corpus(300)
    flipped = [(i, q, 1 - x if zlib.crc32(str(i).encode()) % 3 == 1 else x) for i, q, x in labels]
    docs = spark.createDataFrame(rows, DOCS)
    one, two = (t.fit(docs, spark.createDataFrame(x, LABELS)) for x in (labels, flipped))
    assert np.array_equal(one[0], two[0]) and one[1] == two[1]


def test_sample_is_bounded(spark):
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(300)] + [(None, 1, 1), (4, None, None)], LABELS)
    got = t.sample(labels, 7, 11).collect()
    assert Counter(r.toxic for r in got) == {1: 7, 0: 11}
    assert all(zlib.crc32(str(r.label_id).encode()) % 3 != 1 for r in got)


def test_edge_rows(spark):
    docs = spark.createDataFrame([(None, None, 1, "x"), (1, "", 1, "x"), (1, "", 1, "x"), (2, " \n", None, None), (3, "a" * 100000, 0, "")], DOCS)
    none = spark.createDataFrame([], LABELS)
    got = t.toxicity(docs, none).collect()
    assert len(got) == 5 and all(r.score == 0.5 for r in got) and not any(r.held_out for r in got if r.doc_id is None)
    assert t.toxicity(docs.filter(F.lit(False)), none).collect() == []


def test_grams_are_those_of_the_text():
    text = "Été  à\tla Été"
    norm = f" {' '.join(text.lower().split())} "
    assert len(t.grams(text)) == sum(len(norm) - k + 1 for k in (3, 4, 5))
    distinct = {norm[i:i + k] for k in (3, 4, 5) for i in range(len(norm) - k + 1)}
    assert len(set(t.grams(text).tolist())) == len(distinct)
