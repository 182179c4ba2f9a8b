import math
import re
from collections import Counter

import xxhash
from pyspark.sql import functions as F

from paperledger.llm import quality as q

DOCS = "doc_id long, text string"
CASES = [
    None, "", " \t\n", "a", "a a a a a", "a b c a b c", "x y z x y z x y\n\nx y z\nx y z \nx y z", "# a|b <c> 100%",
    " non breaking été \U0001f600", "a b " * 400, "\n".join(["same line"] * 30), "one\x0btwo\x0cthree\rfour",
]


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    times = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if times[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def grams(text, buckets):
    h = [signed(xxhash.xxh64(w.encode(), seed=42).intdigest()) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    return [x & (buckets - 1) for x in h] + [(a ^ (b >> 20)) & (buckets - 1) for a, b in zip(h, h[1:])]


def scores(docs, trusted, buckets):
    raw, target = Counter(), Counter()
    for doc_id, text in docs:
        raw.update(grams(text, buckets))
        if doc_id in trusted:
            target.update(grams(text, buckets))
    r, t = sum(raw.values()), sum(target.values())
    ratio = [math.log((target[b] + q.PRIOR * raw[b] / r) / (t + q.PRIOR) / (raw[b] / r)) if raw[b] else 0.0 for b in range(buckets)]
    return [sum(ratio[b] for b in g) / len(g) if (g := grams(text, buckets)) else None for _, text in docs]


def test_counts_and_scores_match_brute_force(spark):
    good = [f"the cat sat on a mat and saw {' '.join(f'word{i * k % 53}' for k in range(70))}" for i in range(1, 9)]
    junk = [" ".join(f"w{i * k % 71} |" for k in range(60)) for i in range(1, 9)]
    rows = list(enumerate(CASES + good + junk))
    trusted = {len(CASES) + i for i in range(4)}
    docs = spark.createDataFrame(rows, DOCS).withColumn("score", F.lit("clash")).withColumn("_bits", F.lit(0))
    labels = spark.createDataFrame(
        [(i, 1, 0) for i in trusted] * 2 + [(len(CASES) + 9, 0, 0), (None, 1, 0), (0, None, None)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in q.quality(docs, labels, buckets=256).collect()}
    assert len(got) == len(rows)
    for (doc_id, text), want in zip(rows, scores(rows, trusted, 256)):
        r = got[doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(text)
        assert (r.score is None) == (want is None)
        if want is not None:
            assert math.isclose(r.score, want, abs_tol=1e-9)
        assert r.kept == (not r.base_failed and want is not None and r.score >= q.THRESHOLD)


def test_junk_scores_below_clean_text(spark):
    clean = [" ".join(f"word{(i * 7 + k * k) % 97}" for k in range(120)) for i in range(30)]
    junk = [" ".join(f"z{(i * 5 + k * 3) % 89} |" for k in range(80)) for i in range(6)]
    docs = spark.createDataFrame(list(enumerate(clean + junk)), DOCS)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(12)], "doc_id long, quality int, toxic int")
    kept = {r.doc_id for r in q.quality(docs, labels).filter("kept").collect()}
    assert kept == set(range(30))


def test_empty_tables_and_repeated_rows(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert q.quality(spark.createDataFrame([], DOCS), labels).collect() == []
    text = " ".join(f"w{i}" for i in range(60))
    rows = q.quality(spark.createDataFrame([(1, text), (1, text), (None, text)], DOCS), labels).collect()
    assert len(rows) == 3 and all(r.kept and abs(r.score) < 1e-12 for r in rows)


def test_trusted_sample_is_bounded_and_fixed(spark):
    docs = spark.createDataFrame([(i, f"a{i} b c") for i in range(20)], DOCS)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    one, two = (q.log_ratios(docs, labels.repartition(k), 64, trusted=5).first().ratios for k in (1, 4))
    assert one == two and any(one)


def test_asked_columns_come_back_as_they_were(spark):
    docs = spark.createDataFrame([(1, None, None, "x"), (2, "a", 7, "y")], "doc_id long, text string, n_chars long, kept string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = {r.doc_id: r for r in q.quality(docs, labels, columns=["doc_id", "text", "n_chars", "kept"]).collect()}
    assert rows[1].text is None and rows[2].n_chars == 7 and rows[1].kept is False
