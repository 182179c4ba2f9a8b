"""Toxicity: a linear classifier over character n-grams that are scaled by naive Bayes log-count ratios.

A text's features are the hashed 3- to 5-grams of its lower-cased characters that it contains, white space as one blank.
From labelled documents the log ratio of each n-gram's share of toxic and of other documents is taken; n-grams are
ranked by a likelihood-ratio test and at most `FEATURES` kept; logistic regression learns weights for the kept ones, each
scaled by its log ratio. A text's score is the logistic function of the sum over its distinct n-grams.

The fit sees at most `TOXIC` toxic and `OTHER` other labelled documents, those with the smallest hash of doc_id, whole
texts; a doc_id with several labels is toxic if one says so. Only their ids, the 2^`BITS` counters, the kept features of
those documents, and the weights pass the driver: all bounded by parameters. Every document is scored, in one scan.

A null or empty text has no n-grams and gets the score of the bias alone. Without labels that is 0.5. A null doc_id is
never held out. Rows that repeat are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from paperledger.llm.frames import as_text, numbers

BITS = 18
ORDERS = (3, 4, 5)
TOXIC = 4000
OTHER = 8000
FEATURES = 1 << 12
MIN_DOCS = 4
MIN_TEST = 2.0
PENALTY = 1.0
ROUNDS = 300
THRESHOLD = 0.7


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def grams(text: str | None) -> np.ndarray:
    """Hashes of all n-grams, with repeats."""
    c = np.frombuffer(f" {' '.join((text or '').lower().split())} ".encode("utf-32-le"), np.uint32)
    found, h = [], c.astype(np.uint32)
    for order in range(2, max(ORDERS) + 1):
        h = h[: max(0, len(c) - order + 1)] * np.uint32(0x01000193) + c[order - 1:]
        if order in ORDERS:
            found.append(((h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BITS))
    return np.concatenate(found)


def sample(labels: DataFrame, toxic: int = TOXIC, other: int = OTHER) -> DataFrame:
    """label_id, toxic: a bounded sample of the labelled documents that are not held out."""
    rows = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").alias("label_id")).agg(F.max("toxic").alias("toxic"))
    rows = rows.filter(~held_out(F.col("label_id")))
    order = [F.xxhash64("label_id"), F.col("label_id")]
    return rows.filter("toxic = 1").orderBy(*order).limit(toxic).unionByName(rows.filter("toxic <> 1").orderBy(*order).limit(other))


def counts(train: DataFrame) -> DataFrame:
    """feature, toxic, other: in how many documents of each kind it is."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen = np.zeros((2, 1 << BITS), np.int64)
            for text, toxic in zip(batch["text"], batch["toxic"]):
                seen[int(toxic == 1), np.unique(grams(text))] += 1
            there = np.flatnonzero(seen.any(axis=0))
            yield pd.DataFrame({"feature": there, "toxic": seen[1, there], "other": seen[0, there]})

    return train.mapInPandas(run, "feature int, toxic long, other long").groupBy("feature").agg(
        F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def chosen(found: DataFrame, n_toxic: int, n_other: int, features: int) -> DataFrame:
    """feature, ratio of the `features` n-grams that tell most: log-count ratio, and a likelihood-ratio test to rank by."""
    p, q = F.col("toxic").cast("double"), F.col("other").cast("double")
    ratio = F.log((p + 1) / (n_toxic + 2)) - F.log((q + 1) / (n_other + 2))
    share = (p + q) / max(1, n_toxic + n_other)

    def term(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    test = term(p, share * n_toxic) + term(q, share * n_other) + term(n_toxic - p, (1 - share) * n_toxic) + term(n_other - q, (1 - share) * n_other)
    ranked = found.filter(p + q >= MIN_DOCS).select("feature", ratio.alias("ratio"), test.alias("test")).filter(F.col("test") > MIN_TEST)
    return ranked.orderBy(F.desc("test"), "feature").limit(features)


def present(train: DataFrame, kept: np.ndarray) -> DataFrame:
    """toxic, features: the places in `kept` of what each document has."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text in batch["text"]:
                own = np.unique(grams(text)).astype(np.int64)
                at = np.minimum(np.searchsorted(kept, own), max(len(kept) - 1, 0))
                out.append(at[kept[at] == own].astype(np.int32) if len(kept) else np.empty(0, np.int32))
            yield pd.DataFrame({"label_id": batch["label_id"], "toxic": batch["toxic"], "features": out})

    return train.mapInPandas(run, "label_id long, toxic int, features array<int>")


def logistic(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, penalty: float, rounds: int) -> tuple[np.ndarray, float]:
    """Weights of the unscaled features and the bias, by gradient steps with adaptive rates."""
    n, k = len(rows), len(ratio)
    bias = float(np.log((y.sum() + 0.5) / (n - y.sum() + 0.5)))
    if not n or not k:
        return np.zeros(k), bias
    of = np.repeat(np.arange(n, dtype=np.int32), [len(r) for r in rows])
    at = np.concatenate(rows)
    w, m, v = np.zeros(k + 1), np.zeros(k + 1), np.zeros(k + 1)
    w[k] = bias
    for step in range(1, rounds + 1):
        z = w[k] + np.bincount(of, (w[:k] * ratio)[at], n)
        error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        g = np.append(np.bincount(at, error[of], k) * ratio + penalty * w[:k], error.sum()) / n
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w[:k] * ratio, float(w[k])


def fit(docs: DataFrame, labels: DataFrame, toxic: int = TOXIC, other: int = OTHER, features: int = FEATURES) -> tuple[np.ndarray, float]:
    """A weight for each of the 2^BITS n-gram hashes, and the bias."""
    ids = F.broadcast(sample(labels, toxic, other))
    # A doc_id that repeats trains with the least of its texts: as many rows as there are labelled ids in the sample.
    train = docs.select("doc_id", "text").join(ids, docs["doc_id"] == ids["label_id"]).groupBy("label_id", "toxic").agg(F.min("text").alias("text"))
    sizes = {int(r["toxic"] == 1): r["n"] for r in train.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    best = chosen(counts(train), sizes.get(1, 0), sizes.get(0, 0), features).toPandas().sort_values("feature")
    kept, ratio = best["feature"].to_numpy(), best["ratio"].to_numpy()
    rows = present(train, kept).toPandas().sort_values("label_id")
    learned, bias = logistic([np.asarray(r, np.int32) for r in rows["features"]], (rows["toxic"] == 1).to_numpy(float), ratio, PENALTY, ROUNDS)
    weights = np.zeros(1 << BITS, np.float32)
    weights[kept] = learned
    return weights, bias


def toxicity(
    docs: DataFrame, labels: DataFrame, toxic: int = TOXIC, other: int = OTHER, features: int = FEATURES, threshold: float = THRESHOLD
) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of docs."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, toxic, other, features))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights, bias = model.value
        used = weights != 0
        for batch in batches:
            sums = []
            for text in batch["text"]:
                g = grams(text)
                sums.append(bias + float(weights[np.unique(g[used[g]])].sum(dtype=np.float64)))
            score = 1 / (1 + np.exp(-np.clip(np.array(sums, float), -30, 30)))
            yield pd.DataFrame({"doc_id": numbers(batch["doc_id"]), "score": score})

    scored = docs.select(as_text("doc_id"), F.col("text").cast("string")).mapInPandas(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
