"""Document fingerprints by winnowing.

A text's word k-grams are hashed to 31 bits. Of every `WINDOW` neighbouring hashes the smallest is chosen, the rightmost
of equal ones, with its position. Two texts that share K + WINDOW - 1 words in a row so share a chosen hash, and no match
shorter than K words is seen. The window's minimum needs no loop over windows: a hash and its position are one long,
later positions smaller, and minima over 2, 4, 8 ... neighbours come from minima over half as many.

Fewer than K words are one gram; fewer grams than a window are one window. A null text is empty; an empty or blank text has
no fingerprint. Likeness is shared over all distinct chosen hashes; two empty fingerprints are alike (1), an empty one
and another are not (0).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from paperledger.llm.words import range_bounds, range_bucket, shuffle_width, text_or_empty, words

K = 5
WINDOW = 8
_LAST = (1 << 32) - 1


def _chosen(df: DataFrame, text: str, out: str, k: int, window: int) -> DataFrame:
    """Adds `out`: the chosen grams in order, each hash * 2^32 + (2^32 - 1 - position)."""
    n = F.greatest(F.size("_w") - k + 1, F.least(F.size("_w"), F.lit(1)))
    gram = F.transform("_w", lambda w, i: F.shiftleft(
        F.xxhash64(w, *(F.get("_w", i + j) for j in range(1, k))).bitwiseAND(F.lit((1 << 31) - 1).cast("long")), 32,
    ).bitwiseOR(F.lit(_LAST).cast("long") - i))
    df = df.withColumn("_w", F.transform(words(F.col(text)), lambda w: F.xxhash64(w)))
    df = df.withColumn("_g", F.slice(gram, F.lit(1), n))
    span = 1
    while span < window:
        step = min(span, window - span)
        df = df.withColumn("_g", F.transform("_g", lambda x, i: F.least(x, F.get("_g", i + step))))  # noqa: B023
        span += step
    # At the end, beyond the last whole window, minima are over fewer grams; a short text has one window.
    whole = F.slice("_g", F.lit(1), F.greatest(F.size("_g") - window + 1, F.least(F.size("_g"), F.lit(1))))
    df = df.withColumn("_g", whole)
    first = F.filter("_g", lambda x, i: F.coalesce(x != F.get("_g", i - 1), F.lit(True)))
    return df.withColumn(out, first).drop("_w", "_g")


def with_fingerprint(df: DataFrame, text: str, out: str, k: int = K, window: int = WINDOW) -> DataFrame:
    return _chosen(df, text, out, k, window)


def shown(chosen: Column) -> Column:
    """A fingerprint as text: hash in hexadecimal, colon, position of the gram's first word, for each chosen gram."""
    return F.array_join(F.transform(chosen, lambda x: F.concat_ws(
        ":", F.lower(F.hex(F.shiftright(x, 32))), (F.lit(_LAST).cast("long") - x.bitwiseAND(F.lit(_LAST).cast("long"))).cast("string"))), " ")


def likeness(a: Column, b: Column) -> Column:
    def hashes(x: Column) -> Column:
        return F.transform(x, lambda v: F.shiftright(v, 32))

    both = F.size(F.array_union(hashes(a), hashes(b)))
    return F.when(both == 0, 1.0).otherwise(F.size(F.array_intersect(hashes(a), hashes(b))) / both)


def beside_next(docs: DataFrame, columns: list[str], prepare, buckets: int | None = None) -> DataFrame:
    """Every row with `columns` of the next row by doc_id as `next_`..., the first row's after the last.

    Rows are dealt into ranges of doc_id by quantiles of all ids, so that one shuffle puts neighbours together and no task
    has all rows. `prepare` adds columns after that shuffle. The last row of a range takes the first one of the next range;
    there is one such row for each range. Null ids come first, equal ids in order of text.
    """
    buckets = buckets or 4 * shuffle_width(docs)
    lowest = F.lit(-(1 << 63)).cast("long")
    rows = docs.select("doc_id", text_or_empty(docs["text"]).alias("text"), F.coalesce(F.col("doc_id").cast("long"), lowest).alias("_id"))
    bounds = range_bounds(rows, "_id", buckets)

    def dealt(df: DataFrame) -> DataFrame:
        return df.withColumn("_bounds", bounds).withColumn("_bucket", range_bucket(F.col("_id"), F.col("_bounds"), buckets)).drop("_bounds")

    starts = dealt(rows.select("_id")).groupBy("_bucket").agg(F.min("_id").alias("_start"))
    ring = starts.withColumn("_before", F.coalesce(F.lag("_bucket").over(W.orderBy("_bucket")), F.max("_bucket").over(W.partitionBy())))
    heads = rows.join(F.broadcast(ring.select("_start", "_before")), rows["_id"] == F.col("_start"))
    heads = heads.groupBy("_before").agg(F.min("text").alias("text"))
    heads = prepare(heads).select("_before", *(F.col(c).alias(f"_head_{c}") for c in columns))

    order = W.partitionBy("_bucket").orderBy("_id", "text")
    placed = prepare(dealt(rows).repartition("_bucket")).withColumn("_last", F.lead(F.lit(False), 1, True).over(order))
    for c in columns:
        placed = placed.withColumn(f"_lead_{c}", F.lead(c).over(order))
    joined = placed.join(heads, (placed["_bucket"] == heads["_before"]) & placed["_last"], "left")
    found = {f"next_{c}": F.when(F.col("_last"), F.col(f"_head_{c}")).otherwise(F.col(f"_lead_{c}")) for c in columns}
    return joined.withColumns(found).drop("_id", "_bucket", "_last", "_before", *(f"_{x}_{c}" for x in ("head", "lead") for c in columns))


def fingerprints(docs: DataFrame, k: int = K, window: int = WINDOW, buckets: int | None = None) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for each row of docs."""
    rows = beside_next(docs, ["text", "_own"], lambda df: with_fingerprint(df, "text", "_own", k, window), buckets)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("_edited"), "_own", "next__own")
    rows = with_fingerprint(rows, "_edited", "_changed", k, window)
    return rows.select(
        "doc_id", "n_chars", F.sha2("_edited", 256).alias("edited_sha256"), shown(F.col("_own")).alias("fingerprint"),
        shown(F.col("_changed")).alias("edited_fingerprint"), likeness(F.col("_own"), F.col("_changed")).alias("near_edited"),
        likeness(F.col("_own"), F.col("next__own")).alias("near_next"),
    )
