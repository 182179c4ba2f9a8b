"""Quality rules: plain counts of a text, and a log-likelihood ratio of hashed n-grams.

Words and pairs of neighbouring words are hashed into `BUCKETS` counters. Two multinomials are fitted: one over the raw
corpus, one over a trusted target, smoothed towards the raw one with the weight of `PRIOR` n-grams. A document's score is
the sum of ln p_target(bucket) - ln p_raw(bucket) over its n-grams, divided by their number; it is kept at `THRESHOLD`
or above.

The raw multinomial counts every document. The trusted one counts documents whose label says quality 1, at most
`TRUSTED` of them, those with the smallest hash of doc_id; only their ids are broadcast. Both become one table of
`BUCKETS` numbers, which a scalar subquery hands to the scan that scores: no document is shuffled.

A null or empty text has counts of 0 and no score, and fails the base rules. Rows that repeat are judged each on their
own. A null doc_id is never trusted. Without trusted documents, or without documents, every
ratio is 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from paperledger.llm.words import BLANKS, computed, text_or_empty, words

BUCKETS = 1 << 14
PRIOR = 1 << 14
TRUSTED = 20_000
THRESHOLD = -0.1
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
NOT_SYMBOL = r"[^#*$%&|<>]+"


def _shift(direction: str, value: Column, bits: Column) -> Column:
    return F.call_function(f"shift{direction}", value, bits)


def _counts(docs: DataFrame) -> DataFrame:
    """`row`, the row as it was, n_words, the four base counts, and `hashes`, one number for each word."""
    lines = F.filter(F.split("text", "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    df = docs.select(F.struct(*docs.columns).alias("row"), text_or_empty(docs["text"]).alias("text"))
    df = df.select("row", "text", words(df["text"]).alias("words"), lines.alias("lines"))
    df = df.select(
        "row",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", NOT_SYMBOL, "")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    return _with_repeated_words(df)


def _with_repeated_words(df: DataFrame) -> DataFrame:
    """Adds n_repeat_words: words inside windows of three words that occur at least twice in the text.

    A window is one long: its hash above, its position in as many low bits as the text's length needs. One sort of
    longs then brings equal windows together, and their positions tell how many words they cover.
    """
    packed = F.transform("hashes", lambda h, i: _shift(
        "left", F.xxhash64(h, F.get("hashes", i + 1), F.get("hashes", i + 2)), F.col("_bits"),
    ).bitwiseOR(i.cast("long")))

    def alike(x: Column, y: Column) -> Column:
        return _shift("right", x.bitwiseXOR(y), F.col("_bits")) == 0

    # Beside the ends of the array there is null, which counts as unlike.
    equal = F.filter("_windows", lambda x, i: alike(x, F.get("_windows", i + 1)) | alike(x, F.get("_windows", i - 1)))
    places = F.sort_array(F.transform(equal, lambda w: w.bitwiseAND(_shift("left", F.lit(1).cast("long"), F.col("_bits")) - 1)))
    covered = F.aggregate(
        F.transform("_places", lambda p, i: F.least(F.lit(3).cast("long"), F.coalesce(F.get("_places", i + 1), p + 3) - p)),
        F.lit(0).cast("long"), lambda total, x: total + x,
    )
    df = df.withColumn("_bits", F.length(F.bin(F.col("n_words"))).cast("int"))
    df = df.withColumn("_windows", F.sort_array(F.slice(packed, F.lit(1), F.greatest(F.size("hashes") - 2, F.lit(0)))))
    df = df.withColumn("_places", places)
    return df.withColumn("n_repeat_words", covered).drop("_bits", "_windows", "_places")


def _grams(hashes: Column, buckets: int) -> Column:
    """Buckets of all words and of all pairs of neighbouring words."""
    low = F.lit(buckets - 1).cast("long")
    pairs = F.transform(hashes, lambda h, i: h.bitwiseXOR(F.shiftright(F.get(hashes, i + 1), 20)).bitwiseAND(low).cast("int"))
    return F.concat(
        F.transform(hashes, lambda h: h.bitwiseAND(low).cast("int")),
        F.slice(pairs, F.lit(1), F.greatest(F.size(hashes) - 1, F.lit(0))),
    )


def log_ratios(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, trusted: int = TRUSTED) -> DataFrame:
    """One row: `ratios`, for each bucket ln p_target - ln p_raw."""
    ids = labels.filter("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").alias("trusted_id")).distinct()
    ids = F.broadcast(ids.orderBy(F.xxhash64("trusted_id"), "trusted_id").limit(trusted))
    hashed = docs.select("doc_id", F.transform(words(docs["text"]), lambda w: F.xxhash64(w)).alias("hashes"))
    marked = hashed.join(ids, hashed["doc_id"] == ids["trusted_id"], "left")
    rows = marked.select(
        F.explode(_grams(F.col("hashes"), buckets)).alias("bucket"), F.col("trusted_id").isNotNull().cast("long").alias("target"),
        F.lit(1).cast("long").alias("raw"),
    )
    nothing = F.lit(0).cast("long")
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"), nothing.alias("target"), nothing.alias("raw"))
    counts = rows.unionByName(every).groupBy("bucket").agg(F.sum("target").alias("target"), F.sum("raw").alias("raw"))
    # `buckets` rows from here on, whatever the input: they fit one row.
    whole = counts.agg(
        F.sum("target").alias("targets"), F.sum("raw").alias("raws"),
        F.sort_array(F.collect_list(F.struct("bucket", "target", "raw"))).alias("rows"),
    )

    def ratio(x: Column) -> Column:
        raw = x["raw"] / F.col("raws")
        return F.when(x["raw"] > 0, F.log((x["target"] + PRIOR * raw) / (F.col("targets") + PRIOR) / raw)).otherwise(F.lit(0.0))

    return whole.select(F.transform("rows", ratio).alias("ratios"))


def quality(
    docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, trusted: int = TRUSTED, threshold: float = THRESHOLD,
    columns: tuple[str, ...] | list[str] = ("doc_id",),
) -> DataFrame:
    """Per row of docs: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score, kept.

    Before them come the asked `columns` of docs; of those, one with a name from this list gives way.
    """
    ratios = log_ratios(docs, labels, buckets, trusted).scalar()
    df = _counts(docs.select(*dict.fromkeys([*columns, "text"])))
    df = df.withColumn("_grams", _grams(F.col("hashes"), buckets)).withColumn("_ratios", ratios)
    total = F.aggregate("_grams", F.lit(0.0), lambda a, g: a + F.get("_ratios", g))
    df = df.withColumn("score", F.when(F.size("_grams") > 0, total / F.size("_grams")))
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    found = df.select(
        "row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed.alias("base_failed"),
        "score", (~base_failed & F.coalesce(F.col("score") >= threshold, F.lit(False))).alias("kept"),
    )
    given = [F.col("row")[c].alias(c) for c in columns if c not in found.columns]
    return computed(found.select(*given, *found.columns[1:]))
