"""N-gram Jaccard join: documents whose sets of five-word shingles are alike, exactly, and their components.

Documents with equal sets are one class, named by 64 bits of the set's hash; only classes are compared.

1. Tiles. Shingles are ordered: rare ones by their hash, then those seen often in some batch (`often`, a list of bounded
   length; it only sets the order). Two sets of n and m shingles, n <= m, with a Jaccard similarity of 80 % share one of
   the first n - ceil(0.8 n) + 1 and m - ceil(0.8 m) + 1. So classes meet in tiles, one for each such shingle.
2. Size bands. Within a tile only pairs of sizes that allow 80 % are taken. Tiles of up to `TILE` classes give all such
   pairs. Larger ones are compared band by band, in blocks of about `BLOCK` by `BLOCK` classes, each a task's group: first
   for a forest of the likeliest pairs, then, once those are decided, for all pairs of classes that are still apart.
3. Hashed bitmaps. Shingles are hashed to buckets of four bits; the first in a bucket sets its first bit, the second the
   second, and so on. The bits that two sets have in common, and the shingles beyond four in a bucket, bound their overlap
   from above.
4. What passes is decided by intersecting the sorted arrays of 64-bit shingle hashes. The arrays are made from the text
   where a pair is decided: text takes less room in a shuffle. The texts of the classes needed are picked by doc_id, with
   the ids in every task if there are at most `PICKED`, else by a shuffle.

Lower case is for A-Z only; words end at ASCII white space. Fewer than five words are one shingle; a null, empty or blank
text has none, links with nothing and is its own component. A null doc_id takes part; its component is the smallest
doc_id reachable, or null. Rows that repeat are copies. Nothing is capped: bounds only choose the way.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from paperledger.llm.components import apart, components
from paperledger.llm.frames import as_text, numbers
from paperledger.session import stored

WORDS = 5
PERCENT = 80
TILE = 64
BLOCK = 1024
OFTEN = 1 << 17
OFTEN_SHARE = 2000
OFTEN_LEAST = 3
ROWS = 1000
PICKED = 1_000_000
SIZE_BITS = 16
TOKEN_BITS = 40

_BASE = 0x9E3779B97F4A7C15


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n - 1 of an odd number and of its inverse, modulo 2^64."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    """A random number for each byte."""
    return np.array([int.from_bytes(hashlib.blake2b(bytes([b]), digest_size=8).digest(), "big") for b in range(256)], np.uint64)


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles: hashes of byte ranges, from one pass of prefix sums."""
    found = (text or "").encode().lower().split()
    if not found:
        return np.empty(0, np.uint64)
    line = np.frombuffer(b" ".join(found), np.uint8)
    power, inverse = _powers(1 << max(12, len(line).bit_length()))
    sums = np.zeros(len(line) + 1, np.uint64)
    np.cumsum(_byte_values()[line] * power[: len(line)], out=sums[1:])
    blanks = np.flatnonzero(line == 32)
    k = min(words, len(found))
    start = np.concatenate(([0], blanks + 1))[: len(found) - k + 1]
    end = np.concatenate((blanks, [len(line)]))[k - 1:]
    x = (sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64)
    for shift, factor in ((31, 0x7FB5D329728EA185), (27, 0x81DADEF4BC2DD44D)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return np.unique(x ^ (x >> np.uint64(33)))


def needed(n: int | np.ndarray, percent: int) -> int | np.ndarray:
    """Shingles that a set of n shares at least with any set alike."""
    return (percent * n + 99) // 100


def prefix(hashes: np.ndarray, often: np.ndarray, rank: np.ndarray, percent: int) -> np.ndarray:
    """The first shingles of a set in the common order: those not in `often` by hash, then the others by rank."""
    size = len(hashes) - needed(len(hashes), percent) + 1
    if not len(often):
        return hashes[:size]
    at = np.minimum(np.searchsorted(often, hashes), len(often) - 1)
    known = often[at] == hashes
    first = hashes[~known][:size]
    if len(first) == size:
        return first
    rest = np.argsort(rank[at[known]], kind="stable")[: size - len(first)]
    return np.concatenate((first, hashes[known][rest]))


def places(tokens: np.ndarray, n: int) -> np.ndarray:
    """Tokens and their set's size in one number, to shuffle few bytes: 40 bits of the hash, then the size up to 65,535.

    Both only choose what is compared: sets may meet by hashes that differ, and large sizes pass for alike.
    """
    return (tokens >> np.uint64(64 - TOKEN_BITS) << np.uint64(SIZE_BITS) | np.uint64(min(n, (1 << SIZE_BITS) - 1))).view(np.int64)


def _nibbles(counts: np.ndarray) -> np.ndarray:
    """A bucket's count, up to four, as that many bits; two buckets in a byte."""
    bits = ((1 << np.minimum(counts, 4)) - 1).astype(np.uint8)
    return bits[0::2] | (bits[1::2] << 4)


def bitmap(hashes: np.ndarray) -> np.ndarray:
    """About as many buckets as shingles, 16 at least and 2^14 at most, as bytes."""
    buckets = 1 << min(14, max(4, (len(hashes) - 1).bit_length()))
    return _nibbles(np.bincount((hashes & np.uint64(buckets - 1)).astype(np.int64), minlength=buckets))


def folded(bits: np.ndarray, size: int) -> np.ndarray:
    """A bitmap of the same set with fewer buckets."""
    while len(bits) > size:
        counts = np.bitwise_count(np.stack((bits & 15, bits >> 4), axis=1).ravel())
        bits = _nibbles(counts[: len(counts) // 2] + counts[len(counts) // 2:])
    return bits


def alike(shared: int | np.ndarray, n: int | np.ndarray, m: int | np.ndarray, percent: int) -> bool | np.ndarray:
    return 100 * shared >= percent * (n + m - shared)


def may_be_alike(n: int, bits: np.ndarray, m: int, other: np.ndarray, percent: int) -> bool:
    size = min(len(bits), len(other))
    bits, other = folded(bits, size), folded(other, size)
    beyond = min(n - int(np.bitwise_count(bits).sum()), m - int(np.bitwise_count(other).sum()))
    return alike(min(n, m, int(np.bitwise_count(bits & other).sum()) + beyond), n, m, percent)


def forest(likeness: np.ndarray) -> np.ndarray:
    """The pairs (i, j) of a spanning forest of the positive entries of a symmetric matrix, likeliest first."""
    n = len(likeness)
    group, out = np.arange(n), []
    while True:
        apart = np.where(group[:, None] != group[None, :], likeness, 0)
        best = apart.argmax(axis=1)
        worth = apart[np.arange(n), best]
        # Each group takes its likeliest pair with another one.
        order = np.lexsort((np.arange(n), -worth))
        order = order[worth[order] > 0]
        _, first = np.unique(group[order], return_index=True)
        taken = False
        for i in order[np.sort(first)]:
            j = best[i]
            if group[i] != group[j]:
                out.append((i, j))
                group[group == group[j]] = group[i]
                taken = True
        if not taken:
            return np.array(out, np.int64).reshape(-1, 2)


def name(hashes: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True)


def _times(sets: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The distinct shingles of all sets and in how many sets they are, by sixteenths of the hashes to save memory."""
    steps = np.arange(1, 16, dtype=np.uint64) << np.uint64(60)
    cuts = [np.concatenate(([0], np.searchsorted(s, steps), [len(s)])) for s in sets]
    for k in range(16 if sets else 0):
        yield np.unique(np.concatenate([s[c[k]:c[k + 1]] for s, c in zip(sets, cuts)]), return_counts=True)


def _keys(docs: DataFrame, words: int) -> DataFrame:
    """Per document n and the name of its class (kind 0); per batch the shingles that many of its documents have (kind 1)."""

    keyed = "_key" in docs.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingles(t, words) for t in batch["text"]]
            yield pd.DataFrame({
                "kind": 0, "doc_id": numbers(batch["doc_id"]), "n": [len(s) for s in sets], "cls": [name(s) for s in sets],
            } | ({"_key": numbers(batch["_key"])} if keyed else {}))
            for seen, times in _times(sets):
                many = times >= max(OFTEN_LEAST, len(sets) // OFTEN_SHARE)
                yield pd.DataFrame({
                    "kind": 1, "doc_id": pd.array([pd.NA] * int(many.sum()), "Int64"), "n": times[many], "cls": seen[many].view(np.int64),
                } | ({"_key": pd.array([pd.NA] * int(many.sum()), "Int64")} if keyed else {}))

    columns = [as_text("doc_id"), "text", *([as_text("_key")] if keyed else [])]
    return docs.select(*columns).mapInPandas(run, "kind int, doc_id long, n long, cls long" + (", _key long" if keyed else ""))


def _per_class(docs: DataFrame, words: int, what: Callable[[np.ndarray], object], schema: str) -> DataFrame:
    """cls, n and `what` of the set, once for each class in `ROWS` rows; blank texts have none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), ROWS):
                sets = {name(s): s for t in batch["text"].iloc[start:start + ROWS] if len(s := shingles(t, words))}
                yield pd.DataFrame({"cls": list(sets), "n": [len(s) for s in sets.values()], "what": [what(s) for s in sets.values()]})

    return docs.select("text").mapInPandas(run, f"cls long, n long, what {schema}")


def _texts(docs: DataFrame, classes: DataFrame, words: int, picked: int) -> DataFrame:
    """cls, text of the given classes (cls, first), from the documents that they have as first.

    Where one doc_id has several texts, all of them come; who uses them has to compare names.
    """

    def named(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"cls": [name(shingles(t, words)) for t in batch["text"]], "text": batch["text"]})

    ids = classes.filter("first IS NOT NULL")
    known = docs.join(F.broadcast(ids) if ids.count() <= picked else ids, docs["doc_id"] == ids["first"]).select("cls", "text")
    nameless = docs.filter("doc_id IS NULL").select("text").mapInPandas(named, "cls long, text string").dropDuplicates(["cls"])
    return known.unionByName(nameless.join(classes.filter("first IS NULL").select("cls"), "cls"))


def likely_pairs(pairs: DataFrame, signatures: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) that may be alike by their bitmaps."""

    def by_bits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            keep = [
                may_be_alike(n, np.frombuffer(p, np.uint8), m, np.frombuffer(q, np.uint8), percent)
                for n, p, m, q in zip(x["n"].tolist(), x["bits"], x["m"].tolist(), x["bits2"])
            ]
            yield x.loc[np.array(keep, bool), ["a", "b"]]

    left = signatures.select(F.col("cls").alias("a"), "n", "bits")
    right = signatures.select(F.col("cls").alias("b"), F.col("n").alias("m"), F.col("bits").alias("bits2"))
    return pairs.join(left, "a").join(right, "b").mapInPandas(by_bits, "a long, b long")


def verified(likely: DataFrame, docs: DataFrame, classes: DataFrame, words: int, percent: int, picked: int) -> DataFrame:
    """Those of the pairs (a, b) that are alike, by their arrays."""

    def by_arrays(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last: dict[str, tuple[int, str | None, np.ndarray]] = {}

        def set_of(side: str, cls: int, text: str) -> np.ndarray | None:
            """The set if the text is of this class; rows come sorted by one side, so its last set often serves again."""
            if last.get(side, (0, None))[:2] != (cls, text):
                found = shingles(text, words)
                last[side] = (cls, text, found if name(found) == cls else None)
            return last[side][2]

        for x in batches:
            keep = []
            for a, b, p, q in zip(x["a"].tolist(), x["b"].tolist(), x["text"], x["text2"]):
                p, q = set_of("a", a, p), set_of("b", b, q)
                known = p is not None and q is not None
                keep.append(known and alike(len(np.intersect1d(p, q, assume_unique=True)), len(p), len(q), percent))
            yield x.loc[np.array(keep, bool), ["a", "b"]]

    likely = stored(likely)
    needed_ = likely.select(F.col("a").alias("cls")).unionByName(likely.select(F.col("b").alias("cls"))).distinct()
    texts = _texts(docs, stored(classes.join(needed_, "cls").select("cls", "first")), words, picked)
    left, right = texts.withColumnRenamed("cls", "a"), texts.withColumnsRenamed({"cls": "b", "text": "text2"})
    return likely.join(left, "a").join(right, "b").mapInPandas(by_arrays, "a long, b long").distinct()


def _band(n: Column, percent: int) -> Column:
    """Sizes that allow the similarity are in one band or in neighbouring ones."""
    return F.floor(F.log(n.cast("double")) / F.log(F.lit(100.0 / percent)) + 1e-9).cast("int")


def _small_pairs(small: DataFrame, tile: int, percent: int) -> DataFrame:
    """All pairs of each tile whose sizes allow it; the tiles have `tile` classes at most."""
    # Dealt out as rows: lists of one, as the aggregate makes them before a shuffle, are three times as large.
    lists = small.repartition("token").groupBy("token").agg(F.sort_array(F.collect_list(F.struct("n", "cls"))).alias("of"))

    def partners(x: Column, i: Column) -> Column:
        larger = F.filter(F.slice(F.col("of"), i + 2, F.lit(tile)), lambda y: 100 * x["n"] >= percent * y["n"])
        return F.transform(larger, lambda y: F.struct(F.least(x["cls"], y["cls"]).alias("a"), F.greatest(x["cls"], y["cls"]).alias("b")))

    return lists.select(F.inline(F.flatten(F.transform("of", partners)))).distinct()


def _block_pairs(large: DataFrame, signatures: DataFrame, roots: DataFrame | None, block: int, percent: int) -> DataFrame:
    """Pairs of large tiles that pass sizes and bitmaps: of each block a forest, or with `roots` all that are still apart.

    A tile's band holds its own classes and those of the next band. It is cut by hash into k parts, where k * `block`
    is about the tile's size, and each two parts, or one with itself, are a group.
    """
    if roots is None:
        rows = large.withColumn("root", F.col("cls"))
    else:
        rows = large.join(roots, large["cls"] == roots["node"], "left").withColumn("root", F.coalesce("root", "cls")).drop("node")
        apart = rows.groupBy("token").agg(F.min("root").alias("r1"), F.max("root").alias("r2")).filter("r1 <> r2").select("token")
        rows = rows.join(apart, "token")
    rows = rows.drop("n").join(signatures.select("cls", "n", "bits"), "cls")
    rows = rows.withColumn("own", _band(F.col("n"), percent)).withColumn("parts", F.ceil(F.col("c") / block).cast("int"))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int"))
    rows = rows.withColumn("band", F.explode(F.array(F.col("own"), F.col("own") - 1)))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.select(
        "token", "band", "own", "cls", "n", "root", "part", "bits",
        F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"),
    )
    only_forest = roots is None

    def compare(x: pd.DataFrame) -> pd.DataFrame:
        x = x.sort_values("cls")
        i, j, band = x["i"].iloc[0], x["j"].iloc[0], x["band"].iloc[0]
        size = min(map(len, x["bits"]))
        bits = np.stack([folded(np.frombuffer(b, np.uint8), size) for b in x["bits"]])
        n, cls, root = x["n"].to_numpy(), x["cls"].to_numpy(), x["root"].to_numpy()
        own, part = x["own"].to_numpy(), x["part"].to_numpy()
        beyond = n - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
        likeness = np.zeros((len(cls), len(cls)), np.float32) if only_forest else None
        out = []
        for at in np.flatnonzero(part == i):
            # Two classes of one upper band meet in that band's own group.
            with_ = (part == j) & (root != root[at]) & ((own[at] == band) | (own == band))
            if i == j:
                with_ &= cls > cls[at]
            with_ &= 100 * np.minimum(n, n[at]) >= percent * np.maximum(n, n[at])
            to = np.flatnonzero(with_)
            shared = np.bitwise_count(bits[to] & bits[at]).sum(axis=1, dtype=np.int64) + np.minimum(beyond[to], beyond[at])
            shared = np.minimum(shared, np.minimum(n[to], n[at]))
            good = alike(shared, n[to], n[at], percent)
            to, shared = to[good], shared[good]
            if only_forest:
                likeness[at, to] = likeness[to, at] = shared / (n[to] + n[at] - shared)
            else:
                out.append(np.stack((np.full(len(to), at), to), axis=1))
        pairs = cls[forest(likeness) if only_forest else np.concatenate(out) if out else np.empty((0, 2), np.int64)]
        return pd.DataFrame({"a": pairs.min(axis=1), "b": pairs.max(axis=1)}) if len(pairs) else pd.DataFrame({"a": [], "b": []}, dtype=np.int64)

    return rows.groupBy("token", "band", "i", "j").applyInPandas(compare, "a long, b long").distinct()


def jaccard_components(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT, tile: int = TILE, block: int = BLOCK, often: int = OFTEN,
    picked: int = PICKED,
) -> DataFrame:
    """doc_id, n_shingles, component_id for each row of docs."""
    rows = _rows(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), words, percent, tile, block, often, picked)
    return rows.select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component")).alias("component_id"),
    )


def text_key(text: Column) -> Column:
    """With the doc_id this tells rows apart that share it: a hash of the text, null as empty."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def first_rows(docs: DataFrame) -> DataFrame:
    """doc_id, _key for each row of docs, and `first`, that of its component's smallest row (no_id, doc_id, _key): null ids last.

    A text without shingles has no component, and null there.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), text_key(F.col("text")).alias("_key"))
    return _rows(docs, WORDS, PERCENT, TILE, BLOCK, OFTEN, PICKED).select("doc_id", "_key", F.col("least").alias("first"))


def _rows(docs: DataFrame, words: int, percent: int, tile: int, block: int, often: int, picked: int) -> DataFrame:
    """doc_id, n and component for each row of docs (doc_id, text); with a column `_key` in docs also that and `least`."""
    keyed = "_key" in docs.columns
    keys = stored(_keys(docs, words))
    frequent = keys.filter("kind = 1").groupBy("cls").agg(F.sum("n").alias("c")).orderBy(F.desc("c"), "cls").limit(often)
    frequent = frequent.toArrow().to_pandas()
    frequent = frequent.iloc[np.argsort(frequent["cls"].to_numpy().view(np.uint64), kind="stable")]
    given = docs.sparkSession.sparkContext.broadcast((frequent["cls"].to_numpy().view(np.uint64), frequent["c"].to_numpy()))
    rows = keys.filter("kind = 0").drop("kind")
    row = [F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_key")).alias("least")] if keyed else []
    classes = rows.filter("n > 0").groupBy("cls").agg(F.min("doc_id").alias("first"), *row)

    tokens = _per_class(docs, words, lambda s: places(prefix(s, *given.value, percent), len(s)), "array<long>")
    token = F.shiftright("place", SIZE_BITS)
    tokens = tokens.select("cls", F.explode("what").alias("place")).repartition(token)
    tokens = tokens.select("cls", F.col("place").bitwiseAND((1 << SIZE_BITS) - 1).alias("n"), token.alias("token"))
    # A window rather than an aggregate joined back: the tokens, most of them of one class only, are shuffled once.
    of_token = Window.partitionBy("token")
    met = tokens.withColumn("c1", F.min("cls").over(of_token)).withColumn("c2", F.max("cls").over(of_token))
    met = met.filter("c1 <> c2").select("token", "cls", "n").dropDuplicates(["token", "cls"])
    met = stored(met.withColumn("c", F.count(F.lit(1)).over(of_token)))
    small, large = met.filter(F.col("c") <= tile), met.filter(F.col("c") > tile)
    signatures = _per_class(docs, words, lambda s: bitmap(s).tobytes(), "binary").withColumnRenamed("what", "bits")
    meeting = met.groupBy("cls").agg((F.max("c") > tile).alias("in_large"), (F.min("c") <= tile).alias("in_small"))
    signatures = stored(signatures.join(meeting, "cls").dropDuplicates(["cls"]))

    likely = likely_pairs(_small_pairs(small, tile, percent), signatures.filter("in_small"), percent)
    any_large = not large.isEmpty()
    if any_large:
        likely = likely.unionByName(_block_pairs(large, signatures.filter("in_large"), None, block, percent)).distinct()
    roots = components(verified(likely, docs, classes, words, percent, picked))
    if any_large:
        rest = _block_pairs(large, signatures.filter("in_large"), roots, block, percent)
        rest = stored(verified(rest, docs, classes, words, percent, picked))
        if not rest.isEmpty():
            roots = components(rest.unionByName(roots.toDF("a", "b")))

    rooted = classes.join(roots.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    least = [F.min("least").alias("least")] if keyed else []
    component = rooted.groupBy("root").agg(F.min("first").alias("component"), *least)
    rooted = rooted.select("cls", "root").join(apart(component, "root"), "root").drop("root")
    return rows.join(rooted, "cls", "left")
