"""Hard negatives from Hilbert-ordered blocks with zone maps.

Rows are sorted by label and by their place on a Hilbert curve through all dimensions (two bits each, scaled by mean and
deviation), range-partitioned, and written as Parquet, one row for each block of at most `BLOCK` vectors. A block's zone map is
its least and greatest component in every dimension, its labels' range and its smallest id. For an anchor a, interval arithmetic
bounds all scores of a block: sum of max(a lo, a hi) from above, sum of min(a lo, a hi) from below.

- Positives: an anchor's own block gives a score that its fifth positive reaches at least. Only blocks that hold its label
  and whose upper bound reaches that score (at that score: with a smaller id) are read.
- Windows: each positive's score p gives a window of scores, p/2 to 95 p/100. The block of other labels with the greatest upper bound
  in each page of zone maps is read first, and gives a score that the window's third negative reaches at least. Then blocks are read
  whose bounds meet what is left of a window.

All bounds only choose blocks; scores are exact whole numbers, so the result is that of comparing all pairs. Anchors
travel in tiles of at most `TILE`, zone maps in pages of `PAGE` blocks; a tile meets pages, then the blocks chosen for some of
its anchors. Per anchor and block at most five rows, or three a window, leave a task; best rows are cut before the shuffle.
How many blocks bounds spare depends on the data: clustered vectors are read in few blocks, vectors without clusters in many
dimensions (as in the given tables) in nearly all, which costs each anchor a scan in blocks.

Rows with a null label, a null or empty vector, null or non-finite components take no part, nor do those of another length than most
vectors or with a component so large that a score may exceed a long. A row with a null vec_id is no anchor, and comes last among
equal scores. Rows that repeat are rows of their own: each is an anchor, and "other" rows are all but itself. An empty table gives
no rows, as does an anchor without positives.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from paperledger.llm.frames import as_text
from paperledger.llm.vectors import whole_vectors
from paperledger.session import shared_dir

FACTOR = 256
BLOCK = 1024
TILE = 256
PAGE = 256
BITS = 2
POSITIVES = 5
NEGATIVES = 3
HIGH = 95  # percent of a positive's score; half of it is the least

NONE = np.iinfo(np.int64).min
LAST = np.iinfo(np.int64).max
BLOCKS = (
    "block long, n int, label_lo long, label_hi long, id_lo long, lo binary, hi binary, "
    "ids array<string>, labels binary, vectors binary, seeds array<struct<row:int,score:long,id:long>>"
)
ANCHORS = "address long, id string, label long, vector binary, least long, least_id long"
TILES = "tile long, addresses array<long>, ids array<string>, labels binary, vectors binary, floors binary"
PAGES = "page int, blocks array<long>, label_lo binary, label_hi binary, id_lo binary, lo binary, hi binary"
PAIRS = "block long, addresses array<long>, anchor_labels binary, anchors binary, windows binary"
FOUND = "address long, place int, id string, score long"


def curve_keys(levels: np.ndarray, bits: int) -> list[bytes]:
    """Places on the Hilbert curve through a cube with 2^bits levels in each dimension, as bytes that sort like them."""
    x = levels.astype(np.uint32).copy()
    n, dims = x.shape
    for b in range(bits - 1, 0, -1):
        bit, below = np.uint32(1 << b), np.uint32((1 << b) - 1)
        for d in range(dims):
            on = (x[:, d] & bit) != 0
            swap = np.where(on, 0, (x[:, 0] ^ x[:, d]) & below).astype(np.uint32)
            x[:, 0] ^= np.where(on, below, swap).astype(np.uint32)
            if d:
                x[:, d] ^= swap
    for d in range(1, dims):
        x[:, d] ^= x[:, d - 1]
    turn = np.zeros(n, dtype=np.uint32)
    for b in range(bits - 1, 0, -1):
        turn ^= np.where(x[:, -1] & np.uint32(1 << b), np.uint32((1 << b) - 1), 0).astype(np.uint32)
    x ^= turn[:, None]
    planes = np.stack([(x >> b) & 1 for b in range(bits - 1, -1, -1)], axis=1).astype(np.uint8)
    return [row.tobytes() for row in np.packbits(planes.reshape(n, -1), axis=1)]


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole vectors, exact: by doubles where these hold all sums."""
    largest = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if largest < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def unpacked(data: bytes, dims: int) -> np.ndarray:
    return np.frombuffer(data, dtype="<i4").reshape(-1, dims).astype(np.int64)


def best(values: np.ndarray, allowed: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """k times the place and value of each row's greatest value still allowed (NONE: no more), of equal ones the first."""
    left = np.where(allowed, values, NONE)
    every = np.arange(len(left))
    for _ in range(min(k, left.shape[1])):
        at = left.argmax(axis=1)
        yield at, left[every, at].copy()
        left[every, at] = NONE


def order_ids(ids: list[str | None]) -> np.ndarray:
    """Ids as longs for comparison; a null comes last."""
    return np.array([LAST if i is None else int(i) for i in ids], dtype=np.int64)


def keyed(rows: DataFrame, dims: int) -> DataFrame:
    """Rows with `key`, their place on the curve."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((3, dims))
        for batch in batches:
            q = np.stack(batch["x"].to_numpy()).astype(np.float64)
            total += np.stack([np.full(dims, len(q)), q.sum(axis=0), (q * q).sum(axis=0)])
        yield pd.DataFrame({"dim": np.arange(dims), "n": total[0], "s": total[1], "ss": total[2]})

    moments = rows.select("x").mapInPandas(partial, "dim int, n double, s double, ss double")
    by_dim = sorted(moments.groupBy("dim").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("ss").alias("ss")).collect())
    mean = np.array([r["s"] / max(r["n"], 1) for r in by_dim])
    deviation = np.sqrt(np.maximum([r["ss"] / max(r["n"], 1) for r in by_dim] - mean**2, 1e-9))

    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            q = np.stack(batch["x"].to_numpy()) if len(batch) else np.zeros((0, dims))
            levels = np.clip((q - mean) / deviation * (1 << BITS) / 4 + (1 << BITS) / 2, 0, (1 << BITS) - 1)
            packed = [v.tobytes() for v in np.stack(batch["x"].to_numpy()).astype("<i4")] if len(batch) else []
            yield batch[["id", "label"]].assign(vector=packed, key=curve_keys(levels, BITS))

    return rows.mapInPandas(keys, "id string, label long, vector binary, key binary")


def blocks_of(rows: DataFrame, dims: int, anchor_every: int, block: int = BLOCK) -> DataFrame:
    """One row a block: its zone map, ids, labels and vectors, and for each anchor in it the least score of its last positive."""

    def made(part: int, serial: int, rows: pd.DataFrame) -> tuple:
        ids = order_ids(rows["id"].tolist())
        rows = rows.iloc[np.argsort(ids, kind="stable")]
        ids = np.sort(ids)
        q = np.stack([np.frombuffer(v, dtype="<i4") for v in rows["vector"]]).astype(np.int64)
        labels = rows["label"].to_numpy(dtype=np.int64)
        at = np.flatnonzero((ids % anchor_every == 0) & rows["id"].notna().to_numpy())
        seeds = [(int(a), int(NONE), int(LAST)) for a in at]
        if len(at):
            allowed = labels[at][:, None] == labels[None, :]
            allowed[np.arange(len(at)), at] = False
            found = list(best(scores(q[at], q), allowed, POSITIVES))
            if len(found) == POSITIVES:
                where, last = found[-1]
                seeds = [(int(a), int(v), int(ids[w]) if v != NONE else int(LAST)) for a, w, v in zip(at, where, last)]
        return (
            (part << 20) + serial, len(q), int(labels.min()), int(labels.max()), int(ids[0]), q.min(axis=0).astype("<i4").tobytes(),
            q.max(axis=0).astype("<i4").tobytes(), rows["id"].tolist(), labels.astype("<i8").tobytes(), q.astype("<i4").tobytes(), seeds)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, serial, held = 0, 0, []
        names = [c.split()[0] for c in "block n label_lo label_hi id_lo lo hi ids labels vectors seeds".split()]

        def frame(rows: pd.DataFrame) -> pd.DataFrame:
            row = dict(zip(names, made(part, serial, rows)))
            row["seeds"] = [{"row": r, "score": s, "id": i} for r, s, i in row["seeds"]]
            return pd.DataFrame({k: [v] for k, v in row.items()})

        for batch in batches:
            if not len(batch):
                continue
            part = int(batch["part"].iloc[0])
            held.append(batch)
            while sum(map(len, held)) >= block:
                whole = pd.concat(held, ignore_index=True)
                yield frame(whole.iloc[:block])
                serial += 1
                held = [whole.iloc[block:]]
        if sum(map(len, held)):
            yield frame(pd.concat(held, ignore_index=True))

    # Equal rows are split between tasks by their place; the order of ids keeps smaller ones in earlier blocks.
    order = ["label", "key", F.col("id").cast("long").asc_nulls_last(), "place"]
    dealt = keyed(rows, dims).withColumn("place", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    return dealt.select("id", "label", "vector", F.spark_partition_id().alias("part")).mapInPandas(cut, BLOCKS)


def anchors_of(blocks: DataFrame, dims: int, block: int = BLOCK) -> DataFrame:
    """One row an anchor; its address is unique, its label and vector come from its block."""

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for at, ids, labels, vectors, seeds in batch.itertuples(index=False):
                q, own = np.frombuffer(vectors, dtype="<i4").reshape(-1, dims), np.frombuffer(labels, dtype="<i8")
                for s in seeds:
                    out.append((at * block + s["row"], ids[s["row"]], int(own[s["row"]]), q[s["row"]].tobytes(), s["score"], s["id"]))
            if out:
                yield pd.DataFrame(out, columns=["address", "id", "label", "vector", "least", "least_id"])

    return blocks.filter(F.size("seeds") > 0).select("block", "ids", "labels", "vectors", "seeds").mapInPandas(split, ANCHORS)


def aligned(windows: pd.Series) -> np.ndarray:
    """lo, hi, least, least_id by anchor and window; an anchor with fewer windows gets some that no score is in."""
    most = max((len(w) for w in windows), default=0)
    out = np.empty((len(windows), most, 4), dtype="<i8")
    out[:] = (LAST, NONE, LAST, NONE)
    for i, own in enumerate(windows):
        for j, w in enumerate(own):
            out[i, j] = (w["lo"], w["hi"], w["least"], w["least_id"])
    return out


def tiles_of(anchors: DataFrame, tile: int = TILE) -> DataFrame:
    """Neighbouring anchors together; `floors` (lo, hi, least, least_id) are the windows of each anchor with what they must reach."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def frame(rows: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({
                "tile": [int(rows["address"].iloc[0])], "addresses": [rows["address"].tolist()], "ids": [rows["id"].tolist()],
                "labels": [rows["label"].to_numpy(dtype="<i8").tobytes()], "vectors": [b"".join(rows["vector"])],
                "floors": [aligned(rows["floors"]).tobytes()],
            })

        for batch in batches:
            held.append(batch)
            while sum(map(len, held)) >= tile:
                whole = pd.concat(held, ignore_index=True)
                yield frame(whole.iloc[:tile])
                held = [whole.iloc[tile:]]
        if sum(map(len, held)):
            yield frame(pd.concat(held, ignore_index=True))

    rows = anchors.select("address", "id", "label", "vector", "floors")
    return rows.repartitionByRange("address").sortWithinPartitions("address").mapInPandas(cut, TILES)


def pages_of(blocks: DataFrame, pages: int) -> DataFrame:
    """Zone maps of about `PAGE` blocks in one row."""

    def page(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        whole = {c: rows[c].to_numpy(dtype="<i8").tobytes() for c in ("label_lo", "label_hi", "id_lo")}
        return pd.DataFrame([{"page": key[0], "blocks": rows["block"].tolist(), **whole, "lo": b"".join(rows["lo"]), "hi": b"".join(rows["hi"])}])

    number = F.pmod(F.xxhash64("block"), F.lit(pages)).cast("int").alias("page")
    zones = blocks.select(number, "block", "label_lo", "label_hi", "id_lo", "lo", "hi")
    return zones.groupBy("page").applyInPandas(page, PAGES)


def chosen(tiles: DataFrame, n_tiles: int, pages: DataFrame, n_pages: int, dims: int, same_label: bool, probe: bool = False) -> DataFrame:
    """Blocks to read, each with those anchors of a tile that must read it.

    Every tile meets every page once, in groups of 64 tiles to a page. With `probe` an anchor reads only the block of a page that may
    hold the greatest score.
    """

    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for t in batch.itertuples(index=False):
                a = unpacked(t.vectors, dims).astype(np.float64)
                lo, hi = (unpacked(z, dims).astype(np.float64) for z in (t.lo, t.hi))
                labels = np.frombuffer(t.labels, dtype="<i8")[:, None]
                label_lo, label_hi, id_lo = (np.frombuffer(z, dtype="<i8")[None, :] for z in (t.label_lo, t.label_hi, t.id_lo))
                up, down = np.maximum(a, 0), np.minimum(a, 0)
                upper, lower = up @ hi.T + down @ lo.T, up @ lo.T + down @ hi.T
                # Sums that doubles hold are exact; others are given room for rounding.
                slack = np.abs(a) @ np.maximum(np.abs(lo), np.abs(hi)).T
                slack = np.where(slack < 1 << 53, 0.0, 1e-12 * slack)
                upper, lower = upper + slack, lower - slack
                holds = (label_lo <= labels) & (labels <= label_hi) if same_label else (label_lo != labels) | (label_hi != labels)
                must = np.zeros(upper.shape, dtype=bool)
                floors = np.frombuffer(t.floors, dtype="<i8").reshape(len(a), -1, 4)
                for w in range(floors.shape[1]):
                    f_lo, f_hi, least, least_id = (floors[:, w, i, None] for i in range(4))
                    # A block that can only equal the least score must hold a smaller id (or the same one again).
                    reaches = (upper > least) | ((upper >= least) & (id_lo <= least_id))
                    must |= (upper >= f_lo) & (lower <= f_hi) & reaches
                must &= holds
                if probe:
                    at = np.where(must, upper, -np.inf).argmax(axis=1)
                    first = np.zeros(must.shape, dtype=bool)
                    first[np.arange(len(at)), at] = True
                    must &= first
                out = []
                vectors, flat = unpacked(t.vectors, dims).astype("<i4"), labels[:, 0]
                for j in np.flatnonzero(must.any(axis=0)):
                    rows = np.flatnonzero(must[:, j])
                    out.append((
                        int(t.blocks[j]), [int(t.addresses[i]) for i in rows], flat[rows].astype("<i8").tobytes(), vectors[rows].tobytes(),
                        floors[rows, :, :2].tobytes()))
                if out:
                    yield pd.DataFrame(out, columns=["block", "addresses", "anchor_labels", "anchors", "windows"])

    buckets = -(-n_tiles // 64)
    left = tiles.withColumn("bucket", F.pmod(F.xxhash64("tile"), F.lit(buckets))).withColumn("page", F.explode(F.sequence(F.lit(0), F.lit(n_pages - 1))))
    right = pages.withColumnRenamed("page", "of").withColumn("with", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    met = left.join(right, (left["page"] == right["of"]) & (left["bucket"] == right["with"]))
    met = met.select("addresses", "vectors", "floors", "blocks", "label_lo", "label_hi", "id_lo", "lo", "hi", "labels")
    return met.mapInPandas(choose, PAIRS)


def scored(pairs: DataFrame, blocks: DataFrame, dims: int, same_label: bool, block: int = BLOCK) -> DataFrame:
    """(address, place, id, score): the best rows of the chosen blocks for each anchor and window (place)."""
    k = POSITIVES if same_label else NEGATIVES

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: list[pd.DataFrame] = []
            for t in batch.itertuples(index=False):
                q, labels, ids = unpacked(t.vectors, dims), np.frombuffer(t.labels, dtype="<i8"), np.array(list(t.ids), dtype=object)
                addresses = np.array(t.addresses, dtype=np.int64)
                values = scores(unpacked(t.anchors, dims), q)
                own = np.frombuffer(t.anchor_labels, dtype="<i8")[:, None]
                allowed = (own == labels) if same_label else (own != labels)
                inside = addresses - t.block * block
                here = np.flatnonzero((inside >= 0) & (inside < len(q)))
                allowed[here, inside[here]] = False
                windows = np.frombuffer(t.windows, dtype="<i8").reshape(len(addresses), -1, 2)
                for w in range(windows.shape[1]):
                    lo, hi = windows[:, w, 0, None], windows[:, w, 1, None]
                    for at, value in best(values, allowed & (values >= lo) & (values <= hi), k):
                        some = value != NONE
                        if not some.any():
                            break
                        out.append(pd.DataFrame({"address": addresses[some], "place": w, "id": ids[at[some]], "score": value[some]}))
            if out:
                yield pd.concat(out)

    held = blocks.select(F.col("block").alias("of"), "ids", "labels", "vectors")
    met = pairs.join(held, pairs["block"] == held["of"]).drop("of")
    found = met.mapInPandas(read, FOUND)
    order = [F.desc("score"), F.col("id").cast("long").asc_nulls_last()]
    rank = F.row_number().over(W.partitionBy("address", "place").orderBy(*order))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def floors(lo: Column, hi: Column, least: Column, least_id: Column) -> Column:
    return F.struct(lo.alias("lo"), hi.alias("hi"), least.alias("least"), least_id.alias("least_id"))


def hard_negatives(rows: DataFrame, dims: int, anchor_every: int = 50, block: int = BLOCK, tile: int = TILE, page: int = PAGE) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of rows (id string, label long, x array<long>).

    Anchors are rows whose id is divisible by `anchor_every`.
    """
    spark = rows.sparkSession
    path = f"{shared_dir(spark)}/blocks-{uuid.uuid4().hex}"
    blocks_of(rows, dims, anchor_every, block).write.parquet(path)
    blocks = spark.read.schema(BLOCKS).parquet(path)
    anchors = anchors_of(blocks, dims, block).checkpoint()
    n_pages = max(1, -(-blocks.count() // page))
    pages = pages_of(blocks, n_pages).checkpoint()
    all_scores = F.array(floors(F.lit(NONE), F.lit(LAST), F.col("least"), F.col("least_id")))

    def read(tiles: DataFrame, same_label: bool, probe: bool = False) -> DataFrame:
        pairs = chosen(tiles, max(1, tiles.count()), pages, n_pages, dims, same_label, probe)
        return scored(pairs, blocks, dims, same_label, block)

    tiles = tiles_of(anchors.withColumn("floors", all_scores), tile).checkpoint()
    positives = read(tiles, True).select("address", F.col("rank").alias("nth"), F.col("id").alias("positive_id"), F.col("score").alias("p")).checkpoint()
    # 50 p <= 100 s <= 95 p in whole numbers; products of p with 95 might exceed a long.
    p, whole = F.col("p"), F.expr("p div 100")
    lo = F.expr("p div 2") + F.when(p % 2 != 0, 1).otherwise(0)
    spans = positives.filter("p >= 0").select("address", lo.alias("lo"), (whole * HIGH + F.expr(f"(p % 100) * {HIGH} div 100")).alias("hi")).distinct()
    windows = spans.groupBy("address").agg(F.array_sort(F.collect_list(F.struct("lo", "hi"))).alias("spans"))
    own = anchors.join(windows, "address").select("address", "id", "label", "vector", "spans").checkpoint()

    first = own.withColumn("floors", F.transform("spans", lambda s: floors(s["lo"], s["hi"], F.lit(NONE), F.lit(LAST))))
    reached = read(tiles_of(first, tile).checkpoint(), False, probe=True).filter(F.col("rank") == NEGATIVES)
    reached = reached.groupBy("address").agg(F.map_from_entries(F.collect_list(F.struct("place", F.struct(
        F.col("score").alias("least"), F.coalesce(F.col("id").cast("long"), F.lit(LAST)).alias("least_id"))))).alias("reached"))
    second = own.join(reached, "address", "left").withColumn("floors", F.transform("spans", lambda s, i: floors(
        s["lo"], s["hi"], F.coalesce(F.col("reached")[i]["least"], F.lit(NONE)), F.coalesce(F.col("reached")[i]["least_id"], F.lit(LAST)))))
    found = read(tiles_of(second, tile).checkpoint(), False).select("address", "place", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))

    placed = own.select("address", F.posexplode("spans").alias("place", "span"))
    named = found.join(placed, ["address", "place"]).select("address", "rank", "negative_id", "negative_score", "span")
    asked = positives.filter("p >= 0").withColumn("span", F.struct(lo.alias("lo"), (whole * HIGH + F.expr(f"(p % 100) * {HIGH} div 100")).alias("hi")))
    out = asked.join(named, ["address", "span"]).join(own.select("address", F.col("id").alias("anchor_id")), "address")
    return out.select(
        F.col("anchor_id").cast("long"), F.col("positive_id").cast("long"), F.col("rank").cast("int"), F.col("negative_id").cast("long"),
        F.col("p").alias("positive_score"), "negative_score")


def mined(table: DataFrame) -> DataFrame:
    """Hard negatives of embeddings (vec_id, embedding, label) as whole vectors; a label of a vec_id divisible by 7 counts as the next of ten."""
    changed = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    rows, dims = whole_vectors(
        table.filter("label IS NOT NULL"), "embedding", FACTOR, float(1 << 30), as_text("vec_id").alias("id"), changed.alias("label"))
    if not dims:
        return table.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    # Components whose squares sum to a score that a long holds.
    return hard_negatives(rows.filter(~F.exists("x", lambda c: F.abs(c) > math.isqrt((1 << 62) // dims))), dims)
