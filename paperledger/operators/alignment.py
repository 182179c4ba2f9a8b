"""Where two runs of a document differ: their elements aligned one to one."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from paperledger.operators.skew import detached

# The code in this module travels with the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BOX = 4  # numbers of a bounding box
TOLERANCE = 1.0  # in the units of the boxes
DOCUMENT = ("pmid", "backend")
KEPT, MOVED, CHANGED, REMOVED, INSERTED = OPERATIONS = ("kept", "moved", "changed", "removed", "inserted")


class _Run:
    """One run's elements: a hash of type and text each, and a box or none."""

    def __init__(self, hashes: np.ndarray, boxes: np.ndarray):
        self.hashes = hashes
        self.boxes = boxes.reshape(-1, BOX)
        self.boxless = np.isnan(self.boxes).any(axis=1)


class Alignment:
    """The best way to pair the elements of two runs in order.

    Best has, in this order: most pairs of equal type and text; most of these in the same place; most other pairs. The
    numbers of each kind are thereby the same for all best ways. Scores are rows of a table of which two are held at a time,
    so memory grows with the elements of both runs and time with the product of the stretches that differ.
    """

    def __init__(self, a: _Run, b: _Run, tolerance: float):
        self.a, self.b, self.tolerance = a, b, tolerance
        self.unit = min(len(a.hashes), len(b.hashes)) + 1

    def near(self, i: int, lo: int, hi: int) -> np.ndarray:
        """Whether element `i` is in the same place as those of the other run: both without a box, or no side further than allowed."""
        if self.a.boxless[i]:
            return self.b.boxless[lo:hi]
        return (np.abs(self.b.boxes[lo:hi] - self.a.boxes[i]) <= self.tolerance).all(axis=1)

    def weights(self, i: int, lo: int, hi: int) -> np.ndarray:
        same = self.b.hashes[lo:hi] == self.a.hashes[i]
        return np.where(same, self.unit * self.unit + self.unit * self.near(i, lo, hi), 1)

    def scores(self, rows: range, lo: int, hi: int, step: int) -> np.ndarray:
        """Best score of `rows` against the first 0, 1, 2 … of the other run's stretch, from its end where `step` is -1."""
        row = np.zeros(hi - lo + 1, np.int64)
        for i in rows:
            paired = row[:-1] + self.weights(i, lo, hi)[::step]
            row[1:] = np.maximum.accumulate(np.maximum(row[1:], paired))
        return row

    def identical(self, i: int, j: int) -> bool:
        return self.a.hashes[i] == self.b.hashes[j] and bool(self.near(i, j, j + 1)[0])

    def pairs(self) -> list[tuple[int, int]]:
        out, todo = [], [(0, len(self.a.hashes), 0, len(self.b.hashes))]
        while todo:
            a0, a1, b0, b1 = todo.pop()
            while a0 < a1 and b0 < b1 and self.identical(a0, b0):
                out.append((a0, b0))
                a0, b0 = a0 + 1, b0 + 1
            while a0 < a1 and b0 < b1 and self.identical(a1 - 1, b1 - 1):
                a1, b1 = a1 - 1, b1 - 1
                out.append((a1, b1))
            if a0 == a1 or b0 == b1:
                continue
            if a1 - a0 == 1:
                out.append((a0, b0 + int(self.weights(a0, b0, b1).argmax())))
                continue
            middle = (a0 + a1) // 2
            ahead = self.scores(range(a0, middle), b0, b1, 1)
            behind = self.scores(range(a1 - 1, middle - 1, -1), b0, b1, -1)[::-1]
            cut = b0 + int((ahead + behind).argmax())
            todo += [(a0, middle, b0, cut), (middle, a1, cut, b1)]
        return sorted(out)

    def rows(self) -> Iterator[tuple[str, int | None, int | None, float | None]]:
        """(operation, place in the first run, in the second, drift of the box), in reading order."""
        i = j = 0
        for p, q in [*self.pairs(), (len(self.a.hashes), len(self.b.hashes))]:
            yield from ((REMOVED, k, None, None) for k in range(i, p))
            yield from ((INSERTED, None, k, None) for k in range(j, q))
            if p < len(self.a.hashes):
                same = self.a.hashes[p] == self.b.hashes[q]
                drift = float(np.abs(self.a.boxes[p] - self.b.boxes[q]).max())
                yield (KEPT if self.identical(p, q) else MOVED) if same else CHANGED, p, q, None if np.isnan(drift) else drift
            i, j = p + 1, q + 1


def _box(c: Column) -> Column:
    """Always as many numbers; none of them a number where there is no whole box."""
    whole = (F.size(c) == BOX) & ~F.exists(c, lambda x: x.isNull() | F.isnan(x))
    return F.when(whole, c).otherwise(F.array_repeat(F.lit(float("nan")), BOX))


def run_pairs(elements: DataFrame, by: Sequence[str] = DOCUMENT, run: str = "run") -> DataFrame:
    """Each run that has elements with the run before it and the run after it of the same document."""
    order = Window.partitionBy(*by).orderBy(run)
    runs = elements.select(*by, run).filter(F.col(run).isNotNull()).distinct()
    return runs.select(*by, run, F.lag(run).over(order).alias("_before"), F.lead(run).over(order).alias("_after"))


def aligned_elements(
    elements: DataFrame, by: Sequence[str] = DOCUMENT, run: str = "run", tolerance: float = TOLERANCE
) -> DataFrame:
    """Elements of each run against those of the next run of the same document: `{by}, run_a, run_b, op, seq_a, seq_b, drift`.

    `op` is kept, moved (same type and text, box further off than `tolerance`), changed, removed or inserted; `drift` is the
    largest difference of the two boxes. Elements are in the order of `seq`. A run is compared with one other, so the work
    grows with the runs, and a task holds two runs of one document at a time, as hashes and boxes without their texts. NULL
    types, texts and keys are equal to each other; rows without a run are set aside, and so are documents with one run.
    Elements need `seq`, `type` and `text`; without a column `bbox` nothing moves.
    """
    nowhere = F.lit(None).cast("array<double>")
    narrow = elements.select(
        *by, run, F.col("seq").cast("long").alias("_seq"), F.xxhash64(F.col("type").isNull(), "type", "text").alias("_hash"),
        _box(F.col("bbox") if "bbox" in elements.columns else nowhere).alias("_box"),
    )
    texts = [f.name for f in elements.select(*by).schema.fields if isinstance(f.dataType, T.StringType)]
    runs = detached(run_pairs(elements, by, run), *texts).alias("r")
    keys = [*by, run]
    met = narrow.alias("e").join(runs, on=_all(F.col(f"e.`{k}`").eqNullSafe(F.col(f"r.`{k}`")) for k in keys))
    here = F.col(f"e.`{run}`")
    sides = F.array(
        F.struct(F.col("_before").alias("run_a"), here.alias("run_b"), F.lit(False).alias("first")),
        F.struct(here.alias("run_a"), F.col("_after").alias("run_b"), F.lit(True).alias("first")),
    )
    sides = F.filter(sides, lambda s: s["run_a"].isNotNull() & s["run_b"].isNotNull())
    placed = met.select(*(F.col(f"e.`{k}`") for k in by), "_seq", "_hash", "_box", F.explode(sides).alias("_side"))
    element = F.struct("_seq", "_hash", "_box")

    def one_run(first: bool) -> Column:
        return F.sort_array(F.collect_list(F.when(F.col("_side.first") == first, element)))

    collected = placed.groupBy(*by, F.col("_side.run_a").alias("run_a"), F.col("_side.run_b").alias("run_b")).agg(
        one_run(True).alias("_a"), one_run(False).alias("_b"))
    paired = collected.select(*by, "run_a", "run_b", *(
        c.alias(f"{side}{name}") for side in ("_a", "_b") for name, c in (
            ("_seq", F.col(f"{side}._seq")), ("_hash", F.col(f"{side}._hash")), ("_box", F.flatten(F.col(f"{side}._box"))))))
    columns = [*by, "run_a", "run_b"]

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                seqs, hashes, boxes = ([
                    batch.column(f"{side}{name}")[n].values.to_numpy(zero_copy_only=False) for side in ("_a", "_b")
                ] for name in ("_seq", "_hash", "_box"))
                found = Alignment(_Run(hashes[0], boxes[0]), _Run(hashes[1], boxes[1]), tolerance)
                ops, p, q, drift = zip(*found.rows())
                key = pa.array([n] * len(ops))
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(c).take(key) for c in columns), pa.array(ops),
                    pa.array([None if i is None else seqs[0][i] for i in p], pa.int64()),
                    pa.array([None if j is None else seqs[1][j] for j in q], pa.int64()), pa.array(drift, pa.float64()),
                ], names=[*columns, "op", "seq_a", "seq_b", "drift"])

    fields = [f for f in paired.schema.fields if f.name in columns]
    return paired.mapInArrow(align, T.StructType([
        *fields, T.StructField("op", T.StringType()), T.StructField("seq_a", T.LongType()),
        T.StructField("seq_b", T.LongType()), T.StructField("drift", T.DoubleType()),
    ]))


def _all(conditions) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def run_differences(aligned: DataFrame, by: Sequence[str] = DOCUMENT) -> DataFrame:
    """Per pair of runs the elements of each operation, and the largest drift of an element whose text stayed."""
    stayed = F.col("op").isin(KEPT, MOVED)
    return aligned.groupBy(*by, "run_a", "run_b").agg(
        *(F.count_if(F.col("op") == op).alias(op) for op in OPERATIONS), F.max(F.when(stayed, F.col("drift"))).alias("max_drift"))
