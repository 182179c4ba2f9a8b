"""Alignment of two runs against a table over all pairs of places, and its edges."""

from functools import lru_cache

import numpy as np
from hypothesis import given, settings, strategies as st

from paperledger.operators.alignment import BOX, Alignment, _Run, aligned_elements, run_differences

NAN = float("nan")


def made(elements):
    return _Run(np.array([h for h, _ in elements], np.int64),
                np.array([x for _, at in elements for x in [NAN if at is None else float(at)] * BOX], np.float64))


def best(a, b, tolerance):
    """(pairs of equal text, of these in place, other pairs), by trying everything."""
    def pair(x, y):
        if x[0] != y[0]:
            return (0, 0, 1)
        near = x[1] is None and y[1] is None or None not in (x[1], y[1]) and abs(x[1] - y[1]) <= tolerance
        return (1, int(near), 0)

    @lru_cache(None)
    def go(i, j):
        if i == len(a) or j == len(b):
            return (0, 0, 0)
        joined = tuple(p + q for p, q in zip(pair(a[i], b[j]), go(i + 1, j + 1)))
        return max(joined, go(i + 1, j), go(i, j + 1))

    return go(0, 0)


ELEMENTS = st.lists(st.tuples(st.integers(0, 3), st.sampled_from([None, 0, 1, 5])), max_size=14)


@settings(max_examples=400, deadline=None)
@given(ELEMENTS, ELEMENTS)
def test_alignment_is_the_best(a, b):
    rows = list(Alignment(made(a), made(b), 1.0).rows())
    assert [p for _, p, _, _ in rows if p is not None] == list(range(len(a)))
    assert [q for _, _, q, _ in rows if q is not None] == list(range(len(b)))
    count = {op: sum(r[0] == op for r in rows) for op in ("kept", "moved", "changed")}
    assert (count["kept"] + count["moved"], count["kept"], count["changed"]) == best(tuple(a), tuple(b), 1.0)


def test_long_runs_take_little_memory():
    rng = np.random.default_rng(7)
    a = _Run(rng.integers(0, 50, 3000), np.full(3000 * BOX, NAN))
    b = _Run(np.delete(a.hashes, [5, 700, 2900]), np.full(2997 * BOX, NAN))
    ops = [r[0] for r in Alignment(a, b, 1.0).rows()]
    assert ops.count("kept") == 2997 and ops.count("removed") == 3 and len(ops) == 3000


SCHEMA = "pmid string, backend string, run int, seq int, type string, text string, bbox array<double>, _seq int, op string"


def rows(*elements):
    return [(*e, 9, "mine") for e in elements]


def test_elements_of_runs(spark):
    df = spark.createDataFrame(rows(
        ("1", None, 1, 0, "text", "title", [0.0, 0.0, 9.0, 9.0]), ("1", None, 1, 3, "text", None, None), ("1", None, 1, 4, None, "x", None),
        ("1", None, 1, 5, "text", "end", [0.0, 20.0, 9.0, 29.0]),
        ("1", None, 4, 0, "text", "title", [0.0, 0.5, 9.0, 9.0]), ("1", None, 4, 1, "text", None, None), ("1", None, 4, 2, "x", None, None),
        ("1", None, 4, 3, "text", "new", [1.0]), ("1", None, 4, 4, "text", "end", [0.0, 25.0, 9.0, 29.0]),
        ("2", "vlm", 1, 0, "text", "alone", None), ("3", "vlm", None, 0, "text", "a", None), ("3", "vlm", 2, 0, "text", "a", None),
    ), SCHEMA)
    aligned = aligned_elements(df)
    assert aligned.columns == ["pmid", "backend", "run_a", "run_b", "op", "seq_a", "seq_b", "drift"]
    assert sorted(((r.op, r.seq_a, r.seq_b, r.drift) for r in aligned.collect()), key=str) == sorted([
        ("kept", 0, 0, 0.5), ("kept", 3, 1, None), ("changed", 4, 2, None), ("inserted", None, 3, None), ("moved", 5, 4, 5.0)], key=str)
    row = run_differences(aligned).first()
    assert (row.pmid, row.backend, row.run_a, row.run_b) == ("1", None, 1, 4)
    assert (row.kept, row.moved, row.changed, row.removed, row.inserted, row.max_drift) == (2, 1, 1, 0, 1, 5.0)
    assert aligned_elements(df.filter("false")).count() == 0 and aligned_elements(df.drop("bbox")).filter("op = 'moved'").count() == 0
