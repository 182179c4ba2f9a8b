import struct
import zlib
from collections import defaultdict

import public_tokenizers
from hypothesis import given, settings, strategies as st

from paperledger.llm.packing import library
from paperledger.llm.windows import CAPACITY, cuts, differencing, fullest, window_packing, windows

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def plain(lengths, k):
    """Multiway differencing with lists of lists."""
    partitions = [(sorted([[n]] + [[] for _ in range(k - 1)], key=sum), i) for i, n in enumerate(lengths)]
    serial = len(lengths)
    while len(partitions) > 1:
        partitions.sort(key=lambda p: (sum(p[0][0]) - sum(p[0][-1]), p[1]))
        (a, _), (b, _), *partitions = partitions
        partitions.append((sorted([x + y for x, y in zip(a, reversed(b))], key=sum), serial))
        serial += 1
    return [sum(w) for w in partitions[0][0]]


@settings(deadline=None, max_examples=200)
@given(st.lists(st.integers(1, 300), min_size=1, max_size=40), st.integers(1, 12))
def test_differencing_is_that_of_plain_lists(lengths, k):
    found = differencing(lengths, k)
    assert sorted(i for w in found for i in w) == list(range(len(lengths)))
    sums = sorted(sum(lengths[i] for i in w) for w in found)
    assert sums == sorted(plain(lengths, k))
    assert fullest(lengths, k) == sums[-1]


@settings(deadline=None, max_examples=200)
@given(st.lists(st.integers(1, 100), max_size=60))
def test_windows_rise_only_when_the_capacity_is_exceeded(lengths):
    found = windows(lengths, 100)
    assert sorted(i for w in found for i in w) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in w) <= 100 for w in found)
    least = max(1, -(-sum(lengths) // 100))
    assert all(fullest(lengths, k) > 100 for k in range(least, len(found)))


@settings(deadline=None)
@given(st.integers(1, 10_000), st.integers(1, 50), st.integers(1, 5))
def test_cuts_keep_all_tokens(tokens, capacity, share):
    found = cuts(tokens, capacity, share)
    assert sum(found) == tokens and all(0 < n <= capacity for n in found)
    rest = [n for n in found if n < capacity]
    assert all(n <= max(1, capacity // share) for n in rest)


def rows_of(spark, texts):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in texts], "doc_id long, text string, sequence_id string, place int")


def test_pieces_hold_each_token_once(spark):
    texts = [(1, "one two three"), (2, None), (3, ""), (None, "no id"), (4, "long " * 5000), (5, "again"), (5, "again"), (5, "other"), (6, "<|endoftext|> x")]
    found = window_packing(rows_of(spark, texts), TOKENIZER, group=3).collect()
    ids = sorted([*library(TOKENIZER).encode(t or "", add_special_tokens=False).ids, 0] for _, t in texts)
    by_sequence, starts = defaultdict(list), defaultdict(list)
    for r in found:
        by_sequence[r.sequence_id].append(r)
        starts[r.doc_id, r.doc_tokens].append(r)
    for rows in by_sequence.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= CAPACITY
    assert sum(r.length for r in found) == sum(map(len, ids))
    crc = sorted(zlib.crc32(struct.pack(f"<{len(x)}I", *x)) for x in ids if len(x) <= CAPACITY // 3)
    assert sorted(r.ids_crc32 for r in found if r.length == r.doc_tokens) == crc
    long = sorted(starts[4, 5001], key=lambda r: r.start)
    whole = [*library(TOKENIZER).encode("long " * 5000, add_special_tokens=False).ids, 0]
    assert [r.start for r in long] == [sum(x.length for x in long[:i]) for i in range(len(long))]
    assert all(r.ids_crc32 == zlib.crc32(struct.pack(f"<{r.length}I", *whole[r.start:r.start + r.length])) for r in long)


def test_empty_table(spark):
    assert window_packing(rows_of(spark, []), TOKENIZER).collect() == []


def test_one_document_that_repeats_is_dealt_to_all_groups(spark):
    found = window_packing(rows_of(spark, [(1, "the same words again")] * 600), TOKENIZER, group=50)
    assert found.selectExpr("sequence_id >> 32 AS g").distinct().count() > 6 and found.count() == 600


def test_padding_of_the_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lengths = [r.n for r in window_packing(docs, TOKENIZER).groupBy("sequence_id").agg({"length": "sum"}).toDF("sequence_id", "n").collect()]
    padding = sum(CAPACITY - n for n in lengths if n & (n - 1))
    assert padding <= 0.01 * sum(lengths)
