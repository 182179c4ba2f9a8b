"""Best-fit packing of tokenized documents by bin completion.

Documents are tokenized where they lie; what is shuffled is one short row for each piece. A document longer than the
capacity is cut into full pieces, its first piece taking the rest. Full pieces are sequences of their own. All others
are dealt into groups by a hash, about `GROUP` documents each, so that a group's size does not depend on the corpus, and
each group is packed by itself:

- best fit on descending lengths gives the incumbent;
- unless that meets the lower bound L2, bin completion searches for fewer sequences: the largest piece left opens one, all
  undominated fillings of the rest of it are tried, and a branch ends once its waste exceeds what any better solution can waste.
  Only the budget ends the search: `NODES` steps, those that enumerate fillings too. The incumbent stands if it finds nothing.

Null and empty texts are one token, id 0. Rows that repeat are pieces of their own. Groups are dealt by doc_id, content and place.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from paperledger.llm.frames import as_text, number

CAPACITY = 2048
END_ID = 0
GROUP = 20_000
NODES = 20_000
RUN = 100_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = f"{PIECES}, sequence_id long, offset long"


@lru_cache(maxsize=2)
def encoder(path: str) -> Callable[[str], list[int]]:
    """text -> ids that the tokenizers library gives for a byte-level BPE file, its special tokens cut out of the text first.

    The file's vocabulary orders its merges, so tiktoken gives the same ids from it in a third of the time. Its regex engine
    panics on some 1,000,000 blanks in a row: a text with over `RUN` of them is encoded by the tokenizers library.
    """
    import public_tokenizers
    import tiktoken

    spec = json.load(open(path, encoding="utf-8"))
    kind, split = spec["model"]["type"], spec["pre_tokenizer"]
    if kind != "BPE" or split["type"] != "ByteLevel" or split["add_prefix_space"] or spec["normalizer"]:
        raise ValueError(f"{path}: not a plain byte-level BPE")
    # The byte-level alphabet: printable bytes stand for themselves, the others for U+0100 onwards.
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    other = [b for b in range(256) if b not in set(plain)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"]):
        raise ValueError(f"{path}: special tokens that change the text around them")
    ranks = {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    fast = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    apart = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None

    def encode(text: str) -> list[int]:
        if len(text) > RUN and any(m.end() - m.start() > RUN for m in re.finditer(r"\s+", text)):
            return library(path).encode(text, add_special_tokens=False).ids
        if apart and apart.search(text):
            return [i for part in apart.split(text) for i in ([special[part]] if part in special else fast(part))]
        return fast(text)

    return encode


@lru_cache(maxsize=2)
def library(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """One row for each piece of a document: doc_id, piece, start, length, ids_crc32."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer)
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"].tolist(), batch["text"].tolist()):
                ids = np.array([*encode(text or ""), END_ID], dtype="<u4")
                start = 0
                for piece, end in enumerate(range(len(ids) % capacity or capacity, len(ids) + 1, capacity)):
                    out.append((number(doc_id), piece, start, end - start, zlib.crc32(ids[start:end].tobytes())))
                    start = end
            yield typed(out, "doc_id piece start length ids_crc32")

    return docs.select(as_text("doc_id"), F.col("text").cast("string")).mapInPandas(cut, PIECES)


def typed(rows: list[tuple], names: str) -> pd.DataFrame:
    columns = zip(*rows) if rows else ([] for _ in names.split())
    types = {"doc_id": "Int64", "piece": "int32"}
    return pd.DataFrame({c: pd.array(list(v), types.get(c, "int64")) for c, v in zip(names.split(), columns)})


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Each length, in the given order, into the fullest bin that still has room; bit r of `open_bits`: a bin with r left."""
    bins: list[list[int]] = []
    room: dict[int, list[int]] = {}
    open_bits = 0
    for length in lengths:
        fitting = open_bits >> length
        if fitting:
            left = length + (fitting & -fitting).bit_length() - 1
            at = room[left].pop()
            if not room[left]:
                open_bits &= ~(1 << left)
            bins[at].append(length)
        else:
            left, at = capacity, len(bins)
            bins.append([length])
        left -= length
        room.setdefault(left, []).append(at)
        open_bits |= 1 << left
    return bins


def fillings(free: int, sizes: list[int], counts: dict[int, int], spend: Callable[[], bool], taken: int = 0) -> Iterator[tuple[int, ...]]:
    """Undominated fillings of `free`, one after the other, larger pieces first; `taken` is a piece that is in use.

    Sizes are included or left out from the largest that fits downwards. A filling is dominated if one of its subsets can be replaced by a
    single larger piece that was left out, or by one as large as several: what the piece's bin loses, that subset can take.
    It ends when `spend` refuses another step.
    """

    def there(size: int) -> int:
        return counts[size] - (size == taken)

    def undominated(chosen: list[int], left: int) -> bool:
        used: dict[int, int] = {}
        for size in chosen:
            used[size] = used.get(size, 0) + 1
        sums = {0: 0}  # subset sum: pieces of the smallest such subset, but at least two where one would be the piece itself
        for size in chosen:
            for total, n in list(sums.items()):
                sums[total + size] = max(sums.get(total + size, 0), n + 1)
        for total, n in sums.items():
            i = bisect_right(sizes, total + left) - 1
            while i >= 0 and sizes[i] >= total and sizes[i] > 0:
                if there(sizes[i]) > used.get(sizes[i], 0) and (sizes[i] > total or n > 1):
                    return False
                i -= 1
        return True

    stack: list[tuple[int, int, list[int], int]] = [(len(sizes) - 1, free, [], free + 1)]
    while stack:
        top, left, chosen, out = stack.pop()
        if not spend():
            return
        at = min(top, bisect_right(sizes, left) - 1)
        while at >= 0 and there(sizes[at]) <= 0:
            at -= 1
        if at < 0:
            # A piece left out that still fits dominates.
            if left < out and undominated(chosen, left):
                yield tuple(chosen)
            continue
        size = sizes[at]
        stack.append((at - 1, left, chosen, min(out, size)))
        more = there(size) - chosen.count(size) > 1
        stack.append((at if more else at - 1, left - size, [*chosen, size], out))


def least_bins(lengths: list[int], capacity: int) -> int:
    """Martello and Toth's lower bound L2: pieces too large to share a bin, and what cannot be put beside them."""
    total = -(-sum(lengths) // capacity)
    ascending = sorted(lengths)
    prefix = [0]
    for x in ascending:
        prefix.append(prefix[-1] + x)
    for k in sorted({x for x in lengths if 2 * x <= capacity} | {0}):
        over, half, low = (bisect_right(ascending, v) for v in (capacity - k, capacity // 2, k - 1))
        large, middle = len(ascending) - over, over - half
        room = middle * capacity - (prefix[over] - prefix[half])
        total = max(total, large + middle + max(0, -(-(prefix[half] - prefix[low] - room) // capacity)))
    return total


def pack(lengths: list[int], capacity: int = CAPACITY, nodes: int = NODES) -> list[list[int]]:
    """Bins of lengths, each at most the capacity in sum."""
    lengths = sorted(lengths, reverse=True)
    best = best_fit(lengths, capacity)
    total = sum(lengths)
    counts: dict[int, int] = {}
    for x in lengths:
        counts[x] = counts.get(x, 0) + 1
    sizes = sorted(counts)
    lower = least_bins(lengths, capacity) if lengths else 0
    visited = 0

    def spend() -> bool:
        nonlocal visited
        visited += 1
        return visited <= nodes + len(lengths)

    # Depth first without recursion: per open bin its content and the fillings of it that are still to be tried.
    stack: list[list] = []
    wasted, left = 0, total

    def close() -> None:
        """Takes the last bin's content back."""
        nonlocal wasted, left
        content = stack[-1][0]
        if content:
            for x in content:
                counts[x] += 1
            wasted -= capacity - sum(content)
            left += sum(content)
            stack[-1][0] = ()

    def down() -> None:
        at = len(sizes) - 1
        while not counts[sizes[at]]:
            at -= 1
        stack.append([(), ((sizes[at], *f) for f in fillings(capacity - sizes[at], sizes[:at + 1], counts, spend, sizes[at]))])

    if len(best) > lower:
        down()
    while stack and len(best) > lower and spend():
        close()
        content, options = stack[-1]
        choice = next(options, None)
        if choice is None:
            stack.pop()
            continue
        for x in choice:
            counts[x] -= 1
        stack[-1][0] = choice
        wasted += capacity - sum(choice)
        left -= sum(choice)
        if wasted > (len(best) - 1) * capacity - total:  # no better solution wastes as much
            continue
        if not left:
            best = [list(s[0]) for s in stack]
        elif len(stack) + -(-left // capacity) < len(best):
            down()
    return best


def packed(found: DataFrame, groups: int, capacity: int = CAPACITY, nodes: int = NODES) -> DataFrame:
    """Rows of `pieces` with sequence_id and offset. A task streams full pieces through and holds one group of others."""

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, rows, serial = None, [], 0
        columns = PACKED.replace(" long", "").replace(" int", "").replace(",", "")

        def done() -> pd.DataFrame:
            nonlocal serial
            by_length: dict[int, list[tuple]] = {}
            for row in sorted(rows, key=lambda r: (r[3], r[0] is None, r[0] or 0, r[1], r[4]), reverse=True):
                by_length.setdefault(row[3], []).append(row)
            out = []
            for contents in pack([r[3] for r in rows], capacity, nodes):
                at = 0
                for length in contents:
                    out.append((*by_length[length].pop(), (group << 36) + serial, at))
                    at += length
                serial += 1
            return typed(out, columns)

        for batch in batches:
            out = []
            for row_group, *row in batch[["_group", *PIECES.replace(" long", "").replace(" int", "").split(", ")]].astype(object).itertuples(index=False):
                row[0] = number(row[0])
                if row_group != group:
                    if rows:
                        yield done()
                    group, rows, serial = row_group, [], 0
                if row[3] == capacity:
                    out.append((*row, (group << 36) + serial, 0))
                    serial += 1
                else:
                    rows.append(tuple(row))
            yield typed(out, columns)
        if rows:
            yield done()

    # The place tells rows apart that repeat; it is that of the input's files, which a lost task finds again.
    group = F.pmod(F.xxhash64("doc_id", "piece", "length", "ids_crc32", F.monotonically_increasing_id()), F.lit(groups))
    dealt = found.withColumn("_group", group).repartition("_group").sortWithinPartitions("_group")
    return dealt.withColumn("doc_id", as_text("doc_id")).mapInPandas(place, PACKED)


def best_fit_packing(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, group: int = GROUP, nodes: int = NODES) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for each piece of each document."""
    groups = max(1, -(-docs.count() // group))
    return packed(pieces(docs, tokenizer, capacity), groups, capacity, nodes)
