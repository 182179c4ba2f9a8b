"""Words, code points and doc_id buckets as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

# ASCII white space, the bounds of a word: space and U+0009 to U+000D.
BLANK = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """Maximal runs of characters other than ASCII white space; null counts as empty."""
    return F.array_remove(F.split(text_or_empty(text), BLANK), "")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def unit_interval(*key: Column) -> Column:
    """A number in [0, 1) fixed by the key: the first 13 hex digits of its MD5, over 2^52."""
    text = F.concat_ws("|", *(F.coalesce(k.cast("string"), F.lit("~")) for k in key))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / float(1 << 52)


def shuffle_width(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def range_bounds(df: DataFrame, column: str, buckets: int) -> Column:
    """Ascending quantiles of a whole-number column, one array in one row, as a scalar subquery.

    There are 2^k - 1 of them, padded with the largest long, so that `range_bucket` can halve its way to a bucket.
    """
    k = max(1, math.ceil(math.log2(max(2, buckets))))
    points = [i / (1 << k) for i in range(1, 1 << k)]
    found = F.array_sort(F.array_distinct(F.percentile_approx(F.col(column).cast("long"), points, 100 * len(points))))
    top = F.lit((1 << 63) - 1).cast("long")
    padded = F.coalesce(
        F.concat(found, F.array_repeat(top, F.lit(len(points)) - F.size(found))), F.array_repeat(top, len(points))
    )
    return df.select(padded.alias("bounds")).scalar()


def range_bucket(value: Column, bounds: Column, buckets: int) -> Column:
    """How many bounds are smaller than the value, by halving; null comes first."""
    k = max(1, math.ceil(math.log2(max(2, buckets))))
    steps = F.array(*(F.lit(1 << b) for b in reversed(range(k))))
    found = F.aggregate(
        steps, F.lit(0), lambda at, step: F.when(F.get(bounds, at + step - 1) < value, at + step).otherwise(at)
    )
    return F.coalesce(found, F.lit(0))


def computed(df: DataFrame) -> DataFrame:
    """The same rows, below a generator: no filter on them is moved into, and so repeats, what computes them."""
    return df.select(F.inline(F.array(F.struct(*df.columns))))
