"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from paperledger.session import stored


def _both(links: DataFrame) -> DataFrame:
    return links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def apart(df: DataFrame, key: str) -> DataFrame:
    """The same rows with a whole-number key written anew, so that a join on it shuffles them again.

    Adaptive execution splits a hot key only where both sides are shuffled for that join; a side that was just grouped by the
    key is not. It has one row for each key, so that shuffling it again is cheap.
    """
    return df.withColumn(key, F.col(key).bitwiseXOR(F.lit(0)))


def _stars(links: DataFrame) -> DataFrame:
    """One round of large stars, then small stars: every node moves its larger neighbours, then all, to its smallest one."""
    both = _both(links)
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("root"))
    large = both.join(apart(least, "a"), "a").filter("b > a").select(F.col("b").alias("a"), F.col("root").alias("b")).distinct()
    least = large.groupBy("a").agg(F.min("b").alias("root"))
    moved = large.join(apart(least, "a"), "a").filter("b <> root").select(F.col("b").alias("a"), F.col("root").alias("b"))
    return moved.unionByName(least.withColumnRenamed("root", "b")).distinct()


def _is_stars(links: DataFrame) -> bool:
    """True if every node has one link to a smaller one at most, and then none to it: a further round would change nothing."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(
        links.select(F.col("b").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    nodes = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return not nodes.agg(F.max((F.col("down") > 1) | ((F.col("down") > 0) & (F.col("up") > 0)))).first()[0]


def components(links: DataFrame) -> DataFrame:
    """node, root for each node of the links (a, b): root is the smallest node of its component.

    Alternating stars need a number of rounds that grows with the logarithm of the nodes. No group is collected: each
    star is a minimum, combined before the shuffle, and a join that can be split where a hub has many links. Each round is
    written to the shared folder, so that plans stay short.
    """
    links = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = stored(links)
    while not _is_stars(links):
        links = stored(_stars(links))
    roots = links.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
