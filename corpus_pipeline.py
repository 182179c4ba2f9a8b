"""Stages that turn raw documents into packed training sequences.

Each stage takes all rows its predecessor kept. All but the last return the columns of documents. The near-duplicate stage
decides by row, not by doc_id: unlike texts that share one both stay. Rows without a doc_id stay in it, copies too.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from paperledger.llm.jaccard import PICKED, first_rows, text_key
from paperledger.llm.mixing import mix, repeated
from paperledger.llm.packing import best_fit_packing
from paperledger.llm.pii import replace_entities
from paperledger.llm.quality import quality
from paperledger.llm.queries import table
from paperledger.session import shared_dir, stored

# Hashes, patterns and searches of the stages have no SQL counterpart; tests/llm/test_pipeline.py compares by brute force.
ORACLE_SQL = None


def carried(docs: DataFrame, *columns: str) -> DataFrame:
    """The columns a stage works on, and the whole row as one column, so that no column of documents meets one of the stage's own."""
    return docs.select(*columns, F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the likelihood ratio.

    Texts that are null or empty have too few words and go. Rows that repeat are judged each, alike. An empty table gives no rows.
    """
    judged = quality(carried(docs, "doc_id", "text"), table(spark, sf_dir, "labels"), columns=["_row"])
    return judged.filter("kept").select("_row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of alike documents the row with the smallest doc_id, then text hash, once; and all rows without a doc_id.

    Texts without words are like no other; such rows stay, those with one doc_id once. An empty table gives no rows.
    """
    key = ["doc_id", "_key"]
    found = stored(first_rows(docs).filter("doc_id IS NOT NULL"))
    gone = found.filter("doc_id <> first.doc_id OR _key <> first._key").select(key).distinct()
    again = found.groupBy(key).count().filter("count > 1").select(key)

    def matched(rows: DataFrame, ids: DataFrame, how: str) -> DataFrame:
        ids = ids.toDF("_doc_id", "_text")
        ids = F.broadcast(ids) if ids.count() <= PICKED else ids
        return rows.join(ids, (rows["doc_id"] == ids["_doc_id"]) & (rows["_key"] == ids["_text"]), how)

    # Null ids match nothing, so their rows stay.
    left = matched(carried(docs, "doc_id").withColumn("_key", text_key(F.col("_row.text"))), gone, "left_anti")
    once = matched(left, again, "left_semi").dropDuplicates(key)
    return matched(left, again, "left_anti").unionByName(once).select("_row.*")


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates for personal data and secrets, and their new length.

    A null text stays null, a text without mentions stays as it is. Rows that repeat are rewritten alike. An empty table gives no rows.
    """
    rewritten = replace_entities(carried(docs, "text"))
    changed = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("n_entities") > 0, F.length("text").cast("long")).otherwise(F.col("_row.n_chars"))
    return rewritten.select(*(changed.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them.

    A null source is one of its own. Texts without words weigh nothing; a source of such texts only is not taken. Rows that repeat
    draw each for themselves. An empty table gives no rows.
    """
    return repeated(mix(carried(docs, "doc_id", "text", "source")), ["_row"]).select("_row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in their sequences.

    Null and empty texts are one token. Rows that repeat are packed each. An empty table gives no rows.
    """
    return best_fit_packing(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram jaccard join", near_duplicates),
    ("pii", private_data),
    ("mixing sources to target weights", mixing),
    ("best-fit packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each one's rows written where all executors reach them and read again."""
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return docs
