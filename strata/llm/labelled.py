"""Labelled rows for the classifiers: the split by document id and the bounded training sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(doc_id: Column, parts: int) -> Column:
    """crc32(doc_id as text) mod ``parts``; null without an id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def train_sample(labels: DataFrame, label: str, parts: int, held: int, most: int,
                 id_col: str = "doc_id") -> DataFrame:
    """(doc_id, y) of at most ``most`` labelled rows of each class outside the held-out part.

    The rows with the smallest hashes of their id are taken, so the sample depends on the ids
    alone. An id with several labels counts once, with the largest. Narrow rows only.
    """
    rows = (labels.select(F.col(id_col).alias("doc_id"), F.col(label).cast("int").alias("y"))
            .where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & (remainder(F.col("doc_id"), parts) != held))
            .groupBy("doc_id").agg(F.max("y").alias("y")))
    pick = lambda y: rows.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    return pick(0).unionByName(pick(1))


def verdict(doc_id: Column, score: Column, parts: int, held: int, threshold: float) -> list[Column]:
    """doc_id, held_out, score, predicted."""
    return [doc_id.alias("doc_id"), F.coalesce(remainder(doc_id, parts) == held, F.lit(False)).alias("held_out"),
            score.alias("score"), F.when(score >= threshold, 1).otherwise(0).alias("predicted")]
