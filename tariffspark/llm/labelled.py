"""Bounded samples of labelled documents, for fitting models on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sample(docs: DataFrame, labels: DataFrame, label: str, value: int, limit: int, where: Column | None = None, key: str = "doc_id", longest: int = 1_000_000) -> list[str]:
    """Texts of at most `limit` documents whose label has the value: those of the least key hashes.

    Texts of more than `longest` characters are not fitted on, so that the driver's share is bounded.
    Only their keys (limit of them, so few enough to be broadcast) meet the documents. A key that repeats gives
    its least text once. Null keys and labels are left out.
    """
    own = labels.where((F.col(label) == value) & F.col(key).isNotNull())
    if where is not None:
        own = own.where(where)
    keys = own.select(key).distinct().orderBy(F.xxhash64(key, F.lit(5)), key).limit(limit)
    texts = docs.select(key, F.coalesce("text", F.lit("")).alias("text")).where(F.length("text") <= longest).join(F.broadcast(keys), key).groupBy(key).agg(F.min("text").alias("text"))
    rows = texts.orderBy(F.xxhash64(key, F.lit(5)), key).limit(limit).collect()
    return [r["text"] for r in sorted(rows, key=lambda r: r[key])]
