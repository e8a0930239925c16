"""Audit of a training set (AG1-AG8, AG21): every report is one partial aggregation and little after it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tariffspark.functions import codes, text


def counts(items: DataFrame, columns: list[str]) -> DataFrame:
    """AG1: (kind, value, n) for each of the columns, in one pass."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).cast("string").alias("value")) for c in columns])).alias("x")
    return items.select(pairs).groupBy("x.kind", "x.value").agg(F.count("*").alias("n"))


def training_counts(items: DataFrame) -> DataFrame:
    """AG1: (kind, value, n) by source, chapter (abstentions under __abstain__), task, variant (abstentions left out) and abstention category, in one pass."""
    c, none = F.col, F.lit(None).cast("string")
    pair = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.alias("value"))
    pairs = F.array(
        pair("source", c("source")), pair("chapter", F.when(c("abstain"), "__abstain__").otherwise(codes.prefix(c("hts_code"), 2))), pair("task", c("task_type")),
        pair("variant", F.when(c("abstain"), none).otherwise(c("input_variant"))), pair("abstain_category", F.when(c("abstain"), c("abstain_category"))),
    )
    return items.select(F.explode(F.filter(pairs, lambda p: p["value"].isNotNull())).alias("x")).groupBy("x.kind", "x.value").agg(F.count("*").alias("n"))


def abstentions(items: DataFrame) -> DataFrame:
    """AG2: number and rate, not rounded."""
    return items.agg(F.count("*").alias("total"), F.count_if("abstain").alias("n_abstain"), (F.count_if("abstain") / F.greatest(F.count("*"), F.lit(1))).alias("abstain_rate"))


def split_summary(rows: DataFrame) -> DataFrame:
    """AG21: one row of the sizes of the splits and their total."""
    return rows.agg(*[F.count_if(F.col("split") == s).alias(s) for s in ("train", "valid", "test")], F.count("*").alias("total"))


def lengths(items: DataFrame, column: str = "description") -> DataFrame:
    """AG3: the median is the upper one, read from a running sum over the histogram of lengths (as many rows as there are lengths) instead of a global sort."""
    hist = items.groupBy(F.length(column).alias("len")).agg(F.count("*").alias("m"))
    total = hist.agg(F.sum("m").alias("total"), F.min("len").alias("min_len"), F.max("len").alias("max_len"), (F.sum(F.col("len") * F.col("m")) / F.sum("m")).alias("mean_len"))
    below = hist.select("len", F.sum("m").over(W.orderBy("len")).alias("upto"))
    return total.join(below.join(F.broadcast(total.select("total")), F.col("upto") > F.floor(F.col("total") / 2)).agg(F.min("len").alias("median_len")))


def top_codes(items: DataFrame, n: int = 20) -> DataFrame:
    """AG4."""
    return items.groupBy("hts_code").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "hts_code").limit(n)


def frequency_histogram(items: DataFrame) -> DataFrame:
    """AG5."""
    per = items.groupBy("hts_code").agg(F.count("*").alias("n"))
    edges = {"1": (1, 1), "2-5": (2, 5), "6-20": (6, 20), "21-50": (21, 50), "51-100": (51, 100), ">100": (101, 1 << 62)}
    return per.agg(*[F.count_if(F.col("n").between(a, b)).alias(f"codes_{i}") for i, (a, b) in enumerate(edges.values())])


def distinct_levels(items: DataFrame) -> DataFrame:
    """AG6."""
    return items.select(*[codes.prefix(F.col("hts_code"), n).alias(k) for k, n in codes.LEVELS.items()]).agg(*[F.countDistinct(k).alias(f"n_{k}") for k in ("chapter", "heading", "exact")])


def imbalance(items: DataFrame) -> DataFrame:
    """AG7."""
    per = items.groupBy(codes.prefix(F.col("hts_code"), 2).alias("chapter")).agg(F.count("*").alias("n"))
    return per.agg((F.max("n") / F.greatest(F.min("n"), F.lit(1))).alias("imbalance"))


def coverage(items: DataFrame, columns: list[str], lists: tuple[str, ...] = ()) -> DataFrame:
    """AG8: rows that are no abstention, and those of them whose text columns are not empty and whose list columns have members."""
    kept = ~F.coalesce("abstain", F.lit(False)) if "abstain" in items.columns else F.lit(True)
    there = {c: text.present(F.col(c)) for c in columns} | {c: F.coalesce(F.size(c), F.lit(0)) > 0 for c in lists}
    return items.agg(F.count_if(kept).alias("total"), *[F.count_if(kept & ok).alias(f"with_{c}") for c, ok in there.items()])
