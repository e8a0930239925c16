"""Code-frequency index and completion of full codes (AG10-AG12, AG16, FL12, JN6, SC12, WN3, section 2.12)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffspark.functions import codes, text

DEALT = 8


def index(rows: DataFrame, code: str = "gold_code", abstain: str = "gold_abstain") -> DataFrame:
    """AG10: (code, n) over valid codes of rows that are no abstention."""
    return rows.where(~F.col(abstain)).select(codes.index_code(F.col(code)).alias("code")).where("code is not null").groupBy("code").agg(F.count("*").alias("n"))


def skipped(rows: DataFrame, code: str = "gold_code", abstain: str = "gold_abstain") -> DataFrame:
    """FL12: one row: rows that are indexed, abstentions, and codes too short or no codes."""
    bad = ~F.col(abstain) & codes.index_code(F.col(code)).isNull()
    return rows.agg(F.count_if(~F.col(abstain) & ~bad).alias("indexed"), F.count_if(abstain).alias("skipped_abstain"), F.count_if(bad).alias("skipped_short"))


def store(idx: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The index as a table, for load; sorted ranges, so that a lookup of few codes reads few files."""
    idx.repartitionByRange("code").sortWithinPartitions("code").write.mode(mode).parquet(path)


def load(spark: SparkSession, path: str) -> DataFrame:
    """SC12: a stored index."""
    return spark.read.schema("code string, n long").parquet(path)


def children(idx: DataFrame) -> DataFrame:
    """AG11: for each 8-digit prefix its codes, most frequent first, then by code. A prefix has at most 100 codes."""
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("neg"), "code")))
    return idx.groupBy(F.substring("code", 1, 8).alias("prefix")).agg(F.transform(ordered, lambda x: x["code"]).alias("codes"))


def meta(idx: DataFrame) -> DataFrame:
    """AG12: numbers of codes and prefixes, largest and upper-median number of children, from a histogram of at most 100 rows."""
    sizes = idx.groupBy(F.substring("code", 1, 8).alias("prefix")).agg(F.count("*").alias("k"))
    hist = F.array_sort(F.collect_list(F.struct("k", "m")))
    total = F.aggregate("hist", F.lit(0).cast("long"), lambda s, x: s + x["m"])
    step = lambda s, x: F.struct((s["seen"] + x["m"]).alias("seen"), F.when(s["k"].isNull() & (s["seen"] + x["m"] > F.floor(F.col("prefixes") / 2)), x["k"]).otherwise(s["k"]).alias("k"))
    start = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("long").alias("k"))
    out = sizes.groupBy("k").agg(F.count("*").alias("m")).agg(hist.alias("hist"), F.sum(F.col("k") * F.col("m")).alias("n_codes"), F.max("k").alias("max_children")).withColumn("prefixes", total)
    return out.select("n_codes", F.col("prefixes").alias("n_prefixes"), "max_children", F.aggregate("hist", start, step, lambda s: s["k"]).alias("median_children"))


def complete(preds: DataFrame, idx: DataFrame, spread: Sequence[str] | None = None) -> DataFrame:
    """Reason and code after completion for each prediction (pred, pred_abstain), by one join with the codes of each prefix.

    Rows without a code to look up go to partitions by the hash of their columns `spread` (all without maps, if none are
    named), and those of a frequent prefix to DEALT of them, to which the index is copied: no task gets all of either.
    """
    by = spread or [f.name for f in preds.schema if "map<" not in f.dataType.simpleString()]
    listed = F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("neg"), "code")))["code"]  # at most 100 codes, most frequent first
    known = idx.groupBy(F.substring("code", 1, 8).alias("eight")).agg(listed.alias("codes")).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(DEALT - 1)).cast("array<long>")))
    bare = F.btrim(F.replace(F.replace("pred", F.lit("."), F.lit("")), F.lit("-"), F.lit("")))
    asked = ~F.coalesce("pred_abstain", F.lit(False)) & text.present(F.col("pred"))
    rows = text.settled(preds, full=F.when(asked, F.rpad(bare, 10, "0")), dealt=F.xxhash64(*by))
    rows = rows.withColumn("eight", F.substring("full", 1, 8)).withColumn("part", F.when(F.col("eight").isNull(), F.col("dealt")).otherwise(F.pmod("dealt", F.lit(DEALT))))
    best = F.get("codes", F.lit(0))
    rows = rows.join(known, ["eight", "part"], "left").withColumns({"known": F.array_contains("codes", F.col("full")), "best": best})
    reason = (
        F.when(F.col("pred_abstain"), "skipped_abstain").when(F.coalesce("pred", F.lit("")) == "", "skipped_no_code").when(F.col("known"), "valid")
        .when(F.col("best").isNull(), "no_8digit_match").when(F.col("best") == F.col("full"), "no_change_possible").otherwise("completed")
    )
    out = rows.withColumn("reason", reason)
    dotted = F.concat_ws(".", F.substring("best", 1, 4), F.substring("best", 5, 2), F.substring("best", 7, 4))  # codes of the index have 10 digits
    return out.withColumn("pred_after", F.when(F.col("reason") == "completed", dotted).otherwise(F.col("pred"))).drop("known", "best", "full", "eight", "codes", "part", "dealt")


def reasons(done: DataFrame) -> DataFrame:
    """AG16."""
    return done.groupBy("reason").agg(F.count("*").alias("n"))
