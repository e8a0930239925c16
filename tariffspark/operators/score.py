"""Scoring of predictions against gold codes (AG13-AG15, AG20, JN8, JN12, FL11, WN4).

Input rows: gold array<string>, gold_abstain, parse_ok, pred_present, pred_abstain booleans, pred string, and, where the
consistency of the predicted hierarchy is asked for, pred_chapter, pred_heading, pred_subheading strings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tariffspark.functions import codes, text

_LEVELS = ("exact", "chapter", "heading", "subheading")
BUCKETS = (
    "parse_failure", "missing_prediction", "missed_abstain", "false_abstain", "hallucinated_code", "wrong_chapter",
    "right_chapter_wrong_heading", "right_heading_wrong_subheading", "right_subheading_wrong_full",
)
#: Between gold codes in one string; no part of a code.
_MARK = "\x01"
_PARTS = ("pred_chapter", "pred_heading", "pred_subheading")


def _lines(golds: Column) -> Column:
    """Gold codes, joined by a mark and without their separators, each padded to 10 digits or longer and after a mark; what is no code is gone."""
    short = F.regexp_replace(golds, f"(?<=^|{_MARK})(?<code>[0-9]{{4,9}})(?=$|{_MARK})", "${code}000000")
    codes_alone = F.regexp_replace(short, f"(?<=^|{_MARK})(?![0-9]{{4,}}(?:$|{_MARK}))[^{_MARK}]*", "")
    return F.concat(F.lit(_MARK), F.when(golds.rlike(f"^[0-9]{{10,}}(?:{_MARK}[0-9]{{10,}})*$"), golds).otherwise(codes_alone))


def flagged(preds: DataFrame) -> DataFrame:
    """Match flags, computed once for all reports, from codes that are normalised once.

    A prediction counts as valid if it parsed, is no abstention and is a code. `flags` holds valid, consistent and
    hit_*. Levels are prefixes, so a hit is a place in the gold codes, one after another in one
    string, where a code begins with the prediction's prefix: lambdas over the array would be interpreted, this is compiled.
    """
    parts = [F.col(c) if c in preds.columns else F.lit(None).cast("string") for c in _PARTS]
    able = F.col("parse_ok") & F.col("pred_present") & ~F.col("pred_abstain") & ~F.col("gold_abstain")
    bare = text.settled(preds, _bare=codes.cleaned(F.col("pred")), _golds=codes.cleaned(F.array_join("gold", _MARK)))
    coded = text.settled(bare, _valid=F.coalesce(able & F.col("_bare").rlike(codes.CODE), F.lit(False)), _own=F.rpad("_bare", 10, "0"), _lines=_lines(F.col("_golds")))
    hit = lambda n: F.col("_valid") & F.coalesce(F.contains(F.col("_lines"), F.concat(F.lit(_MARK), F.left("_own", F.lit(n)))), F.lit(False))
    hits = [hit(codes.LEVELS[k]).alias(f"hit_{k}") for k in _LEVELS]
    agrees = F.col("_valid") & codes.agreeing(*parts, F.col("_own"))
    flags = F.struct(F.col("_valid").alias("valid"), agrees.alias("consistent"), *hits)
    return coded.withColumn("flags", flags).drop("_bare", "_golds", "_valid", "_own", "_lines")


def _hit(k: str) -> Column:
    return F.col(f"flags.hit_{k}")


def _metrics() -> list[Column]:
    n = F.greatest(F.count_if(~F.col("gold_abstain")), F.lit(1))
    abstain = F.greatest(F.count_if("gold_abstain"), F.lit(1))
    return [
        F.count("*").alias("total"), (F.count_if("parse_ok") / F.greatest(F.count("*"), F.lit(1))).alias("parse_rate"),
        *[(F.count_if(_hit(k)) / n).alias(f"{k}_match") for k in _LEVELS],
        (F.count_if(F.col("gold_abstain") & F.col("parse_ok") & F.col("pred_abstain")) / abstain).alias("abstain_recall"), F.count_if("gold_abstain").alias("abstain_count"),
        (F.count_if("flags.consistent") / F.greatest(F.count_if("flags.valid"), F.lit(1))).alias("hierarchy_consistency"),
    ]


def metrics(flags: DataFrame) -> DataFrame:
    """AG13: one row, one aggregation."""
    return flags.agg(*_metrics())


def parse_totals(preds: DataFrame) -> DataFrame:
    """AG20."""
    return preds.agg(F.count("*").alias("total"), F.count_if("parse_ok").alias("parse_ok"), F.count_if(~F.coalesce("parse_ok", F.lit(False))).alias("parse_fail"))


def by_chapter(flags: DataFrame) -> DataFrame:
    """AG14: by the chapter of the first gold code, abstentions and bad codes left out."""
    rows = text.settled(flags.where(~F.col("gold_abstain")), _first=codes.cleaned(F.get("gold", F.lit(0))))
    per = rows.groupBy(F.substring(codes.padded(F.col("_first")), 1, 2).alias("chapter")).agg(F.count("*").alias("total"), *[(F.count_if(_hit(k)) / F.count("*")).alias(f"{k}_match") for k in _LEVELS])
    return per.where("chapter is not null")


def bucket() -> Column:
    """AG15: the first that applies; null where there is no error."""
    c = F.col
    return (
        F.when(~c("parse_ok"), "parse_failure").when(~c("pred_present"), "missing_prediction").when(c("gold_abstain") & ~c("pred_abstain"), "missed_abstain")
        .when(~c("gold_abstain") & c("pred_abstain"), "false_abstain").when(c("gold_abstain"), None).when(~c("flags.valid"), "hallucinated_code").when(_hit("exact"), None)
        .when(~_hit("chapter"), "wrong_chapter").when(~_hit("heading"), "right_chapter_wrong_heading").when(~_hit("subheading"), "right_heading_wrong_subheading")
        .otherwise("right_subheading_wrong_full")
    )


def error_buckets(flags: DataFrame) -> DataFrame:
    """(bucket, n) of the errors there are: one row of counts, turned; a filter on the bucket would be pushed down and worked out twice."""
    one = flags.withColumn("bucket", bucket()).agg(*[F.count_if(F.col("bucket") == b).alias(b) for b in BUCKETS])
    return one.unpivot([], list(BUCKETS), "bucket", "n").where("n > 0")


def error_samples(flags: DataFrame, order: list[str], texts: tuple[str, ...] = (), most: int = 5, width: int = 200) -> DataFrame:
    """WN4: the first rows of each bucket, their texts cut to `width`. Candidates are ranked inside hash parts first, so no bucket is sorted by one task."""
    rows = flags.withColumn("bucket", bucket()).withColumn("part", F.pmod(F.xxhash64(*order), F.lit(64)))
    few = rows.withColumn("rn", F.row_number().over(W.partitionBy("bucket", "part").orderBy(*order))).where(F.col("rn") <= most)
    first = few.withColumn("rn", F.row_number().over(W.partitionBy("bucket").orderBy(*order))).where((F.col("rn") <= most) & F.col("bucket").isNotNull())
    return first.withColumns({t: F.left(F.col(t), F.lit(width)) for t in texts}).drop("part")


def failures(flags: DataFrame) -> DataFrame:
    """FL11: parsed, no abstention, a valid code, but none of the gold codes."""
    return flags.where(F.col("flags.valid") & ~_hit("exact"))


def deltas(old: DataFrame, new: DataFrame) -> DataFrame:
    """JN12: metric by metric, new minus old."""
    def long(m: DataFrame, name: str) -> DataFrame:
        parts = ", ".join(f"'{c}', cast({c} as double)" for c in m.columns)
        return m.select(F.expr(f"stack({len(m.columns)}, {parts}) as (metric, {name})"))

    return long(old, "old_value").join(long(new, "new_value"), "metric").withColumn("delta", F.round(F.col("new_value") - F.col("old_value"), 4))
