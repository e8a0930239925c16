"""Mixing sources to target weights, in DataFrame functions only.

Sizes are summed per source (partially aggregated, so a source of any share is fine). Targets: every
source gets its weight's share of `share` times all sizes, at most `most` times its own size; what is cut
off is shared again by weight until no source is above. A document is emitted floor(rate) times, rate =
target / source size, plus once more by a Bernoulli draw with the fraction as its probability. Draws are
hashes of the document's key and a seed; of SEEDS seeds each source uses the one whose draws come nearest
to its target, summed in the same pass for all seeds.

Sources are ordered by code point, null last. Null texts have size 0. Repeated keys draw alike. A source
without words has rate 0. No documents: no rows. Very long texts count as any other. Extra columns stay out
of mix and pass through emit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, materialise

SEEDS = 32
SALTS = 16

def _draw(seed) -> F.Column:
    """Uniform in [0, 1) from the key (a null one counts as empty) and a seed, by a hash that every engine has."""
    hashed = F.md5(F.concat(seed.cast("string"), F.lit("|"), F.coalesce(F.col("key").cast("string"), F.lit(""))))
    return F.conv(F.substring(hashed, 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def ranked(sources: DataFrame) -> DataFrame:
    """sources with `place`: 0, 1, ... in the order of (source is null, source), without one global sort task."""
    order = [F.col("source").isNull(), F.col("source")]
    parts = materialise(sources.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    counts = {r["part"]: r["n"] for r in parts.groupBy("part").agg(F.count("*").alias("n")).collect()}  # one row per partition
    offset, before = [F.lit(-1), F.lit(0)], 0
    for part in sorted(counts):
        offset += [F.lit(part), F.lit(before)]
        before += counts[part]
    own = F.row_number().over(W.partitionBy("part").orderBy(*order))
    return parts.select("*", (F.create_map(*offset)[F.col("part")] + own - 1).alias("place"))


def targets(sizes: DataFrame, weights: list[int], share: float, most: float) -> DataFrame:
    """(source, source_size, target) from sizes(source, source_size)."""
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    placed = materialise(ranked(sizes).select("source", "source_size", weight.cast("double").alias("weight")))
    total = float(placed.agg(F.sum("source_size")).first()[0] or 0)
    level, capped = 0.0, -1
    while True:  # raise the level until the sources that stop at their cap are stable; one sum a round
        full = F.col("weight") * level >= F.col("source_size") * most
        row = placed.agg(
            F.count_if(full).alias("n"), F.sum(F.when(full, F.col("source_size") * most).otherwise(0)).alias("held"), F.sum(F.when(full, 0).otherwise(F.col("weight"))).alias("open")
        ).first()
        if row["n"] == capped or not row["open"]:
            break
        capped, level = row["n"], max(level, (min(share, most) * total - row["held"]) / row["open"])
    target = F.when(full, F.col("source_size") * most).otherwise(F.col("weight") * level)
    return placed.select("source", "source_size", target.cast("double").alias("target"))


def _size() -> F.Column:
    return F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")


def _joined(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """rows(key, source, ..) with their source's plan as a struct. Rows of one source are spread over SALTS parts, and its plan is copied to each."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)))
    copies = plan.select("source", F.struct(*plan.columns).alias("plan")).withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))).withColumnRenamed("source", "plan_source")
    return salted.join(copies, (salted["salt"] == copies["salt"]) & salted["source"].eqNullSafe(copies["plan_source"])).drop("salt", "plan_source")


def planned(docs: DataFrame, key: str = "doc_id", weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size, target, rate, fraction, seed), one row a source."""
    small = materialise(docs.select(F.col(key).alias("key"), "source", _size().alias("size")))
    by_source = materialise(small.groupBy("source").agg(F.sum("size").alias("source_size")))
    rates = materialise(targets(by_source, list(weights), share, most).withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)).withColumn("fraction", F.col("rate") - F.floor("rate")))
    tried = _joined(small, rates.select("source", "fraction"))
    extra = [F.sum(F.when(_draw(F.lit(s)) < F.col("plan.fraction"), F.col("size")).otherwise(0)).alias(f"e{s}") for s in range(SEEDS)]
    sums = tried.groupBy("source").agg(*extra)
    wanted = F.col("target") - F.floor("rate") * F.col("source_size")
    off = F.array(*[F.struct(F.abs(F.col(f"e{s}") - wanted).alias("off"), F.lit(s).alias("seed")) for s in range(SEEDS)])
    plan = rates.join(sums.withColumnRenamed("source", "own"), F.col("source").eqNullSafe(F.col("own")))
    return materialise(plan.select("source", "source_size", "target", "rate", "fraction", F.array_min(off)["seed"].alias("seed")), small, by_source)


def _copies() -> F.Column:
    return F.floor("plan.rate") + (_draw(F.col("plan.seed")) < F.col("plan.fraction")).cast("long")


def mix(docs: DataFrame, key: str = "doc_id", weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(key, size, source_size, target, copies, taken) for each row of docs(key, text, source)."""
    out = _joined(docs.select(F.col(key).alias("key"), "source", _size().alias("size")), planned(docs, key, weights, share, most))
    copies = _copies()
    return out.select(F.col("key").alias(key), "size", "plan.source_size", "plan.target", copies.alias("copies"), (F.col("size") * copies).alias("taken"))


def emit(docs: DataFrame, key: str = "doc_id", weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """The mix itself: every row of docs as often as its copies say, all columns as they are, whatever their names.

    Texts meet the plan by their source alone: where the plan is small, they are not shuffled.
    """
    rows = docs.select(F.struct(*docs.columns).alias("doc"), F.col(key).alias("key"), F.col("source"))
    out = _joined(rows, planned(docs, key, weights, share, most)).withColumn("copies", _copies()).where("copies > 0")
    copy = F.explode(F.array_repeat(F.lit(True), F.col("copies").cast("int")))
    return out.select("doc", copy.alias("copy")).select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])
