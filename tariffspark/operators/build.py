"""Building and splitting training examples (RN1, RN2, RN4, RN5, JN10, WN2, WN8-WN10, WN12, ST14, ST15). Hash order stands for shuffles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tariffspark.functions import codes, text

#: Shares of the input variants, abstention categories.
VARIANTS = (("rich", 0.45), ("minimal", 0.25), ("glossary_enriched", 0.20), ("materials_only", 0.10))
CATEGORIES = ("vague_description", "missing_materials", "ambiguous_use")
SEED = 42


def variant(key: Column, has_materials: Column, has_glossary: Column) -> Column:
    """RN1: by cumulative shares; a variant that lacks its field falls back to rich."""
    u, upto, out = text.unit_hash(key, SEED), 0.0, None
    for name, share in VARIANTS:
        upto += share
        out = F.when(u < upto, name) if out is None else out.when(u < upto, name)
    drawn = out.otherwise("rich")
    return F.when((drawn == "glossary_enriched") & ~has_glossary | (drawn == "materials_only") & ~has_materials, "rich").otherwise(drawn)


def abstain_rows(items: DataFrame, rate: float) -> DataFrame:
    """RN2: floor(n * rate) rows, those of the least hashes; a top-k, not a global sort of all rows."""
    n = items.count()
    return items.orderBy(text.order_hash(F.col("seq"), SEED), "seq").limit(int(n * rate))


def corrupted(description: Column, key: Column) -> Column:
    """RN2, RN5, ST14, ST15: struct(category, description)."""
    category = F.element_at(F.array(*map(F.lit, CATEGORIES)), (F.pmod(text.bucket_hash(key, SEED + 1), F.lit(3)) + 1).cast("int"))
    vague = F.element_at(F.array(*map(F.lit, text.VAGUE)), (F.pmod(text.bucket_hash(key, SEED + 2), F.lit(4)) + 1).cast("int"))
    out = F.when(category == CATEGORIES[0], vague).when(category == CATEGORIES[1], text.without_materials(description)).otherwise(text.first_words(description))
    return F.struct(category.alias("category"), out.alias("description"))


def cap_per_code(items: DataFrame, most: int) -> DataFrame:
    """WN2: at most `most` rows a code, by hash; abstentions are exempt. Ranked in hash parts first: a hot code is cut down before its rows meet."""
    order = [text.order_hash(F.col("seq"), SEED), F.col("seq")]
    exempt = F.coalesce("abstain", F.lit(False)) if "abstain" in items.columns else F.lit(False)
    parts = items.withColumn("part", F.pmod(F.xxhash64("seq"), F.lit(64))).withColumn("own", F.when(exempt, F.concat(F.lit("abstain "), F.col("seq").cast("string"))).otherwise(F.col("hts_code")))
    few = parts.withColumn("rn", F.row_number().over(W.partitionBy("own", "part").orderBy(*order))).where(F.col("rn") <= most)
    return few.withColumn("rn", F.row_number().over(W.partitionBy("own").orderBy(*order))).where(F.col("rn") <= most).drop("rn", "part", "own")


def ranked(rows: DataFrame, by: str, order: Column, tie: str) -> DataFrame:
    """rows with `n`, the size of their stratum, and `rank` in it by (order, tie); order is a hexadecimal hash.

    A stratum is ranked in 256 parts, by the first two digits; the parts' sizes give the offsets. No task sorts a whole stratum.
    """
    parts = rows.withColumn("_order", order).withColumn("_part", F.substring("_order", 1, 2)).withColumn("_by", F.coalesce(F.col(by).cast("string"), F.lit("\0")))
    sizes = parts.groupBy("_by", "_part").agg(F.count("*").alias("_size"))
    before = W.partitionBy("_by").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.select("_by", "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"), F.sum("_size").over(W.partitionBy("_by")).alias("n"))
    own = parts.withColumn("_own", F.row_number().over(W.partitionBy("_by", "_part").orderBy("_order", tie)))
    return own.join(sizes, ["_by", "_part"]).withColumn("rank", F.col("_before") + F.col("_own")).drop("_order", "_part", "_by", "_own", "_before")


def _dealt(rows: DataFrame, val: float, test: float) -> DataFrame:
    """rows(n, rank) with `split`: a stratum of three or more gives at least one row to valid and to test."""
    size = lambda share: F.when(F.col("n") >= 3, F.greatest(F.lit(1), F.floor(F.col("n") * F.lit(share)))).otherwise(0)
    out = rows.withColumn("n_val", size(val)).withColumn("n_test", size(test))
    n_train = F.col("n") - F.col("n_val") - F.col("n_test")
    split = F.when((n_train <= 0) | (F.col("rank") <= n_train), "train").when(F.col("rank") <= n_train + F.col("n_val"), "valid").otherwise("test")
    return out.withColumn("split", split).drop("n_val", "n_test", "n", "rank")


def split_groups(items: DataFrame, val: float = 0.1, test: float = 0.1) -> DataFrame:
    """WN8, WN9: (ruling_number, stratum, split). A ruling's stratum is the chapter of its first row that is no abstention, __other__ if
    there is none or it has no code; ranks in it follow the hash."""
    abstain = F.coalesce("abstain", F.lit(False)) if "abstain" in items.columns else F.lit(False)
    chapter = F.coalesce(codes.prefix(F.col("hts_code"), 2), F.lit(""))
    rows = items.where(F.coalesce(F.col("ruling_number"), F.lit("")) != "").select("ruling_number", F.when(~abstain, F.struct(F.col("seq").alias("seq"), chapter.alias("chapter"))).alias("first"))
    groups = rows.groupBy("ruling_number").agg(F.coalesce(F.nullif(F.min("first")["chapter"], F.lit("")), F.lit("__other__")).alias("stratum"))
    dealt = ranked(groups, "stratum", text.order_hash(F.col("ruling_number"), SEED), "ruling_number")
    return _dealt(dealt, val, test).select("ruling_number", "stratum", "split")


def assigned(items: DataFrame, val: float = 0.1, test: float = 0.1) -> DataFrame:
    """items with the split of their ruling; rows without a ruling train."""
    groups = split_groups(items, val, test).select("ruling_number", "split")
    return items.join(groups, "ruling_number", "left").withColumn("split", F.coalesce("split", F.lit("train")))


def split_rows(items: DataFrame, val: float = 0.1, test: float = 0.1) -> DataFrame:
    """WN8 by row: strata are chapters, and abstentions are one of their own."""
    abstain = F.coalesce("abstain", F.lit(False)) if "abstain" in items.columns else F.lit(False)
    rows = items.withColumn("stratum", F.when(abstain, "__abstain__").otherwise(codes.prefix(F.col("hts_code"), 2)))
    return _dealt(ranked(rows, "stratum", text.order_hash(F.col("seq"), SEED), "seq"), val, test)


def leaking_groups(rows: DataFrame, key: str = "ruling_number") -> DataFrame:
    """JN10: keys in more than one split."""
    return rows.where(text.present(F.col(key))).groupBy(key).agg(F.countDistinct("split").alias("n_splits")).where("n_splits > 1")


def head(rows: DataFrame, n: int, order: str = "seq") -> DataFrame:
    """WN10: the first n rows, a distributed top-k."""
    return rows.orderBy(order).limit(n)


def shuffled(rows: DataFrame, key: str = "seq", seed: int = SEED) -> DataFrame:
    """WN12: the order in which a sink writes: by hash, in ranges, the same in every run."""
    return rows.orderBy(text.order_hash(F.col(key), seed), key)


def stratified(rows: DataFrame, stratum: str, n: int) -> DataFrame:
    """RN4: proportional quotas in order of the stratum's name (null first), the last takes the remainder; all rows if there are no more than n.

    Strata are few; their running quota is a fold over the sorted sizes, and rows are ranked by hash in each.
    """
    sizes = sorted(((r[stratum], r["count"]) for r in rows.groupBy(stratum).count().collect()), key=lambda x: (x[0] is not None, x[0]))
    total, left, quota = sum(c for _, c in sizes), n, []
    for i, (name, c) in enumerate(sizes):
        q = left if i == len(sizes) - 1 else min(max(1, n * c // total), left, c)
        quota.append((name, q))
        left -= q
    if total <= n:
        return rows
    per = F.create_map(*[F.lit(x) for name, q in quota for x in ("\0" if name is None else str(name), q)])[F.coalesce(F.col(stratum).cast("string"), F.lit("\0"))]
    return ranked(rows, stratum, text.order_hash(F.col("seq"), SEED), "seq").where(F.col("rank") <= per).drop("rank", "n")
