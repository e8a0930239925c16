"""Filters, exact and near-duplicate removal (FL1, FL2, WN1, ND1-ND4).

Near-duplicates are exact: set-similarity join by prefix filtering. In any one order of all shingles, two
sets of Jaccard t or more share one of their |x| - ceil(t |x|) + 1 first, and m of m - 1 more, so only these are
joined, a pair is sent on once for a run of them, and pairs that share fewer are dropped; what is left is compared
whole. The order is that of the hashes, with frequent
shingles, which would make quadratic groups, at the end. Which are frequent is counted for hashes below zero,
since the first shingles of a set are hardly ever others, and marked in bits of fixed number: a shingle that
is marked by chance, or frequent and not marked, costs time and changes no result, as the order is still one
and the same for all sets. Greedy removal and leakage compare each set with one that decides first, and only
those still open with all. Equal sets (copies, and all texts of under three words) are one set before
anything is joined.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tariffspark.functions import codes, text

#: A shingle of more than OFTEN sets is frequent; frequent ones are marked in WORDS times 64 bits. Of every SHARE shingles of a set one more has to be shared.
OFTEN, WORDS, SHARE = 32, 1 << 16, 40


def valid_codes(items: DataFrame) -> DataFrame:
    return items.where(codes.is_valid(F.col("hts_code"))).withColumn("hts_code", codes.normalized(F.col("hts_code")))


def length_band(items: DataFrame, low: int = 30, high: int = 2048) -> DataFrame:
    return items.where(F.length("description").between(low, high))


def exact_dedup(items: DataFrame) -> DataFrame:
    """WN1: the first row of each (lower-cased trimmed description, code). A minimum, not a window: no task gets a key's rows."""
    key = [text.stripped(F.lower("description")), codes.normalized(F.col("hts_code"))]
    first = items.groupBy(*[k.alias(f"k{i}") for i, k in enumerate(key)]).agg(F.min("seq").alias("seq"))
    return items.join(first.select("seq"), "seq", "left_semi")


def near_dedup(items: DataFrame, threshold: float, checkpoint) -> DataFrame:
    """ND3 on items(seq, description): of rows with equal sets the first stays, and of these what greedy keep-first removal leaves."""
    sets = with_shingles(items.select(F.col("seq").alias("id"), "description"), "description").select("id", "sh")
    dropped = greedy_keep(decisive_pairs(sets, threshold), checkpoint).withColumnRenamed("id", "seq")
    kept = first_ids(sets).withColumnRenamed("id", "seq")
    return items.join(kept.join(dropped, "seq", "left_anti"), "seq", "left_semi")


def with_shingles(df: DataFrame, description: str, size: int = 3) -> DataFrame:
    """ND1: `sh`, distinct word shingles as 64-bit hashes; with fewer words one shared sentinel.

    The words are a column of their own, so that they are split once and not for every shingle.
    """
    n, w = F.size("_w"), F.col("_w")
    each = F.transform(F.sequence(F.lit(0), n - size), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(size)]))
    sh = F.when(n >= size, F.array_distinct(each)).otherwise(F.array(F.lit(0).cast("long")))
    return df.withColumn("_w", text.words(F.lower(F.coalesce(F.col(description), F.lit(""))))).withColumn("sh", sh).drop("_w")


def _key(sh: Column) -> list[Column]:
    """128 bits of hash of a sorted set, by which sets are grouped and joined in place of their shingles."""
    return [F.xxhash64(sh).alias("h"), F.xxhash64(F.lit(1), sh).alias("i")]


def _keyed(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.select(*columns, F.sort_array("sh").alias("sh")).select("*", *_key(F.col("sh")))


def representatives(rows: DataFrame) -> DataFrame:
    """(id, rep): rows with equal sets have one representative, their least id. However many copies there are, only it is compared."""
    key = _keyed(rows, "id").drop("sh")
    return key.join(key.groupBy("h", "i").agg(F.min("id").alias("rep")), ["h", "i"]).select("id", "rep")


def first_ids(rows: DataFrame) -> DataFrame:
    """(id): the least id among those of rows(id, sh) with equal sets."""
    return _keyed(rows, "id").groupBy("h", "i").agg(F.min("id").alias("id")).select("id")


def _distinct_sets(rows: DataFrame, *by: str) -> DataFrame:
    """(h, i, *by, id, sh, docs): each distinct set of rows(id, sh, *by) under its least id, with its number of rows.

    Every reader of it asks for all columns (hence the filter, which is always true): else the optimizer prunes them
    differently for each, and the sets are shuffled once for every reader instead of once.
    """
    one = _keyed(rows, "id", *by).groupBy("h", "i", *by).agg(F.min(F.struct("id", "sh")).alias("d"), F.count("*").alias("docs")).where("docs > 0")
    return one.select("h", "i", *by, "d.id", "d.sh", "docs")


def _frequent(sets: DataFrame, often: int) -> DataFrame:
    """One row of WORDS times 64 bits, in which every shingle of negative hash is marked that more than `often` sets hold."""
    often_held = sets.select(F.explode("sh").alias("s")).where("s < 0").groupBy("s").agg(F.count("*").alias("df")).where(F.col("df") > often)
    words = often_held.groupBy(_word(F.col("s")).alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(s & 63 as int)))").alias("bits"))
    all_words = sets.sparkSession.range(WORDS).select(F.col("id").cast("int").alias("w"), F.lit(0).cast("long").alias("bits")).union(words).groupBy("w").agg(F.bit_or("bits").alias("bits"))
    return all_words.agg(F.transform(F.sort_array(F.collect_list(F.struct("w", "bits"))), lambda x: x["bits"]).alias("marks"))


def _word(s: Column) -> Column:
    return F.shiftrightunsigned(s, 6).bitwiseAND(WORDS - 1).cast("int")


def _first(n: Column, threshold: float) -> Column:
    """How many of a set's n shingles are joined: any similar set has one of them."""
    return n - F.ceil(n * threshold - 1e-9).cast("int") + 1


def _ends(key: list[str], side: str) -> list[str]:
    return [f"{c}_{side}" for c in key]


def _candidates(sets: DataFrame, threshold: float, often: int, *by: str) -> DataFrame:
    """(h_x, i_x, *by_x, h_y, i_y, *by_y, at): pairs of rows of _distinct_sets that may be similar, each once; at: how early they meet.

    A pair is sent on for every run of shingles that it shares one after the other, not for every shingle: one is passed over if
    that before it is shared too. So the first shared one is always sent, and only there the places have to leave room for what
    must be shared. Runs of one (the next ones differ in eight bits of theirs) count as one, others as any number.
    """
    key = ["h", "i", *by]
    # every row is copied once with the marks, which therefore are few
    held = sets.select(*key, "sh", _frequent(sets, often).scalar().alias("marks"))
    marked = F.filter("sh", lambda s: (s < 0) & (F.getbit(F.get("marks", _word(s)), s.bitwiseAND(63).cast("int")) == 1))
    known = text.settled(held, marked=marked)
    n = F.size("sh")
    begun = text.settled(known, own=F.slice(F.concat(F.array_except("sh", "marked"), F.col("marked")), F.lit(1), _first(n, threshold)))
    spread = begun.select(*key, n.cast("long").alias("n"), "own", F.posexplode("own").alias("p", "s"))
    # the size, the place and eight bits of the next shingle in one number
    place = F.shiftleft("n", 36).bitwiseOR(F.shiftleft(F.col("p").cast("long"), 8)).bitwiseOR(F.coalesce(F.get("own", F.col("p") + 1).bitwiseAND(255), F.lit(0)))
    first = spread.select(*key, "s", place.alias("place"), F.get("own", F.col("p") - 1).alias("prev"))
    x, y = (first.select("s", *[F.col(c).alias(f"{c}_{side}") for c in [*key, "place", "prev"]]) for side in "xy")
    once = F.col("side_x") < F.col("side_y") if "side" in by else (F.col("h_x") < F.col("h_y")) | ((F.col("h_x") == F.col("h_y")) & (F.col("i_x") < F.col("i_y")))
    n_x, n_y = (F.shiftrightunsigned(f"place_{side}", 36) for side in "xy")
    p_x, p_y = (F.shiftrightunsigned(f"place_{side}", 8).bitwiseAND((1 << 28) - 1) for side in "xy")
    fits = F.least(n_x, n_y) >= F.greatest(n_x, n_y) * threshold - 1e-9
    begins = F.coalesce(F.col("prev_x") != F.col("prev_y"), F.lit(True))
    # of the `meet` shingles that a pair has to share, all but those after the first `zone` are among these, on either side
    meet = F.ceil((n_x + n_y) * (threshold / (1 + threshold)) - 1e-9)
    zones = [F.least(_first(n, threshold), n - meet + 1 + F.floor(F.least(n_x, n_y) / SHARE)) for n in (n_x, n_y)]
    need = F.least(*[zone - n + meet for zone, n in zip(zones, (n_x, n_y), strict=True)])
    run = F.when(F.col("place_x").bitwiseXOR(F.col("place_y")).bitwiseAND(255) == 0, 1 << 28).otherwise(1)
    at = F.when((n_x - p_x >= meet) & (n_y - p_y >= meet), p_x + p_y)
    runs = x.join(y, "s").where(once & fits & begins & (p_x < zones[0]) & (p_y < zones[1])).groupBy(*_ends(key, "x"), *_ends(key, "y"))
    return runs.agg(F.sum(run).alias("m"), F.min(need).alias("need"), F.min(at).alias("at")).where("m >= need and at is not null").select(*_ends(key, "x"), *_ends(key, "y"), "at")


def _compared(sets: DataFrame, pairs: DataFrame, threshold: float, *by: str) -> DataFrame:
    """(x, y, jaccard): the pairs with Jaccard threshold or more, as structs (h, i, *by, id, docs)."""
    key = ["h", "i", *by]
    pairs = pairs.select(*_ends(key, "x"), *_ends(key, "y"))
    for side in "xy":
        own = sets.select(*[F.col(c).alias(f"{c}_{side}") for c in key], F.struct(*key, "id", "docs").alias(side), F.col("sh").alias(f"sh_{side}"))
        pairs = pairs.join(own, _ends(key, side))
    both = F.size(F.array_intersect("sh_x", "sh_y"))
    return pairs.select("x", "y", (both / (F.size("sh_x") + F.size("sh_y") - both)).alias("jaccard")).where(F.col("jaccard") >= threshold - 1e-12)


def _close(sets: DataFrame, threshold: float, often: int, *by: str) -> DataFrame:
    """All similar pairs of different rows of _distinct_sets, as _compared gives them.

    With `side` among `by`, x is of a lesser side than y; else each pair comes once.
    """
    return _compared(sets, _candidates(sets, threshold, often, *by), threshold, *by)


def similar_pairs(left: DataFrame, right: DataFrame, threshold: float, same: bool, often: int = OFTEN) -> DataFrame:
    """ND2: (a, b, jaccard) between distinct sets of left(id, sh) and right(id, sh), each under its least id; a < b if both are the same table."""
    if same:
        near = _close(_distinct_sets(left), threshold, often)
        return near.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"), "jaccard")
    rows = left.select("id", "sh", F.lit(0).alias("side")).union(right.select("id", "sh", F.lit(1).alias("side")))
    return _close(_distinct_sets(rows, "side"), threshold, often, "side").select(F.col("x.id").alias("a"), F.col("y.id").alias("b"), "jaccard")


def decisive_pairs(rows: DataFrame, threshold: float, often: int = OFTEN) -> DataFrame:
    """(a, b): of the similar pairs of similar_pairs(rows, rows), enough for greedy keep-first removal.

    What may only be like later sets stays for certain, so what is like it goes, and no other pair of that matters. Among many
    near copies this leaves the pairs of one with all others in place of all pairs.
    """
    sets = _distinct_sets(rows)
    pairs = _candidates(sets, threshold, often).drop("at")
    for side in "xy":
        pairs = pairs.join(sets.select(*[F.col(c).alias(f"{c}_{side}") for c in ("h", "i", "id")]), _ends(["h", "i"], side))
    x, y = (F.struct(*[F.col(f"{c}_{side}").alias(c) for c in ("h", "i")]) for side in "xy")
    ahead = F.col("id_x") < F.col("id_y")
    pairs = pairs.select(F.when(ahead, x).otherwise(y).alias("x"), F.when(ahead, y).otherwise(x).alias("y"))
    pairs = pairs.select(*[F.col(f"{side}.{c}").alias(f"{c}_{side}") for side in "xy" for c in ("h", "i")])
    later = pairs.select(*_ends(["h", "i"], "y")).distinct().toDF("h_x", "i_x").withColumn("later", F.lit(True))
    known = pairs.join(later, ["h_x", "i_x"], "left")
    found = _compared(sets, known.where("later is null"), threshold).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"), "y.h", "y.i")
    # both ids are asked for, in a way that filters no set by them: so sets are sent once to what is compared
    gone = found.where(~F.col("a").eqNullSafe(F.col("b"))).select("h", "i").distinct()
    rest = known.where("later")
    for side in "xy":
        rest = rest.join(gone.toDF(*_ends(["h", "i"], side)), _ends(["h", "i"], side), "left_anti")
    return found.select("a", "b").union(_compared(sets, rest, threshold).select("x.id", "y.id"))


def leakage(rows: DataFrame, threshold: float = 0.85) -> DataFrame:
    """ND4: (kind, n): rows(id, sh, split) of valid and of test with a similar row in train; a kind without any is left out.

    Each set is compared with the one of train that it meets first, and only without success with all others.
    """
    side = F.when(F.col("split") == "train", 0).when(F.col("split").isin("valid", "test"), 1)
    by = ["side", "split"]
    sets = _distinct_sets(rows.withColumn("side", side).where("side is not null"), *by)
    pairs = _candidates(sets, threshold, OFTEN, *by)
    x, y = (_ends(["h", "i", *by], side) for side in "xy")
    first = pairs.groupBy(*y).agg(F.min(F.struct("at", *x)).alias("x")).select(*[F.col(f"x.{c}").alias(c) for c in x], *y)
    hit = _compared(sets, first, threshold, *by).select("y").distinct()
    rest = pairs.join(hit.select(*[F.col(f"y.{c}").alias(f"{c}_y") for c in ("h", "i", *by)]), y, "left_anti")
    hit = hit.union(_compared(sets, rest, threshold, *by).select("y").distinct())
    return hit.groupBy(F.concat("y.split", F.lit("_vs_train")).alias("kind")).agg(F.sum("y.docs").alias("n"))


#: Components of so many pairs are settled by one task; greater ones in rounds, in all tasks.
WHOLE = 200_000


def components(pairs: DataFrame, checkpoint) -> DataFrame:
    """(id, component) of every id in pairs(a, b): the least id that can be reached.

    Each round an id, and the id that it points to, take the least that a neighbour points to; then pointers are followed one step.
    """
    both = checkpoint(pairs.select("a", "b").union(pairs.select("b", "a")).toDF("u", "v").distinct())
    low = checkpoint(both.select(F.col("u").alias("id")).distinct().withColumn("low", F.col("id")))
    while True:
        ends = both.join(low.toDF("v", "low_v"), "v").join(low.toDF("u", "low_u"), "u")
        hooks = ends.select(F.explode(F.array("u", "low_u")).alias("id"), "low_v").groupBy("id").agg(F.min("low_v").alias("to"))
        hooked = low.join(hooks, "id").select("id", F.least("low", "to").alias("low"), F.col("low").alias("was"))
        step = hooked.select(F.col("id").alias("low"), F.col("low").alias("beyond"))
        low = checkpoint(hooked.join(step, "low").select("id", F.least("low", "beyond").alias("low"), "was"))
        if low.where("low <> was").isEmpty():
            return low.select("id", F.col("low").alias("component"))
        low = low.select("id", "low")


def greedy_keep(pairs: DataFrame, checkpoint, whole: int = WHOLE) -> DataFrame:
    """ND3: ids dropped by keep-first dedup, from pairs(a < b): b goes if an earlier similar row is kept.

    What is dropped in a component of pairs depends on nothing else, so those of up to `whole` pairs are settled each by one pass
    over its pairs in order, however long its chains are. Greater ones settle in rounds as long as their longest chain.
    """
    pairs = checkpoint(pairs.select("a", "b").distinct())
    owned = checkpoint(pairs.join(components(pairs, checkpoint).withColumnRenamed("id", "a"), "a"))
    great = owned.groupBy("component").count().where(F.col("count") > whole).select("component")
    small = owned.join(great, "component", "left_anti").repartition("component").sortWithinPartitions("component", "b", "a")

    def settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, dropped = None, set()
        for rows in batches:
            found = []
            for component, a, b in zip(rows["component"], rows["a"], rows["b"], strict=True):
                if component != own:
                    own, dropped = component, set()
                if a not in dropped and b not in dropped:  # a is settled: all its pairs with earlier rows came before
                    dropped.add(b)
                    found.append(b)
            yield pd.DataFrame({"id": pd.Series(found, dtype=rows["b"].dtype)})

    settled = small.mapInPandas(settle, StructType([StructField("id", pairs.schema["b"].dataType)]))
    large = checkpoint(owned.join(great, "component", "left_semi").select("a", "b"))
    return settled if large.isEmpty() else settled.union(_in_rounds(large, checkpoint))


def _in_rounds(open_pairs: DataFrame, checkpoint) -> DataFrame:
    """Rows settle round by round: kept once all earlier neighbours are dropped, dropped once one is kept."""
    dropped = checkpoint(open_pairs.select(F.col("b").alias("id")).limit(0))
    while True:
        waiting = open_pairs.select(F.col("b").alias("id")).distinct()
        kept = open_pairs.select(F.col("a").alias("id")).distinct().join(waiting, "id", "left_anti")
        fresh = open_pairs.join(kept.withColumnRenamed("id", "a"), "a", "left_semi").select(F.col("b").alias("id")).distinct()
        dropped = checkpoint(dropped.union(fresh))
        gone = dropped.select("id")
        open_pairs = checkpoint(open_pairs.join(gone.withColumnRenamed("id", "a"), "a", "left_anti").join(gone.withColumnRenamed("id", "b"), "b", "left_anti"))
        if open_pairs.isEmpty():
            return dropped.distinct()
