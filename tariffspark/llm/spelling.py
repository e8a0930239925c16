"""Grouping of spelling variants: words that differ by one inserted, deleted or replaced code point.

A word is parted evenly in two segments. One edit leaves one of them whole (pigeonhole), so the words are indexed by their
length and each of their segments, and every word probes the index with its substrings at the places where a segment of a
word of its own length, or of one that is a code point shorter, would stand: unshifted, or behind the edit shifted by one.
A pair that both segments propose is taken from the first; what is left is verified as one edit, inside the join.

Segments that many words share ("-ations") are dealt: their index rows go to as many parts as keep GROUP rows in each, and
probes go to all of these, so that no task gets a whole group. Counts are added up before anything is shuffled, and no text
or word list reaches the driver.

A word's form is its most frequent near word, if that is SHARE times as frequent; forms are followed to the last. Since the
counts grow by SHARE with every form, the longest chain is known from the largest count, and so is the number of joins that
double the step.

Nulls and empty texts have no words; a null id counts as an empty one. Texts are taken whole, their words as one array.
Ties for the form go to the smallest word in code-point order. Rows that repeat count each. Without words the result is
empty. Further columns, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

LETTERS = "A-Za-zÀ-ÿ"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Index rows of one segment that go to one part.
GROUP = 500
SHARE = 5


def words(docs: DataFrame, key: str = "doc_id", shortest: int = 6, least: int = 5, every: int = 199) -> DataFrame:
    """(word, n): runs of letters of all texts, with planted slips, of `shortest` code points and `least` occurrences or more.

    Where `every` divides the crc32 of "<id>:<run>", the run loses the code point that the hash names.
    """
    lowered = F.translate(F.col("text"), _UPPER, _LOWER)
    runs = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(lowered, F.lit(f"[{LETTERS}]{{{shortest},}}"), F.lit(0))).alias("run"))
    hashed = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    slipped = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    word = F.when(F.col("h") % every == 0, slipped).otherwise(F.col("run"))
    return hashed.select(word.alias("word")).where(F.length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def _segment(side: int, length: Column, seg: Column) -> Column:
    return F.struct(F.lit(side).alias("side"), length.alias("length"), seg.alias("seg"))


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n): pairs of words one edit apart, each once; a is the shorter one, or the lesser of equal length."""
    size = F.length("word")
    half = F.floor(size / 2).cast("int")
    index = vocabulary.select(F.col("word").alias("a"), F.col("n").alias("a_n"), F.explode(F.array(_segment(0, size, F.left("word", half)), _segment(1, size, F.substr("word", half + 1)))).alias("key"))
    less, of_less = size - 1, F.floor((size - 1) / 2).cast("int")
    own = [_segment(0, size, F.left("word", half)), _segment(1, size, F.substr("word", half + 1))]
    shorter = [_segment(0, less, F.left("word", of_less)), _segment(1, less, F.substr("word", of_less + 2))]
    probes = vocabulary.select(F.col("word").alias("b"), F.col("n").alias("b_n"), F.explode(F.array(*own, *shorter)).alias("key"))
    crowded = index.groupBy("key").agg(F.ceil(F.count("*") / GROUP).cast("int").alias("parts")).where("parts > 1")
    parts = F.coalesce("parts", F.lit(1))
    dealt = index.join(crowded, "key", "left").select("key", "a", "a_n", F.pmod(F.xxhash64("a"), parts).cast("int").alias("part"))
    asked = probes.join(crowded, "key", "left").select("key", "b", "b_n", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    first = F.floor(F.length("a") / 2).cast("int")
    once = (F.length("a") < F.length("b")) | (F.col("a") < F.col("b"))
    unproposed = (F.col("key.side") == 0) | (F.left("a", first) != F.left("b", first))
    together = dealt.join(asked, ["key", "part"]).where(once & unproposed & (F.levenshtein("a", "b", 1) == 1))
    return together.select("a", "a_n", "b", "b_n")


def _rounds(most: int, least: int) -> int:
    """Doublings that reach the end of any chain of forms: counts grow from `least` to `most` by SHARE a step."""
    steps = 0
    while least * SHARE ** (steps + 1) <= most:
        steps += 1
    return max(steps - 1, 0).bit_length()


def grouped(docs: DataFrame, key: str = "doc_id", shortest: int = 6, least: int = 5, every: int = 199) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word; see words() for these."""
    vocabulary = materialise(words(docs, key, shortest, least, every))
    pairs = near_pairs(vocabulary)
    side = lambda w, o: F.struct(F.col(w).alias("word"), F.struct((-F.col(f"{o}_n")).alias("less"), F.col(o).alias("form")).alias("best"))
    both = pairs.select(F.explode(F.array(side("a", "b"), side("b", "a"))).alias("x")).select("x.*")
    near = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min("best").alias("best"))
    joined = vocabulary.join(near, "word", "left")
    fits = -F.col("best.less") >= SHARE * F.col("n")
    found = materialise(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(fits, F.col("best.form")).alias("form"), F.when(fits, -F.col("best.less")).alias("form_n")))
    ends = found.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    for _ in range(_rounds(vocabulary.agg(F.max("n")).first()[0] or 0, least)):
        further = ends.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        ends = materialise(ends.join(further, "root", "left").select("word", F.coalesce("beyond", "root").alias("root")))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
