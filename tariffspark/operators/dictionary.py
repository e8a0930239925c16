"""Terms of a dictionary in texts, as a join (JN7, RN3).

A text is cut into runs of word characters ([A-Za-z0-9_], as \\b has them) and single other characters. A term that stands
between word borders is a run of whole such tokens, so the n-grams of tokens that begin and end at borders, of the lengths
that terms have, are joined with the terms by 128 bits of hash. Of the terms at a place the longest counts, and a fold from
left to right passes over places inside a term that was taken: what an alternation of all terms, longest first, would find.

Nothing is collected; the terms may be many or few, which decides only how the planner joins them. Common n-grams are
dealt by their text over DEALT parts, to which all terms are copied.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffspark.functions import text

SEED = 42
DEALT = 8
SHORTEST = 3
_TOKEN = r"[a-z0-9_]+|[^a-z0-9_]"


def _tokens(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(f"(?s)({_TOKEN})"), F.lit(1))


def _key(gram: Column) -> Column:
    return F.struct(F.xxhash64(gram).alias("h"), F.xxhash64(F.lit(1), gram).alias("i"))


def _solid(token: Column) -> Column:
    """Whether a token is a run of word characters, by its first one; there may be none."""
    known = F.coalesce(token, F.lit(" "))
    return ((known >= "0") & (known < ":")) | ((known >= "a") & (known < "{")) | known.startswith("_")


def _border(i: Column) -> Column:
    """Whether one of the tokens before and at place i is a word and the other is not, or is none."""
    return _solid(F.get("words", i - 1)) != _solid(F.get("words", i))


def _grams(texts: DataFrame, lengths: DataFrame) -> DataFrame:
    """(seq, place, size, key): the n-grams from border to border, of all `lengths` that terms have.

    Rows of places and not lambdas over arrays: all steps are compiled together, and the words are not copied with a row.
    The outer generators have no filter that the optimizer derives from them, which would cut the texts anew.
    """
    cut = texts.select("seq", _tokens(F.col("description")).alias("words")).crossJoin(lengths)
    starts = cut.select("seq", "words", "lengths", F.posexplode_outer("words").alias("place", "token")).where(_border(F.col("place")))
    sized = starts.select("seq", "words", "place", F.explode_outer("lengths").alias("size")).where(_border(F.col("place") + F.col("size")))
    return sized.select("seq", "place", "size", _key(F.array_join(F.slice("words", F.col("place") + 1, F.col("size")), "")).alias("key"))


def terms_of(glossary: DataFrame) -> DataFrame:
    """(term, definition): one row for each term of SHORTEST characters or more, in lower case; of several definitions the least."""
    if "definition" not in glossary.columns:
        glossary = glossary.withColumn("definition", F.lit(None).cast("string"))
    return glossary.where(F.length("term") >= SHORTEST).groupBy(F.lower("term").alias("term")).agg(F.min("definition").alias("definition"))


def matches(texts: DataFrame, terms: DataFrame) -> DataFrame:
    """(seq, found): the distinct terms of each text(seq, description) that has any, in order of their first place.

    terms(term) are distinct and in lower case. seq is unique; a null description has none.
    """
    dealt = terms.select(_key(F.col("term")).alias("key"), "term", F.explode(F.sequence(F.lit(0), F.lit(DEALT - 1))).alias("part"))
    lengths = terms.select(F.size(_tokens(F.col("term"))).alias("n")).agg(F.collect_set("n").alias("lengths"))
    grams = _grams(texts, lengths).withColumn("part", F.pmod(F.xxhash64("seq"), F.lit(DEALT)).cast("int"))
    longest_first = F.struct("place", (-F.col("size")).alias("less"), "term")
    hits = grams.join(dealt, ["key", "part"]).groupBy("seq").agg(F.array_sort(F.collect_list(longest_first)).alias("hits"))
    start = F.struct(F.lit(0).alias("free"), F.array().cast("array<string>").alias("found"))

    def step(state: Column, hit: Column) -> Column:
        longer = F.when(F.array_contains(state["found"], hit["term"]), state["found"]).otherwise(F.concat(state["found"], F.array(hit["term"])))
        return F.when(hit["place"] >= state["free"], F.struct((hit["place"] - hit["less"]).alias("free"), longer.alias("found"))).otherwise(state)

    return hits.select("seq", F.aggregate("hits", start, step, lambda s: s["found"]).alias("found"))


def glossary_defined(items: DataFrame, glossary: DataFrame, most: int = 3) -> DataFrame:
    """items(seq, description) with `terms`, an array of struct(term, definition): up to `most` terms of the glossary(term[, definition])
    that the description has, in hash order, empty where there are none."""
    terms = terms_of(glossary)
    found = matches(items.select("seq", "description"), terms)
    drawn = F.slice(F.array_sort(F.transform("found", lambda t: F.struct(text.order_hash(t, SEED).alias("h"), t.alias("term")))), 1, most)
    rows = found.select("seq", F.explode(drawn).alias("x")).select("seq", "x.h", "x.term").join(terms, "term")
    pairs = rows.groupBy("seq").agg(F.array_sort(F.collect_list(F.struct("h", "term", "definition"))).alias("_found"))
    none = F.array().cast("array<struct<h:string,term:string,definition:string>>")
    named = F.transform(F.coalesce("_found", none), lambda x: F.struct(x["term"].alias("term"), x["definition"].alias("definition")))
    return items.join(pairs, "seq", "left").withColumn("terms", named).drop("_found")


def glossary_matches(items: DataFrame, glossary: DataFrame, most: int = 3) -> DataFrame:
    """As glossary_defined, with the terms alone."""
    return glossary_defined(items, glossary, most).withColumn("terms", F.transform("terms", lambda x: x["term"]))
