"""Text functions: cleaning, mining of rulings, corruption, hashing in place of random numbers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = " \t\n\r\f\x0b"
#: Words that name a material, templates of vague goods, boilerplate before a subject, openings of descriptions and
#: reasoning (DESCRIPTION, REASONING), and the two patterns in gold_codes and question_product.
MATERIALS = ("steel", "iron", "copper", "aluminum", "plastic", "rubber", "cotton", "silk", "wool", "leather", "wood", "ceramic", "glass", "paper", "nylon", "polyester", "titanium", "brass")
VAGUE = ("miscellaneous goods for general use", "product item for commercial purposes", "assorted merchandise for import", "general commodity for trade")
SUBJECT_PREFIX = r"(?i)^(?:The tariff classification (?:and [^of]+ )?of |Classification of |Tariff classification of |RE:\s*The tariff classification of |RE:\s*)"
DESCRIPTION = (
    r"(?is)(?d)The subject (?:product|merchandise|item|article)s?\s*(?:,\s*\w+,?\s*)*(?:is|are|consists?|comprises?)\s+(.*?)(?=\n\s*\n|\nThe applicable)",
    r"(?is)(?d)The (?:product|merchandise|item|article)s?\s+(?:at issue|under consideration|in question)\s+(?:is|are)\s+(.*?)(?=\n\s*\n|\nThe applicable)",
    r"(?is)(?d)You (?:have submitted|describe|state that)\s+(.*?)(?=\n\s*\n|\nThe applicable)",
)
REASONING = (r"(?is)(?d)(The applicable (?:sub)?heading.*?which provides for\s*[\"']?.*?[\"']?\.)", r"(?is)(?d)(The applicable (?:sub)?heading.*?\.)\s")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value worked out once, however often the body mentions it.

    The optimizer writes a column's expression out wherever it is referred to; a lambda's variable it leaves alone.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def settled(df: DataFrame, **columns: Column) -> DataFrame:
    """df with further columns, each worked out once for a row, however often it is referred to afterwards.

    A generator of one row: the optimizer never writes an expression out across it, and it is compiled with what stands around it.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def present(c: Column) -> Column:
    """Neither null nor empty."""
    return F.coalesce(c != "", F.lit(False))


def stripped(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def words(c: Column) -> Column:
    """Split at runs of ASCII blanks, without empty ends."""
    return F.filter(F.split(c, r"[ \t\n\r\f\x0B]+"), lambda w: w != "")


def order_hash(key: Column, seed: int) -> Column:
    """A hex string to order by instead of a shuffle; the same in any engine with md5."""
    return F.md5(F.concat(F.lit(f"{seed}|"), key.cast("string")))


def bucket_hash(key: Column, seed: int) -> Column:
    """0 .. 2^32-1."""
    return F.conv(F.substring(order_hash(key, seed), 1, 8), 16, 10).cast("long")


def unit_hash(key: Column, seed: int) -> Column:
    """[0, 1)."""
    return bucket_hash(key, seed) / F.lit(4294967296.0)


def clean_subject(subject: Column) -> Column:
    """ST1: without boilerplate and one trailing period; the original if 10 or fewer characters remain."""
    s = stripped(F.regexp_replace(subject, SUBJECT_PREFIX, ""))
    s = F.when(F.endswith(s, F.lit(".")), stripped(F.substr(s, F.lit(1), F.greatest(F.length(s) - 1, F.lit(0))))).otherwise(s)
    return F.when(F.length(s) > 10, s).otherwise(stripped(subject))


def _first_long(text: Column, patterns: tuple[str, ...], longer_than: int) -> Column:
    def one(p: str) -> Column:
        hit = stripped(F.regexp_replace(F.replace(F.regexp_extract(text, p, 1), F.lit("\r"), F.lit("")), r"[ \t\n\r\f\x0B]+", " "))
        return F.when(F.length(hit) > longer_than, hit)

    return F.coalesce(*map(one, patterns))


def product_description(text: Column) -> Column:
    """ST2."""
    return _first_long(text, DESCRIPTION, 20)


def ruling_reasoning(text: Column) -> Column:
    """ST3."""
    return _first_long(text, REASONING, 30)


def clean_tier(text: Column) -> Column:
    """ST5: one line-feed style, no more than one blank line in a row, no correction notice."""
    t = F.regexp_replace(F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n")), r"(?i)^Correction to Ruling[^\n]*\n", "")
    return stripped(F.regexp_replace(t, r"\n{3,}", "\n\n"))


def without_materials(text: Column) -> Column:
    """ST14."""
    kept = F.array_join(F.filter(words(text), lambda w: ~F.btrim(F.lower(w), F.lit(",.;:")).isin(*MATERIALS)), " ")
    return F.when(F.length(kept) > 10, kept).otherwise(F.lit("product of unspecified composition"))


def first_words(text: Column, n: int = 3) -> Column:
    """ST15."""
    return F.concat(F.array_join(F.slice(words(text), 1, n), " "), F.lit("..."))


def gold_codes(answer: Column) -> Column:
    """ST26: dotted codes after the marker and before the reasoning, in order, each once."""
    region = F.regexp_extract(answer, r"(?is)(?d)HTS US Code\s*->\s*(.+?)(?:\n\s*Reasoning|$)", 1)
    return F.array_distinct(F.regexp_extract_all(region, F.lit(r"\b(\d{4}\.\d{2}\.\d{2,4})\b"), F.lit(1)))


def question_product(question: Column) -> Column:
    """ST27."""
    body = stripped(F.regexp_replace(question, r"(?i)^\s*what\s+is\s+the\s+hts\s*us\s+code\s+for\s+", ""))
    return F.rtrim(body, F.lit("?. \t"))
