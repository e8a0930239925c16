"""Hierarchical codes: digit strings of 10, whose prefixes of 2, 4, 6 (and 8) are levels (CD1-CD14)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LEVELS = {"chapter": 2, "heading": 4, "subheading": 6, "exact": 10}


def cleaned(code: Column) -> Column:
    return F.translate(code, " \t\n\r\f\x0b.-", "")


#: What is a code once separators are gone.
CODE = "^[0-9]{4,10}$"


def is_valid(code: Column) -> Column:
    """CD3: 4 to 10 digits once separators are gone; null is not valid."""
    return F.coalesce(cleaned(code).rlike(CODE), F.lit(False))


def normalized(code: Column) -> Column:
    """CD1: padded on the right to 10 digits; longer ones as they are; null where there are no 4 digits."""
    return padded(cleaned(code))


def padded(cleaned: Column) -> Column:
    """CD1 of a code whose separators are gone."""
    return F.when(cleaned.rlike("^[0-9]{4,}$"), F.when(F.length(cleaned) <= 10, F.rpad(cleaned, 10, "0")).otherwise(cleaned))


def dotted(code: Column) -> Column:
    """CD2: XXXX.XX.XXXX of the first 10 digits."""
    c = normalized(code)
    return F.concat_ws(".", F.substring(c, 1, 4), F.substring(c, 5, 2), F.substring(c, 7, 4))


def prefix(code: Column, digits: int) -> Column:
    """CD4: the level of a code."""
    return F.substring(normalized(code), 1, digits)


def hierarchy(code: Column) -> Column:
    """CD5."""
    return F.struct(*[prefix(code, n).alias(name) for name, n in LEVELS.items()])


def matches(predicted: Column, actual: Column, level: str) -> Column:
    """CD6: equal at the level after padding; an invalid side matches nothing."""
    return F.coalesce(prefix(predicted, LEVELS[level]) == prefix(actual, LEVELS[level]), F.lit(False))


def digits(code: Column) -> Column:
    return F.regexp_replace(code, "[^0-9]", "")


def digit_prefix(code: Column, n: int) -> Column:
    """CD7: no padding, so a shorter code never equals a longer level."""
    return F.substring(digits(code), 1, n)


def index_code(code: Column) -> Column:
    """CD8: at least 8 digits without dots, cut or padded to 10; else null."""
    c = F.btrim(F.replace(code, F.lit("."), F.lit("")))
    return F.when(c.rlike("^[0-9]{8,}$"), F.rpad(c, 10, "0"))


def agrees_with_any(code: Column, tariffs: Column) -> Column:
    """CD11: the first 8 digits of either start the other."""
    c = F.replace(code, F.lit("."), F.lit(""))

    def pair(t: Column) -> Column:
        d = F.replace(t, F.lit("."), F.lit(""))
        return d.startswith(F.substring(c, 1, 8)) | c.startswith(F.substring(d, 1, 8))

    return F.coalesce(F.exists(tariffs, pair), F.lit(False))


def canonical_level(code: Column, head: int, total: int) -> Column:
    """CD12: a dot after `head` digits, where there is none and there are `total` digits."""
    return F.when(~F.contains(code, F.lit(".")) & (F.length(code) >= total), F.concat(F.substring(code, 1, head), F.lit("."), F.substring(code, head + 1, 2))).otherwise(code)


def backfilled(chapter: Column, heading: Column, subheading: Column, code: Column) -> Column:
    """CD13: struct of levels, each missing one taken from the nearest below."""
    bare = lambda c: F.coalesce(F.replace(c, F.lit("."), F.lit("")), F.lit(""))
    some = lambda c: F.nullif(c, F.lit(""))
    d = bare(code)
    sub = F.coalesce(some(subheading), F.when(F.length(d) >= 6, F.concat(F.substring(d, 1, 4), F.lit("."), F.substring(d, 5, 2))))
    s = F.coalesce(some(bare(sub)), d)
    head = F.coalesce(some(heading), F.when(F.length(s) >= 4, F.concat(F.substring(s, 1, 2), F.lit("."), F.substring(s, 3, 2))))
    h = F.coalesce(some(bare(head)), some(bare(sub)), d)
    chap = F.coalesce(some(chapter), F.when(F.length(h) >= 2, F.substring(h, 1, 2)))
    return F.struct(chap.alias("chapter_code"), head.alias("heading_code"), sub.alias("subheading_code"))


def consistent(chapter: Column, heading: Column, subheading: Column, code: Column) -> Column:
    """CD14: every level that is present agrees with the full code."""
    return agreeing(chapter, heading, subheading, normalized(code))


def agreeing(chapter: Column, heading: Column, subheading: Column, n: Column) -> Column:
    """CD14 of a normalised code."""
    bare = lambda c: F.replace(c, F.lit("."), F.lit(""))
    gone = lambda c: c.isNull() | (c == "")
    same_chapter = F.ltrim(chapter, F.lit("0")) == F.ltrim(F.substring(n, 1, 2), F.lit("0"))
    return F.coalesce((gone(chapter) | same_chapter) & (gone(heading) | (bare(heading) == F.substring(n, 1, 4))) & (gone(subheading) | (bare(subheading) == F.substring(n, 1, 6))), F.lit(False))
