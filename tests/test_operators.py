"""Literal cases and small models of operators that SQL cannot say."""

import random

from pyspark.sql import functions as F

from tariffspark.functions import codes, text
from tariffspark.operators import chat, normalize, score
from tariffspark.plans.catalog import _checkpoint


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_codes(spark):
    c = F.lit
    assert one(spark, codes.normalized(c("0101")), codes.dotted(c("0101")), codes.is_valid(c("01AB.21.0010")), codes.is_valid(c("01")), codes.normalized(c("12345678901"))) == ("0101000000", "0101.00.0000", False, False, "12345678901")
    assert one(spark, codes.matches(c("8544.30"), c("8544300000"), "exact"), codes.matches(c("0201.30.0000"), c("0202300000"), "chapter"), codes.matches(c("0201.30.0000"), c("0202300000"), "heading")) == (True, True, False)
    assert one(spark, codes.consistent(c("73"), c(None), c(None), c("8544300000")), codes.consistent(c("1"), c("01.01"), c(""), c("0101210010"))) == (False, True)


def test_parse(spark):
    def parsed(s):
        return one(spark, chat.parsed(F.lit(s)))[0]

    p = parsed("Chapter 61: Knits\nSubheading 6110.11: Sweaters\nHTS Code: 6110.11.0015\nReasoning: it is\nwool\nProvides for: Sweaters")
    assert (p.heading_code, p.heading_desc, p.reasoning, p.provides_for, p.parse_ok) == ("61.10", None, "it is\nwool", "Sweaters", True)
    assert parsed("Heading 6110: x\nSubheading 854430: y").heading_code == "61.10"
    for bad in ("", "garbage", "<think>\n</think>", "Chapter 1: x"):
        assert not parsed(bad).parse_ok
    assert parsed("<think>\n</think>\n\nCannot classify: too vague").abstention_reason == "too vague"


def test_corruption(spark):
    assert one(spark, text.without_materials(F.lit("a Steel, bolt for wood doors")), text.without_materials(F.lit("steel bolt")), text.first_words(F.lit("a b c d"))) == ("a bolt for doors", "product of unspecified composition", "a b c...")


def test_greedy_chain(spark):
    """A~B, B~C, not A~C: A and C stay. And random graphs against a loop."""
    rng = random.Random(1)
    for edges in ([(1, 2), (2, 3)], *[sorted({tuple(sorted(rng.sample(range(12), 2))) for _ in range(14)}) for _ in range(2)]):
        kept = set()
        for node in sorted({x for e in edges for x in e}):
            if not any(b == node and a in kept for a, b in edges):
                kept.add(node)
        dropped = {r[0] for r in normalize.greedy_keep(spark.createDataFrame(edges, "a int, b int"), _checkpoint(spark)).collect()}
        assert dropped == {x for e in edges for x in e} - kept


def test_flags_of_odd_codes(spark):
    """Short, long, spaced and invalid codes on both sides, several or no gold codes, against a plain version."""
    rng = random.Random(4)
    pool = ["8544.30", "8544300000", "85443000001", "85", "85 44", "abc", "", "0101", "01.01.21", "8544-30-99 10", "8544309910", "9", "0101210010"]

    def norm(c):
        c = "".join(x for x in c or "" if x not in " \t\n\r\f\x0b.-")
        return c.ljust(10, "0") if c.isdigit() and len(c) >= 4 else None

    rows, want, chapters = [], {}, {}
    for k in range(500):
        pred, golds = rng.choice([None, *pool]), rng.choice([None, [], [rng.choice(pool)], [rng.choice([None, *pool]) for _ in range(3)]])
        rows.append((k, golds, False, True, True, False, pred))
        own = norm(pred) if norm(pred) and len(norm(pred)) == 10 else None
        valid = [norm(g) for g in golds or [] if norm(g)]
        first = norm(golds[0]) if golds and golds[0] else None
        want[k] = (own is not None, *[own is not None and any(g[:n] == own[:n] for g in valid) for n in (10, 2, 4, 6)])
        if first:
            chapters[first[:2]] = chapters.get(first[:2], 0) + 1
    preds = spark.createDataFrame(rows, "seq int, gold array<string>, gold_abstain boolean, parse_ok boolean, pred_present boolean, pred_abstain boolean, pred string")
    found = {r.seq: r.flags for r in score.flagged(preds).collect()}
    assert {k: (f.valid, f.hit_exact, f.hit_chapter, f.hit_heading, f.hit_subheading) for k, f in found.items()} == want
    assert {r.chapter: r.total for r in score.by_chapter(score.flagged(preds)).collect()} == chapters


def test_greedy_components(spark):
    """Random graphs against a loop, whole and in rounds; a path of 3,000 rows is settled whole."""
    rng = random.Random(8)
    for whole in (1_000, 3):
        edges = sorted({tuple(sorted(rng.sample(range(60), 2))) for _ in range(45)})
        dropped = set()
        for a, b in sorted(edges, key=lambda e: (e[1], e[0])):
            if a not in dropped:
                dropped.add(b)
        pairs = spark.createDataFrame(edges, "a long, b long")
        assert {r.id for r in normalize.greedy_keep(pairs, _checkpoint(spark), whole).collect()} == dropped
        reach = {r.id: r.component for r in normalize.components(pairs, _checkpoint(spark)).collect()}
        least = {x: x for e in edges for x in e}
        for _ in edges:
            for a, b in edges:
                least[a] = least[b] = min(least[a], least[b])
        assert reach == least
    rounds = []

    def counted(df):
        rounds.append(1)
        return _checkpoint(spark)(df)

    path = spark.range(2_999).selectExpr("id as a", "id + 1 as b")
    assert {r.id for r in normalize.greedy_keep(path, counted).collect()} == set(range(1, 3_000, 2))
    assert len(rounds) < 22
    assert normalize.greedy_keep(path.limit(0), _checkpoint(spark)).count() == 0
