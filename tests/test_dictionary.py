"""The dictionary join against one alternation of all terms, tried by Python's matcher from left to right."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from tariffspark.operators import dictionary


def by_pattern(text, terms):
    pattern = r"\b(" + "|".join(re.escape(t) for t in sorted(terms, key=lambda t: (-len(t), t))) + r")\b"
    return list(dict.fromkeys(re.findall(pattern, text.lower(), re.ASCII)))


def test_random_texts(spark):
    rng = random.Random(3)
    pieces = ["bolt", "nut", "Steel", "bolt-nut", " ", " ", " ", "-", ".", "é", "$5", "x_1", "\n", "STEEL BOLT", "of", "ﬁn"]
    texts = [(k, "".join(rng.choice(pieces) for _ in range(rng.randint(0, 40)))) for k in range(300)] + [(300, None), (301, "")]
    terms = ["bolt", "steel bolt", "bolt nut", "nut", "bolt-nut", "nut.bolt", "x_1", "$5", "é bolt", "bolt é", "nut - nut", "steel bolt nut", "-nut", "of", "5bolt"]
    known = {t for t in terms if len(t) >= 3}
    items = spark.createDataFrame(texts, "seq long, description string").repartition(3)
    glossary = spark.createDataFrame([(t.upper(), f"on {t}") for t in terms] + [("bolt", "z later")], "term string, definition string")
    found = {r.seq: r.found for r in dictionary.matches(items, dictionary.terms_of(glossary)).collect()}
    want = {k: by_pattern(t or "", known) for k, t in texts}
    assert found == {k: w for k, w in want.items() if w} and len(found) > 200
    defined = {r.seq: r.terms for r in dictionary.glossary_defined(items, glossary, 2).collect()}
    order = lambda t: hashlib.md5(f"42|{t}".encode()).hexdigest()
    assert {k: [(x.term, x.definition) for x in v] for k, v in defined.items()} == {k: [(t, f"on {t}") for t in sorted(w, key=order)[:2]] for k, w in want.items()}
    assert all(r.terms == [] for r in dictionary.glossary_matches(items, glossary.limit(0)).collect())


def test_many_terms_are_joined(spark):
    """300,000 terms, none of them on the driver; without a broadcast the join is one of two shuffled sides."""
    terms = spark.range(300_000).select(F.concat(F.lit("part "), F.col("id"), F.when(F.col("id") % 3 == 0, " of steel").otherwise("")).alias("term"))
    items = spark.range(2_000).select(F.col("id").alias("seq"), F.concat(F.lit("one Part "), F.col("id") * 7, F.lit(" of steel, part of part "), F.col("id")).alias("description"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = {r.seq: r.found for r in dictionary.matches(items, dictionary.terms_of(terms)).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    want = {}
    for k in range(2_000):
        first = [f"part {7 * k} of steel"] if k % 3 == 0 else [f"part {7 * k}"]
        second = [] if k % 3 == 0 else [f"part {k}"]
        want[k] = list(dict.fromkeys(first + second))
    assert found == {k: w for k, w in want.items() if w}


def test_words_are_met_in_compiled_code(spark):
    """No lambda, which would be interpreted for every word of a text, stands below the join with the terms."""
    items = spark.createDataFrame([(k, "a Steel bolt, of steel") for k in range(20)], "seq long, description string")
    found = dictionary.matches(items, dictionary.terms_of(spark.createDataFrame([("steel",), ("steel bolt",)], "term string")))
    assert {tuple(r.found) for r in found.collect()} == {("steel bolt", "steel")}
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "xxhash64" in plan and not [line for line in plan[plan.index("Join") :].splitlines() if "lambda" in line]
