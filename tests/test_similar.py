"""The similarity join against every pair of sets, and what it shuffles."""

import random

import pytest
from pyspark.sql import functions as F

from tariffspark.operators import normalize
from tariffspark.plans.catalog import _checkpoint


def sets_of(rng, rows):
    """Sets of few and many members, near each other and not, with members that most of them hold; copies; one of one member."""
    common, made = [rng.getrandbits(64) - 2**63 for _ in range(6)], []
    for _ in range(rows):
        if made and rng.random() < 0.6:
            old = set(rng.choice(made))
            for x in rng.sample(sorted(old), rng.randint(0, max(1, len(old) // 6))):
                old.discard(x)
            own = old | {rng.getrandbits(64) - 2**63 for _ in range(rng.randint(0, max(1, len(old) // 8)))}
        else:
            own = {rng.getrandbits(64) - 2**63 for _ in range(rng.choice([1, 2, 5, 9, 30, 120]))} | set(rng.sample(common, rng.randint(0, 6)))
        made.append(own or {0})
    return [(k, rng.sample(sorted(s), len(s))) for k, s in enumerate(made)]


def likeness(x, y):
    return len(set(x) & set(y)) / len(set(x) | set(y))


@pytest.mark.parametrize("often", [1, 4, 1000])
def test_every_pair(spark, often):
    """However many shingles count as frequent, the pairs are the same."""
    rows = sets_of(random.Random(often), 160)
    first = {}
    for k, s in rows:
        first.setdefault(frozenset(s), k)
    table = spark.createDataFrame(rows, "id long, sh array<long>").repartition(5)
    assert {r.id for r in normalize.first_ids(table).collect()} == set(first.values())
    for threshold in (0.5, 0.8):
        want = {(a, b): likeness(s, t) for s, a in first.items() for t, b in first.items() if a < b and likeness(s, t) >= threshold}
        found = normalize.similar_pairs(table, table, threshold, same=True, often=often).collect()
        assert len(found) == len(want) > 10 and {(r.a, r.b): r.jaccard for r in found} == want
    left, right = table.where("id % 3 = 0"), table.where("id % 3 > 0")
    least = lambda keep: {s: min(k for k, t in rows if keep(k) and frozenset(t) == s) for s in {frozenset(t) for k, t in rows if keep(k)}}
    want = {(a, b): likeness(s, t) for s, a in least(lambda k: k % 3 == 0).items() for t, b in least(lambda k: k % 3 > 0).items() if likeness(s, t) >= 0.8}
    found = normalize.similar_pairs(left, right, 0.8, same=False, often=often).collect()
    assert len(found) == len(want) > 10 and {(r.a, r.b): r.jaccard for r in found} == want


def test_leakage_of_copies(spark):
    """Copies count each, within a split and across; a row of no split counts nowhere."""
    rows = sets_of(random.Random(9), 150)
    split = ["train", "valid", "test", "other", None]
    table = spark.createDataFrame([(k, s, split[k % 5]) for k, s in rows], "id long, sh array<long>, split string")
    hit = [name for k, s in rows if (name := split[k % 5]) in ("valid", "test") and any(likeness(s, t) >= 0.85 for j, t in rows if j % 5 == 0)]
    assert {r.kind: r.n for r in normalize.leakage(table).collect()} == {f"{name}_vs_train": hit.count(name) for name in set(hit)} and len(set(hit)) == 2
    assert normalize.leakage(table.where("split <> 'train'")).count() == 0


def shuffled(spark, df):
    """Bytes that stages write to shuffles while df is collected."""
    store, gateway = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._gateway

    def written():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        stages = store.stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), gateway.jvm.java.util.ArrayList())
        return {(stages.apply(k).stageId(), stages.apply(k).attemptId()): stages.apply(k).shuffleWriteBytes() for k in range(stages.size())}

    before = written()
    df().collect()
    return sum(n for key, n in written().items() if key not in before)


@pytest.mark.parametrize("name", ["pairs", "fuzzy", "leakage"])
def test_sets_are_shuffled_once(spark, name):
    """All shuffles together have less than four times the bytes of the sets."""
    rng = random.Random(5)
    texts = [[str(rng.randrange(10**6)) for _ in range(400)] for _ in range(800)]
    texts += [[w if rng.random() > 0.01 else "x" for w in t] for t in texts[:100]]
    rows = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "id long, text string")
    sets = normalize.with_shingles(rows, "text").select("id", "sh")
    size = 8 * sets.agg(F.sum(F.size("sh"))).first()[0]
    split = F.when(F.col("id") % 2 == 0, "train").when(F.col("id") % 4 == 1, "valid").otherwise("test")
    run = {
        "pairs": lambda: normalize.similar_pairs(sets, sets, 0.8, same=True), "leakage": lambda: normalize.leakage(sets.withColumn("split", split)),
        "fuzzy": lambda: normalize.near_dedup(rows.withColumnsRenamed({"id": "seq", "text": "description"}), 0.8, _checkpoint(spark)).select("seq"),
    }
    assert shuffled(spark, run[name]) < 4 * size


@pytest.mark.parametrize("threshold", [0.5, 0.8])
def test_decisive_pairs(spark, threshold):
    """They are similar pairs, and greedy removal by them is that by all pairs."""
    rows = sets_of(random.Random(21), 200)
    first = {}
    for k, s in rows:
        first.setdefault(frozenset(s), k)
    gone = set()
    for s, k in first.items():
        if any(j < k and j not in gone and likeness(s, t) >= threshold for t, j in first.items()):
            gone.add(k)
    pairs = normalize.decisive_pairs(spark.createDataFrame(rows, "id long, sh array<long>").repartition(3), threshold)
    of = {k: s for s, k in first.items()}
    assert all(r.a < r.b and likeness(of[r.a], of[r.b]) >= threshold for r in pairs.collect())
    assert {r.id for r in normalize.greedy_keep(pairs, _checkpoint(spark)).collect()} == gone and len(gone) > 20


@pytest.mark.parametrize("name", ["fuzzy", "leakage"])
def test_near_copies_do_not_multiply(spark, name):
    """Near copies of one text: four times as many shuffle at most six times the bytes, not sixteen times."""
    rng = random.Random(6)
    base = [rng.getrandbits(64) - 2**63 for _ in range(300)]

    def run(copies):
        rows = [(k, [x if rng.random() > 0.03 else rng.getrandbits(64) - 2**63 for x in base]) for k in range(copies)]
        table = spark.createDataFrame(rows, "id long, sh array<long>").repartition(4)
        split = F.when(F.col("id") % 2 == 0, "train").otherwise("test")
        return shuffled(spark, lambda: normalize.decisive_pairs(table, 0.8) if name == "fuzzy" else normalize.leakage(table.withColumn("split", split)))

    assert run(400) < 6 * run(100)
