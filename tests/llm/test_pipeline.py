"""The pipeline's stages one by one, and as a whole against a plain-Python version of what can be said plainly."""

import random

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

RNG = random.Random(11)
WORDS = [f"{a}{b}{c}" for a in ("sa", "te", "li", "mo", "ru") for b in ("n", "r", "l", "st") for c in ("a", "e", "io", "u")]
CLASHING = "_key _hash _spans copies doc row key own text_hash salt part plan size found h k id component_id kept toxic spans base".split()


def prose(n):
    return " ".join(RNG.choice(WORDS) for _ in range(n))


BASE = [prose(120) for _ in range(12)]
BASE[0] += " write to some.one@mail.example.com or 10.1.2.3"
TOXIC = [prose(30) + f" {RNG.choice(('vilest', 'grimest', 'foulest'))} " + prose(30) for _ in range(40)]


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    """documents with planted cases, and labels, in a folder."""
    rows = [(i, t) for i, t in enumerate(TOXIC + [prose(60) for _ in range(40)])]
    rows += [(100 + i, t) for i, t in enumerate(BASE)]
    copy = BASE[1].split()
    copy[50] = "changed"
    rows += [(200, BASE[2]), (201, " ".join(copy)), (202, None), (203, ""), (204, " \n"), (None, TOXIC[0]), (None, "a short clean one"), (205, "x" * 60_000 + " " + prose(3000)), (206, "twice"), (206, "twice"), (207, BASE[3]), (207, TOXIC[1])]
    docs = spark.createDataFrame([(i, t, "en", f"s{k % 3}" if k % 5 else None, len(t or ""), "x") for k, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long, extra string")
    docs = docs.select("*", *[F.lit(c).alias(c) for c in CLASHING])
    labels = spark.createDataFrame([(i, 1, int(i < 40)) for i in range(80)] + [(None, 1, 1)], "doc_id long, quality int, toxic int")
    path = str(tmp_path_factory.mktemp("world"))
    docs.repartition(3).write.parquet(f"{path}/documents.parquet")
    labels.write.parquet(f"{path}/labels.parquet")
    return spark.read.parquet(f"{path}/documents.parquet"), path, rows


def plain(df):
    return sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in df.collect())


def want(rows):
    return sorted((i is None, i or 0, t or "") for i, t in rows)


def test_toxic_rows_go_by_their_own_text(spark, world):
    docs, path, rows = world
    left = corpus_pipeline.drop_toxic(spark, docs, path)
    assert left.columns == docs.columns
    assert plain(left) == want([(i, t) for i, t in rows if t not in TOXIC])


def test_one_row_of_each_group_stays(spark, world):
    docs, path, rows = world
    left = corpus_pipeline.drop_near_duplicates(spark, docs, path)
    assert left.columns == docs.columns
    found = {(r.doc_id, r.text) for r in left.collect()}
    gone = [(i, t) for i, t in rows if (i, t) not in found]
    assert sorted(i for i, _ in gone) == [0, 200, 201, 207, 207] or sorted(i for i, _ in gone if i is not None) == [0, 1, 200, 201, 207]
    assert left.where("doc_id = 206").count() == 1 and left.where("doc_id in (202, 203, 204)").count() == 3


def test_redaction_keeps_other_columns(spark, world):
    docs, path, rows = world
    done = corpus_pipeline.redact_personal_data(spark, docs, path)
    assert done.columns == docs.columns and done.count() == len(rows)
    row = done.where("doc_id = 100").first()
    assert row.text.endswith("write to <email> or <ip>") and row.n_chars == len(row.text) and row._key == "_key"
    assert done.where("doc_id = 202").first().text is None
    same = [(i, t) for i, t in rows if i != 100]
    assert plain(done.where("doc_id is null or doc_id <> 100")) == want(same)


def test_mix_emits_whole_rows(spark, world):
    docs, path, rows = world
    mixed = corpus_pipeline.mix_sources(spark, docs, path)
    assert mixed.columns == docs.columns
    texts = {t or "" for _, t in rows}
    counts = {}
    for r in mixed.collect():
        assert (r.text or "") in texts and r.copies == "copies"
        counts[r.doc_id, r.text, r.source] = counts.get((r.doc_id, r.text, r.source), 0) + 1
    assert all(n <= 4 for n in counts.values())  # at most twice for each of two equal rows


def test_whole_pipeline(spark, world):
    docs, path, rows = world
    out = corpus_pipeline.run(spark, path)
    again = corpus_pipeline.run(spark, path)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(map(tuple, again.collect()), key=repr)
    assert {r.doc_id for r in out.collect()}.isdisjoint(range(40))


def test_empty_tables(spark, world, tmp_path):
    docs, _, _ = world
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
