"""Each operator on empty tables, and on nulls, repeated rows, long texts and columns with clashing names."""

import public_tokenizers as tokenizers
import pytest
from pyspark.sql import functions as F

from tariffspark.llm import alignment, byte_bpe, embedding_dedup, minhash_dedup, mixing, pii, piece_codec, piece_counts, quality_classifier, quality_rules, spelling, toxicity, warc

LONG = "word " * 20_000 + "a" * 50_000
TEXTS = [(1, None), (2, ""), (3, "one two three four five six"), (3, "one two three four five six"), (None, "one two three four five six"), (4, LONG), (5, " \n\t"), (6, "mail a.b@c.example.com now"), (6, "another text of the same id")]
CLASHING = "key own_key text_hash set_a salt part size plan toxic score n_tokens ids kept found spans base label embedding_ rep weight cell side payload sha1 captured chunk place a b n times word run id".split()

OPERATORS = {
    "pii": lambda d, _: pii.digest(pii.find(d)),
    "piece_counts": lambda d, _: piece_counts.count_tokens(d, tokenizers.path("piece_bpe_32k.model"), 4096),
    "byte_bpe": lambda d, _: byte_bpe.round_trip(d, tokenizers.path("byte_bpe_50k.tiktoken"), tokenizers.PATTERN),
    "mixing": lambda d, _: mixing.mix(d),
    "emit": lambda d, _: mixing.emit(d),
    "minhash": lambda d, _: minhash_dedup.near_duplicates(d),
    "pieces": lambda d, _: piece_codec.round_trip(d, tokenizers.path("piece_bpe_32k.model")),
    "alignment": lambda d, _: alignment.aligned(d, tokenizers.path("byte_bpe_50k.json"), tokenizers.PATTERN, tokenizers.path("piece_bpe_32k.model")),
    "rules": quality_rules.filter_quality,
    "toxicity": toxicity.classify,
    "quality": quality_classifier.classify,
}
LABELS = "doc_id long, quality int, toxic int"


def documents(spark, rows):
    d = spark.createDataFrame([(i, t, f"s{(i or 0) % 2}") for i, t in rows], "doc_id long, text string, source string")
    return d.select("*", *[F.lit(c).alias(c) for c in CLASHING]).repartition(3)


@pytest.mark.parametrize("name", OPERATORS)
def test_documents(spark, name):
    labels = spark.createDataFrame([(3, 1, 0), (4, 0, 1), (6, 1, 1), (6, 1, 1), (None, 1, 1), (99, 0, 0)], LABELS)
    out = OPERATORS[name](documents(spark, TEXTS), labels)
    rows = out.collect()
    if name != "emit":
        assert len(rows) == len(TEXTS) and sorted(map(str, (r.doc_id for r in rows))) == sorted(str(i) for i, _ in TEXTS)
        twins = [r for r in rows if r.doc_id == 3]
        assert twins[0] == twins[1]  # repeated rows are treated alike
    empty = OPERATORS[name](documents(spark, []), spark.createDataFrame([], LABELS))
    assert empty.columns == out.columns and empty.count() == 0
    # labels without documents, documents without labels
    assert OPERATORS[name](documents(spark, TEXTS[2:4]), spark.createDataFrame([], LABELS)).count() == (2 if name != "emit" else OPERATORS["emit"](documents(spark, TEXTS[2:4]), None).count())


def test_minhash_keys(spark):
    """A key with two texts links both; null keys link nothing; keys may be strings."""
    base = " ".join(f"w{i}" for i in range(80))
    other = " ".join(f"v{i}" for i in range(80))
    rows = [("e", base), ("e", other), ("f", other + " x"), ("g", base + " x"), (None, base), (None, None), ("h", ""), ("h", base + " y")]
    found = minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id string, text string").repartition(4), size=3, percent=85).collect()
    assert sorted((str(r.doc_id), str(r.component_id), r.kept) for r in found) == sorted([("None", "None", True)] * 2 + [("e", "e", True)] * 2 + [("f", "e", False), ("g", "e", False), ("h", "e", False), ("h", "e", False)])


def test_personal_data_in_long_texts(spark):
    """Many hits in one text; places are code points."""
    text = "é" + " ".join(f"u{i}@mail.example.com and" for i in range(6000))
    docs = spark.createDataFrame([(1, text), (1, text), (2, "x" * 100_000 + " 1.2.3.4 " + "9" * 100_000)], "doc_id long, text string")
    found = pii.find(docs)
    rows = pii.digest(found).collect()
    assert [(r.doc_id, r.n_email, r.n_ip) for r in sorted(rows, key=lambda r: r.doc_id)] == [(1, 6000, 0), (1, 6000, 0), (2, 0, 1)]
    last = next(r.spans for r in rows if r.doc_id == 1).split(",")[-1]
    a, b = map(int, last.split(":")[1:])
    assert text[a:b] == "u5999@mail.example.com"
    redacted = pii.redact(docs, found).where("doc_id = 1").collect()
    assert len(redacted) == 2 and {r.text for r in redacted} == {"é" + " ".join(["<email> and"] * 6000)}


def test_bootstrapping(spark):
    """Accepted instances vouch for further patterns; numbers that fail a check are not accepted by context."""
    seeds = [f"contact desk via person{i}@mail.example.com today" for i in range(20)]
    first = [f"contact desk via person{i}(at)mail{i}example please" for i in range(20)]  # found by the seeds' words before
    second = ["kindly use someone(at)host99 please", "kindly use other(at)host98 please"]  # found by the word after those
    cards = [f"card number 4111 1111 1111 1{k:03d} ends" for k in range(60)]
    rows = list(enumerate([*seeds, *first, *second, *cards, "version 12.4 of 2019 please"]))
    out = {r.doc_id: r for r in pii.digest(pii.find(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert all(out[i].spans.startswith("email:") and out[i].n_email == 0 for i in range(20, 42))
    assert pii.digest(pii.find(spark.createDataFrame(rows, "doc_id long, text string"), rounds=1)).where("doc_id in (40, 41) and spans <> ''").count() == 0
    for i in range(42, 102):
        assert (out[i].spans != "") == (out[i].n_card == 1)
    assert out[102].spans == ""


def test_pages(spark):
    rows = [(1, None, None), (2, "http://a/", ""), (None, "http://a/", ""), (3, "http://a/", "p"), (3, "http://a/", "p"), (4, None, "p"), (5, "http://b/" + "x" * 5000, "q" * 300_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").select("*", *[F.lit(c).alias(c) for c in CLASHING if c != "captured"])
    found = warc.archive(pages.repartition(3), per_range=2).collect()
    assert sorted((str(r.page_id), r.payload_bytes, r.record_type, str(r.refers_to)) for r in found) == sorted(
        [("1", 0, "response", "None"), ("2", 0, "revisit", "1"), ("None", 0, "response", "None"), ("3", 1, "response", "None"), ("3", 1, "response", "None"), ("4", 1, "revisit", "3"), ("5", 300_000, "response", "None")]
    )
    assert warc.archive(pages.limit(0)).count() == 0


def test_vectors(spark):
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [1.0, 0.001], 1), (3, [], 1), (4, None, None), (5, [0.0, 0.0], 1), (6, [1.0], 1), (7, [1.0, 0.0], 2), (None, [1.0, 0.0], 1)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").select("*", *[F.lit(c).alias(c) for c in CLASHING if c != "label"])
    found = embedding_dedup.near_duplicates(vectors).collect()
    assert len(found) == len(rows)
    assert sorted((str(r.vec_id), r.component_id, r.kept) for r in found if r.vec_id is not None) == sorted([("1", 1, True), ("1", 1, True), ("2", 1, False), ("3", 3, True), ("4", 4, True), ("5", 5, True), ("6", 6, True), ("7", 7, True)])
    assert embedding_dedup.near_duplicates(vectors.limit(0)).count() == 0


def test_spelling(spark):
    """Repeated rows count each; a word of 50,000 letters is a word like others; without words there is nothing."""
    rows = [(k, f"{LONG} spelling spellings") for k in (1, 1, 2, 3, 4)] + [(5, None), (6, ""), (None, "spelling " * 21)]
    found = {r.word: (r.n, r.form, r.root, r.n_near) for r in spelling.grouped(documents(spark, rows), every=1 << 40).collect()}
    assert found == {"a" * 50_000: (5, None, "a" * 50_000, 0), "spelling": (26, None, "spelling", 1), "spellings": (5, "spelling", "spelling", 1)}
    assert spelling.grouped(documents(spark, rows[5:7])).count() == 0 and spelling.grouped(documents(spark, [])).count() == 0


def test_pieces_decode(spark):
    coded = piece_codec.encode(documents(spark, TEXTS), tokenizers.path("piece_bpe_32k.model"))
    back = piece_codec.decode(coded, tokenizers.path("piece_bpe_32k.model")).collect()
    assert sorted((str(r.doc_id), r.decoded) for r in back) == sorted((str(i), t or "") for i, t in TEXTS)


@pytest.mark.parametrize("decoded", [False, True])
def test_byte_bpe_reuses_words_that_were_chunks(decoded):
    """A word that was a chunk by itself is not contracted again where punctuation follows; its ids are those of a new codec."""
    make = lambda: byte_bpe.Codec(tokenizers.path("byte_bpe_50k.tiktoken"), tokenizers.PATTERN, decoded)
    used, contracted = make(), []
    plain = used._contract
    used._contract = lambda words, raws: contracted.extend(words) or plain(words, raws)
    used.encode(["zqxv zqxvkjw ézqxvkjw  \t zqxvkjw"])
    assert " zqxvkjw" in contracted
    contracted.clear()
    later = ["zqxv zqxvkjw, zqxvkjw. zqxvkjw;\t \n  zqxvkjw! ézqxvkjw?"]
    assert used.encode(later) == make().encode(later) and " zqxvkjw" not in contracted
