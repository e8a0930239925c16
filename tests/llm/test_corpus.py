"""Operators against brute force, exact libraries or planted cases, on small tables with nulls, empties, ties and repeated rows."""

import base64
import hashlib
import random
import re
import struct

import public_tokenizers as tokenizers
import pytest
import sentencepiece
import tiktoken
from pyspark.sql import functions as F

from tariffspark.llm import byte_bpe, components, embedding_dedup, minhash_dedup, mixing, pii, piece_counts, quality_classifier, quality_rules, toxicity, warc

RNG = random.Random(5)
BITS = ["a", "b", " ", "  ", "\n", "\t", "é", "中", "1", "'s", "▁", "\x1c", "\x85", "\xa0", "😀", "\r", ".", "<|endoftext|>", "<s>", "the", " and"]
TEXTS = [None, "", " ", "  a", "a ", "x" * 900, " " * 700, "ab" * 400, "中文" * 300, *["".join(RNG.choice(BITS) for _ in range(RNG.randint(1, 50))) for _ in range(300)]]
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, f"s{i % 3}" if i % 7 else None, "extra") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, rows[5], (None, "no id", "s1", "extra")], "doc_id long, text string, source string, n_tokens string").repartition(3)


def test_token_counts(docs):
    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizers.path("piece_bpe_32k.model"))
    found = piece_counts.count_tokens(docs, tokenizers.path("piece_bpe_32k.model"), 100).collect()
    assert len(found) == len(TEXTS) + 2
    for r in found:
        t = "no id" if r.doc_id is None else TEXTS[r.doc_id] or ""
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(t.encode()), len(sp.encode(t)), len(sp.encode(t)) > 100)


def test_byte_bpe(docs):
    path = tokenizers.path("byte_bpe_50k.tiktoken")
    enc = tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={})
    for r in byte_bpe.round_trip(docs, path, tokenizers.PATTERN).collect():
        t = "no id" if r.doc_id is None else TEXTS[r.doc_id] or ""
        ids = enc.encode_ordinary(t)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
    coded = byte_bpe.encode(docs, path, tokenizers.PATTERN)
    for r in byte_bpe.decode(coded, path, tokenizers.PATTERN).collect():
        assert bytes(r.decoded) == ("no id" if r.doc_id is None else TEXTS[r.doc_id] or "").encode()


def shingles(t, n):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) or (frozenset([tuple(w)]) if w else frozenset())


def least(ids, links):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def test_minhash(spark):
    vocabulary = [f"w{i}" for i in range(400)]
    base = [[RNG.choice(vocabulary) for _ in range(120)] for _ in range(4)]
    texts = [None, "", "one", "one two", "One TWO"]
    for b in base:
        for k in range(30):  # near copies of growing distance, some linked only through others
            w = list(b)
            for _ in range(k // 3):
                w[RNG.randrange(len(w))] = RNG.choice(vocabulary)
            texts.append(" ".join(w))
    rows = [(i, t) for i, t in enumerate(texts)]
    found = minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), size=3, percent=85).collect()
    sets = {i: shingles(t, 3) for i, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    want = least(sets, links)
    assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found} == {(i, len(s), want[i], want[i] == i) for i, s in sets.items()}
    assert minhash_dedup.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_embeddings(spark):
    rows, i = [], 0
    for label in (1, 2, None):
        for _ in range(15):
            centre = [RNG.gauss(0, 1) for _ in range(16)]
            for _ in range(4):
                rows.append((i, [x + RNG.gauss(0, 0.12) for x in centre], label))
                i += 1
    rows += [(i, None, 1), (i + 1, [0.0] * 16, 1), (i + 2, [float("nan")] * 16, 1), (i + 3, [1.0] * 15 + [None], 2), (i + 4, rows[0][1], 1), (i + 5, [3 * x for x in rows[0][1]], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    sound = {v: (x, lab) for v, x, lab in rows if lab and x and None not in x and any(x) and not any(c != c for c in x)}
    cos = lambda x, y: sum(a * b for a, b in zip(x, y)) / (sum(a * a for a in x) * sum(b * b for b in y)) ** 0.5
    links = [(a, b) for a in sound for b in sound if a < b and sound[a][1] == sound[b][1] and cos(sound[a][0], sound[b][0]) >= 0.98]
    want = least([r[0] for r in rows], links)
    for pivots in (1024, 8):  # one cell a label; many cells
        embedding_dedup.PER_PIVOT, keep = pivots, embedding_dedup.PER_PIVOT
        found = {(r.vec_id, r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(df).collect()}
        embedding_dedup.PER_PIVOT = keep
        assert found == {(v, sum(v in e for e in links), want[v]) for v in want}


def test_components(spark):
    edges = [(RNG.randrange(200), RNG.randrange(200)) for _ in range(150)] + [(500, k) for k in range(501, 560)]
    want = least({x for e in edges if e[0] != e[1] for x in e}, edges)
    assert {tuple(r) for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()} == set(want.items())


def test_mixing(docs):
    found = mixing.mix(docs).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(map(tuple, mixing.mix(docs).collect()), key=repr)
    sizes, taken, target = {}, {}, {}
    source = lambda i: "s1" if i is None else f"s{i % 3}" if i % 7 else None
    for r in found:
        s = source(r.doc_id)
        assert r.size == len(WORD.findall("no id" if r.doc_id is None else TEXTS[r.doc_id] or "")) and r.taken <= 2 * r.size
        sizes[s], taken[s], target[s] = sizes.get(s, 0) + r.size, taken.get(s, 0) + r.taken, r.target
    level = lambda x: {s: min(2 * sizes[s], x * w) for s, w in zip(("s0", "s1", "s2", None), (3, 1, 2, 3))}
    low, high = 0.0, 1e9
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(level(mid).values()) < 1.5 * sum(sizes.values()) else (low, mid)
    for s, t in level(low).items():
        assert abs(target[s] - t) < 1e-3 and abs(taken[s] - t) < 0.1 * t


def test_warc(spark):
    rows = [(i, f"http://h{i % 4}.example.com/{i % 6}?q#f" if i % 9 else None, None if i % 11 == 0 else f"page {i % 25} é") for i in range(80)]
    found = warc.archive(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5), per_range=30).collect()
    assert [(r.url_key, r.captured, r.page_id) for r in found] == sorted((r.url_key, r.captured, r.page_id) for r in found)
    first = {}
    for i, _, h in rows:
        first.setdefault(h or "", i)
    want = {(i, len((h or "").encode()), base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode(), first[h or ""] if first[h or ""] != i else None) for i, _, h in rows}
    assert {(r.page_id, r.payload_bytes, r.payload_digest, r.refers_to) for r in found} == want
    for k in range(7):
        runs = [sorted(RNG.randrange(9) for _ in range(RNG.randrange(6))) for _ in range(k)]
        assert list(warc.loser_tree(runs, lambda x: x)) == sorted(x for r in runs for x in r)


def test_pii(spark):
    base = ["mail a.b@c.example.com.", "a@b.c_d@e.f and 1.2.3.4.5.6.7.8", "300.1.1.1 10.0.0.255", "card 4111 1111 1111 1111 or 4111-1111-1111-1112", "+1 (988) 555-2485 x", "é 4111111111111111", None, "", "7" * 5000]
    seeds = [f"please write to user{i}@mail.example.com thanks {i}" for i in range(30)]
    planted = "please write to someone-at-123456-mail thanks now"
    rows = list(enumerate([*base, *seeds, planted]))
    out = {r.doc_id: r for r in pii.digest(pii.find(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert [out[i].spans for i in range(len(base))] == ["email:5:22", "email:0:5,email:5:11,ip:16:23,ip:24:31", "ip:10:20", "card:5:24", "phone:0:17", "card:2:18", "", "", ""]
    assert out[0].n_email == 1 and out[2].n_ip == 1 and out[6].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert out[len(rows) - 1].spans == "email:16:38" and out[len(rows) - 1].n_email == 0  # found by its context
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("source", F.lit("s"))
    assert {r.doc_id: r.text for r in pii.redact(docs, pii.find(docs)).collect()}[0] == "mail <email>."


def prose(n):
    return " ".join(RNG.choice(("the river runs slowly past old stone houses while people talk about weather and bread in quiet voices near market").split()) for _ in range(n))


def test_quality_rules():
    texts = ["a b c a b c d", "x\nx\n\nx y", "", "#a $b|", "one two", "é é é é"]
    m = quality_rules.measure(texts).counts
    assert m["n_words"].tolist() == [7, 4, 0, 2, 2, 4] and m["n_repeat_words"].tolist() == [6, 0, 0, 0, 0, 4] and m["n_dup_lines"].tolist() == [0, 1, 0, 0, 0, 0]
    assert m["word_chars"].tolist() == [7, 4, 0, 5, 6, 4] and m["n_symbols"].tolist() == [0, 0, 0, 3, 0, 0]
    good, bad = ["\n".join(prose(40) + "." for _ in range(4)) for _ in range(40)], ["\n".join("MENU | " * 8 + prose(3).upper() + "!!" for _ in range(5)) for _ in range(40)]
    field = quality_rules.fit(good[:30], bad[:30])
    assert quality_rules.judge(good[30:], field)["kept"].all() and not quality_rules.judge(bad[30:], field)["kept"].any()


def test_classifiers():
    good, bad = [prose(80) for _ in range(60)], [prose(60).upper() + "!!" for _ in range(60)]
    a, b = quality_classifier.dictionary(good[:30]), quality_classifier.dictionary(bad[:30])
    x = quality_classifier.differences([*good[30:], *bad[30:], ""], a, b)
    assert x[:30].min() > x[30:60].max() and x[60] == 0
    toxic = [prose(30) + f" {RNG.choice(['vilest', 'grimest', 'foulest'])} " + prose(30) for _ in range(60)]
    chain = toxicity.fit(toxic[:40], good[:40])
    assert (chain.predict(toxic[40:])[:, -1] > 0.5).all() and (chain.predict([*good[40:], ""])[:, -1] < 0.5).all()
    assert (toxicity.fit([], good).predict(good)[:, -1] < 0.5).all()


def test_byte_bpe_long_words():
    path = tokenizers.path("byte_bpe_50k.tiktoken")
    own = byte_bpe.Codec(path, tokenizers.PATTERN)
    enc = tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    letters = lambda n, of: "".join(RNG.choice(of) for _ in range(n))
    texts = ["a" * 20_001, "-" * 30_000, "ab" * 9_999, letters(20_000, "abcdefghijklmnopqrstuvwxyz"), letters(3_000, "etaoin"), letters(5_000, "的一是在不了"), " " * 9_999, letters(20_000, "ABCDwxyz0189+/"), *[letters(RNG.randint(2, 400), "aeinrst") for _ in range(200)]]
    packed = own.encode(texts)
    assert packed == [struct.pack(f"<{len(ids)}I", *ids) for ids in map(enc.encode_ordinary, texts)]
    assert own.decode(packed) == [t.encode() for t in texts]
