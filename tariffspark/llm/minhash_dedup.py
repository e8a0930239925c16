"""Near-duplicate documents: circulant MinHash, banding, exact Jaccard verification.

Two permutations of 32-bit integers serve all coordinates of a signature: the first scatters the
shingles, and the second, shifted circularly by k, gives coordinate k:
sig[k] = min over shingles x of P((S(x) + k) mod 2^32). Consecutive coordinates form bands.

1. Signatures: one pass over the texts; a document leaves its set's size, a fingerprint of the
   set and its band keys. Documents with the same set are collapsed at once (partial minimum): a group of
   copies, however large, is one node from here on, and a node's text is one that has just its set.
2. Every bucket of two or more names its most crowded member as hub (the one whose bands collide
   most, the likely original) and proposes (member, hub) pairs: linear in the bucket. Members meet their
   bucket's rows salted, so that a bucket's rows are dealt to several tasks.
3. Proposed pairs whose set sizes allow the threshold are verified on the full sets, recomputed from
   the texts of just these nodes.
4. Members other than the hub of a bucket that are still in several components get HUBS - 1 further hubs
   in turn; a bucket of up to HUBS + 1 members is then settled.
5. Larger buckets that are still in several components are finished without a cap: their members
   meet in tiles of bounded size (members of the bucket's largest component only meet the others),
   each tile is verified by products of incidence matrices and returns a forest of its links.
6. Keys come in only now: a key with several sets ties them together, and each component is named by
   its least key.

Expected chance to propose a pair at the threshold itself is 1 - (1 - t^rows)^bands
(defaults at 0.85: 0.99998). Shingles are compared as 64-bit hashes.

Keys may be of any type that can be ordered. Null and empty texts have the empty set: they link with
nothing. Texts with fewer words than a shingle are one shingle. Rows that repeat a key are one node: linked
if any of their texts is; each row returns, with its own set's size. Rows with a null key return with a null
component and are kept; they link nothing. Very long texts are taken whole. Input columns other than the key
and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import document_texts, materialise, sliced, text_slices, typed
from .components import components
from .wordarrays import mix64, sets_of

BANDS, ROWS = 28, 7
TILE = 256
HUBS = 3
#: Up to so many candidates (two longs and a key each) are broadcast to pick their texts; more are joined by sorting.
BROADCAST_IDS = 1_000_000
#: A bucket's members are dealt to SALTS tasks until its size is known, then to one for each SPLIT members.
SALTS, SPLIT = 8, 512


def _scatter(x: np.ndarray) -> np.ndarray:
    """S: a permutation of 32-bit integers."""
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    x = (x ^ (x >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return x ^ (x >> np.uint32(16))


def _permute(x: np.ndarray) -> np.ndarray:
    """P: another one, in place; x is a scratch array."""
    t = x >> np.uint32(16)
    np.bitwise_xor(x, t, out=x)
    np.multiply(x, np.uint32(0x7FEB352D), out=x)
    np.right_shift(x, np.uint32(15), out=t)
    np.bitwise_xor(x, t, out=x)
    np.multiply(x, np.uint32(0x846CA68B), out=x)
    np.right_shift(x, np.uint32(16), out=t)
    return np.bitwise_xor(x, t, out=x)


def signatures(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """A row of `coordinates` minima for each set that is not empty."""
    flat = np.concatenate(sets)
    first = np.cumsum([0, *map(len, sets)])[:-1]
    base = _scatter((flat ^ (flat >> np.uint64(32))).astype(np.uint32))
    out = np.empty((len(sets), coordinates), np.uint32)
    block = 1 << 16
    edges = [0]
    for i in range(1, len(sets)):
        if first[i] - first[edges[-1]] >= block:
            edges.append(i)
    for a, b in zip(edges, [*edges[1:], len(sets)], strict=True):
        part = base[first[a] : first[b] if b < len(sets) else len(base)]
        starts = first[a:b] - first[a]
        for k in range(coordinates):
            out[a:b, k] = np.minimum.reduceat(_permute(part + np.uint32(k)), starts)
    return out


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = sig.astype(np.uint64).reshape(len(sig), bands, rows)
    key = np.broadcast_to(np.arange(bands, dtype=np.uint64), parts.shape[:2]).copy()
    for r in range(rows):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, r])
    return key.view(np.int64)


def _signed(docs: DataFrame, key: str, size: int, bands: int, rows: int) -> DataFrame:
    """(key, text_hash, n_shingles, set_a, set_b, keys) of each document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in text_slices(batch.column(2)):
                sets = sets_of(texts, size)
                n = np.array([len(s) for s in sets], np.int64)
                print_a = np.array([int(np.add.reduce(mix64(s))) if len(s) else 0 for s in sets], np.uint64).view(np.int64)
                print_b = np.array([int(np.bitwise_xor.reduce(mix64(s + np.uint64(0x5851F42D4C957F2D)))) if len(s) else 0 for s in sets], np.uint64).view(np.int64)
                some = np.flatnonzero(n)
                keys = pa.array([None] * len(sets), pa.list_(pa.int64()))
                if len(some):
                    found = band_keys(signatures([sets[i] for i in some], bands * rows), bands, rows)
                    ends = np.zeros(len(sets) + 1, np.int32)
                    ends[1:] = np.cumsum((n > 0) * bands)
                    keys = pa.ListArray.from_arrays(pa.array(ends), pa.array(found.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(n), pa.array(print_a), pa.array(print_b), keys], names=schema.names)

    given = _hashed(docs, key).select("key", "text_hash", "text")
    schema = typed(given, "key", "text_hash long, n_shingles long, set_a long, set_b long, keys array<long>")
    return given.mapInArrow(run, schema)


def _hashed(docs: DataFrame, key: str) -> DataFrame:
    """(key, text, text_hash); text_hash tells the texts of one key apart."""
    return document_texts(docs, key).toDF("key", "text").withColumn("text_hash", F.xxhash64("text"))


def _texts_of(docs: DataFrame, key: str, nodes: DataFrame) -> DataFrame:
    """(id, text), one row for each of nodes(id, first: struct of key and text_hash)."""
    wanted = nodes.select("id", F.col("first.key").alias("own_key"), F.col("first.text_hash").alias("text_hash"))
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    found = _hashed(docs, key).join(wanted, "text_hash").where(F.col("key").eqNullSafe(F.col("own_key")))
    return found.groupBy("id").agg(F.min("text").alias("text"))


def _verify_pairs(pairs: DataFrame, size: int, percent: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            keep = []
            for a, b in sliced(left):
                for i, (x, y) in enumerate(zip(sets_of(left[a:b], size), sets_of(right[a:b], size), strict=True), a):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    if both and 100 * both >= percent * (len(x) + len(y) - both):
                        keep.append(i)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep, pa.int64())), batch.column(1).take(pa.array(keep, pa.int64()))], names=["u", "v"])

    return pairs.select("u", "v", "left_text", "right_text").mapInArrow(run, "u long, v long")


def links_in_tile(ids: np.ndarray, sides: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A forest of the links (i, j) of a tile, i on side 0 and j on side 1, or both on side 0 if there is no other."""
    flat = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    value, column, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = times[column] > 1  # what one document alone has meets nothing
    order = np.argsort(column[shared], kind="stable")
    row, column = row[shared][order], column[shared][order]
    count = np.array([len(s) for s in sets])
    a = np.flatnonzero(sides == 0)
    b = np.flatnonzero(sides == 1) if (sides == 1).any() else a
    meet = np.zeros((len(a), len(b)), np.float32)
    width = 4096
    kept = np.unique(column)
    column = np.searchsorted(kept, column)
    cuts = np.searchsorted(column, np.arange(0, len(kept) + width, width))
    for k, (x, y) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        block = np.zeros((len(sets), width), np.float32)
        block[row[x:y], column[x:y] - k * width] = 1
        meet += block[a] @ block[b].T
    linked = 100 * meet >= percent * (count[a][:, None] + count[b][None, :] - meet)
    parent = list(range(len(sets)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    forest = []
    for i, j in zip(*np.nonzero(linked), strict=True):
        p, q = root(int(a[i])), root(int(b[j]))
        if p != q:
            parent[max(p, q)] = min(p, q)
            forest.append((int(ids[a[i]]), int(ids[b[j]])))
    return forest


def _parts(crowd) -> F.Column:
    """Into how many parts a bucket's members are dealt."""
    return F.greatest(F.lit(1), F.ceil(crowd / SPLIT)).cast("int")


def _own_part() -> F.Column:
    return F.pmod(F.xxhash64("id"), _parts(F.col("crowd")))


def _every_part(n: F.Column) -> F.Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), n.cast("long") - 1))


def _rest(open_members: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Links between members of a bucket that are in different components.

    open_members(bucket, id, crowd, component). side 1: the largest component of the bucket.
    """
    sizes = open_members.groupBy("bucket", "component").agg(F.count("*").alias("n"), F.any_value("crowd").alias("crowd"))
    by_bucket = sizes.groupBy("bucket").agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.max("n").alias("n_main"), F.sum("n").alias("n_all"), F.any_value("crowd").alias("crowd"))
    by_bucket = by_bucket.select("bucket", "main", "n_main", "n_all", _every_part(_parts(F.col("crowd"))).alias("part"))
    tiles = lambda n: F.ceil(n / TILE)
    rows = open_members.withColumn("part", _own_part()).join(by_bucket, ["bucket", "part"]).select(
        "bucket", "id", (F.col("component") == F.col("main")).cast("int").alias("side"),
        tiles(F.col("n_all") - F.col("n_main")).alias("t0"), tiles(F.col("n_main")).alias("t1"),
    )
    own = F.pmod(F.xxhash64("id"), F.when(F.col("side") == 1, F.col("t1")).otherwise(F.col("t0")))
    name = lambda kind, i, j: F.struct(F.lit(kind).alias("kind"), i.cast("long").alias("i"), j.cast("long").alias("j"))
    upto = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    units = F.when(F.col("side") == 1, F.transform(upto(F.col("t0")), lambda i: name("main", i, F.col("tile")))).otherwise(
        F.concat(F.transform(upto(F.col("t0")), lambda j: name("own", F.least("tile", j), F.greatest("tile", j))), F.transform(upto(F.col("t1")), lambda j: name("main", F.col("tile"), j)))
    )
    placed = rows.withColumn("tile", own).select("bucket", "id", "side", F.explode(units).alias("unit")).join(texts, "id")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("id")
        sets = sets_of(pdf["text"].tolist(), size)
        found = links_in_tile(pdf["id"].to_numpy(), pdf["side"].to_numpy(), sets, percent)
        return pd.DataFrame(found, columns=["u", "v"], dtype="int64")

    return placed.groupBy("bucket", "unit").applyInPandas(run, "u long, v long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", size: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(key, n_shingles, component_id, kept) for each row of docs(key, text).

    Linked: 100 * |A & B| >= percent * |A | B| for the sets of distinct lower-cased (A-Z) shingles of `size` words.
    component_id: the least key reachable by links; kept: it is the row's own key.
    """
    fingerprint = ["set_a", "set_b", "n_shingles"]
    signed = materialise(_signed(docs, key, size, bands, rows))
    some = signed.where("key is not null and n_shingles > 0")
    sets = some.groupBy(*fingerprint).agg(F.min(F.struct("key", "text_hash")).alias("first"), F.any_value("keys").alias("keys"))
    sets = materialise(sets.withColumn("id", F.monotonically_increasing_id()))  # fixed by being written
    drawn = sets.select("id", F.col("n_shingles").alias("n"), F.explode("keys").alias("bucket"))
    crowd = drawn.groupBy("bucket").agg(F.count("*").alias("crowd")).where("crowd > 1")
    dealt = drawn.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    member = materialise(dealt.join(crowd.withColumn("part", _every_part(F.lit(SALTS))), ["bucket", "part"]).drop("part"))
    pull = member.groupBy("id").agg(F.sum("crowd").alias("pull"))
    member = materialise(member.join(pull, "id"), member)
    texts = materialise(_texts_of(docs, key, sets.join(member.select("id").distinct(), "id", "left_semi")))
    links = found = None
    rest = member.withColumn("component", F.col("id"))
    spent = []
    for _ in range(HUBS):
        hub = rest.groupBy("bucket").agg(F.max_by(F.struct("id", "n", "component"), F.struct("pull", -F.col("id"))).alias("hub"), F.any_value("crowd").alias("hub_crowd"))
        hub = hub.select("bucket", "hub", _every_part(_parts(F.col("hub_crowd"))).alias("part"))
        met = materialise(rest.withColumn("part", _own_part()).join(hub, ["bucket", "part"]).where(F.col("id") != F.col("hub.id")).drop("part"), *spent)
        fits = F.least("n", "hub.n") * 100 >= F.greatest("n", "hub.n") * percent
        pairs = met.where(fits & (F.col("component") != F.col("hub.component"))).select(F.col("id").alias("u"), F.col("hub.id").alias("v")).distinct()
        with_texts = pairs.join(texts.select(F.col("id").alias("u"), F.col("text").alias("left_text")), "u").join(texts.select(F.col("id").alias("v"), F.col("text").alias("right_text")), "v")
        fresh = materialise(_verify_pairs(with_texts, size, percent))
        links = fresh if links is None else links.union(fresh)
        if found is None or not fresh.isEmpty():
            found = components(links)
        rest = met.drop("hub", "component").join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
        split = rest.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.any_value("crowd").alias("split_crowd")).where("low <> high")
        split = split.select("bucket", _every_part(_parts(F.col("split_crowd"))).alias("part"))
        rest = materialise(rest.withColumn("part", _own_part()).join(split, ["bucket", "part"]).select("id", "n", "bucket", "crowd", "pull", "component"))
        spent = [met, rest]
    left = materialise(_rest(rest.select("bucket", "id", "crowd", "component"), texts, size, percent))
    if not left.isEmpty():
        links = links.union(left)
        found = components(links)
    placed = signed.select("key", "n_shingles", "set_a", "set_b").join(sets.select(*fingerprint, "id", F.col("first.key").alias("least")), fingerprint, "left")
    placed = materialise(placed.select("key", "n_shingles", F.when(F.col("key").isNotNull(), F.col("id")).alias("id"), "least"), member, texts, *spent)
    again = materialise(placed.where("key is not null").groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("low"), F.max("id").alias("high")).where("n > 1").select("key", "low", "high"))
    ties = placed.where("id is not null").join(again.where("low <> high"), "key").select(F.col("id").alias("u"), F.col("low").alias("v"))
    if not again.where("low <> high").isEmpty():
        found = components(links.union(ties))
    names = found.join(sets.select("id", F.col("first.key").alias("least")), "id").groupBy("component").agg(F.min("least").alias("named"))
    named = materialise(found.join(names, "component").select("id", "named"))
    own = placed.join(named, "id", "left").select("key", "n_shingles", F.coalesce("named", "least", "key").alias("component"))
    if not again.isEmpty():  # all rows of a key, also those without words, bear its component
        by_key = again.join(placed.select("key", "id", "least").where("id is not null").dropDuplicates(["key"]), "key").join(named, "id", "left").select("key", F.coalesce("named", "least").alias("of_key"))
        own = own.join(by_key, "key", "left").select("key", "n_shingles", F.coalesce("of_key", "component").alias("component"))
    component = F.when(F.col("key").isNotNull(), F.col("component"))
    return own.select(F.col("key").alias(key), "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("key"), F.lit(True)).alias("kept"))
