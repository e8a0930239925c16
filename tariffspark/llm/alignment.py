"""Alignment of two tokenizers by the bytes that their tokens stand for.

Arrow batches are coded by both tokenizers, and DuckDB aligns the tokens: as tables of byte intervals, many texts on one
axis. An ASOF join finds the A token in which each B token begins, a range join the A tokens that begin inside it: these
are all overlaps, each once. A window sum over the places where two tokens begin together numbers the groups. Pair counts
are partial sums over chunks of documents; Spark adds them up, finds each B id's largest, and hands every chunk the sums of
its own pairs. What is shuffled is a chunk's distinct pairs and, for each document, places in the list of them.

Texts are cut before blanks that follow something other than white space: there both tokenizers begin a token, so a chunk
between blanks has its groups and links to itself, and those of short chunks stay in a cache bounded by bytes. A token table
never holds more than about STEP tokens of A, cut where both sides end, so chunks may have any length. Nulls, empty texts and texts that either side does not give back
byte for byte have no tokens: zeros and an empty digest. Ties for a B id's largest count all count as largest. Repeated rows,
also of one key, count each; null keys are keys like others; further columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .byte_bpe import Codec
from .common import TwoGenerations, document_texts, held, materialise, sliced, text_slices

SLICE, CHUNK_BYTES = 1 << 20, 8 << 20
STEP = 250_000
CACHE_BYTES, LONGEST_KEPT = 64 << 20, 64

#: opens: an A token begins there too. goes_on: the A token ends inside the B token.
_FIRST = """
CREATE OR REPLACE TEMP TABLE first AS
SELECT b.k AS bk, a.k AS ak, b.doc, a.id AS a_id, b.id AS b_id, b.s, b.e, a.s = b.s AS opens, a.e < b.e AS goes_on,
       sum((a.s = b.s)::INTEGER) OVER (ORDER BY b.s) AS own_group
FROM given_b b ASOF JOIN given_a a ON b.s >= a.s
"""
_FURTHER = """
CREATE OR REPLACE TEMP TABLE further AS
SELECT a.k AS ak, f.doc, a.id AS a_id, f.b_id, f.own_group
FROM (SELECT * FROM first WHERE goes_on) f
JOIN (SELECT * FROM given_a a ANTI JOIN (SELECT s FROM first WHERE opens) USING (s)) a ON a.s > f.s AND a.s < f.e
"""
_PAIRS = """
SELECT doc, a_id, b_id FROM (SELECT doc, a_id, b_id FROM first UNION ALL SELECT doc, a_id, b_id FROM further) ORDER BY doc
"""
_GROUPS_A = "SELECT own_group FROM (SELECT ak, own_group FROM first WHERE opens UNION ALL SELECT ak, own_group FROM further) ORDER BY ak"
_GROUPS_B = "SELECT own_group FROM first ORDER BY bk"


def _byte_level() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable ones for themselves, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(rest)}


class ByteLevel:
    """A byte-level BPE of a tokenizer file (JSON). Its merges must make ids in their own order, so that ids are ranks."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, before = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or before != {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": before.get("trim_offsets"), "use_regex": True} or spec["normalizer"] or model.get("ignore_merges") or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix"):
            raise ValueError("only byte-level BPE without normalisation is supported")
        to_byte, added = _byte_level(), {t["id"] for t in spec["added_tokens"]}
        self.raw = {i: t.encode() if i in added else bytes(to_byte[c] for c in t) for t, i in model["vocab"].items()}
        made = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        if any(x >= y for x, y in zip(made, made[1:])):
            raise ValueError("the merges must be in the order of the ids that they make")
        self.encode = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks={r: i for i, r in self.raw.items() if i not in added}, special_tokens={}).encode_ordinary


class Pieces:
    """A sentence-piece model, which puts one blank before a text and has all bytes as pieces."""

    def __init__(self, path: str):
        import sentencepiece

        own = sentencepiece.SentencePieceProcessor(model_file=path)
        if own.encode("a b") != own.encode("a") + own.encode("b"):
            raise ValueError("the model must put a blank before a text")
        blank = own.piece_to_id("▁")
        #: of chunks that begin with the blank that the model would put there
        self.encode = lambda chunks: [x if len(c) > 1 else [blank] for c, x in zip(chunks, own.encode([c[1:] for c in chunks], num_threads=1), strict=True)]
        name = [own.id_to_piece(i) for i in range(own.get_piece_size())]
        self.raw = {i: b"" if own.is_control(i) else bytes([int(p[1:-1], 16)]) if own.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(name)}


class Aligner:
    """Both tokenizers and one DuckDB; kept by each Python worker between its tasks."""

    def __init__(self, path_a: str, pattern: str, path_b: str):
        self.a, self.b = ByteLevel(path_a, pattern), Pieces(path_b)
        self.size_a, self.size_b = (np.array([len(x.raw.get(i, b"")) for i in range(max(x.raw) + 1)], np.int64) for x in (self.a, self.b))
        n_a, n_b = len(self.size_a), len(self.size_b)
        #: a token as the digest has it: A's after a comma, after a semicolon; B's after a comma, after a bar
        self.said = np.array([f"{mark}{i}" for mark, n in ((",", n_a), (";", n_a), (",", n_b), ("|", n_b)) for i in range(n)], object)
        self.base = np.array([0, n_a, 2 * n_a, 2 * n_a + n_b])
        self.chunks = TwoGenerations(CACHE_BYTES, LONGEST_KEPT)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": "", "allocator_flush_threshold": "1MB", "allocator_bulk_deallocation_flush_threshold": "1MB"})

    @staticmethod
    def _chunks(text: str) -> list[str]:
        """The text with a blank before it, cut before every blank that follows something other than white space."""
        if not text:
            return []
        head, *rest = Codec._chunks(text)
        return [" " + head, *rest]

    def align(self, texts: list[str]) -> list[dict]:
        """For each text: n_a, n_b, n_groups, digest, and its links as a << 32 | b."""
        out = []
        for found in self.chunks.resolve([self._chunks(t) for t in texts], self._align_new):
            if not found or min(x[2] for x in found) < 0:  # what one side does not give back
                out.append({"n_a": 0, "n_b": 0, "n_groups": 0, "digest": "", "links": np.zeros(0, np.int64)})
                continue
            said, links, n_a = ";".join([x[0] for x in found]), np.frombuffer(b"".join([x[1] for x in found]), np.int64), sum(x[2] for x in found)
            n_groups = said.count(";") + 1
            # a group of p and q tokens has p + q - 1 links
            out.append({"n_a": n_a, "n_b": len(links) + n_groups - n_a, "n_groups": n_groups, "digest": hashlib.sha256(said.encode()).hexdigest(), "links": links})
        return out

    def _align_new(self, chunks: list[str]) -> dict[str, tuple[str, bytes, int]]:
        """chunk -> (groups as in the digest, packed links, number of A tokens; -1 if a side does not give the chunk back)."""
        out = {}
        for f, t in sliced(chunks, SLICE):
            own = chunks[f:t]
            raw = [c.encode() for c in own]
            both = list(zip(self._encoded_a(own, raw), self.b.encode(own), strict=True))
            whole = b"".join(raw)
            if any(b"".join([x.raw[i] for p in both for i in p[side]]) != whole for side, x in enumerate((self.a, self.b))):
                both = [p if b"".join([self.a.raw[i] for i in p[0]]) == r == b"".join([self.b.raw[i] for i in p[1]]) else ([], []) for p, r in zip(both, raw, strict=True)]
            said, links = self._aligned(both)
            out.update((c, (s, x, len(a) if a else -1)) for c, s, x, (a, _) in zip(own, said, links, both, strict=True))
        return out

    def _encoded_a(self, chunks: list[str], raw: list[bytes]) -> list[list[int]]:
        """The A tokens of each chunk. Chunks that end in something other than white space are coded side by side: the next one begins
        with a blank, where no token reaches across; their sizes tell where each one's tokens end."""
        out, side = [[]] * len(chunks), [k for k, c in enumerate(chunks) if not c[-1].isspace()]
        for k, c in enumerate(chunks):
            if c[-1].isspace():
                out[k] = self.a.encode(c)
        if side:
            ids = self.a.encode("".join([chunks[k] for k in side]))
            upto = np.searchsorted(np.cumsum(self.size_a[ids]), np.cumsum([len(raw[k]) for k in side])) + 1
            for k, x, y in zip(side, [0, *upto.tolist()], upto.tolist(), strict=False):
                out[k] = ids[x:y]
        return out

    def _aligned(self, both: list[tuple[list[int], list[int]]]) -> tuple[list[str], list[bytes]]:
        """For each pair of token lists, which stand for the same bytes, the groups and the packed links; STEP tokens of A at a time."""
        said, links = [""] * len(both), [b""] * len(both)
        a_ids, b_ids = (np.fromiter((i for x in both for i in x[side]), np.int32) for side in (0, 1))
        a_doc, b_doc = (np.repeat(np.arange(len(both), dtype=np.int32), [len(x[side]) for x in both]) for side in (0, 1))
        a_end, b_end = np.cumsum(self.size_a[a_ids]), np.cumsum(self.size_b[b_ids])
        common = np.intersect1d(a_end, b_end, assume_unique=True)
        a_cut = b_cut = 0
        while a_cut < len(a_ids):  # up to the first common end that leaves STEP tokens of A behind
            upto = common[min(np.searchsorted(common, a_end[min(a_cut + STEP, len(a_ids)) - 1]), len(common) - 1)]
            a_to, b_to = int(np.searchsorted(a_end, upto)) + 1, int(np.searchsorted(b_end, upto)) + 1
            tables = [(x[f:t], d[f:t], s[x[f:t]], e[f:t]) for x, d, s, e, f, t in ((a_ids, a_doc, self.size_a, a_end, a_cut, a_to), (b_ids, b_doc, self.size_b, b_end, b_cut, b_to))]
            self._step(said, links, *tables)
            a_cut, b_cut = a_to, b_to
        return said, links

    def _step(self, said: list[str], links: list[bytes], a: tuple, b: tuple) -> None:
        for name, (ids, doc, size, end) in (("given_a", a), ("given_b", b)):
            self.db.register(name, pa.table({"k": np.arange(len(ids), dtype=np.int32), "doc": doc, "id": ids, "s": end - size, "e": end}))
        self.db.execute(_FIRST)
        self.db.execute(_FURTHER)
        pairs = self.db.execute(_PAIRS).fetchnumpy()
        group_a, group_b = (self.db.execute(q).fetchnumpy()["own_group"].astype(np.int64) for q in (_GROUPS_A, _GROUPS_B))
        for name in ("given_a", "given_b"):
            self.db.unregister(name)
        key = pairs["a_id"].astype(np.int64) << 32 | pairs["b_id"]
        for d, x, y in _runs(pairs["doc"]):
            links[d] += key[x:y].tobytes()
        # the tokens in the digest's order: by group, A's before B's
        side = np.concatenate([2 * group_a, 2 * group_b + 1])
        order = np.argsort(side, kind="stable")
        side = side[order]
        kind = 2 * (side & 1) + np.append(True, side[1:] != side[:-1])
        words = self.said[self.base[kind] + np.concatenate([a[0], b[0]])[order]].tolist()
        for d, x, y in _runs(np.concatenate([a[1], b[1]])[order]):
            text = "".join(words[x:y])
            said[d] += text if said[d] else text[1:]


def _runs(sorted_ids: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(id, from, to) of each run of equal ids."""
    ids, start = np.unique(sorted_ids, return_index=True)
    return zip(ids.tolist(), start.tolist(), [*start.tolist()[1:], len(sorted_ids)], strict=True)


_DOCUMENT = "chunk string, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, place array<int>, times array<int>, a array<int>, b array<int>, n array<long>"
_SUMS = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _schema(docs: DataFrame, key: str, fields: str) -> StructType:
    return StructType([StructField("key", docs.schema[key].dataType), *StructType.fromDDL(fields).fields])


def _chunked(docs: DataFrame, make, key: str) -> DataFrame:
    """A row for each document, with its chunk, and one for each chunk with its distinct pairs (a, b, n)."""
    schema = _schema(docs, key, _DOCUMENT)
    ints, longs = pa.list_(pa.int32()), pa.list_(pa.int64())

    def document_rows(keys: pa.Array, chunk: str, found: list[dict], known: dict[int, int], sums: list[int]) -> pa.RecordBatch:
        n, links = len(found), np.concatenate([x["links"] for x in found])
        distinct, back, often = np.unique(links, return_inverse=True, return_counts=True)
        number = np.array([known.setdefault(k, len(known)) for k in distinct.tolist()], np.int64)
        sums.extend([0] * (len(known) - len(sums)))
        for k, s in zip(number.tolist(), often.tolist(), strict=True):
            sums[k] += s
        row = np.repeat(np.arange(n), [len(x["links"]) for x in found])
        own, times = np.unique(row << 32 | number[back], return_counts=True)
        offsets = pa.array(np.searchsorted(own >> 32, np.arange(n + 1)), pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(v, pa.int32())) for v in (own & 0xFFFFFFFF, times)]
        longs_of = lambda f: pa.array([f(x) for x in found], pa.int64())
        return pa.RecordBatch.from_arrays([keys, pa.array([chunk] * n), longs_of(lambda x: x["n_a"]), longs_of(lambda x: x["n_b"]), longs_of(lambda x: x["n_groups"]), longs_of(lambda x: len(x["links"])), pa.array([x["digest"] for x in found]), *lists, pa.nulls(n, ints), pa.nulls(n, ints), pa.nulls(n, longs)], names=schema.names)

    def chunk_row(kind: pa.DataType, chunk: str, known: dict[int, int], sums: list[int]) -> pa.RecordBatch:
        pairs = np.fromiter(known, np.int64, len(known))
        one = lambda v, t: pa.array([v], pa.list_(t))
        return pa.RecordBatch.from_arrays([pa.nulls(1, kind), pa.array([chunk]), *[pa.nulls(1, pa.int64())] * 4, pa.nulls(1, pa.string()), pa.nulls(1, ints), pa.nulls(1, ints), one((pairs >> 32).astype(np.int32), pa.int32()), one((pairs & 0xFFFFFFFF).astype(np.int32), pa.int32()), one(np.array(sums, np.int64), pa.int64())], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, known, sums, size, kind = TaskContext.get().partitionId(), 0, {}, [], 0, None
        with make() as own:
            for batch in batches:
                kind = batch.column(0).type
                for a, b, texts in text_slices(batch.column(1), SLICE):
                    yield document_rows(batch.column(0).slice(a, b - a), f"{part}-{number}", own.align(texts), known, sums)
                    size += sum(map(len, texts))
                    if size >= CHUNK_BYTES:
                        yield chunk_row(kind, f"{part}-{number}", known, sums)
                        number, known, sums, size = number + 1, {}, [], 0
            if known:
                yield chunk_row(kind, f"{part}-{number}", known, sums)

    return document_texts(docs, key).mapInArrow(run, schema)


def aligned(docs: DataFrame, path_a: str, pattern: str, path_b: str, key: str = "doc_id") -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for each row of docs(key, text).

    n_best: links whose pair's count is the largest of its B id; count_sum: their pairs' counts, added up over the links.
    """
    make = lambda: held((path_a, pattern, path_b), lambda: Aligner(path_a, pattern, path_b))
    found = materialise(_chunked(docs, make, key))
    pairs = found.where(F.col("a").isNotNull()).select("chunk", F.posexplode(F.arrays_zip("a", "b", "n")).alias("place", "x")).select("chunk", "place", "x.a", "x.b", "x.n")
    counts = pair_counts(pairs)
    valued = pairs.join(counts, ["a", "b"]).select(F.col("chunk").alias("own_chunk"), "place", "total", "is_best")
    schema = _schema(docs, key, _SUMS)

    def summed(rows: pa.Table, values: pa.Table) -> pa.Table:
        order = np.argsort(values.column("place").to_numpy())
        total = values.column("total").to_numpy()[order]
        best = values.column("is_best").to_numpy()[order].astype(np.int64)
        own = rows.combine_chunks()
        lists = own.column("place").combine_chunks()
        place, times = lists.flatten().to_numpy(), own.column("times").combine_chunks().flatten().to_numpy().astype(np.int64)
        row = np.repeat(np.arange(len(own)), np.diff(lists.offsets.to_numpy()))
        sums = []
        for v in (best, total):
            out = np.zeros(len(own), np.int64)
            if len(place):
                np.add.at(out, row, v[place] * times)
            sums.append(pa.array(out))
        return pa.Table.from_arrays([*[own.column(c) for c in ("key", "n_a", "n_b", "n_groups", "n_links")], *sums, own.column("groups_sha256")], schema=pa.schema([(f, t) for f, t in zip(schema.names, [own.column("key").type, *[pa.int64()] * 6, pa.string()], strict=True)]))

    rows = found.where(F.col("a").isNull()).drop("a", "b", "n")
    done = rows.groupBy("chunk").cogroup(valued.groupBy("own_chunk")).applyInArrow(summed, schema)
    return done.withColumnRenamed("key", key)


def pair_counts(pairs: DataFrame) -> DataFrame:
    """(a, b, total, is_best) from partial counts (a, b, n); is_best: no other A id has more with that B id."""
    counts = pairs.groupBy("a", "b").agg(F.sum("n").alias("total"))
    top = counts.groupBy("b").agg(F.max("total").alias("top"))
    return counts.join(top, "b").select("a", "b", "total", (F.col("total") == F.col("top")).alias("is_best"))
